"""From raw rows to cleaned rows, one function per entity, and the merge each entity uses.

``stage_*`` functions take raw rows of one batch and return one row per key, ready to merge, together
with the rows to quarantine (a key is missing or does not parse).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.functions.casts import round_int, safe_date, safe_int, safe_timestamp
from smelter.functions.text import char_length, count_char, mask_name, mask_text, word_count
from smelter.operators.dedup import dedup_latest, explode_list, split_null_keys
from smelter.operators.flatten import json_text
from smelter.operators.merge import insert_only_merge, scd1_merge, scd2_merge, with_hash_diff
from smelter.schemas import COMPLIMENTS, LAYOUT, bronze_schema

Instant = datetime | str
Staged = tuple[DataFrame, DataFrame]

# What a matched row takes from the batch.
REVIEW_UPDATES = ["stars", "useful", "funny", "cool", "text", "word_count"]
TIP_UPDATES = ["text", "compliment_count"]


def _lineage(df: DataFrame) -> list[str]:
    return [c for c in ("_source_file",) if c in df.columns]


# Grown columns that the cleaned schema has taken in.
ADOPTED = ("data_quality_tag", "user_loyalty_tier")


def _grown(df: DataFrame, entity: str) -> list[Column]:
    """Columns that schema growth has added to the raw rows, as text."""
    known = {f.name for f in bronze_schema(entity).fields} | {"dt", *ADOPTED}
    return [F.col(f"`{c}`").cast("string").alias(c) for c in df.columns if c not in known and not c.startswith("_") and c != "hash_diff"]


def _trim_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Trim key columns; a blank key counts as missing."""
    return df.withColumns({k: F.nullif(F.trim(F.col(k).cast("string")), F.lit("")) for k in keys})


def stage_businesses(raw: DataFrame, mask_pii: bool = False) -> Staged:
    """Latest row per business with its change fingerprint. ``mask_pii`` masks name and address."""
    keyed, bad = split_null_keys(_trim_keys(raw, "business_id"), ["business_id"])
    latest = dedup_latest(keyed, ["business_id"], ["review_count", "stars"])
    types = dict(latest.dtypes)
    clean = latest.select(
        "business_id", "name", "address", "city", "state", "postal_code",
        F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"),
        F.col("stars").try_cast("double").alias("stars"),
        safe_int(F.col("review_count")).alias("review_count"),
        safe_int(F.col("is_open")).alias("is_open"),
        "categories",
        json_text(F.col("attributes"), latest.schema["attributes"].dataType).alias("attributes_json"),
        json_text(F.col("hours"), latest.schema["hours"].dataType).alias("hours_json"),
        *(["data_quality_tag"] if "data_quality_tag" in types else []),
        *_grown(latest, "business"), *_lineage(latest),
    )
    hashed = with_hash_diff(clean, list(LAYOUT["business"].tracked))
    if mask_pii:
        hashed = hashed.withColumns({"name": mask_name(F.col("name")), "address": mask_name(F.col("address"))})
    return hashed, bad


def stage_users(raw: DataFrame, mask_pii: bool = False, load_compliments: bool = True) -> Staged:
    """Latest row per user. The fingerprint covers the raw values; the name is always masked.

    ``load_compliments=False`` leaves the compliment columns null.
    """
    keyed, bad = split_null_keys(_trim_keys(raw, "user_id"), ["user_id"])
    latest = dedup_latest(keyed, ["user_id"], ["review_count", safe_timestamp(F.col("yelping_since")), "yelping_since"])
    hashed = with_hash_diff(latest, list(LAYOUT["user"].tracked))
    extra = [c for c in ("user_loyalty_tier",) if c in raw.columns]
    compliments = [safe_int(F.col(c)).alias(c) for c in COMPLIMENTS if c in raw.columns] if load_compliments else []
    friends = F.col("friends")
    staged = hashed.select(
        "user_id", mask_name(F.col("name")).alias("name"),
        safe_int(F.col("review_count")).alias("review_count"),
        safe_date(F.col("yelping_since")).alias("yelping_since"),
        *[safe_int(F.col(c)).alias(c) for c in ("useful", "funny", "cool")],
        F.col("elite").cast("string").alias("elite"),
        (F.regexp_replace(friends, r"[^,\s]", "*") if mask_pii else friends).alias("friends"),
        safe_int(F.col("fans")).alias("fans"),
        F.col("average_stars").try_cast("double").alias("average_stars"),
        *compliments, *extra, *_grown(hashed, "user"), "hash_diff", *_lineage(hashed),
    )
    return staged, bad


def stage_reviews(raw: DataFrame) -> Staged:
    """Latest row per review: typed, masked, with measures of the unmasked text."""
    keyed, bad = split_null_keys(_trim_keys(raw, "review_id", "user_id", "business_id"),
                                 ["review_id", "user_id", "business_id"])
    latest = dedup_latest(keyed, ["review_id"], [safe_timestamp(F.col("date")), "date"])
    text = F.col("text")
    staged = latest.select(
        "review_id", "user_id", "business_id",
        round_int(F.col("stars")).alias("stars"),
        *[safe_int(F.col(c)).alias(c) for c in ("useful", "funny", "cool")],
        mask_text(text).alias("text"),
        word_count(text).alias("word_count"),
        char_length(text).alias("char_length"),
        count_char(text, "!").alias("exclamation_count"),
        safe_date(F.col("date")).alias("date"),
        *_grown(latest, "review"), *_lineage(latest),
    )
    return staged, bad


def stage_tips(raw: DataFrame) -> Staged:
    """Latest row per (user, business, day); a tip without a readable day is quarantined."""
    dated = _trim_keys(raw, "user_id", "business_id").withColumn("_day", safe_date(F.col("date")))
    keyed, bad = split_null_keys(dated, ["user_id", "business_id", "_day"])
    latest = dedup_latest(keyed, ["user_id", "business_id", "_day"], [safe_timestamp(F.col("date")), "date"])
    staged = latest.select(
        "user_id", "business_id", mask_text(F.col("text")).alias("text"), F.col("_day").alias("date"),
        safe_int(F.col("compliment_count")).alias("compliment_count"), *_grown(latest, "tip"), *_lineage(latest),
    )
    return staged, bad.drop("_day")


def stage_checkins(raw: DataFrame) -> Staged:
    """One row per (business, instant) out of the comma lists; unreadable instants are quarantined."""
    listed = _trim_keys(raw, "business_id").withColumnRenamed("date", "_list")
    exploded = explode_list(listed, "_list", "date", cast="timestamp")
    keyed, bad = split_null_keys(exploded, ["business_id", "date"])
    # All columns but the lineage are key columns, so min() of the lineage is the whole tie-break.
    lineage = [F.min(c).alias(c) for c in _lineage(keyed)]
    grouped = keyed.groupBy("business_id", "date")
    return (grouped.agg(*lineage) if lineage else grouped.agg(F.count(F.lit(1)).alias("_n")).drop("_n")), bad


def merge_businesses(target: DataFrame, raw: DataFrame, processing_time: Instant, **options) -> DataFrame:
    return scd2_merge(target, stage_businesses(raw, **options)[0], "business_id", processing_time)


def merge_users(target: DataFrame, raw: DataFrame, processing_time: Instant, **options) -> DataFrame:
    return scd2_merge(target, stage_users(raw, **options)[0], "user_id", processing_time)


def merge_reviews(target: DataFrame, raw: DataFrame, processing_time: Instant) -> DataFrame:
    return scd1_merge(target, stage_reviews(raw)[0], ["review_id"], REVIEW_UPDATES, processing_time)


def merge_tips(target: DataFrame, raw: DataFrame, processing_time: Instant) -> DataFrame:
    return scd1_merge(target, stage_tips(raw)[0], ["user_id", "business_id", "date"], TIP_UPDATES, processing_time)


def merge_checkins(target: DataFrame, raw: DataFrame, processing_time: Instant) -> DataFrame:
    return insert_only_merge(target, stage_checkins(raw)[0], ["business_id", "date"], processing_time)
