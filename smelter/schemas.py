"""Schema registry: raw and cleaned schemas, keys, personal-data columns, layout and versions.

The column names, types, keys, personal-data lists and layouts below are FIXED VALUES of the data
model: they must equal what producers write and what readers of the tables expect.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

ENTITIES = ("business", "review", "user", "checkin", "tip")

COMPLIMENTS = (
    "compliment_hot", "compliment_more", "compliment_profile", "compliment_cute", "compliment_list",
    "compliment_note", "compliment_plain", "compliment_cool", "compliment_funny", "compliment_writer",
    "compliment_photos",
)

_META = "_ingested_at timestamp, _source_file string, _schema_version bigint, _processed_at timestamp"
_VERSIONED = "is_current boolean, valid_from timestamp, valid_to timestamp, hash_diff bigint"
_COMPLIMENT_DDL = ", ".join(f"{name} bigint" for name in COMPLIMENTS)

# ---- raw (bronze): what the producers write, one JSON object per line --------------------------
_RAW_DDL = {
    "business": "business_id string, name string, address string, city string, state string, "
                "postal_code string, latitude double, longitude double, stars double, "
                "review_count bigint, is_open bigint, attributes string, hours string, categories string",
    "review": "review_id string, user_id string, business_id string, stars double, useful bigint, "
              "funny bigint, cool bigint, text string, date string",
    "user": "user_id string, name string, review_count bigint, yelping_since string, useful bigint, "
            "funny bigint, cool bigint, elite string, friends string, fans bigint, average_stars double, "
            + _COMPLIMENT_DDL,
    "checkin": "business_id string, date string",
    "tip": "user_id string, business_id string, text string, date string, compliment_count bigint",
}

# ---- cleaned (silver) -------------------------------------------------------------------------
_SILVER_DDL = {
    "business": "business_id string, name string, address string, city string, state string, "
                "postal_code string, latitude double, longitude double, stars double, "
                "review_count bigint, is_open bigint, categories string, attributes_json string, "
                f"hours_json string, data_quality_tag string, {_VERSIONED}, {_META}",
    "review": "review_id string, user_id string, business_id string, stars bigint, useful bigint, "
              "funny bigint, cool bigint, text string, word_count bigint, char_length bigint, "
              f"exclamation_count bigint, date date, {_META}",
    "user": "user_id string, name string, review_count bigint, yelping_since date, useful bigint, "
            "funny bigint, cool bigint, elite string, friends string, fans bigint, average_stars double, "
            f"{_COMPLIMENT_DDL}, user_loyalty_tier string, {_VERSIONED}, {_META}",
    "checkin": f"business_id string, date timestamp, {_META}",
    "tip": f"user_id string, business_id string, text string, date date, compliment_count bigint, {_META}",
}

PII = {
    "business": ("name", "address"),
    "review": ("text",),
    "user": ("name", "friends"),
    "checkin": (),
    "tip": ("text",),
}

DESCRIPTIONS = {
    "business_id": "business key",
    "user_id": "user key",
    "review_id": "review key",
    "stars": "rating, 1 to 5",
    "is_open": "1 open, 0 closed",
    "categories": "comma-separated categories",
    "elite": "comma-separated elite years",
    "friends": "comma-separated user keys",
    "is_current": "newest version of its key",
    "valid_from": "version holds from (inclusive)",
    "valid_to": "version holds until (exclusive)",
    "hash_diff": "fingerprint of the tracked columns",
}

SCHEMA_VERSIONS = {entity: 1 for entity in ENTITIES}
SILVER_TABLES = {"business": "businesses", "review": "reviews", "user": "users", "checkin": "checkins", "tip": "tips"}


@dataclass(frozen=True)
class Layout:
    """How a cleaned table lies on storage.

    ``month_of`` names the date column whose month is the partition; ``sort_by`` is the order inside
    each file, so that parquet min/max statistics skip row groups.
    """

    keys: tuple[str, ...]
    month_of: str | None = None
    sort_by: tuple[str, ...] = ()
    tracked: tuple[str, ...] = field(default=())
    append_only: bool = False


LAYOUT = {
    "business": Layout(
        keys=("business_id",),
        sort_by=("business_id",),
        tracked=("name", "address", "city", "state", "postal_code", "stars", "review_count", "is_open", "categories"),
    ),
    "review": Layout(keys=("review_id",), month_of="date", sort_by=("business_id", "stars")),
    "user": Layout(
        keys=("user_id",),
        sort_by=("user_id",),
        tracked=("review_count", "yelping_since", "useful", "funny", "cool", "elite", "friends", "fans", "average_stars"),
    ),
    "checkin": Layout(keys=("business_id", "date"), month_of="date", sort_by=("business_id",), append_only=True),
    "tip": Layout(keys=("user_id", "business_id", "date"), month_of="date", sort_by=("business_id",)),
}

OPEN_END = "9999-12-31 00:00:00"
DEFAULT_SOURCE = "bronze_external_table"


def _with_metadata(schema: T.StructType, entity: str) -> T.StructType:
    return T.StructType([
        T.StructField(f.name, f.dataType, True, {
            "pii": f.name in PII[entity],
            "description": DESCRIPTIONS.get(f.name, f.name.replace("_", " ").strip()),
        })
        for f in schema.fields
    ])


def _known(entity: str) -> str:
    if entity not in ENTITIES:
        raise ValueError(f"unknown entity {entity!r}; known: {', '.join(ENTITIES)}")
    return entity


def bronze_schema(entity: str) -> T.StructType:
    """Raw schema of an entity (parsed by Spark, so a session must exist)."""
    return _with_metadata(T.StructType.fromDDL(_RAW_DDL[_known(entity)]), entity)


def get_schema(entity: str) -> T.StructType:
    """Cleaned schema of an entity, with ``pii`` and ``description`` in each field's metadata."""
    return _with_metadata(T.StructType.fromDDL(_SILVER_DDL[_known(entity)]), entity)


def pii_columns(entity: str) -> list[str]:
    """Names of the columns that hold personal data; empty for an unknown entity."""
    return list(PII.get(entity, ()))


def partition_config(entity: str) -> Layout | None:
    """Keys, month partition and sort order; ``None`` for an unknown entity."""
    return LAYOUT.get(entity)
