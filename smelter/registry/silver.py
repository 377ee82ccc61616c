"""Queries: casts, text, masks, deduplication and the merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.functions import casts
from smelter.functions import text as tx
from smelter.operators.dedup import dedup_latest, explode_list
from smelter.operators.merge import as_of, current, scd2_insert_set, with_hash_diff
from smelter.plans import silver
from smelter.registry.standins import lake, ntz, table, text
from smelter.schemas import COMPLIMENTS, OPEN_END
from smelter.sources import tables

T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


# ---- text and masks ----------------------------------------------------------------------------

def pii_mask_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", tx.mask_text(F.col("text")).alias("text"))


def text_enrich(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id", tx.word_count(t).alias("word_count"), tx.char_length(t).alias("char_length"),
        tx.count_char(t, "!").alias("exclamation_count"), tx.list_size(t).alias("list_size"),
        tx.non_empty_flag(t).alias("has_text"))


def mask_name(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("name"))
    texts = table(spark, sf, "documents").select(
        (-F.col("doc_id") - 1).alias("c_custkey"), F.when(F.col("lang") != "de", F.col("text")).alias("name"))
    return names.unionByName(texts).select("c_custkey", tx.mask_name(F.col("name")).alias("name"))


# ---- casts and dates ---------------------------------------------------------------------------

def safe_casts(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    number = F.get_json_object("props", "$.k")
    whole = F.when(c("event_type") == "error", F.concat(number, F.lit("x"))).when(
        c("event_type") == "view", F.concat(number, F.lit(".0"))).otherwise(number)
    moment = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    stamp = F.when(c("event_type") == "click", F.replace(moment, F.lit(" "), F.lit("T"))).when(
        c("event_type") == "error", F.concat(F.lit("on "), moment)).otherwise(F.concat(F.lit(" "), moment))
    return ntz(table(spark, sf, "events").select(
        "event_id", casts.safe_int(whole).alias("int_of_text"), casts.round_int(whole).alias("rounded_text"),
        casts.round_int(c("value")).alias("rounded"), casts.trunc_int(c("value")).alias("truncated"),
        casts.safe_double(whole).alias("double_of_text"), casts.safe_timestamp(stamp).alias("ts_of_text"),
        casts.safe_date(stamp).alias("date_of_text"), casts.plain_date(stamp).alias("plain_date")))


def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.dayofweek(d).alias("day_of_week"), F.month(d).alias("month"), F.year(d).alias("year"),
        casts.month_of(d).alias("month_start"),
        F.datediff(casts.local_today("2002-01-01 18:00:00"), F.to_date(d)).alias("days_ago"))


def run_date(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    return events.groupBy("event_type", casts.local_date(F.col("ts")).alias("run_date")).agg(
        F.count(F.lit(1)).alias("events"))


# ---- deduplication -----------------------------------------------------------------------------

def dedup_newest(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_latest(table(spark, sf, "events"), ["user_id", "event_type"], ["ts"], ["event_id"])


def dedup_two_keys(spark: SparkSession, sf: str) -> DataFrame:
    rest = ["l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    return dedup_latest(table(spark, sf, "lineitem"), ["l_orderkey"], ["l_quantity", "l_extendedprice"], rest)


def dedup_expr_key(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_latest(table(spark, sf, "events"), ["user_id", "event_type", F.to_date("ts")], ["ts"], ["event_id"])


def raw_checkins(spark: SparkSession, sf: str) -> DataFrame:
    """Each event as a comma list: its minute, blanks, nothing, its day, the minute again, and garbage."""
    minute = F.date_format("ts", "yyyy-MM-dd HH:mm:00")
    parts = [minute, F.lit("  "), F.lit(""), F.date_format("ts", "yyyy-MM-dd"), F.concat(F.lit(" "), minute),
             F.when(F.col("event_type") == "error", F.lit("soon")).otherwise(F.lit(""))]
    return table(spark, sf, "events").select(
        F.concat(F.lit(" "), text("user_id")).alias("business_id"), F.concat_ws(",", *parts).alias("date"), "ts")


def checkin_explode(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(silver.stage_checkins(raw_checkins(spark, sf))[0])


def checkin_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    bad = explode_list(raw_checkins(spark, sf).withColumnRenamed("date", "_list"), "_list", "date").where("date IS NULL")
    return bad.groupBy(F.trim("business_id").alias("business_id")).agg(F.count(F.lit(1)).alias("unreadable"))


# ---- versioned dimensions ----------------------------------------------------------------------

def orders_in(spark: SparkSession, sf: str, period: int, through: int | None = None) -> DataFrame:
    """Orders of one (or several) of three consecutive periods that cover the table. A customer has many or none."""
    bounds = ["1900-01-01", "1997-01-01", "1999-01-01", "9999-01-01"]
    d = F.col("o_orderdate")
    orders = table(spark, sf, "orders").where((d >= bounds[period]) & (d < bounds[(period if through is None else through) + 1]))
    size = F.floor(F.col("o_totalprice") / 100000)
    return orders.select("o_custkey", size.alias("size"), F.substring("o_orderpriority", 1, 1).cast("bigint").alias("digit"))


def raw_businesses(spark: SparkSession, sf: str, period: int, through: int | None = None) -> DataFrame:
    """One row per order: the customer as a business, so keys repeat and the merge must deduplicate."""
    null = F.lit(None).cast("string")
    return orders_in(spark, sf, period, through).select(
        text("o_custkey").alias("business_id"), F.concat(F.lit("Shop "), text("o_custkey")).alias("name"),
        null.alias("address"), F.concat(F.lit("City "), text("size")).alias("city"), null.alias("state"),
        null.alias("postal_code"), F.col("digit").cast("double").alias("latitude"), F.lit(1.5).alias("longitude"),
        F.col("digit").cast("double").alias("stars"), F.col("size").alias("review_count"),
        F.when(F.col("size") >= 2, 1).otherwise(0).cast("bigint").alias("is_open"), F.lit("Food, Bars").alias("categories"),
        F.lit('{"k":1}').alias("attributes"), null.alias("hours"))


def raw_users(spark: SparkSession, sf: str, period: int) -> DataFrame:
    rank = F.col("size") * 10 + F.col("digit")
    null = F.lit(None).cast("string")
    return orders_in(spark, sf, period).select(
        F.concat(text("o_custkey"), F.lit(" ")).alias("user_id"), F.concat(F.lit("U"), text("o_custkey")).alias("name"),
        rank.alias("review_count"), F.concat(F.lit("200"), text("digit"), F.lit("-03-04 10:00:00")).alias("yelping_since"),
        F.col("size").alias("useful"), F.col("digit").alias("funny"), F.lit(None).cast("bigint").alias("cool"),
        F.when(F.col("digit") == 1, "2019,2020").otherwise("").alias("elite"), null.alias("friends"),
        F.col("size").alias("fans"), F.col("digit").cast("double").alias("average_stars"),
        *[(rank + i).alias(name) for i, name in enumerate(COMPLIMENTS)])


def business_versions(spark: SparkSession, sf: str) -> DataFrame:
    """The stored dimension after three batches, each of which swaps in the buckets it touches."""
    root = lake(spark)
    for period, at in enumerate((T1, T2, T3)):
        stage, _ = silver.stage_businesses(raw_businesses(spark, sf, period))
        tables.apply_scd2(spark, root, "business", stage, at, batch=f"b{period}")
    return tables.read_silver(spark, root, "business").drop("hash_diff")


def printable_end(df: DataFrame) -> DataFrame:
    """``valid_to`` as text: the open end lies beyond what nanosecond clocks of result viewers can hold."""
    return ntz(df.withColumn("valid_to", F.date_format("valid_to", "yyyy-MM-dd HH:mm:ss")))


def scd2_business(spark: SparkSession, sf: str) -> DataFrame:
    return printable_end(business_versions(spark, sf))


def scd2_user(spark: SparkSession, sf: str) -> DataFrame:
    root = lake(spark)
    for period, at in enumerate((T1, T2, T3)):
        tables.apply_scd2(spark, root, "user", silver.stage_users(raw_users(spark, sf, period))[0], at, batch=f"b{period}")
    return printable_end(tables.read_silver(spark, root, "user").drop("hash_diff"))


def scd2_current(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(current(business_versions(spark, sf)).select("business_id", "city", "stars", "valid_from"))


def scd2_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return printable_end(as_of(business_versions(spark, sf), "2024-02-15 00:00:00").select(
        "business_id", "city", "stars", "valid_from", "valid_to", "is_current"))


def insert_set(spark: SparkSession, sf: str) -> DataFrame:
    root = lake(spark)
    tables.apply_scd2(spark, root, "business", silver.stage_businesses(raw_businesses(spark, sf, 0))[0], T1, batch="b0")
    stage, _ = silver.stage_businesses(raw_businesses(spark, sf, 1, through=2))
    return scd2_insert_set(tables.read_silver(spark, root, "business"), stage, "business_id").select("business_id", "city", "stars")


def hash_change(spark: SparkSession, sf: str) -> DataFrame:
    """Does the fingerprint of a customer's newest order differ from that of its oldest?"""
    cols = ["o_orderstatus", "o_orderpriority", "note"]
    orders = table(spark, sf, "orders").withColumn(
        "note", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    hashed = with_hash_diff(orders, cols)
    order = F.struct("o_orderdate", "o_orderkey")
    return hashed.groupBy("o_custkey").agg(
        (F.max_by("hash_diff", order) != F.min_by("hash_diff", order)).alias("changed"))


# ---- SCD-1 and insert-only ---------------------------------------------------------------------

def raw_reviews(spark: SparkSession, sf: str, batch: int) -> DataFrame:
    """Lines as reviews of their order, newest ship date wins. The two batches overlap by a year."""
    d = F.col("l_shipdate")
    lines = table(spark, sf, "lineitem").where(d < "2000-01-01" if batch == 0 else d >= "1999-01-01")
    day = F.date_format(d, "yyyy-MM-dd")
    votes = F.dayofyear(d).cast("bigint") + batch * 1000
    return lines.select(
        text("l_orderkey").alias("review_id"), F.concat(F.lit("u"), text("l_orderkey")).alias("user_id"),
        F.lit("b").alias("business_id"), (F.month(d) / 2).alias("stars"), votes.alias("useful"),
        (votes % 7).alias("funny"), F.when(votes % 2 == 0, votes).alias("cool"),
        F.concat(F.lit("Sent "), day, F.lit("!! mail a.b-"), F.lit(batch), F.lit("@shop.example  or (555) 123-4567 !")).alias("text"),
        F.concat(day, F.lit("T10:00:00")).alias("date"))


def merge_scd1(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews merged twice into a stored monthly table; a batch reads and rewrites the months it touches."""
    root = lake(spark)
    for batch, at in enumerate((T1, T2)):
        tables.apply_scd1(spark, root, "review", silver.stage_reviews(raw_reviews(spark, sf, batch))[0], silver.REVIEW_UPDATES, at)
    return ntz(tables.read_silver(spark, root, "review"))


def raw_tips(spark: SparkSession, sf: str, batch: int) -> DataFrame:
    ts = F.col("ts")
    events = table(spark, sf, "events").where(ts < "2024-01-20" if batch == 0 else ts >= "2024-01-10")
    return events.select(
        text("user_id").alias("user_id"), F.col("event_type").alias("business_id"),
        F.concat(F.lit("call 5551234567: "), F.col("props")).alias("text"), text("ts").alias("date"),
        (F.floor("value") + batch * 1000).alias("compliment_count"))


def merge_scd1_multi(spark: SparkSession, sf: str) -> DataFrame:
    root = lake(spark)
    for batch, at in enumerate((T1, T2)):
        tables.apply_scd1(spark, root, "tip", silver.stage_tips(raw_tips(spark, sf, batch))[0], silver.TIP_UPDATES, at)
    return ntz(tables.read_silver(spark, root, "tip"))


def merge_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches that overlap by ten days; of the second, only months that may hold one of its keys are read."""
    root, raw = lake(spark), raw_checkins(spark, sf)
    for days, at in (("ts < '2024-01-20'", T1), ("ts >= '2024-01-10'", T2)):
        tables.apply_insert_only(spark, root, "checkin", silver.stage_checkins(raw.where(days).drop("ts"))[0], at)
    return ntz(tables.read_silver(spark, root, "checkin"))


QUERIES = {
    "pii_mask_text": pii_mask_text, "text_enrich": text_enrich, "mask_name": mask_name,
    "safe_casts": safe_casts, "date_parts": date_parts, "run_date": run_date,
    "dedup_latest": dedup_newest, "dedup_two_keys": dedup_two_keys, "dedup_expr_key": dedup_expr_key,
    "checkin_explode": checkin_explode, "checkin_quarantine": checkin_quarantine,
    "hash_change": hash_change, "scd2_insert_set": insert_set, "scd2_business": scd2_business, "scd2_user": scd2_user,
    "scd2_current": scd2_current, "scd2_as_of": scd2_as_of,
    "merge_scd1": merge_scd1, "merge_scd1_multi": merge_scd1_multi, "merge_insert_only": merge_insert_only,
}

_MASKED = (r"regexp_replace(regexp_replace({0}, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{{2,}}', '[EMAIL]', 'g'), "
           r"'\(?\d{{3}}\)?[\s.-]?\d{{3}}[\s.-]?\d{{4}}', '[PHONE]', 'g')")

# Independent of the merge: versions are the changes in the sequence of a key's states.
_VERSIONS = f"""
    WITH src AS (
        SELECT o_custkey AS k, CAST(floor(o_totalprice / 100000) AS BIGINT) * 10 + CAST(left(o_orderpriority, 1) AS BIGINT) AS v,
            CASE WHEN o_orderdate < '1997-01-01' THEN TIMESTAMP '{T1}' WHEN o_orderdate < '1999-01-01'
                THEN TIMESTAMP '{T2}' ELSE TIMESTAMP '{T3}' END AS batch_ts FROM orders),
    state AS (SELECT k, batch_ts, max(v) AS v FROM src GROUP BY 1, 2),
    step AS (SELECT *, lag(v) OVER (PARTITION BY k ORDER BY batch_ts) AS before FROM state),
    versions AS (
        SELECT k, v, v // 10 AS size, v % 10 AS digit, batch_ts AS valid_from, lead(batch_ts) OVER (PARTITION BY k ORDER BY batch_ts) AS closed
        FROM step WHERE before IS NULL OR before <> v)
"""
_VERSION_COLUMNS = f"""closed IS NULL AS is_current, valid_from,
    strftime(coalesce(closed, TIMESTAMP '{OPEN_END}'), '%Y-%m-%d %H:%M:%S') AS valid_to, valid_from AS _ingested_at, 'bronze_external_table' AS _source_file, CAST(1 AS BIGINT) AS _schema_version,
    coalesce(closed, valid_from) AS _processed_at"""

_CHECKINS = """
    WITH item AS (
        SELECT CAST(user_id AS VARCHAR) AS business_id, ts, unnest([date_trunc('minute', ts), date_trunc('day', ts)]) AS date
        FROM events)
"""

ORACLE = {
    "pii_mask_text": f"SELECT doc_id, {_MASKED.format('text')} AS text FROM documents",
    "text_enrich": """
        SELECT doc_id, CAST(len(string_split(text, ' ')) AS BIGINT) AS word_count, CAST(length(text) AS BIGINT) AS char_length,
            CAST(length(regexp_replace(text, '[^!]', '', 'g')) AS BIGINT) AS exclamation_count,
            CAST(len(string_split(text, ',')) AS BIGINT) AS list_size,
            CAST(CASE WHEN length(text) > 0 THEN 1 ELSE 0 END AS BIGINT) AS has_text
        FROM documents""",
    "mask_name": """
        WITH n AS (SELECT c_custkey, c_name AS name FROM customer
                   UNION ALL SELECT -doc_id - 1, CASE WHEN lang <> 'de' THEN text END FROM documents)
        SELECT c_custkey, CASE WHEN length(name) > 0 THEN left(name, 1) || repeat('*', length(name) - 1)
            ELSE 'Anonymous' END AS name FROM n""",
    "safe_casts": """
        WITH e AS (SELECT *, json_extract_string(props, '$.k') AS k FROM events)
        SELECT event_id,
            CASE WHEN event_type NOT IN ('error', 'view') THEN CAST(k AS BIGINT) END AS int_of_text,
            CASE WHEN event_type <> 'error' THEN CAST(k AS BIGINT) END AS rounded_text,
            CAST(round(value) AS BIGINT) AS rounded, CAST(trunc(value) AS BIGINT) AS truncated,
            CASE WHEN event_type <> 'error' THEN CAST(k AS DOUBLE) END AS double_of_text,
            CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS ts_of_text,
            CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END AS date_of_text,
            CASE WHEN event_type NOT IN ('error', 'click') THEN CAST(ts AS DATE) END AS plain_date
        FROM e""",
    "date_parts": """
        SELECT o_orderkey, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week,
            CAST(month(o_orderdate) AS INTEGER) AS month, CAST(year(o_orderdate) AS INTEGER) AS year,
            CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
            CAST(DATE '2002-01-02' - CAST(o_orderdate AS DATE) AS INTEGER) AS days_ago
        FROM orders""",
    "run_date": """
        SELECT event_type, CAST(ts + INTERVAL 7 HOUR AS DATE) AS run_date, count(*) AS events FROM events GROUP BY 1, 2""",
    "dedup_latest": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
            ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "dedup_two_keys": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
            ORDER BY l_quantity DESC, l_extendedprice DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC,
                l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC, l_shipdate DESC) AS rn
            FROM lineitem) WHERE rn = 1""",
    "dedup_expr_key": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
            ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "checkin_explode": _CHECKINS + "SELECT DISTINCT business_id, date FROM item",
    "checkin_quarantine": """
        SELECT CAST(user_id AS VARCHAR) AS business_id, count(*) AS unreadable FROM events
        WHERE event_type = 'error' GROUP BY 1""",
    "hash_change": """
        WITH o AS (SELECT o_custkey, o_orderstatus || o_orderpriority AS state, o_orderdate, o_orderkey FROM orders)
        SELECT o_custkey, arg_max(state, (o_orderdate, o_orderkey)) <> arg_min(state, (o_orderdate, o_orderkey)) AS changed
        FROM o GROUP BY 1""",
    "scd2_insert_set": _VERSIONS + f""", two AS (
            SELECT k, max(v) FILTER (batch_ts = TIMESTAMP '{T1}') AS v0, max(v) FILTER (batch_ts > TIMESTAMP '{T1}') AS v1
            FROM src GROUP BY 1)
        SELECT CAST(k AS VARCHAR) AS business_id, 'City ' || v1 // 10 AS city, CAST(v1 % 10 AS DOUBLE) AS stars
        FROM two WHERE v1 IS NOT NULL AND (v0 IS NULL OR v0 <> v1)""",
    "scd2_business": _VERSIONS + f"""
        SELECT CAST(k AS VARCHAR) AS business_id, 'Shop ' || k AS name, CAST(NULL AS VARCHAR) AS address,
            'City ' || size AS city, CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS postal_code,
            CAST(digit AS DOUBLE) AS latitude, CAST(1.5 AS DOUBLE) AS longitude, CAST(digit AS DOUBLE) AS stars,
            size AS review_count, CAST(size >= 2 AS BIGINT) AS is_open, 'Food, Bars' AS categories,
            '{{"k":1}}' AS attributes_json, CAST(NULL AS VARCHAR) AS hours_json, CAST(NULL AS VARCHAR) AS data_quality_tag,
            {_VERSION_COLUMNS} FROM versions""",
    "scd2_user": _VERSIONS + f"""
        SELECT CAST(k AS VARCHAR) AS user_id, 'U' || repeat('*', length(CAST(k AS VARCHAR))) AS name, v AS review_count,
            CAST('200' || digit || '-03-04' AS DATE) AS yelping_since, size AS useful, digit AS funny,
            CAST(NULL AS BIGINT) AS cool, CASE WHEN digit = 1 THEN '2019,2020' ELSE '' END AS elite,
            CAST(NULL AS VARCHAR) AS friends, size AS fans, CAST(digit AS DOUBLE) AS average_stars,
            {', '.join(f'v + {i} AS {name}' for i, name in enumerate(COMPLIMENTS))},
            CAST(NULL AS VARCHAR) AS user_loyalty_tier, {_VERSION_COLUMNS} FROM versions""",
    "scd2_current": _VERSIONS + """
        SELECT CAST(k AS VARCHAR) AS business_id, 'City ' || size AS city, CAST(digit AS DOUBLE) AS stars, valid_from
        FROM versions WHERE closed IS NULL""",
    "scd2_as_of": _VERSIONS + f"""
        SELECT CAST(k AS VARCHAR) AS business_id, 'City ' || size AS city, CAST(digit AS DOUBLE) AS stars, valid_from,
            strftime(coalesce(closed, TIMESTAMP '{OPEN_END}'), '%Y-%m-%d %H:%M:%S') AS valid_to, closed IS NULL AS is_current
        FROM versions WHERE valid_from <= TIMESTAMP '2024-02-15' AND coalesce(closed, TIMESTAMP '{OPEN_END}') > TIMESTAMP '2024-02-15'""",
    "merge_scd1": f"""
        WITH pick AS (SELECT l_orderkey AS k, max(l_shipdate) FILTER (l_shipdate < '2000-01-01') AS d1,
                          max(l_shipdate) FILTER (l_shipdate >= '1999-01-01') AS d2 FROM lineitem GROUP BY 1),
        p AS (SELECT k, d1, d2, coalesce(d1, d2) AS first, coalesce(d2, d1) AS last FROM pick),
        q AS (SELECT *, dayofyear(last) + CASE WHEN d2 IS NULL THEN 0 ELSE 1000 END AS votes,
                  CASE WHEN d2 IS NULL THEN 0 ELSE 1 END AS batch,
                  CASE WHEN d1 IS NULL THEN 1 ELSE 0 END AS batch0 FROM p)
        SELECT CAST(k AS VARCHAR) AS review_id, 'u' || k AS user_id, 'b' AS business_id,
            CAST(floor(month(last) / 2 + 0.5) AS BIGINT) AS stars, votes AS useful, votes % 7 AS funny,
            CASE WHEN votes % 2 = 0 THEN votes END AS cool,
            'Sent ' || strftime(last, '%Y-%m-%d') || '!! mail [EMAIL]  or [PHONE] !' AS text,
            CAST(9 AS BIGINT) AS word_count,
            CAST(length('Sent 2000-01-01!! mail a.b-0@shop.example  or (555) 123-4567 !') AS BIGINT) AS char_length,
            CAST(3 AS BIGINT) AS exclamation_count, CAST(first AS DATE) AS date,
            CASE batch0 WHEN 0 THEN TIMESTAMP '{T1}' ELSE TIMESTAMP '{T2}' END AS _ingested_at,
            'bronze_external_table' AS _source_file, CAST(1 AS BIGINT) AS _schema_version,
            CASE batch WHEN 0 THEN TIMESTAMP '{T1}' ELSE TIMESTAMP '{T2}' END AS _processed_at FROM q""",
    "merge_scd1_multi": f"""
        WITH day AS (SELECT user_id, event_type, CAST(ts AS DATE) AS date, arg_max(props, ts) AS props,
                         arg_max(value, ts) AS value FROM events GROUP BY 1, 2, 3)
        SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS business_id, 'call [PHONE]: ' || props AS text, date,
            CAST(floor(value) AS BIGINT) + CASE WHEN date >= '2024-01-10' THEN 1000 ELSE 0 END AS compliment_count,
            CASE WHEN date < '2024-01-20' THEN TIMESTAMP '{T1}' ELSE TIMESTAMP '{T2}' END AS _ingested_at,
            'bronze_external_table' AS _source_file, CAST(1 AS BIGINT) AS _schema_version,
            CASE WHEN date < '2024-01-10' THEN TIMESTAMP '{T1}' ELSE TIMESTAMP '{T2}' END AS _processed_at FROM day""",
    "merge_insert_only": _CHECKINS + f"""
        SELECT business_id, date, loaded AS _ingested_at, 'bronze_external_table' AS _source_file,
            CAST(1 AS BIGINT) AS _schema_version, loaded AS _processed_at
        FROM (SELECT business_id, date, CASE WHEN min(ts) < '2024-01-20' THEN TIMESTAMP '{T1}' ELSE TIMESTAMP '{T2}' END AS loaded
              FROM item GROUP BY 1, 2)""",
}
