"""Queries: checks, audit sections and personal data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.operators import audit, pii, quality
from smelter.registry.silver import _VERSIONS, business_versions
from smelter.registry.standins import AS_OF, ntz, table

NOW = "2024-01-31 07:30:00"


def bronze_key_stats(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    raw = docs.select(F.when(F.col("lang") != "es", F.col("source")).alias("user_id"), F.col("lang").alias("business_id"),
                      F.when(F.col("n_chars") > 200, F.col("n_chars")).alias("date"))
    return quality.bronze_key_stats(raw, ["user_id", "business_id", "date"], ["user_id", "business_id"])


def events_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a key that is null for errors, one version per event, newest version current."""
    return table(spark, sf, "events").select(
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"), "event_type", "value", "ts",
        (F.col("value") > 10).alias("is_current"))


def dq_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_null_keys(events_by_day(spark, sf), ["user_id"], F.col("ts") >= "2024-01-20")


def dq_active_unique(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_single_active(events_by_day(spark, sf), "user_id", F.col("ts") >= "2024-01-29")


def dq_fact_unique(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumn(
        "l_linenumber", F.when(F.col("l_returnflag") != "A", F.col("l_linenumber")))
    return quality.check_fact_keys(lines, ["l_orderkey", "l_linenumber"], F.col("l_shipdate") >= "1998-01-01")


def dq_suite(spark: SparkSession, sf: str) -> DataFrame:
    events = events_by_day(spark, sf)
    return quality.run_checks(events, "events", [
        quality.row_count(), quality.missing("user_id"), quality.invalid("event_type", ["click", "view", "signup"]),
        quality.freshness("ts", 24, NOW), quality.duplicate("user_id"), quality.duplicate("user_id", "is_current = true"),
        quality.duplicate(["user_id", "ts"]),
    ])


def audit_volume(spark: SparkSession, sf: str) -> DataFrame:
    layers = {"Bronze": ["events", "documents", "pages", "conversations"], "Silver": ["orders", "lineitem", "customer"],
              "Gold": ["labels", "benchmark"]}
    volume = audit.audit_volume({
        layer: {**{n: table(spark, sf, n) for n in names}, "tmp$1": table(spark, sf, names[0])}
        for layer, names in layers.items()})
    return volume.withColumn("created_at", F.col("created_at") > "2020-01-01")  # SQL cannot see when a file was made


def scd2_health(spark: SparkSession, sf: str) -> DataFrame:
    return audit.audit_scd2(business_versions(spark, sf), "silver.businesses").unionByName(
        audit.audit_scd2(events_by_day(spark, sf), "silver.users"))


def audit_latency(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("_processed_at", F.col("ts").cast("timestamp"))
    orders = table(spark, sf, "orders").withColumn("_processed_at", F.col("o_orderdate").cast("timestamp"))
    return ntz(audit.audit_latency(events, NOW, "events").unionByName(audit.audit_latency(orders, AS_OF, "orders")))


def audit_keys(spark: SparkSession, sf: str) -> DataFrame:
    return audit.audit_keys(events_by_day(spark, sf), "user_id", "event_type", "Event Key Check")


def pii_inspect(spark: SparkSession, sf: str) -> DataFrame:
    both = table(spark, sf, "documents").select("text").unionByName(table(spark, sf, "conversations").select("text"))
    return pii.inspect_pii(both, ["text"], min_likelihood="possible")


def deid_mask(spark: SparkSession, sf: str) -> DataFrame:
    return pii.deidentify(table(spark, sf, "documents").select("doc_id", "text", "lang"), ["text", "lang"])


def deid_token(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens are there and back again, and equal values have equal tokens."""
    key, iv_key = b"0123456789abcdef", b"another key"
    users = table(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_name").alias("token"), "c_mktsegment",
                                                F.col("c_mktsegment").alias("segment"))
    sealed = pii.deidentify(users, ["token", "segment"], mode="token", key=key, iv_key=iv_key)
    opened = sealed.withColumn("opened", pii.untokenise(F.col("token"), F.lit(bytearray(key))))
    return opened.groupBy("c_mktsegment").agg(
        F.count_if(F.col("opened") == F.col("c_name")).alias("restored"),
        F.count_distinct("token").alias("tokens"), F.count_distinct("segment").alias("segment_tokens"))


def secure_view(spark: SparkSession, sf: str) -> DataFrame:
    return pii.secure_view(table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), ["c_name"])


QUERIES = {
    "bronze_key_stats": bronze_key_stats, "dq_null_keys": dq_null_keys, "dq_active_unique": dq_active_unique,
    "dq_fact_unique": dq_fact_unique, "dq_suite": dq_suite, "audit_volume": audit_volume, "scd2_health": scd2_health,
    "audit_latency": audit_latency, "audit_keys": audit_keys, "pii_inspect": pii_inspect, "deid_mask": deid_mask,
    "deid_token": deid_token, "secure_view": secure_view,
}

_EVENTS = """
    WITH e AS (SELECT CASE WHEN event_type <> 'error' THEN user_id END AS user_id, event_type, value, ts,
                   value > 10 AS is_current FROM events)
"""


def _check(name: str, observed: str, threshold: float, passed: str, rows: str = "count(*)") -> str:
    return f"""SELECT 'events' AS "table", '{name}' AS "check", 'fail' AS level, CAST({observed} AS DOUBLE) AS observed,
        CAST({threshold} AS DOUBLE) AS threshold, {passed} AS passed, CAST({rows} AS BIGINT) AS rows_checked"""


def _dup(name: str, keys: str, where: str, null_free: str) -> str:
    d = f"count(*) FILTER (n > 1 AND {null_free})"
    return _check(name, d, 0, f"{d} = 0", "sum(n)") + f" FROM (SELECT {keys}, count(*) AS n FROM e WHERE {where} GROUP BY ALL)"


_AGE = f"(epoch_us(TIMESTAMP '{NOW}') - epoch_us(max(ts))) / 3.6e9"
_BAD_TYPE = "count(*) FILTER (event_type NOT IN ('click', 'view', 'signup'))"


def _finding(info_type: str) -> str:
    likelihood, pattern = pii.INFO_TYPES[info_type]
    hits = f"len(regexp_extract_all(text, '{pattern}'))"
    if info_type == "CREDIT_CARD_NUMBER":
        # Luhn over the extracted candidates, written out with list functions.
        hits = f"""len(list_filter(regexp_extract_all(text, '{pattern}'), lambda x: list_sum(list_transform(
            range(1, length(regexp_replace(x, '[^0-9]', '', 'g')) + 1), lambda i:
            CASE WHEN i % 2 = 1 THEN CAST(substr(reverse(regexp_replace(x, '[^0-9]', '', 'g')), i, 1) AS INTEGER)
            ELSE list_extract([0, 2, 4, 6, 8, 1, 3, 5, 7, 9],
                CAST(substr(reverse(regexp_replace(x, '[^0-9]', '', 'g')), i, 1) AS INTEGER) + 1) END)) % 10 = 0))"""
    return f"""SELECT 'text' AS "column", '{info_type}' AS info_type, '{likelihood}' AS likelihood,
        count(*) FILTER (hits > 0) AS rows_found, CAST(sum(hits) AS BIGINT) AS findings, count(*) AS rows_seen
        FROM (SELECT {hits} AS hits FROM t)"""


ORACLE = {
    "bronze_key_stats": """
        WITH raw AS (SELECT CASE WHEN lang <> 'es' THEN source END AS u, lang AS b, CASE WHEN n_chars > 200 THEN n_chars END AS d
                     FROM documents)
        SELECT CAST(sum(CASE WHEN u IS NULL OR b IS NULL THEN n END) AS BIGINT) AS total_nulls,
            count(*) FILTER (n > 1 AND u IS NOT NULL AND b IS NOT NULL AND d IS NOT NULL) AS total_duplicates
        FROM (SELECT u, b, d, count(*) AS n FROM raw GROUP BY ALL)""",
    "dq_null_keys": _EVENTS + """
        SELECT count(*) FILTER (user_id IS NULL) AS null_keys, count(*) AS rows_checked FROM e WHERE ts >= '2024-01-20'""",
    "dq_active_unique": _EVENTS + """
        SELECT user_id, count(*) AS active_count FROM e
        WHERE is_current AND user_id IN (SELECT user_id FROM e WHERE ts >= '2024-01-29') GROUP BY 1 HAVING count(*) > 1""",
    "dq_fact_unique": """
        SELECT CAST(sum(CASE WHEN n2 IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_keys,
            count(*) FILTER (n > 1 AND n2 IS NOT NULL) AS duplicate_keys, CAST(sum(n) AS BIGINT) AS rows_checked
        FROM (SELECT l_orderkey, CASE WHEN l_returnflag <> 'A' THEN l_linenumber END AS n2, count(*) AS n
              FROM lineitem WHERE l_shipdate >= '1998-01-01' GROUP BY 1, 2)""",
    "dq_suite": _EVENTS + " UNION ALL ".join([
        _check("row_count >= 1", "count(*)", 1, "count(*) >= 1") + " FROM e",
        _check("missing_count(user_id)", "count(*) - count(user_id)", 0, "count(*) = count(user_id)") + " FROM e",
        _check("invalid_count(event_type)", _BAD_TYPE, 0, f"{_BAD_TYPE} = 0") + " FROM e",
        _check("freshness(ts) hours", _AGE, 24, f"{_AGE} < 24") + " FROM e",
        _dup("duplicate_count(user_id)", "user_id", "true", "user_id IS NOT NULL"),
        _dup("duplicate_count(user_id) where is_current = true", "user_id", "is_current", "user_id IS NOT NULL"),
        _dup("duplicate_count(user_id, ts)", "user_id, ts", "true", "user_id IS NOT NULL"),
    ]),
    "audit_volume": " UNION ALL ".join(
        f"SELECT '1. VOLUME' AS category, '{layer}' AS layer, '{name}' AS entity, count(*) AS row_count, true AS created_at FROM {name}"
        for layer, name in [("Bronze", "events"), ("Bronze", "documents"), ("Bronze", "pages"), ("Bronze", "conversations"),
                            ("Silver", "orders"), ("Silver", "lineitem"), ("Silver", "customer"), ("Gold", "labels"),
                            ("Gold", "benchmark")]),
    "scd2_health": _VERSIONS + """, h AS (
            SELECT 'silver.businesses' AS t, closed IS NULL AS cur FROM versions
            UNION ALL SELECT 'silver.users', value > 10 FROM events)
        SELECT '2. SCD2 HEALTH' AS category, t AS "table", count(*) FILTER (cur) AS active_records,
            count(*) FILTER (NOT cur) AS history_records, round(count(*) FILTER (NOT cur) / count(*) * 100, 2) AS overlap_pct
        FROM h GROUP BY t""",
    "audit_latency": f"""
        WITH m AS (SELECT 'events' AS metric, max(ts) AS t, TIMESTAMP '{NOW}' AS now_ts FROM events
                   UNION ALL SELECT 'orders', max(o_orderdate), TIMESTAMP '{AS_OF}' FROM orders),
        h AS (SELECT *, (epoch_us(now_ts) - epoch_us(t)) // 3600000000 AS h FROM m)
        SELECT '3. LATENCY' AS category, metric, t AS last_ingested_record, CAST(h AS BIGINT) AS hours_since_sync,
            CASE WHEN h > 24 THEN '🔴 LAGGING' WHEN h > 6 THEN '🟡 DELAYED' ELSE '🟢 HEALTHY' END AS status FROM h""",
    "audit_keys": _EVENTS + """
        SELECT '4. DQ AUDIT' AS category, 'Event Key Check' AS audit_type, count(*) FILTER (user_id IS NULL) AS null_keys,
            count(*) FILTER (event_type IS NULL) AS null_names, count(*) AS total_rows FROM e WHERE is_current""",
    "pii_inspect": "WITH t AS (SELECT text FROM documents UNION ALL SELECT text FROM conversations) "
                   + " UNION ALL ".join(_finding(t) for t in pii.INFO_TYPES),
    "deid_mask": "SELECT doc_id, repeat('*', length(text)) AS text, repeat('*', length(lang)) AS lang FROM documents",
    "deid_token": """
        SELECT c_mktsegment, count(*) AS restored, count(DISTINCT c_name) AS tokens, CAST(1 AS BIGINT) AS segment_tokens
        FROM customer GROUP BY 1""",
    "secure_view": "SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_name, c_acctbal FROM customer",
}
