"""Queries: raw lines, nested data, schema growth, run logs and the weather feed."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.functions.casts import coerce
from smelter.operators.badrows import split_bad_records
from smelter.operators.evolution import evolve_union, infer_fields
from smelter.operators.flatten import flatten
from smelter.operators.runlog import failed_runs, parse_log
from smelter.registry.standins import LOADED, ntz, table, text
from smelter.session import ensure_checkpoint_dir
from smelter.streaming import weather


def json_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The events' JSON, spoiled in a different way per event type."""
    kind = F.col("event_type")
    line = (F.when(kind == "error", F.expr("left(props, length(props) - 1)")).when(kind == "signup", F.lit("   "))
            .when(kind == "view", F.concat(F.lit("["), F.col("props"), F.lit("]")))
            .when((kind == "click") & (F.col("value") > 20), F.replace("props", F.lit(": "), F.lit(': "x" , "z": ')))
            .otherwise(F.col("props")))
    return table(spark, sf, "events").select("event_id", line.alias("value"))


def dlq_split(spark: SparkSession, sf: str) -> DataFrame:
    good, bad = split_bad_records(json_lines(spark, sf), T.StructType.fromDDL("k bigint"))
    return good.select("event_id", "k", F.lit(None).cast("string").alias("error"), F.lit(None).cast("string").alias("line")).unionByName(
        bad.select("event_id", F.lit(None).cast("bigint").alias("k"), "error", "line"))


def flatten_json(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    level3 = F.struct(F.col("value").alias("v"), F.struct(F.col("user_id").alias("u")).alias("deep"))
    nested = F.struct(F.col("event_type").alias("kind"), F.struct(F.col("ts").alias("at"), level3.alias("c")).alias("b"))
    tags = F.when(F.col("value") > 10, F.array(F.col("event_type"), F.lit("big"))).otherwise(F.array().cast("array<string>"))
    return flatten(e.select("event_id", nested.alias("a"), tags.alias("tags")))


def infer_types(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    mixed = F.when(kind == "click", F.col("user_id").cast("string")).otherwise(F.concat(F.lit('"'), kind, F.lit('"')))
    lines = table(spark, sf, "events").select(F.concat(
        F.lit('{"id": '), text("event_id"), F.lit(', "value": '), text("value"), F.lit(', "flag": '),
        F.when(F.col("value") > 10, "true").otherwise("false"), F.lit(', "props": '), F.col("props"), F.lit(', "mixed": '), mixed,
        F.lit(', "number": '), F.when(kind == "view", F.lit("1.5")).otherwise(text("user_id")), F.lit(', "list": [1]'),
        F.when(kind == "error", F.lit(', "rare": null')).otherwise(F.lit("")), F.lit("}")).alias("value"))
    return infer_fields(lines)


def infer_types_strict(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    lines = table(spark, sf, "events").select(F.concat(
        F.lit('{"kept": '), F.when(kind == "click", text("user_id")).otherwise(F.lit("null")),
        F.lit(', "mix": '), F.when(kind == "click", text("user_id")).otherwise(F.lit("2.5")), F.lit("}")).alias("value"))
    return infer_fields(lines, strict=True)


def evolved(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    old = e.where("ts < '2024-01-16'").select("event_id", "user_id", "event_type")
    new = e.where("ts >= '2024-01-16'").select(
        "event_id", F.col("user_id").cast("double").alias("user_id"), "event_type", F.col("props").alias("data_quality_tag"))
    return evolve_union(old, new)


def run_log_lines(spark: SparkSession, sf: str) -> DataFrame:
    d = F.date_format("o_orderdate", "yyyy-MM-dd")
    status = F.col("o_orderstatus")
    line = F.when(status == "F", F.concat(
        F.lit("PIPELINE_FAILURE|dag=d"), text("o_custkey"), F.lit("|task=t"), text("o_orderkey"), F.lit("|execution_date="), d,
        F.lit("|error=bad | "), F.col("o_orderpriority"), F.lit(" = x"))).when(status == "O", F.concat(
            F.lit("PIPELINE_SUCCESS|dag=d"), text("o_custkey"), F.lit("|execution_date="), d)).otherwise(
                F.concat(F.lit("heartbeat|dag=d"), text("o_custkey")))
    return table(spark, sf, "orders").select(line.alias("value"))


def parse_log_lines(spark: SparkSession, sf: str) -> DataFrame:
    return parse_log(run_log_lines(spark, sf)).drop("try_number")


def failed(spark: SparkSession, sf: str) -> DataFrame:
    runs = table(spark, sf, "orders").select(
        text("o_custkey").alias("dag"), F.col("o_orderkey").alias("run_id"),
        F.when(F.col("o_orderstatus") == "F", "failed").otherwise("success").alias("state"),
        F.col("o_orderdate").cast("timestamp").alias("start_date"), F.col("o_orderdate").alias("logical_date"))
    return ntz(failed_runs(runs, "2001-07-31 12:00:00", minutes=60 * 24 * 90))


def payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Events as raw API payloads; some lack the wind, some have no weather entry."""
    kind = F.col("event_type")
    return table(spark, sf, "events").select(F.concat(
        F.lit('{"name": "'), kind, F.lit('", "main": {"temp": '), text("value"), F.lit(', "humidity": '), text("user_id"),
        F.lit('}, "weather": ['), F.when(kind == "view", F.lit("")).otherwise(F.lit('{"main": "Rain", "id": 7}')),
        F.lit("]"), F.when(kind == "error", F.lit("")).otherwise(F.concat(F.lit(', "wind": {"speed": '), text("user_id"), F.lit("}"))),
        F.lit(', "dt": '), text("event_id"), F.lit("}")).alias("value"))


def weather_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return weather.weather_payload_to_event(payloads(spark, sf), "2024-05-01 10:00:00.25")


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """Events as weather messages: whole numbers for temperature on clicks, null on views, broken on errors."""
    kind = F.col("event_type")
    temp = F.when(kind == "click", F.floor("value").cast("string")).when(kind == "view", "null").otherwise(text("value"))
    return table(spark, sf, "events").select(F.concat(
        F.lit('{"city": "'), kind, F.lit('", "temp_c": '), temp, F.lit(', "humidity": 40, "wind_speed": '), text("value"),
        F.lit(', "api_timestamp": '), text("event_id"), F.when(kind == "error", F.lit("")).otherwise(F.lit("}"))).alias("value"))


def weather_enrich(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = weather.parse_weather(messages(spark, sf))
    return ntz(weather.enrich_weather(good, processing_time=LOADED))


def weather_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The messages as a stream that lands in a sink, read a second time from the start by another checkpoint, then compacted."""
    root = os.path.join(ensure_checkpoint_dir(spark), f"stream-{uuid.uuid4().hex}")
    source, sink = os.path.join(root, "in"), os.path.join(root, "out")
    for part in (0, 1):
        half = messages(spark, sf).where(F.pmod(F.xxhash64("value"), F.lit(2)) == part)
        half.write.mode("append").text(source)
        for checkpoint in ("first", "second")[:1 + part]:
            feed = weather.weather_stream(spark, source)
            weather.start_weather(feed, sink, os.path.join(root, checkpoint), trigger=None, processing_time=LOADED).awaitTermination()
    weather.compact_weather(spark, sink)
    return ntz(weather.read_weather(spark, sink).drop("run", "batch_id"))


def weather_dlq(spark: SparkSession, sf: str) -> DataFrame:
    return weather.parse_weather(messages(spark, sf))[1]


def coerce_types(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as raw businesses whose numbers are text and whose attributes are nested."""
    raw = table(spark, sf, "orders").select(
        text("o_orderkey").alias("business_id"), F.col("o_orderstatus").alias("name"), text("o_totalprice").alias("stars"),
        F.when(F.col("o_orderstatus") == "P", "many").otherwise(text("o_custkey")).alias("review_count"),
        F.struct(F.col("o_orderpriority").alias("priority"), F.lit(None).cast("string").alias("none")).alias("attributes"),
        F.when(F.col("o_orderstatus") == "O", '{"Monday": "9:0-18:0"}').alias("hours"))
    return ntz(coerce(raw, "business", LOADED))


QUERIES = {
    "coerce_types": coerce_types,
    "dlq_split": dlq_split, "flatten_json": flatten_json, "infer_types": infer_types, "infer_types_strict": infer_types_strict,
    "evolve_union": evolved, "parse_log": parse_log_lines, "failed_runs": failed, "weather_flatten": weather_flatten,
    "weather_enrich": weather_enrich, "weather_stream": weather_stream, "weather_dlq": weather_dlq,
}

_MESSAGE = """'{"city": "' || event_type || '", "temp_c": ' || CASE event_type WHEN 'click' THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)
    WHEN 'view' THEN 'null' ELSE CAST(value AS VARCHAR) END || ', "humidity": 40, "wind_speed": ' || value
    || ', "api_timestamp": ' || event_id"""
_TEMP = "CASE event_type WHEN 'click' THEN floor(value) WHEN 'view' THEN NULL ELSE value END"

ORACLE = {
    "coerce_types": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS business_id, o_orderstatus AS name, o_totalprice AS stars,
            CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS review_count,
            '{{"priority":"' || o_orderpriority || '"}}' AS attributes_json,
            CASE WHEN o_orderstatus = 'O' THEN '{{"Monday": "9:0-18:0"}}' END AS hours_json,
            TIMESTAMP '{LOADED}' AS _ingested_at, CAST(1 AS BIGINT) AS _schema_version FROM orders""",
    "dlq_split": """
        WITH l AS (SELECT event_id, event_type, value AS v, CASE
                WHEN event_type = 'error' THEN left(props, length(props) - 1) WHEN event_type = 'signup' THEN '   '
                WHEN event_type = 'view' THEN '[' || props || ']'
                WHEN event_type = 'click' AND value > 20 THEN replace(props, ': ', ': "x" , "z": ') ELSE props END AS line
            FROM events),
        e AS (SELECT *, CASE WHEN trim(line) = '' THEN 'Empty line' WHEN NOT json_valid(line) THEN 'JSON parse error'
                WHEN json_type(line) <> 'OBJECT' THEN 'Expected JSON object'
                WHEN json_type(line, '$.k') = 'VARCHAR' THEN 'Type mismatch' END AS error FROM l)
        SELECT event_id, CASE WHEN error IS NULL THEN CAST(json_extract_string(line, '$.k') AS BIGINT) END AS k, error,
            CASE WHEN error IS NOT NULL THEN line END AS line FROM e""",
    "flatten_json": """
        SELECT event_id, event_type AS a_kind, ts AS a_b_at, value AS a_b_c_v, '{"u":' || user_id || '}' AS a_b_c_deep,
            CASE WHEN value > 10 THEN '["' || event_type || '","big"]' END AS tags FROM events""",
    "infer_types": """
        WITH l AS (SELECT json_object('id', event_id, 'value', value, 'flag', value > 10, 'props', json(props),
                       'mixed', CASE WHEN event_type = 'click' THEN to_json(user_id) ELSE to_json(event_type) END,
                       'number', CASE WHEN event_type = 'view' THEN to_json(1.5) ELSE to_json(user_id) END,
                       'list', json('[1]'), 'rare', NULL) AS j FROM events),
        k AS (SELECT key, json_type(j, '$.' || key) AS t FROM (SELECT j, unnest(json_keys(j)) AS key FROM l)),
        s AS (SELECT key, list_sort(list(DISTINCT CASE WHEN t IN ('BIGINT', 'UBIGINT') THEN 'bigint' WHEN t = 'DOUBLE' THEN 'double'
                  WHEN t = 'BOOLEAN' THEN 'boolean' WHEN t = 'OBJECT' THEN 'json' ELSE 'string' END)) AS ts FROM k GROUP BY 1)
        SELECT key AS field, CASE WHEN len(ts) = 1 THEN ts[1] WHEN ts = ['bigint', 'double'] THEN 'double' ELSE 'string' END AS type
        FROM s""",
    "infer_types_strict": """
        SELECT 'kept' AS field, CASE WHEN count(*) > 0 THEN 'bigint' END AS type FROM events WHERE event_type = 'click'
        UNION ALL SELECT 'mix', CASE WHEN count(DISTINCT event_type = 'click') = 2 THEN 'string' END FROM events""",
    "evolve_union": """
        SELECT event_id, CAST(user_id AS DOUBLE) AS user_id, event_type,
            CASE WHEN ts >= '2024-01-16' THEN props END AS data_quality_tag FROM events""",
    "parse_log": """
        SELECT CASE o_orderstatus WHEN 'F' THEN 'PIPELINE_FAILURE' ELSE 'PIPELINE_SUCCESS' END AS event,
            'd' || o_custkey AS dag, CASE o_orderstatus WHEN 'F' THEN 't' || o_orderkey END AS task,
            strftime(o_orderdate, '%Y-%m-%d') AS execution_date,
            CASE o_orderstatus WHEN 'F' THEN 'bad | ' || o_orderpriority || ' = x' END AS error
        FROM orders WHERE o_orderstatus IN ('F', 'O')""",
    "failed_runs": """
        SELECT CAST(o_custkey AS VARCHAR) AS dag, o_orderkey AS run_id, 'failed' AS state, o_orderdate AS start_date,
            o_orderdate AS logical_date
        FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2001-07-31 12:00:00' - INTERVAL 90 DAY
        ORDER BY o_orderdate DESC, o_orderkey""",
    "weather_flatten": """
        SELECT event_type AS city, value AS temp_c, CASE WHEN event_type <> 'view' THEN 'Rain' END AS condition,
            CAST(user_id AS INTEGER) AS humidity, CASE WHEN event_type <> 'error' THEN CAST(user_id AS DOUBLE) END AS wind_speed,
            event_id AS api_timestamp, '2024-05-01T10:00:00.250000Z' AS ingest_timestamp, 'OpenWeatherMap' AS source
        FROM events""",
    "weather_enrich": f"""
        SELECT event_type AS city, {_TEMP} AS temp_c, CAST(NULL AS VARCHAR) AS condition, CAST(40 AS INTEGER) AS humidity,
            value AS wind_speed, event_id AS api_timestamp, CAST(NULL AS VARCHAR) AS ingest_timestamp,
            CAST(NULL AS VARCHAR) AS source, {_TEMP} * 9 / 5 + 32 AS temp_f, value > 20 AS is_windy,
            TIMESTAMP '{LOADED}' AS _processed_at
        FROM events WHERE event_type <> 'error'""",
    "weather_stream": f"""
        SELECT event_type AS city, {_TEMP} AS temp_c, CAST(NULL AS VARCHAR) AS condition, CAST(40 AS INTEGER) AS humidity,
            value AS wind_speed, event_id AS api_timestamp, CAST(NULL AS VARCHAR) AS ingest_timestamp,
            CAST(NULL AS VARCHAR) AS source, {_TEMP} * 9 / 5 + 32 AS temp_f, value > 20 AS is_windy,
            TIMESTAMP '{LOADED}' AS _processed_at, CAST(epoch_ms(event_id * 1000) AS DATE) AS day
        FROM events WHERE event_type <> 'error'""",
    "weather_dlq": f"SELECT {_MESSAGE} AS line, 'JSON parse error' AS error FROM events WHERE event_type = 'error'",
}
