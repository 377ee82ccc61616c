"""Weather feed: parse JSON messages, add derived columns, append to a table exactly once."""

from __future__ import annotations

import json
import os
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from smelter.functions.casts import instant
from smelter.operators.badrows import split_bad_records
from smelter.operators.dedup import dedup_latest
from smelter.sources import versions

# The message format, and the wind speed above which it is windy.
MESSAGE_DDL = ("city string, temp_c double, condition string, humidity int, wind_speed double, api_timestamp bigint, "
               "ingest_timestamp string, source string")
PAYLOAD_DDL = ("name string, main struct<temp: double, humidity: int>, weather array<struct<main: string>>, "
               "wind struct<speed: double>, dt bigint")
WINDY_ABOVE = 20
API_SOURCE = "OpenWeatherMap"


def message_schema() -> T.StructType:
    return T.StructType.fromDDL(MESSAGE_DDL)


def _iso(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def weather_payload_to_event(raw: DataFrame, ingested_at: datetime | str, source: str = API_SOURCE, col: str = "value") -> DataFrame:
    """Flat message columns out of raw API payloads; what a payload lacks is null."""
    p = F.from_json(F.col(col), PAYLOAD_DDL)
    return raw.select(p.alias("_p")).select(
        F.col("_p.name").alias("city"), F.col("_p.main.temp").alias("temp_c"),
        F.get("_p.weather", F.lit(0))["main"].alias("condition"), F.col("_p.main.humidity").alias("humidity"),
        F.col("_p.wind.speed").alias("wind_speed"), F.col("_p.dt").alias("api_timestamp"),
        _iso(instant(ingested_at)).alias("ingest_timestamp"), F.lit(source).alias("source"))


def as_messages(events: DataFrame) -> DataFrame:
    """One JSON text per row, as a producer would publish it."""
    return events.select(F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"}).alias("value"))


def parse_weather(messages: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Good messages as columns, and the others with the reason they were refused."""
    return split_bad_records(messages, message_schema(), col)


def enrich_weather(df: DataFrame, windy: float = WINDY_ABOVE, processing_time: datetime | str | None = None) -> DataFrame:
    """Add Fahrenheit, the windy flag and the processing time. Stateless, so it runs on a stream as well."""
    at = instant(processing_time) if processing_time is not None else F.current_timestamp()
    return df.withColumns({
        "temp_f": F.col("temp_c") * 9 / 5 + 32, "is_windy": F.col("wind_speed") > windy, "_processed_at": at})


def weather_stream(spark: SparkSession, source: str, max_files: int | None = None) -> DataFrame:
    """Messages that land as text files in a folder. Any streaming frame with a text column ``value`` does
    as well: a message bus whose payload is cast to string needs no other change."""
    reader = spark.readStream.format("text")
    return (reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)).load(source)


def _key(col: str) -> dict[str, Column]:
    """128 bits that tell a message from all others: the same text delivered again has the same."""
    return {"_k1": F.xxhash64(col), "_k2": F.xxhash64(F.lit("message"), col)}


def _first(df: DataFrame) -> tuple:
    return tuple(df.first())


def write_batch(messages: DataFrame, batch_id: int, sink: str, run: str, windy: float = WINDY_ABOVE, processing_time: datetime | str | None = None,
                late_after: int | None = None, once: bool = False) -> None:
    """Write one micro-batch under ``run=<run>/batch_id=<n>``: good rows by day of event, and dead letters.

    A batch that is replayed after a crash overwrites its own folders. A run is one checkpoint: a new checkpoint that
    reads the source again is another run, so it overwrites nothing, and messages (by their text) that another run has
    landed are left out. Only stored events between the batch's first and last day are looked at.

    ``late_after`` (seconds): events that much older than the newest event of the run's earlier batches become dead
    letters. ``once``: of events with the same city and time one is kept, whatever else they say.
    """
    spark = messages.sparkSession
    messages = messages.withColumns(_key("value")).persist(StorageLevel.MEMORY_AND_DISK)  # one micro-batch, read by several jobs
    try:
        good, bad = parse_weather(messages)
        time = F.col("api_timestamp")
        bad = bad.select("line", "error", "_k1", "_k2")
        newest = _newest_before(spark, sink, run, batch_id) if late_after is not None else None
        if newest is not None:
            is_late = F.coalesce(time < newest - late_after, F.lit(False))
            late = good.where(is_late).join(messages.select(F.col("value").alias("line"), "_k1", "_k2").dropDuplicates(["_k1", "_k2"]), ["_k1", "_k2"])
            bad = bad.unionByName(late.select("line", F.lit(LATE).alias("error"), "_k1", "_k2"))
            good = good.where(~is_late)
        others = set(_runs(spark, sink, "events")) - {run}
        if others:
            bad_before = _landed(spark, sink, "dead_letters", DEAD_DDL).where(F.col("run") != run)
            bad = bad.join(bad_before.select("_k1", "_k2"), ["_k1", "_k2"], "left_anti")
        if others or once:
            first, last = _first(good.agg(F.min(_day()), F.max(_day())))
            stored = read_weather(spark, sink, keys=True).where((F.col("run") != run) | (F.col("batch_id") < batch_id))
            stored = stored.where(F.col("day").between(F.lit(first), F.lit(last)) | F.col("day").isNull())
            if others:
                good = good.join(stored.where(F.col("run") != run).select("_k1", "_k2"), ["_k1", "_k2"], "left_anti")
            if once:
                good = dedup_latest(good, ["city", "api_timestamp"], ["_k1", "_k2"])
                good = good.join(stored.select("city", "api_timestamp"), ["city", "api_timestamp"], "left_anti")
        enriched = enrich_weather(good, windy, processing_time).withColumn("day", _day())
        place = os.path.join(f"run={run}", f"batch_id={batch_id}")
        names = [f.name for f in T.StructType.fromDDL(EVENT_DDL).fields]
        enriched.select(*names, "day").write.mode("overwrite").partitionBy("day").parquet(os.path.join(sink, "events", place))
        bad.write.mode("overwrite").parquet(os.path.join(sink, "dead_letters", place))
        if late_after is not None:
            top = good.agg(F.greatest(F.max("api_timestamp"), F.lit(newest).cast("bigint")).alias("newest"))
            top.write.mode("overwrite").parquet(os.path.join(sink, "progress", place))
    finally:
        messages.unpersist()


LATE = "Late event"
EVENT_DDL = MESSAGE_DDL + ", temp_f double, is_windy boolean, _processed_at timestamp, _k1 bigint, _k2 bigint"
DEAD_DDL = "line string, error string, _k1 bigint, _k2 bigint"


def _day() -> Column:
    return F.to_date(F.timestamp_seconds("api_timestamp"))


def _runs(spark: SparkSession, sink: str, kind: str) -> dict[str, list[int]]:
    """The runs in the sink and the numbers of their batches, by folder names."""
    runs = [n.removeprefix("run=") for n in versions.listed(spark, os.path.join(sink, kind)) if n.startswith("run=")]
    return {r: sorted(int(b.removeprefix("batch_id=")) for b in versions.listed(spark, os.path.join(sink, kind, f"run={r}")) if b.startswith("batch_id="))
            for r in runs}


def _newest_before(spark: SparkSession, sink: str, run: str, batch_id: int) -> int | None:
    """The newest event time of the run's batches before this one; each batch's own record holds it."""
    earlier = [b for b in _runs(spark, sink, "progress").get(run, []) if b < batch_id]
    return spark.read.parquet(os.path.join(sink, "progress", f"run={run}", f"batch_id={earlier[-1]}")).first()[0] if earlier else None


def _landed(spark: SparkSession, sink: str, kind: str, ddl: str) -> DataFrame:
    return spark.read.schema(f"{ddl}, run string, batch_id bigint").parquet(os.path.join(sink, kind))


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The run a checkpoint stands for: the id Spark gave the query when the checkpoint was made."""
    return json.loads(spark.read.text(os.path.join(checkpoint, "metadata")).first()["value"])["id"]


def start_weather(messages: DataFrame, sink: str, checkpoint: str, trigger: str | None = "10 seconds", windy: float = WINDY_ABOVE,
                  processing_time: datetime | str | None = None, late_after: int | None = None, once: bool = False) -> StreamingQuery:
    """Run the feed. ``trigger=None`` handles what is there and stops. See :func:`write_batch` for the last two."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, sink, run_of(batch.sparkSession, checkpoint), windy, processing_time, late_after, once)

    writer = messages.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return writer.start()


def read_weather(spark: SparkSession, sink: str, keys: bool = False) -> DataFrame:
    """All enriched events written so far, with day, run and batch: compacted parts, and batches not compacted yet."""
    now = versions.pointer(spark, os.path.join(sink, "compacted")) or {"parts": [], "upto": {}}
    schema, folder = f"{EVENT_DDL}, run string, batch_id bigint, day date", os.path.join(sink, "events")
    events = spark.read.schema(schema).parquet(folder) if versions.listed(spark, folder) else spark.createDataFrame([], schema)
    for run, last in now["upto"].items():
        events = events.where((F.col("run") != run) | (F.col("batch_id") > last))
    if now["parts"]:
        paths = [versions.data_path(os.path.join(sink, "compacted"), p) for p in now["parts"]]
        merged = [spark.read.schema(schema).parquet(p) for p in paths]
        events = reduce(DataFrame.unionByName, merged, events)
    return events if keys else events.drop("_k1", "_k2")


def compact_weather(spark: SparkSession, sink: str) -> int:
    """Gather finished batches into one part by day, and delete their folders; returns how many were gathered.

    A run's newest batch is left, as it may come again after a crash. The part is seen, and its batches are not, from the
    moment the pointer is renamed; a compaction that dies before that changes nothing, and after that leaves folders
    that readers pass over and the next one deletes.
    """
    table = os.path.join(sink, "compacted")
    now = versions.pointer(spark, table)
    parts, upto = (list(now["parts"]), dict(now["upto"])) if now else ([], {})
    runs = _runs(spark, sink, "events")
    finished = {r: [b for b in batches[:-1] if b > upto.get(r, -1)] for r, batches in runs.items()}
    count = sum(map(len, finished.values()))
    if count:
        paths = [os.path.join(sink, "events", f"run={r}", f"batch_id={b}") for r, batches in finished.items() for b in batches]
        events = spark.read.schema(f"{EVENT_DDL}, run string, batch_id bigint, day date").option("basePath", os.path.join(sink, "events")).parquet(*paths)
        version = versions.new_version()
        events.hint("rebalance", "day").write.partitionBy("day").parquet(versions.data_path(table, version))
        upto |= {r: batches[-1] for r, batches in finished.items() if batches}
        versions.publish(spark, table, {"parts": [*parts, version], "upto": upto, "version": version}, now["n"] if now else None)
    for r, batches in runs.items():
        for b in batches[:-1]:
            if b <= upto.get(r, -1):
                versions.discard(spark, os.path.join(sink, "events", f"run={r}", f"batch_id={b}"))
    return count
