"""Cleaned and aggregate tables on storage: plain partitioned parquet.

Parquet has no MERGE, and a table must not be overwritten while it is read. Every write here is a
*dynamic partition overwrite*: tasks write to a staging folder and whole partitions are swapped in when
the job commits, so reading the old rows of the same table is safe and a lost executor only repeats its
tasks. A driver that dies during a commit leaves the batch to be run again; each merge gives the same
table when repeated. One writer per table at a time is assumed.

* Dimensions lie in ``is_current=true/batch=current/bucket=<n>/`` and ``is_current=false/batch=<id>/bucket=-1/``.
  The bucket is a hash of the key. A batch reads and rewrites the current buckets its keys fall into and
  adds one history part; other buckets and older history are never touched or read.
* Facts with a date lie in ``month=<yyyy-MM-01>/``. A batch rewrites only the months it touches.
* Aggregate tables are replaced as a whole, by version (:mod:`smelter.sources.versions`).
* Check-ins are append-only months, with a skip index of their keys (:mod:`smelter.sources.keyindex`): a
  batch reads only the months that may hold one of its keys.
"""

from __future__ import annotations

import os
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from smelter.functions.casts import month_of
from smelter.operators.merge import as_new_rows, scd1_merge, scd2_apply_to_current, scd2_first_versions
from smelter.schemas import ENTITIES, LAYOUT, SILVER_TABLES, get_schema
from smelter.sources import growth, keyindex, versions

Instant = datetime | str
BUCKETS = 64
NO_BUCKET = -1
_PART = {"dimension": ("is_current", "batch", "bucket"), "month": ("month",)}


def silver_path(root: str, entity: str) -> str:
    return os.path.join(root, "silver", SILVER_TABLES[entity])


def gold_path(root: str, name: str) -> str:
    return os.path.join(root, "gold", name)


def empty_table(spark: SparkSession, entity: str) -> DataFrame:
    """No rows, with the entity's cleaned schema."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in get_schema(entity).fields])


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def is_dimension(entity: str) -> bool:
    return bool(LAYOUT[entity].tracked)


def _stored_schema(entity: str, grown: dict[str, str]) -> T.StructType:
    """Columns in the files, then the partition columns with explicit types (nothing is inferred)."""
    schema = T.StructType(get_schema(entity).fields + growth.stored_fields(grown))
    if is_dimension(entity):
        fields = [f for f in schema.fields if f.name != "is_current"]
        return T.StructType(fields + [T.StructField("is_current", T.BooleanType()), T.StructField("batch", T.StringType()),
                                      T.StructField("bucket", T.IntegerType())])
    if LAYOUT[entity].month_of:
        return T.StructType(schema.fields + [T.StructField("month", T.DateType())])
    return schema


def _make_folder(spark: SparkSession, path: str) -> None:
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(fs_path)


def ensure_silver_tables(spark: SparkSession, root: str, buckets: int = BUCKETS, index_blocks: int = keyindex.BLOCKS) -> None:
    """Create every cleaned table that is absent, empty, with its partition columns.

    ``buckets`` (of a dimension's keys) and ``index_blocks`` (of a key index, for each month) are stored with
    the table and hold for its life: choose them by the size the table will have.
    """
    for entity in ENTITIES:
        if path_exists(spark, silver_path(root, entity)):
            continue
        if is_dimension(entity):
            _make_folder(spark, os.path.join(_properties_path(root, entity), f"buckets={int(buckets)}"))
        elif LAYOUT[entity].append_only:
            _make_folder(spark, os.path.join(_properties_path(root, entity), f"index_blocks={int(index_blocks)}"))
            _make_folder(spark, index_path(root, entity))
        _make_folder(spark, silver_path(root, entity))


def index_path(root: str, entity: str) -> str:
    return os.path.join(root, "index", SILVER_TABLES[entity])


def _properties_path(root: str, entity: str) -> str:
    return os.path.join(root, "properties", SILVER_TABLES[entity])


def table_properties(spark: SparkSession, root: str, entity: str) -> dict[str, int]:
    """What was fixed when the table was made: each is the name of an empty folder, ``name=value``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_properties_path(root, entity))
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return {}
    pairs = (str(f.getPath().getName()).split("=") for f in files.listStatus(folder))
    return {name: int(value) for name, value in pairs}


def _read_stored(spark: SparkSession, root: str, entity: str, grown: dict[str, str] | None = None) -> DataFrame:
    grown = growth.grown_columns(spark, root, entity) if grown is None else grown
    return spark.read.schema(_stored_schema(entity, grown)).parquet(silver_path(root, entity))


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket a dimension's key lies in."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def in_months(months: list) -> Column:
    """Partition filter: the month is one of those given; None stands for rows without a date."""
    found = F.col("month").isin([F.lit(m).cast("date") for m in months if m is not None])
    return found | F.col("month").isNull() if None in months else found


def read_silver(spark: SparkSession, root: str, entity: str, months: list | None = None, buckets: list[int] | None = None,
                typed: bool = True) -> DataFrame:
    """A cleaned table in its declared column order, then the columns that schema growth has added, as their type of today
    (``typed=False``: as the text they are stored as).

    ``is_current`` is a partition, so a filter on it skips the history. ``months`` (first days, dates or
    ``yyyy-MM-dd``) skips the other months; a filter on the date itself cannot, as it does not name the
    partition. ``buckets`` of a dimension reads the current rows of those buckets only.
    """
    grown = growth.grown_columns(spark, root, entity)
    df = _read_stored(spark, root, entity, grown)
    if months is not None:
        if not LAYOUT[entity].month_of:
            raise ValueError(f"{entity} is not partitioned by month")
        df = df.where(in_months(months))
    if buckets is not None:
        if not is_dimension(entity):
            raise ValueError(f"{entity} is not partitioned by bucket")
        df = df.where(F.col("is_current") & F.col("bucket").isin(buckets))
    return df.select(*[f.name for f in get_schema(entity).fields],
                     *[F.col(n).try_cast(t).alias(n) if typed and t != "string" else F.col(n) for n, t in grown.items()])


def _overwrite_parts(df: DataFrame, path: str, parts: tuple[str, ...], sort_by: tuple[str, ...], mode: str = "overwrite") -> None:
    """Swap in the partitions that ``df`` has rows for, or add to them with ``mode="append"``.

    The rows come hashed by key, so each task holds rows of every part. Rebalancing gathers a part's rows
    into files of the advisory size: a large part is split over tasks, small ones do not leave one file
    per task.
    """
    (df.hint("rebalance", *parts).sortWithinPartitions(*parts, *sort_by).write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(path))


def _history(path: str, batch: str) -> str:
    return os.path.join(path, "is_current=false", f"batch={batch}")


def stored_months(spark: SparkSession, path: str) -> list[date | None]:
    """The months a table or index has a partition for, by its folders; None for rows without a date."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [str(f.getPath().getName()) for f in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    values = [n.split("=", 1)[1] for n in names if n.startswith("month=")]
    return [None if v.startswith("__") else date.fromisoformat(v) for v in values]


def apply_scd2(spark: SparkSession, root: str, entity: str, stage: DataFrame, processing_time: Instant, batch: str) -> list[int]:
    """Merge a staged batch into a dimension. Reads and rewrites only the current buckets its keys fall into; returns them.

    The history part goes first and is named after the batch, so a run that died between the two
    writes can be repeated. Where the batch has a history part already, that part keeps its rows, except
    versions that this run closes again or that are still current (left by a run that died).
    """
    layout, path = LAYOUT[entity], silver_path(root, entity)
    key = layout.keys[0]
    bucket = bucket_of(key, table_properties(spark, root, entity)["buckets"])
    stage = stage.persist(StorageLevel.MEMORY_AND_DISK)
    merged = None
    try:
        touched = [r["bucket"] for r in stage.select(bucket.alias("bucket")).distinct().collect()]  # bounded by the table's buckets
        if not touched:
            return []
        if not path_exists(spark, os.path.join(path, "is_current=true")) and not path_exists(spark, _history(path, batch)):
            first = scd2_first_versions(read_silver(spark, root, entity, typed=False), stage, processing_time)
            _overwrite_parts(first.withColumns({"batch": F.lit("current"), "bucket": bucket}), path, _PART["dimension"], layout.sort_by)
            return touched
        merged = scd2_apply_to_current(read_silver(spark, root, entity, buckets=touched, typed=False), stage, key, processing_time)
        merged = merged.persist(StorageLevel.MEMORY_AND_DISK)  # read by two writes; its sources stay until the second commits
        closed = merged.where(~F.col("is_current"))
        if path_exists(spark, _history(path, batch)):
            earlier = _read_stored(spark, root, entity).where(~F.col("is_current") & (F.col("batch") == batch)).drop("batch", "bucket")
            closed = closed.unionByName(earlier.join(merged.select(key, "valid_from"), [key, "valid_from"], "left_anti"))
        closed = closed.withColumns({"batch": F.lit(batch), "bucket": F.lit(NO_BUCKET)})
        _overwrite_parts(closed, path, _PART["dimension"], layout.sort_by)
        opened = merged.where("is_current").withColumns({"batch": F.lit("current"), "bucket": bucket})
        _overwrite_parts(opened, path, _PART["dimension"], layout.sort_by)
        return touched
    finally:
        stage.unpersist()
        if merged is not None:
            merged.unpersist()


def touched_months(spark: SparkSession, root: str, entity: str, stage: DataFrame) -> list:
    """Months that hold a row the batch updates, and months the batch inserts into.

    Reads the key and month columns only. The result has one entry per month, so it is small.
    """
    layout = LAYOUT[entity]
    keys = list(layout.keys)
    coming = stage.select(month_of(F.col(layout.month_of)).alias("month"))
    if stored_months(spark, silver_path(root, entity)):
        held = _read_stored(spark, root, entity).join(stage.select(*keys), keys, "left_semi").select("month")
        coming = held.unionByName(coming)
    return [r["month"] for r in coming.distinct().collect()]


def apply_scd1(spark: SparkSession, root: str, entity: str, stage: DataFrame, update_cols: list[str],
               processing_time: Instant) -> list:
    """Merge a staged batch into a monthly fact table; only the touched months are read and rewritten."""
    layout = LAYOUT[entity]
    stage = stage.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        months = touched_months(spark, root, entity, stage)
        if not months:
            return []
        there = set(stored_months(spark, silver_path(root, entity)))
        if there.isdisjoint(months):
            merged = as_new_rows(read_silver(spark, root, entity, typed=False), stage, processing_time)
        else:
            update_cols = [*update_cols, *growth.grown_columns(spark, root, entity)]
            merged = scd1_merge(read_silver(spark, root, entity, months=months, typed=False), stage, list(layout.keys), update_cols, processing_time)
        dated = merged.withColumn("month", month_of(F.col(layout.month_of)))
        _overwrite_parts(dated, silver_path(root, entity), _PART["month"], layout.sort_by)
        return months
    finally:
        stage.unpersist()


def possible_keys(spark: SparkSession, root: str, entity: str, keyed: DataFrame, coming: list) -> DataFrame | None:
    """Keys (with month) of a probed batch that the table may hold, by its key index; None where it has none of the
    batch's months ``coming``."""
    layout = LAYOUT[entity]
    shared = [m for m in stored_months(spark, index_path(root, entity)) if m in coming]
    if not shared:
        return None
    index = spark.read.schema(keyindex.SCHEMA).parquet(index_path(root, entity)).where(in_months(shared))
    return keyindex.possible(keyed, index, [*layout.keys, "month"])


def held_keys(spark: SparkSession, root: str, entity: str, possible: DataFrame) -> tuple[DataFrame, list]:
    """Which of the possible keys the table holds, and the months scanned to find out: only those of possible keys, and
    only their key columns."""
    keys = list(LAYOUT[entity].keys)
    months = [r["month"] for r in possible.select("month").distinct().collect()]
    stored = _read_stored(spark, root, entity).where(in_months(months)).select(*keys)
    return possible.select(*keys).join(stored, keys, "left_semi"), months


def apply_insert_only(spark: SparkSession, root: str, entity: str, stage: DataFrame, processing_time: Instant) -> list:
    """Append the staged rows whose key the table lacks; returns the batch's months. Repeating it appends nothing.

    The index goes first: a run that dies before the rows are there leaves keys in it that no row has, which costs a
    read, where rows without their keys in it would be added again.
    """
    layout = LAYOUT[entity]
    keys, blocks = list(layout.keys), table_properties(spark, root, entity)["index_blocks"]
    stage = stage.withColumn("month", month_of(F.col(layout.month_of))).persist(StorageLevel.MEMORY_AND_DISK)
    kept, fresh = [stage], stage
    try:
        coming = [r["month"] for r in stage.select("month").distinct().collect()]  # twelve a year, whatever the rows
        possible = possible_keys(spark, root, entity, keyindex.probes(stage, keys, blocks), coming)
        if possible is not None:
            possible = possible.persist(StorageLevel.MEMORY_AND_DISK)
            kept.append(possible)
            held, read = held_keys(spark, root, entity, possible)
            fresh = stage.join(held, keys, "left_anti").persist(StorageLevel.MEMORY_AND_DISK) if read else stage
            kept.append(fresh)
        filters = keyindex.filters(keyindex.probes(fresh, keys, blocks))
        filters.hint("rebalance", "month").write.mode("append").partitionBy("month").parquet(index_path(root, entity))
        shaped = as_new_rows(empty_table(spark, entity), fresh, processing_time).withColumn("month", month_of(F.col(layout.month_of)))
        _overwrite_parts(shaped, silver_path(root, entity), _PART["month"], layout.sort_by, mode="append")
        return coming
    finally:
        for df in kept:
            df.unpersist()


def compact_index(spark: SparkSession, root: str, entity: str) -> None:
    """One filter row for each month and block instead of one for each batch; no key is lost."""
    path = index_path(root, entity)
    merged = keyindex.merged(spark.read.schema(keyindex.SCHEMA).parquet(path))
    _overwrite_parts(merged, path, _PART["month"], ("block",))


def write_gold(df: DataFrame, root: str, name: str) -> str:
    """Replace an aggregate or prediction table as a whole: readers see the old version or the new one, never a part."""
    versions.replace(df, gold_path(root, name))
    return gold_path(root, name)


def read_gold(spark: SparkSession, root: str, name: str) -> DataFrame:
    return versions.current(spark, gold_path(root, name))


def overwrite_from_files(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Replace a table with what parquet files hold, without a gap for its readers."""
    versions.replace(spark.read.parquet(source), target)
    return versions.current(spark, target)


def reset_table(spark: SparkSession, root: str, entity: str) -> T.StructType:
    """Drop a cleaned table with its data, create it empty, and return its schema."""
    made = table_properties(spark, root, entity)
    for folder in (silver_path(root, entity), index_path(root, entity)):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    ensure_silver_tables(spark, root, **made)
    return read_silver(spark, root, entity).schema
