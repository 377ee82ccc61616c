"""Raw layer: newline-delimited JSON under ``entity=<name>/dt=<yyyy-MM-dd>/``."""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.functions.casts import run_date
from smelter.operators.badrows import number_lines, parse_lines, split_bad_records, tag_position
from smelter.schemas import ENTITIES, bronze_schema


class TooManyBadRecords(ValueError):
    pass


def entity_path(root: str, entity: str) -> str:
    return os.path.join(root, f"entity={entity}")


def partition_path(root: str, entity: str, at: datetime | str, file_format: str = "json") -> str:
    """Where a producer puts one file of a batch started at ``at``."""
    moment = datetime.fromisoformat(at) if isinstance(at, str) else at
    return os.path.join(entity_path(root, entity), f"dt={moment:%Y-%m-%d}", f"data_{moment:%Y%m%d_%H%M%S}.{file_format}")


def available_entities(spark: SparkSession, root: str, entities: tuple[str, ...] = ENTITIES) -> list[str]:
    """Entities with at least one file; an error if there are none. Lists only until the first file."""
    found = []
    for entity in entities:
        path = spark._jvm.org.apache.hadoop.fs.Path(entity_path(root, entity))
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(path) and fs.listFiles(path, True).hasNext():
            found.append(entity)
    if not found:
        raise FileNotFoundError(f"no data under {root}")
    return found


def batch_path(root: str, entity: str, dt: str) -> str:
    return os.path.join(entity_path(root, entity), f"dt={dt}")


def bronze_lines(spark: SparkSession, root: str, entity: str, dt: str | None = None, positions: bool = False) -> DataFrame:
    """Raw text lines with their partition (as text) and file; ``positions`` adds split and place in the task.

    With ``dt`` only that partition's folder is listed and read, however many batches there are.
    """
    path = entity_path(root, entity) if dt is None else batch_path(root, entity, dt)
    lines = spark.read.schema("value string, dt string").option("basePath", entity_path(root, entity)).text(path)
    if positions:
        return tag_position(lines).withColumnRenamed("_file", "_source_file")
    return lines.select("value", "dt", F.col("_metadata.file_path").alias("_source_file"))


def infer_schema(spark: SparkSession, root: str, entity: str, sampling: float = 1.0) -> T.StructType:
    """Schema of an entity's files as Spark's JSON reader infers it, without the partition column."""
    inferred = spark.read.option("samplingRatio", sampling).option("primitivesAsString", False).json(entity_path(root, entity)).schema
    return T.StructType([f for f in inferred.fields if f.name not in ("dt", "_corrupt_record")])


def read_bronze(spark: SparkSession, root: str, entity: str, dt: str | None = None, infer: bool = False,
                extra: str | None = None) -> DataFrame:
    """Good rows with ``dt`` and ``_source_file``.

    Unknown fields drop out; ``extra`` (DDL) names additional ones to keep, such as columns that schema
    growth has added. ``infer`` replaces the explicit schema by the inferred one.
    """
    return split_bronze(spark, root, entity, dt, infer, extra)[0]


def split_bronze(spark: SparkSession, root: str, entity: str, dt: str | None = None, infer: bool = False,
                 extra: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad lines with the reason, file and partition."""
    schema = infer_schema(spark, root, entity) if infer else bronze_schema(entity)
    return split_bad_records(bronze_lines(spark, root, entity, dt), _with_extra(schema, extra))


def landed_path(root: str, entity: str, dt: str) -> str:
    return os.path.join(root, "landed", f"entity={entity}", f"dt={dt}")


def land_batch(spark: SparkSession, raw: str, root: str, entity: str, dt: str, extra: str | None = None,
               limit: int | None = None) -> int:
    """Parse a raw batch once and keep it as parquet: good rows under ``bad=false/``, refused lines with the
    reason under ``bad=true/``. All later steps read those columns instead of the JSON text. Each row keeps its file's
    split and its place in the task, from which line numbers follow without another scan of the text.

    Returns the number of bad lines, blank ones aside; an error if a ``limit`` is given and there are more.
    """
    parsed = parse_lines(bronze_lines(spark, raw, entity, dt, positions=True), _with_extra(bronze_schema(entity), extra))
    bad = F.col("_error").isNotNull()
    parsed.select(
        "_parsed.*", "_source_file", "_start", "_pos", F.when(bad, F.col("value")).alias("_line"), "_error", bad.alias("bad")).drop("_corrupt").write.mode(
            "overwrite").partitionBy("bad").parquet(landed_path(root, entity, dt))
    refused = _stored_lines(spark, root, entity, dt).where(F.col("bad") & (F.trim("_line") != "")).count()
    if limit is not None and refused > limit:
        raise TooManyBadRecords(f"{entity}: {refused} bad records, at most {limit} allowed")
    return refused


def read_landed(spark: SparkSession, root: str, entity: str, dt: str, bad: bool = False, extra: str | None = None) -> DataFrame:
    """Good rows of a landed batch, or its dead letters as ``(_line, _error, _source_file, line_number)``."""
    rows = _stored_lines(spark, root, entity, dt, extra)
    if not bad:
        return rows.where(~F.col("bad")).drop("_start", "_pos", "_line", "_error", "bad")
    placed = rows.withColumn("_file", F.col("_source_file"))
    wanted = placed.where("bad").select("_file", "_start", "_pos", "_line", "_error")
    return number_lines(placed.select("_file", "_start", "_pos"), wanted).select("_line", "_error", F.col("source_file").alias("_source_file"), "line_number")


def _stored_lines(spark: SparkSession, root: str, entity: str, dt: str, extra: str | None = None) -> DataFrame:
    schema = _with_extra(bronze_schema(entity), extra)
    own = T.StructType.fromDDL("_source_file string, _start bigint, _pos bigint, _line string, _error string, bad boolean")
    return spark.read.schema(T.StructType(schema.fields + own.fields)).parquet(landed_path(root, entity, dt))


def _with_extra(schema: T.StructType, extra: str | None) -> T.StructType:
    return T.StructType(schema.fields + T.StructType.fromDDL(extra).fields) if extra else schema


def check_bad_records(spark: SparkSession, root: str, entity: str, dt: str | None = None, limit: int | None = None) -> int:
    """Number of bad lines, blank ones aside; an error if a ``limit`` is given and there are more."""
    parsed = parse_lines(bronze_lines(spark, root, entity, dt), bronze_schema(entity))
    bad = parsed.where(F.col("_error").isNotNull() & (F.trim("value") != "")).count()
    if limit is not None and bad > limit:
        raise TooManyBadRecords(f"{entity}: {bad} bad records, at most {limit} allowed")
    return bad


def write_bronze(df: DataFrame, root: str, entity: str, dt: str | datetime) -> None:
    """Write rows as one batch partition of JSON lines, replacing an earlier try of the same batch."""
    day = dt if isinstance(dt, str) and len(dt) == 10 else run_date(dt)
    df.write.mode("overwrite").json(batch_path(root, entity, day))


def sample_lines(spark: SparkSession, path: str, n: int = 1000) -> DataFrame:
    """The first ``n`` lines of a text file, for a look at its shape. Reads no further than needed."""
    return spark.read.text(path).limit(n)
