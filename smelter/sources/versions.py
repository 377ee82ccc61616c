"""Tables that are replaced as a whole without a gap: dated folders, and a pointer that is renamed into place last.

``<table>/data/<version>/`` holds parquet files, ``<table>/pointers/<n>.json`` one line that says what a reader takes; the
highest number holds. A version that is being written, or whose writer died, has no pointer and is not seen. A pointer is
written under another name and renamed, which every file system does at once; two writers that try the same number
cannot both succeed. Replaced versions stay for readers that began with them, until :func:`vacuum`.
"""

from __future__ import annotations

import json
import os
import uuid
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class Conflict(RuntimeError):
    """Another writer published a version meanwhile."""


def _files(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is absent."""
    folder, files = _files(spark, path)
    return sorted(str(f.getPath().getName()) for f in files.listStatus(folder)) if files.exists(folder) else []


def discard(spark: SparkSession, path: str) -> None:
    folder, files = _files(spark, path)
    files.delete(folder, True)


def _numbers(spark: SparkSession, table: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in listed(spark, os.path.join(table, "pointers")) if n.endswith(".json") and n[0].isdigit())


def pointer(spark: SparkSession, table: str) -> dict | None:
    """What the newest pointer says, with its number under ``n``; None for a table without one."""
    numbers = _numbers(spark, table)
    if not numbers:
        return None
    path, files = _files(spark, os.path.join(table, "pointers", f"{numbers[-1]:012d}.json"))
    stream = files.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")) | {"n": numbers[-1]}
    finally:
        stream.close()


def publish(spark: SparkSession, table: str, values: dict, after: int | None) -> int:
    """Make ``values`` what readers see. ``after`` is the number of the pointer the writer began from (None: no pointer)."""
    number = 0 if after is None else after + 1
    made, files = _files(spark, os.path.join(table, "pointers", f"_{uuid.uuid4().hex}"))
    stream = files.create(made)
    stream.write(bytearray(json.dumps(values).encode()))
    stream.close()
    final, _ = _files(spark, os.path.join(table, "pointers", f"{number:012d}.json"))
    try:
        done = not files.exists(final) and files.rename(made, final)
    except Py4JJavaError as e:
        raise Conflict(f"{table}: version {number} exists") from e
    if not done:
        files.delete(made, False)
        raise Conflict(f"{table}: version {number} exists")
    return number


def new_version() -> str:
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"


def data_path(table: str, version: str) -> str:
    return os.path.join(table, "data", version)


def replace(df: DataFrame, table: str) -> str:
    """Write df as the new version of a table; readers see the old one whole until it is there whole."""
    spark = df.sparkSession
    before = pointer(spark, table)
    version = new_version()
    df.write.parquet(data_path(table, version))
    publish(spark, table, {"version": version}, None if before is None else before["n"])
    return version


def current_path(spark: SparkSession, table: str) -> str:
    now = pointer(spark, table)
    if now is None:
        raise FileNotFoundError(f"{table} has no version")
    return data_path(table, now["version"])


def current(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.parquet(current_path(spark, table))


def vacuum(spark: SparkSession, table: str, keep: int = 2) -> None:
    """Delete all but the newest ``keep`` published versions, and what writers that died have left. Not while one writes."""
    numbers = _numbers(spark, table)
    held = set()
    for n in numbers[-keep:]:
        path, files = _files(spark, os.path.join(table, "pointers", f"{n:012d}.json"))
        stream = files.open(path)
        held.add(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["version"])
        stream.close()
    for version in listed(spark, os.path.join(table, "data")):
        if version not in held:
            discard(spark, data_path(table, version))
    for n in numbers[:-keep]:
        discard(spark, os.path.join(table, "pointers", f"{n:012d}.json"))
