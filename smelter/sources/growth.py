"""Schema growth across batches: what fields a feed's lines have had, as a versioned registry beside the tables.

The registry of an entity holds one state per field, the set of kinds it was seen as, merged with each batch; its type
follows from the state. Every change makes a new version (:mod:`smelter.sources.versions`) and a row in the change log.
Fields that the cleaned schema does not know are kept in the cleaned table as text and read as the registry's type, so a
type that widens later needs no file to be written again.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.operators.evolution import SchemaChanges, field_kinds, merged_kinds, resolved_type, schema_change_log
from smelter.schemas import SILVER_TABLES, bronze_schema, get_schema
from smelter.sources import versions

MOST_FIELDS = 2000
STORED = {"json": "string"}
_NAME = re.compile(r"[A-Za-z][A-Za-z0-9_]*")


class TooManyFields(ValueError):
    """Lines whose keys are data (ids, say): no table can have a column for each."""


def registry_path(root: str, entity: str) -> str:
    return os.path.join(root, "schema", SILVER_TABLES[entity])


def change_log_path(root: str) -> str:
    return os.path.join(root, "schema", "changes")


def _states(spark: SparkSession, root: str, entity: str) -> DataFrame | None:
    path = registry_path(root, entity)
    return versions.current(spark, path) if versions.pointer(spark, path) else None


def registered_fields(spark: SparkSession, root: str, entity: str) -> dict[str, str]:
    """Every field seen so far with its type; none before the first batch. Bounded by MOST_FIELDS."""
    states = _states(spark, root, entity)
    return {} if states is None else {r["field"]: r["type"] for r in states.select("field", "type").collect()}


def _may_grow(entity: str, names: list[str]) -> list[str]:
    """Names that can be columns beside the declared ones: plain, and different from them and each other whatever the case."""
    taken = {f.name.lower() for f in bronze_schema(entity).fields} | {"dt", "bad"}
    out = []
    for name in sorted(names):
        if _NAME.fullmatch(name) and name.lower() not in taken:
            taken.add(name.lower())
            out.append(name)
    return out


def raw_extra(spark: SparkSession, root: str, entity: str) -> str | None:
    """DDL of the fields that raw lines are parsed for beside the declared ones; all as text."""
    names = _may_grow(entity, list(registered_fields(spark, root, entity)))
    return ", ".join(f"{n} string" for n in names) or None


def grown_columns(spark: SparkSession, root: str, entity: str) -> dict[str, str]:
    """Columns of the cleaned table that growth has added, with the type they are read as."""
    fields = registered_fields(spark, root, entity)
    declared = {f.name.lower() for f in get_schema(entity).fields}
    # Raw fields that staging renames or drops are declared as well.
    names = [n for n in _may_grow(entity, list(fields)) if n.lower() not in declared and not n.startswith("_")]
    return {n: STORED.get(fields[n], fields[n]) for n in names}


def learn(spark: SparkSession, root: str, entity: str, lines: DataFrame, at: str, batch: str) -> SchemaChanges:
    """Merge the fields of a batch's lines into the registry; a new version and a log row if anything changed."""
    found = field_kinds(lines, count_nulls=False).limit(MOST_FIELDS + 1).collect()
    if len(found) > MOST_FIELDS:
        raise TooManyFields(f"{entity}: more than {MOST_FIELDS} different fields in batch {batch}")
    ddl = "field string, kinds array<string>"
    states = spark.createDataFrame([(r["field"], r["kinds"]) for r in found], ddl)
    before = _states(spark, root, entity)
    had = {} if before is None else {r["field"]: (r["kinds"], r["type"]) for r in before.collect()}
    merged = merged_kinds(states if before is None else states.unionByName(before.select("field", "kinds")))
    now = merged.withColumn("type", resolved_type(F.col("kinds"))).collect()
    if len(now) > MOST_FIELDS:
        raise TooManyFields(f"{entity}: more than {MOST_FIELDS} different fields up to batch {batch}")
    declared = {f.name for f in bronze_schema(entity).fields}
    changes = SchemaChanges(
        new_columns=[(r["field"], r["type"]) for r in now if r["field"] not in had and r["field"] not in declared],
        type_changes=[(r["field"], had[r["field"]][1], r["type"]) for r in now if r["field"] in had and had[r["field"]][1] != r["type"]])
    if any(had.get(r["field"], (None,))[0] != r["kinds"] for r in now):
        table = spark.createDataFrame([tuple(r) for r in now], f"{ddl}, type string")
        version = versions.replace(table.coalesce(1), registry_path(root, entity))
        if changes.new_columns or changes.type_changes:
            log = schema_change_log(spark, SILVER_TABLES[entity], changes, [], False, at)
            log.withColumns({"version": F.lit(version), "batch": F.lit(batch)}).coalesce(1).write.mode("append").parquet(change_log_path(root))
    return changes


def stored_fields(grown: dict[str, str]) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in grown]
