"""Schema inference, comparison and growth."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.functions.casts import instant

# Type changes that lose nothing.
SAFE_WIDENINGS = {
    ("bigint", "double"), ("bigint", "decimal(38,9)"), ("double", "decimal(38,9)"), ("bigint", "string"),
    ("double", "string"), ("boolean", "string"), ("date", "timestamp"),
}


@dataclass(frozen=True)
class SchemaChanges:
    new_columns: list[tuple[str, str]] = field(default_factory=list)
    type_changes: list[tuple[str, str, str]] = field(default_factory=list)

    @property
    def is_compatible(self) -> bool:
        """True if every type change is a safe widening."""
        return all((old, new) in SAFE_WIDENINGS for _, old, new in self.type_changes)


def field_kinds(lines: DataFrame, col: str = "value", count_nulls: bool = True) -> DataFrame:
    """Rows ``(field, kinds)`` for the top-level fields of JSON lines: the sorted set of boolean, bigint, double, json (nested
    object) and string (text and lists) that a field was seen as.

    The set is a state that merges: see :func:`merged_kinds`. Each (field, kind) pair is counted once per task before the
    shuffle, so all lines are read. Without ``count_nulls`` a null says nothing about its field's kind.
    """
    spark = lines.sparkSession
    document = lines.select(F.try_parse_json(col).alias("_doc"))
    exploded = document.lateralJoin(spark.tvf.variant_explode(F.col("_doc").outer())).where("key IS NOT NULL")  # objects only
    shape = F.schema_of_variant("value")
    kind = (F.when(shape == "BOOLEAN", "boolean").when(shape == "BIGINT", "bigint")
            .when(shape.startswith("DECIMAL") | shape.isin("DOUBLE", "FLOAT"), "double")
            .when(shape.startswith("OBJECT"), "json"))
    kind = kind.otherwise("string") if count_nulls else kind.when(shape != "VOID", "string")
    seen = exploded.select(F.col("key").alias("field"), kind.alias("_kind")).distinct()
    return seen.groupBy("field").agg(F.sort_array(F.collect_set("_kind")).alias("kinds"))  # at most five values


def merged_kinds(states: DataFrame) -> DataFrame:
    """One state per field out of the states of several batches."""
    each = states.select("field", F.explode_outer("kinds").alias("_kind"))
    return each.groupBy("field").agg(F.sort_array(F.collect_set("_kind")).alias("kinds"))


def resolved_type(kinds: Column, strict: bool = False) -> Column:
    """The type that holds every kind: whole and fractional numbers widen to double, any other mix to string.

    ``strict`` ignores string as soon as another kind is seen, and turns any other mix into string. No kind gives string.
    """
    if strict:
        others = F.array_remove(kinds, "string")
        return F.when(F.size(others) == 1, others[0]).otherwise("string")
    return F.when(F.size(kinds) == 1, kinds[0]).when(kinds == F.array(F.lit("bigint"), F.lit("double")), "double").otherwise("string")


def infer_fields(lines: DataFrame, col: str = "value", strict: bool = False) -> DataFrame:
    """Rows ``(field, type)`` for the top-level fields of JSON lines; see :func:`field_kinds` and :func:`resolved_type`."""
    return field_kinds(lines, col).select("field", resolved_type(F.col("kinds"), strict).alias("type"))


def inferred_schema(inferred: DataFrame) -> dict[str, str]:
    """The inferred fields as a dict. One row per field, so this is small."""
    return {r["field"]: r["type"] for r in inferred.collect()}


def diff_schema(existing: T.StructType, incoming: T.StructType | dict[str, str]) -> SchemaChanges:
    """New columns and type changes in the incoming schema. Names that start with ``_`` are metadata and skipped."""
    have = {f.name: f.dataType.simpleString() for f in existing.fields}
    coming = incoming if isinstance(incoming, dict) else {f.name: f.dataType.simpleString() for f in incoming.fields}
    named = {k: v for k, v in coming.items() if not k.startswith("_")}
    return SchemaChanges(
        new_columns=[(k, v) for k, v in named.items() if k not in have],
        type_changes=[(k, have[k], v) for k, v in named.items() if k in have and have[k] != v])


def evolution_statements(table: str, changes: SchemaChanges) -> list[str]:
    """DDL for the new columns. Columns are never dropped; widenings wait for a human."""
    stored = {"json": "string"}
    return [f"ALTER TABLE {table} ADD COLUMNS (`{name}` {stored.get(kind, kind)})" for name, kind in changes.new_columns]


def evolve_table(spark: SparkSession, table: str, changes: SchemaChanges, dry_run: bool = False,
                 log_path: str | None = None, at: datetime | str | None = None) -> list[str]:
    """Add the new columns to a catalog table and log the change; returns the statements."""
    statements = evolution_statements(table, changes)
    if not dry_run:
        for statement in statements:
            spark.sql(statement)
    if log_path is not None:
        schema_change_log(spark, table, changes, statements, dry_run, at).write.mode("append").parquet(log_path)
    return statements


def schema_change_log(spark: SparkSession, table: str, changes: SchemaChanges, statements: list[str], dry_run: bool,
                      at: datetime | str | None = None) -> DataFrame:
    """One audit row about a schema change."""
    row = [(table, [f"{n} {t}" for n, t in changes.new_columns], [f"{n}: {a} -> {b}" for n, a, b in changes.type_changes],
            changes.is_compatible, statements, dry_run)]
    ddl = ("table string, new_columns array<string>, type_changes array<string>, is_compatible boolean, "
           "statements array<string>, dry_run boolean")
    return spark.createDataFrame(row, ddl).withColumn(
        "timestamp", instant(at) if at is not None else F.current_timestamp())


def evolve_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new rows under a schema with the columns of both; refuses unsafe type changes.

    A safely widened column takes the wider type on both sides.
    """
    changes = diff_schema(old.schema, new.schema)
    if not changes.is_compatible:
        raise ValueError(f"unsafe type changes: {changes.type_changes}")
    for name, _, wider in changes.type_changes:
        old = old.withColumn(name, F.col(f"`{name}`").cast(wider))
    return old.unionByName(new, allowMissingColumns=True)
