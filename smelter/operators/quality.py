"""Data checks as aggregates.

A check result is one row ``(table, check, level, observed, threshold, passed, rows_checked)``. All
checks of a table that need no grouping share one pass; each uniqueness check adds one grouped count,
which combines map-side, so a key that repeats a billion times is one row per task.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.functions.casts import instant

RESULT_DDL = ("table string, check string, level string, observed double, threshold double, "
              "passed boolean, rows_checked bigint")


class CheckFailed(ValueError):
    """Raised by :func:`raise_if_failed`; ``failures`` holds the failed result rows."""

    def __init__(self, failures: list):
        self.failures = failures
        super().__init__("; ".join(f"{r['table']}: {r['check']} observed {r['observed']}" for r in failures))


@dataclass(frozen=True)
class Check:
    """One measured value and the bound it must keep. Build it with the functions below."""

    name: str
    threshold: float
    bound: str  # 'max', 'min' or 'below'
    measure: Column | None = None
    keys: tuple = ()
    where: str | None = None
    level: str = "fail"

    def passed(self, observed: Column) -> Column:
        limit = F.lit(float(self.threshold))
        rule = {"max": observed <= limit, "min": observed >= limit, "below": observed < limit}[self.bound]
        return F.coalesce(rule, F.lit(False))


def row_count(at_least: int = 1) -> Check:
    return Check(f"row_count >= {at_least}", at_least, "min", F.count(F.lit(1)))


def missing(column: str, at_most: int = 0) -> Check:
    return Check(f"missing_count({column})", at_most, "max", F.count_if(F.col(column).isNull()))


def invalid(column: str, allowed: list, at_most: int = 0) -> Check:
    """Values outside ``allowed``; nulls are not invalid."""
    bad = F.col(column).isNotNull() & ~F.col(column).isin(allowed)
    return Check(f"invalid_count({column})", at_most, "max", F.count_if(bad))


def duplicate(column: str | list[str], where: str | None = None, at_most: int = 0) -> Check:
    """Keys that occur more than once among the rows that satisfy ``where``."""
    keys = (column,) if isinstance(column, str) else tuple(column)
    name = f"duplicate_count({', '.join(keys)})" + (f" where {where}" if where else "")
    return Check(name, at_most, "max", keys=keys, where=where)


def freshness(column: str, hours: float, as_of: datetime | str) -> Check:
    """Age in hours of the newest value at ``as_of``; no value at all fails."""
    age = (F.unix_micros(instant(as_of)) - F.unix_micros(F.max(F.col(column).cast("timestamp")))) / 3.6e9
    return Check(f"freshness({column}) hours", hours, "below", age)


def required_columns(df: DataFrame, table: str, columns: list[str], level: str = "warn") -> DataFrame:
    """One result row: how many of the columns the schema lacks. Reads no data."""
    lacking = sorted(set(columns) - set(df.columns))
    row = (table, f"required_columns({', '.join(columns)})", level, float(len(lacking)), 0.0, not lacking, 0)
    return df.sparkSession.createDataFrame([row], RESULT_DDL)


def _result(table: str, check: Check, observed: Column, rows: Column) -> Column:
    value = observed.cast("double")
    return F.struct(
        F.lit(table).alias("table"), F.lit(check.name).alias("check"), F.lit(check.level).alias("level"),
        value.alias("observed"), F.lit(float(check.threshold)).alias("threshold"),
        check.passed(value).alias("passed"), rows.cast("bigint").alias("rows_checked"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row, and how many; a key with a null part does not count."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")


def run_checks(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """Measure all checks of one table; one result row per check."""
    flat = [c for c in checks if not c.keys]
    parts = []
    if flat:
        measured = df.agg(F.count(F.lit(1)).alias("_rows"),
                          *[c.measure.cast("double").alias(f"_m{i}") for i, c in enumerate(flat)])
        rows = F.array(*[_result(table, c, F.col(f"_m{i}"), F.col("_rows")) for i, c in enumerate(flat)])
        parts.append(measured.select(F.explode(rows).alias("_r")).select("_r.*"))
    for check in (c for c in checks if c.keys):
        scope = df.where(check.where) if check.where else df
        # One pass: rows per key, then keys that repeat and rows in all.
        per_key = scope.groupBy(*check.keys).agg(F.count(F.lit(1)).alias("_n"))
        full = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in check.keys])
        counted = per_key.agg(F.count_if((F.col("_n") > 1) & full).alias("_dups"), F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"))
        parts.append(counted.select(_result(table, check, F.col("_dups"), F.col("_rows")).alias("_r")).select("_r.*"))
    return reduce(DataFrame.unionByName, parts)


def raise_if_failed(results: DataFrame) -> list:
    """Collect the results (one row per check), raise on a failed one, return those that only warn."""
    failed = results.where(~F.col("passed")).collect()
    hard = [r for r in failed if r["level"] == "fail"]
    if hard:
        raise CheckFailed(hard)
    return failed


# ---- raw batch statistics ----------------------------------------------------------------------

# Key, and columns whose null makes a raw row count as null, per entity.
BRONZE_KEYS = {
    "user": (("user_id",), ("user_id",)),
    "business": (("business_id",), ("business_id",)),
    "checkin": (("business_id",), ("business_id",)),
    "review": (("review_id",), ("user_id", "business_id")),
    "tip": (("user_id", "business_id", "date"), ("user_id", "business_id")),
}


def bronze_key_stats(df: DataFrame, keys: list[str], null_cols: list[str]) -> DataFrame:
    """One row: raw rows with a null among ``null_cols``, and keys that repeat. For warnings only."""
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in null_cols])
    full_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count_if(any_null).alias("_nulls"))
    return per_key.agg(
        F.coalesce(F.sum("_nulls"), F.lit(0)).alias("total_nulls"),
        F.count_if((F.col("_n") > 1) & full_key).alias("total_duplicates"))


# ---- checks of a loaded batch ------------------------------------------------------------------

def check_null_keys(df: DataFrame, keys: list[str], in_batch: Column) -> DataFrame:
    """One row: batch rows with a null key part, and batch rows seen (0 seen means nothing was checked)."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.where(in_batch).agg(F.count_if(any_null).alias("null_keys"), F.count(F.lit(1)).alias("rows_checked"))


def check_single_active(df: DataFrame, key: str, in_batch: Column) -> DataFrame:
    """Keys the batch touched that have more than one current row.

    One grouped pass decides both questions, so there is no self-join.
    """
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.max(in_batch).alias("_touched"), F.count_if(F.col("is_current")).alias("active_count"))
    return per_key.where(F.col("_touched") & (F.col("active_count") > 1)).select(key, "active_count")


def check_fact_keys(df: DataFrame, keys: list[str], in_batch: Column) -> DataFrame:
    """One row about the batch: null key parts, keys that repeat, rows seen."""
    full_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    per_key = df.where(in_batch).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum(F.when(~full_key, F.col("_n"))), F.lit(0)).alias("null_keys"),
        F.count_if((F.col("_n") > 1) & full_key).alias("duplicate_keys"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_checked"))


# ---- the standing checks of the cleaned tables -------------------------------------------------

def silver_checks(entity: str, as_of: datetime | str) -> list[Check]:
    """Which checks each cleaned table must pass."""
    fresh = freshness("_ingested_at", 24, as_of)
    if entity == "review":
        return [row_count(), missing("review_id"), missing("user_id"), missing("business_id"), duplicate("review_id"),
                invalid("stars", [1, 2, 3, 4, 5]), fresh]
    if entity == "business":
        return [row_count(), missing("business_id"), fresh, duplicate("business_id", "is_current = true")]
    if entity == "user":
        return [row_count(), missing("user_id"), fresh, duplicate("user_id", "is_current = true")]
    return []


def peek(df: DataFrame, n: int = 1, width: int = 100) -> tuple[int, list[dict]]:
    """Row count and the first ``n`` rows, with text cut to ``width`` characters for display."""
    shown = df.select(*[F.substring(F.col(f"`{c}`"), 1, width).alias(c) if t == "string" else F.col(f"`{c}`")
                        for c, t in df.dtypes])
    return df.count(), [r.asDict() for r in shown.limit(n).collect()]
