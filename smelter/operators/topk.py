"""Most frequent values per group, and the first n rows of an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_counts_ranked(df: DataFrame, group_cols: list[str], col: str, k: int) -> DataFrame:
    """Rows ``(group.., value, count, rank)`` of the ``k`` most frequent values, ties by value (null last).

    Counts combine map-side; the rank is cut to ``k`` rows per group before the second shuffle.
    """
    counts = df.groupBy(*group_cols, F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    order = Window.partitionBy(*group_cols).orderBy(F.desc("count"), F.col("value").asc_nulls_last())
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def pack_ranked(ranked: DataFrame, group_cols: list[str], out: str) -> DataFrame:
    """One array of ``struct(value, count)`` per group, best first. The input holds at most k rows per group."""
    packed = F.sort_array(F.collect_list(F.struct("rank", "value", "count")))
    as_pairs = F.transform(packed, lambda e: F.struct(e["value"].alias("value"), e["count"].alias("count")))
    return ranked.groupBy(*group_cols).agg(as_pairs.alias(out))


def approx_top(col: str, k: int, tracked: int = 10000) -> Column:
    """Sketch of the ``k`` most frequent values (null included) as array of ``struct(value, count)``.

    Exact while a group has no more than ``tracked`` different values; beyond that counts may be low.
    """
    sketch = F.expr(f"approx_top_k(`{col}`, {int(k)}, {int(tracked)})")
    return F.transform(sketch, lambda e: F.struct(e["item"].alias("value"), e["count"].alias("count")))


def top_sketch(col: str, tracked: int = 10000) -> Column:
    """Aggregate: a frequent-items sketch of ``col`` that can be stored and merged with others later."""
    return F.expr(f"approx_top_k_accumulate(`{col}`, {int(tracked)})")


def merged_top(sketches: DataFrame, group_cols: list[str], col: str, k: int = 5, tracked: int = 10000, out: str = "top_values") -> DataFrame:
    """The ``k`` most frequent values per group out of stored sketches of its parts (days, say).

    The same as one sketch over all rows while a group has no more than ``tracked`` values; beyond that a count is off by at
    most 3.5/``tracked`` of the group's rows.
    """
    merged = sketches.groupBy(*group_cols).agg(F.expr(f"approx_top_k_combine(`{col}`, {int(tracked)})").alias("_s"))
    top = F.transform(F.expr(f"approx_top_k_estimate(_s, {int(k)})"), lambda e: F.struct(e["item"].alias("value"), e["count"].alias("count")))
    return merged.select(*group_cols, top.alias(out))


def top_values(df: DataFrame, group_cols: list[str], col: str, k: int = 5, exact: bool = True,
               out: str = "top_values") -> DataFrame:
    """The ``k`` most frequent values of ``col`` per group, as one array per group."""
    if exact:
        return pack_ranked(value_counts_ranked(df, group_cols, col, k), group_cols, out)
    return df.groupBy(*group_cols).agg(approx_top(col, k).alias(out))
