"""Keep one row per key, and expand delimited lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.functions.hashing import row_fingerprint

ColumnLike = str | Column


def _column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dedup_latest(df: DataFrame, keys: list[ColumnLike], newest_first: list[ColumnLike],
                 tie_break: list[ColumnLike] | None = None) -> DataFrame:
    """The row of each key that sorts first by ``newest_first`` (descending, nulls last).

    Rows that tie are told apart by ``tie_break``; by default by a fingerprint of the whole row, so
    that a re-run keeps the same row.

    ``row_number() = 1`` lets Spark put a group limit before the shuffle: each map task sends at most
    one row per key, so a key that holds a third of the input costs one row per task, not one huge
    partition.
    """
    ties = [row_fingerprint(df).asc()] if tie_break is None else [_column(c).desc_nulls_last() for c in tie_break]
    order = [_column(c).desc_nulls_last() for c in newest_first] + ties
    window = Window.partitionBy(*[_column(k) for k in keys]).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def explode_list(df: DataFrame, col: str, out: str, sep: str = ",", cast: str | None = "timestamp") -> DataFrame:
    """One row per non-blank item of a delimited string; the items are trimmed, then cast.

    An item that does not cast keeps its row with a null: :func:`split_null_keys` routes it.
    """
    pieces = F.split(F.col(col).cast("string"), f"[{sep}]" if sep not in r"\^" else f"\\{sep}")
    exploded = df.withColumn("_item", F.explode(pieces)).withColumn("_item", F.trim("_item")).where("_item <> ''")
    value = F.col("_item").try_cast(cast) if cast else F.col("_item")
    return exploded.withColumn(out, value).drop("_item")


def split_null_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a full key, and rows to quarantine because some key column is null."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return df.where(~missing), df.where(missing)
