"""Joins whose skew is measured rather than hoped for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_SHARE = 1 / 200
SKETCH_ENTRIES = 4096
LEAST_SALTS = 32


def heavy_hitters(df: DataFrame, keys: list[str], share: float = HEAVY_SHARE, entries: int = SKETCH_ENTRIES) -> dict[str, list]:
    """For each key column the values that hold at least ``share`` of the rows: at most ``1/share`` of them, whatever the data.

    One pass for all keys. Each task keeps a frequent-items sketch of at most ``entries`` counters per key, and the
    sketches merge, so neither a hot key nor many different keys cost memory. A count can be too high by about
    3.5/``entries`` of the rows, so no heavy key is missed, and one slightly below ``share`` may be named as well.
    """
    most = int(1 / share)
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[
        F.expr(f"approx_top_k(`{k}`, {most}, {int(entries)})").alias(k) for k in keys]).first()
    return {k: [e["item"] for e in row[k] if e["item"] is not None and e["count"] > 1 and e["count"] >= row["_rows"] * share] for k in keys}


def join_dimension(fact: DataFrame, dim: DataFrame, key: str, spread_by: str | list[str], how: str = "inner",
                   hot: list | None = None, salts: int | None = None) -> DataFrame:
    """Join a fact table to a dimension with one row per key, with the ``hot`` keys (see :func:`heavy_hitters`) spread.

    The join runs on ``(key, salt)``: fact rows of a hot key are dealt over ``salts`` values (by default as many as there
    are shuffle partitions) by a hash of ``spread_by``, and the dimension rows of the hot keys are repeated once per salt.
    All other rows keep salt 0 and are not repeated. Without hot keys it is a plain join. Either way Catalyst
    broadcasts the dimension if its own size check says so.
    """
    if how not in ("inner", "left"):
        raise ValueError("join_dimension supports inner and left joins")
    if not hot:
        return fact.join(dim, key, how)
    salts = salts or max(LEAST_SALTS, int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    is_hot = F.col(key).isin(hot)
    spread_by = [spread_by] if isinstance(spread_by, str) else spread_by
    salted_fact = fact.withColumn(
        "_salt", F.when(is_hot, F.pmod(F.xxhash64(*spread_by), F.lit(salts))).otherwise(0).cast("int"))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_dim = dim.withColumn("_salt", F.explode(copies))
    return salted_fact.join(salted_dim, [key, "_salt"], how).drop("_salt")
