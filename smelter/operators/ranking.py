"""Exact ranking metrics of a score, distributed: rank sums over ranges of the score, and calibration.

Rows are first counted per distinct score, which combines map-side, so ties (a constant score too) are one row. The
counts are dealt out by ranges of the score and stored; each range's total, one row for each partition, gives the
offset that its own running sums start from. No window and no sort sees all rows in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smelter.session import land


def rank_sums(df: DataFrame, label: str, score: str) -> DataFrame:
    """``score, positives, negatives, below`` for each distinct score: rows with a lower score that are negative.

    Rows with a null label or score take no part.
    """
    counts = (df.select(F.col(score).cast("double").alias("score"), F.col(label).cast("double").alias("y")).where("score IS NOT NULL AND y IS NOT NULL")
              .groupBy("score").agg(F.count_if(F.col("y") == 1).alias("positives"), F.count_if(F.col("y") != 1).alias("negatives")))
    # Stored, so that a lost executor cannot draw other ranges.
    ranged = land(counts.repartitionByRange("score").withColumn("part", F.spark_partition_id()))
    totals = sorted(tuple(r) for r in ranged.groupBy("part").agg(F.sum("negatives")).collect())  # one row per partition
    offsets, seen = [], 0
    for part, total in totals:
        offsets.append((part, seen))
        seen += total
    offset = df.sparkSession.createDataFrame(offsets, "part int, offset bigint")
    running = Window.partitionBy("part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    within = ranged.withColumn("within", F.coalesce(F.sum("negatives").over(running), F.lit(0)))
    return within.join(offset, "part").select("score", "positives", "negatives", (F.col("within") + F.col("offset")).alias("below"))


def roc_auc(df: DataFrame, label: str, score: str) -> float | None:
    """The share of (positive, negative) pairs that the score puts in order, ties counting half; None without both classes."""
    row = rank_sums(df, label, score).agg(
        F.sum(F.col("positives") * (F.col("below").cast("double") + F.col("negatives") / 2)).alias("ordered"),
        F.sum("positives").alias("p"), F.sum("negatives").alias("n")).first()
    return row["ordered"] / row["p"] / row["n"] if row["p"] and row["n"] else None


def calibration(df: DataFrame, label: str, probability: str, bins: int = 10) -> DataFrame:
    """For each of ``bins`` equal ranges of the probability: rows, mean probability and share of positives."""
    p, y = F.col(probability).cast("double"), F.col(label).cast("double")
    place = F.least(F.greatest(F.floor(p * bins), F.lit(0)), F.lit(bins - 1))
    return (df.where(p.isNotNull() & y.isNotNull()).groupBy(place.alias("bin"))
            .agg(F.count(F.lit(1)).alias("rows"), F.avg(p).alias("mean_probability"), F.avg(y).alias("positive_share")))


def calibration_error(df: DataFrame, label: str, probability: str, bins: int = 10) -> float | None:
    """Mean distance between probability and share of positives, weighted by the rows of each range."""
    gap = F.abs(F.col("mean_probability") - F.col("positive_share"))
    return calibration(df, label, probability, bins).agg(F.sum(gap * F.col("rows")) / F.sum("rows")).first()[0]
