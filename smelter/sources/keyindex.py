"""Skip index: which months of a table may hold a key. Blocked Bloom filters as rows, made and merged by plain aggregates.

A key sets one bit in each of the eight words of a block, which is a row; ``bit_or`` over (month, block) makes a batch's
filter, and merges filters. A key was added by one batch, so each batch's row can be tested by itself, and rows of
later batches need not be merged with earlier ones until they are compacted. A test can err only towards "may hold": an
overfull filter costs reads, never rows.

``blocks`` is fixed for a table: about 50 keys a block and batch (or a block and month, once compacted) keep wrong answers
near 1 %.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = 4096
WORDS, PLACE_BITS = 8, 6
SCHEMA = "block int, " + ", ".join(f"w{i} bigint" for i in range(WORDS)) + ", month date"


def _masks(bits: Column) -> dict[str, Column]:
    """The words with the key's bit set: its place in word w is the w-th group of six bits."""
    places = [F.shiftright(bits, PLACE_BITS * w).bitwiseAND(F.lit(2**PLACE_BITS - 1)).cast("int") for w in range(WORDS)]
    return {f"m{w}": F.call_function("shiftleft", F.lit(1).cast("bigint"), place) for w, place in enumerate(places)}


def probes(df: DataFrame, keys: list[str], blocks: int) -> DataFrame:
    """df with the block and the masks m0 .. m7 of each key."""
    hashed = df.withColumns({"block": F.pmod(F.xxhash64(*keys), F.lit(blocks)).cast("int"), "_bits": F.xxhash64(F.lit("bits"), *keys)})
    return hashed.withColumns(_masks(F.col("_bits"))).drop("_bits")


def filters(keyed: DataFrame) -> DataFrame:
    """The filter rows of probed keys."""
    return keyed.groupBy("month", "block").agg(*[F.bit_or(f"m{w}").alias(f"w{w}") for w in range(WORDS)])


def merged(index: DataFrame) -> DataFrame:
    """One row for each month and block."""
    return index.groupBy("month", "block").agg(*[F.bit_or(f"w{w}").alias(f"w{w}") for w in range(WORDS)])


def possible(keyed: DataFrame, index: DataFrame, columns: list[str]) -> DataFrame:
    """Probed keys of which some filter of their month has every bit."""
    every = reduce(lambda a, b: a & b, [F.col(f"w{w}").bitwiseAND(F.col(f"m{w}")) == F.col(f"m{w}") for w in range(WORDS)])
    return keyed.join(index, ["month", "block"]).where(every).select(*columns).distinct()
