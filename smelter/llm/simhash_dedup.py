"""Near-duplicates by SimHash with a byte-position inverted index and count filtering.

A fingerprint of 64 bits is eight bytes at eight positions. Two that differ in at most three bits share at least five of
them. The index posts each different fingerprint under the bytes of eight groups of three positions (all triples within
either half), of which any five shared positions hold one whole; so every pair that links meets in a posting list. There
the pair's shared positional bytes are tallied, pairs with the guaranteed minimum of five are kept and verified bit by
bit. A list longer than ``longest`` is not compared as a whole: its members are posted again under five positions (all
that contain the list's three), where fingerprints differ in three bytes only, so that such a list cannot hold more than
2**24 whatever the input. Inside a list links are followed outwards from one fingerprint after another, and only a star
for each group found is written: rows grow with members, not with pairs. Components are then joined across lists.

Nulls: a null text has no words and the fingerprint zero, as an empty one; a null doc_id gets a fingerprint but sorts
last as a group's smallest (null component_id only in a group of null ids). Repeated rows are returned each. Empty table:
empty result. Very long texts: one row each, a few arrays of their length. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import LAST, Steps, batches, cut, spread, uncollected

POSITIONS, DISTANCE = 8, 3
LEAST_SHARED = POSITIONS - DISTANCE
TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]
LONGEST_LIST = 2000


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half of the hashes; 0 without hashes."""
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        votes += np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = (votes * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprint(text: str | None, width: int = 3) -> int:
    """The SimHash of the text's word shingles: bit set where over half of the shingles' XXH64 have it."""
    # Words are split at ASCII blanks and A-Z lower-cased only, which is what these do with bytes.
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist())),
                         dtype=np.uint64, count=len(words) - width + 1)
    return majority(hashes)


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, for every row of docs."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in uncollected(batches(frames, 512)):
            found = np.array([fingerprint(t, width) for t in frame.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def _byte(k: int):
    return F.shiftrightunsigned("fp", 8 * k).bitwiseAND(255)


def _posted(groups: list[tuple[int, ...]]):
    """An array of (group number, the bytes at the group's positions) for column fp."""
    def key(g):
        out = F.lit(0).cast("long")
        for k in g:
            out = out * 256 + _byte(k)
        return out
    return F.array(*[F.struct(F.lit(n).alias("g"), key(g).alias("k")) for n, g in enumerate(groups)])


def _shared_bytes(x: np.ndarray) -> np.ndarray:
    """How many of the eight bytes are zero, for differences x."""
    return (np.ascontiguousarray(x).view(np.uint8).reshape(-1, POSITIONS) == 0).sum(axis=1)


def stars(members: np.ndarray) -> list[tuple[int, int]]:
    """(member, smallest member reached) of the groups that links make among the sorted members of a posting list."""
    left = members.copy()
    out = []
    while len(left):
        root, wave, left = left[0], left[:1], left[1:]
        while len(wave) and len(left):
            at, wave = wave[0], wave[1:]
            apart = left ^ at
            near = np.zeros(len(left), dtype=bool)
            kept = np.flatnonzero(_shared_bytes(apart) >= LEAST_SHARED)
            near[kept] = np.bitwise_count(apart[kept]) <= DISTANCE
            if near.any():
                out.extend((int(m), int(root)) for m in left[near].view(np.int64))
                wave = np.concatenate([wave, left[near]])
                left = left[~near]
    return [(m, int(np.uint64(r).astype(np.int64))) for m, r in out]


def _grouped_stars(posted: DataFrame) -> DataFrame:
    """Stars of every posting list (g, k, fp)."""

    def run(key: tuple, frame: pa.Table) -> pa.Table:
        found = stars(np.unique(frame["fp"].to_numpy().view(np.uint64)))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return posted.groupBy("g", "k").applyInArrow(run, "a long, b long")


def links(distinct: DataFrame, longest: int = LONGEST_LIST) -> DataFrame:
    """Rows (a, b) of different fingerprints that connect exactly those that links connect; distinct has column fp."""
    posted = distinct.select("fp", F.explode(_posted(TRIPLES)).alias("p")).select("p.g", "p.k", "fp")
    sizes = posted.groupBy("g", "k").agg(F.count("*").alias("n"))
    short = posted.join(sizes.where(f"n between 2 and {longest}").select("g", "k"), ["g", "k"])
    long = posted.join(spread(sizes.where(f"n > {longest}").select("g", "k")), ["g", "k"])
    fives = [(n, five) for n, t in enumerate(TRIPLES) for five in combinations(range(POSITIONS), LEAST_SHARED) if set(t) <= set(five)]
    options = F.filter(F.array(*[F.struct(F.lit(n).alias("of"), F.lit(100 + m).alias("g"), _posted([five])[0]["k"].alias("k"))
                                 for m, (n, five) in enumerate(fives)]), lambda x: x["of"] == F.col("g"))
    again = long.select("fp", F.explode(options).alias("p")).select("p.g", "p.k", "fp")
    return _grouped_stars(short).unionByName(_grouped_stars(again)).distinct()


def components(edges: DataFrame, rounds: int = 60, within: Steps | None = None) -> DataFrame:
    """(a, root): the smallest node each node of edges (a, b) is connected to, by repeated hooking and shortcutting.

    Each round every node takes the smallest label among its neighbours' and its own, then its label's label. Rounds end
    when both ends of every edge have one label; their number grows with the logarithm of a group's diameter, and stars need
    none. Only counts reach the driver. Each table is stored once, in one job, and goes when it is no longer read; the last
    labels stay, in within's folder if given.
    """
    spark = edges.sparkSession
    fixed, held = Steps(spark, within), Steps(spark, within)
    both = fixed.keep(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = held.keep(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")))
    for _ in range(rounds):
        met = Steps(spark, within)
        offered = (both.join(labels.select(F.col("a").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"), F.max("root").alias("far")))
        hooked = met.keep(labels.join(offered, "a").select("a", "root", F.least("root", "near").alias("to"), (F.col("far") != F.col("root")).alias("open")))
        if not hooked.where("open or to <> root").limit(1).count():
            met.drop()
            fixed.drop()
            return labels
        # A node's label passes on what the node has learned, so whole trees hook at once.
        passed = hooked.groupBy(F.col("root").alias("t")).agg(F.min("to").alias("better"))
        moved = hooked.join(passed, hooked["root"] == passed["t"], "left").select("a", F.least("to", "better").alias("to"))
        jump = moved.select(F.col("a").alias("t"), F.col("to").alias("further"))
        following = Steps(spark, within)
        labels = following.keep(moved.join(jump, moved["to"] == jump["t"], "left").select("a", F.least("to", F.coalesce("further", "to")).alias("root")))
        held.drop()
        met.drop()
        held = following
    raise RuntimeError("components did not settle")


def cluster(docs: DataFrame, *, width: int = 3, longest: int = LONGEST_LIST) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id connected by links) for every row of docs."""
    marked = cut(fingerprints(docs, width))
    first = marked.groupBy("fp").agg(F.min(F.coalesce("doc_id", F.lit(LAST))).alias("first"))
    groups = components(links(first.select("fp"), longest))
    rooted = first.join(groups.withColumnRenamed("a", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("smallest"))
    by_print = rooted.join(smallest, "root").select("fp", F.when(F.col("smallest") < LAST, F.col("smallest")).alias("component_id"))
    return marked.join(by_print, "fp")


def cluster_digest(docs: DataFrame) -> DataFrame:
    """doc_id, the fingerprint in 16 hexadecimal digits, component_id."""
    return cluster(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, *, width: int = 3, longest: int = LONGEST_LIST) -> DataFrame:
    """The rows of docs, all columns, one of each group: that with the smallest doc_id (then by a hash of its text)."""
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in uncollected(batches(frames, 512)):
            found = np.array([fingerprint(t, width) for t in frame["text"].to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([frame["doc"], frame["th"], pa.array(found.view(np.int64))], names=["doc", "th", "fp"])

    marked = cut(rows.select("doc", "th", F.col("row.text").alias("text")).mapInArrow(run, "doc long, th long, fp long"))
    prints = marked.groupBy("fp").agg(F.min(F.struct("doc", "th")).alias("first"))
    groups = components(links(prints.select("fp"), longest))
    first = (prints.join(groups.withColumnRenamed("a", "fp"), "fp", "left")
             .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first")).select("first.*"))
    return rows.join(first, ["doc", "th"]).dropDuplicates(["doc", "th"]).select("row.*")
