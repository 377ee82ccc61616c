"""Near copies by five-word shingles: every pair of texts whose sets of shingles have a Jaccard similarity of 0.8 or more.

SimHash comes first: the sets' 64-bit fingerprints go through the inverted index, count filter and bit check of
``simhash_dedup``, and each member of a group that links there make is held against the group's smallest on the whole sets.
Fingerprints of alike sets may differ in more bits, so what SimHash leaves is then settled exactly, by prefix filtering.
Of two sets of n and m shingles with that similarity, put in any one order, the first
n - ceil(0.8 n) + 1 and m - ceil(0.8 m) + 1 have one in common. Only these prefixes are posted. The order puts shingles
that a bounded sample of the texts holds often last, so that a passage which many texts hold is in no prefix but of texts
that are little else; the order decides what is compared, never what is found. Equal sets are one node first. Each
posting list links its members to its smallest, but for those that SimHash has connected with it; lists whose members are
not all connected by then compare the members
outside the list's largest group with the rest, but for pairs that two bounds refuse inside the join: the shingles that
follow the common one must suffice for the similarity (they do at the first shingle that a similar pair has in common),
and short parity bitmaps may differ in no more bits than the sets may in shingles. Every link is verified on the whole
sets, so that rows grow with members, not with pairs, where a large group is alike or a passage is all that texts share.

Words are those of ``simhash_dedup``; a text of fewer than five words is one shingle, and one without words equals the
others without. Shingles are told apart by 64-bit hashes. Null text: empty. A null doc_id sorts last. Repeated rows: one
is kept. Empty table: empty result. Very long texts: linear in their words, 8 bytes a shingle. Other columns, whatever
their names, pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm import simhash_dedup
from smelter.llm.common import LAST, Steps, batches, rolling, spread, stored, uncollected, word_hashes
from smelter.llm.simhash_dedup import components

WIDTH, FIFTHS = 5, 4  # words in a shingle; similarity in fifths
SHORT = 4  # whole numbers in a short bitmap
SAMPLE_ROWS, OFTEN, MOST_OFTEN = 40000, 4, 200000
_NODE = "struct<doc: bigint, th: bigint>"


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The sorted different hashes of the text's word shingles."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    return np.unique(rolling(word_hashes(words), min(width, len(words)))) if words else np.zeros(0, dtype=np.uint64)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets' similarity is 0.8 or more, in whole numbers."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * both >= FIFTHS * (len(a) + len(b) - both)


def parity(found: np.ndarray) -> bytes:
    """A bit for each value of the hashes' low digits, at least as many bits as hashes: is the number of hashes there odd?"""
    bits = 1 << max(6, (max(len(found), 1) - 1).bit_length())
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def signature(found: np.ndarray) -> np.ndarray:
    """The parity of the hashes' lowest byte, 256 bits in SHORT whole numbers; it refuses nothing of sets beyond some 1000."""
    odd = np.bincount((found & np.uint64(255)).astype(np.int64), minlength=64 * SHORT) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def could_be_alike(a: bytes, b: bytes, n: int, m: int) -> bool:
    """False only for sets of n and m that are not alike. Each hash that one set has alone turns one bit over, so bits that
    differ are no more than those hashes; the longer bitmap folds to the shorter one's length."""
    x, y = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return 9 * int(np.bitwise_count(x ^ y).sum()) <= n + m


def prefix(found: np.ndarray, often: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The shingles to post: the first n - ceil(0.8 n) + 1, by count in the sample (often is sorted), then by hash."""
    n = len(found)
    if not n:
        return found
    known = np.zeros(n, dtype=np.int64)
    if len(often):
        at = np.minimum(np.searchsorted(often, found), len(often) - 1)
        known = np.where(often[at] == found, counts[at], 0)
    return found[np.argsort(known, kind="stable")[:n + -FIFTHS * n // 5 + 1]]


def frequent(rows: DataFrame, steps: Steps) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and counts of shingles that OFTEN or more of a sample's texts hold; both sizes are bounded."""
    chosen = F.broadcast(rows.select("doc", "th").distinct().orderBy(F.xxhash64("doc", "th"), "doc", "th").limit(SAMPLE_ROWS))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in uncollected(batches(frames, 512)):
            for text in frame.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingles(text).view(np.int64))], names=["h"])

    counted = (rows.join(chosen, ["doc", "th"]).select("text").mapInArrow(run, "h long").groupBy("h").agg(F.count("*").alias("n"))
               .where(F.col("n") >= OFTEN).orderBy(F.desc("n"), "h").limit(MOST_OFTEN))
    found = steps.keep(counted).toArrow()
    hashes, counts = found["h"].to_numpy().view(np.uint64), found["n"].to_numpy()
    order = np.argsort(hashes)
    return hashes[order], counts[order]


def _sizes_allow(a: Column, b: Column) -> Column:
    return F.least(a, b) * 5 >= F.greatest(a, b) * FIFTHS


def _places_allow(n: Column, at: Column, m: Column, other: Column) -> Column:
    """Whether sets of n and m that meet at places at and other of their orders could be alike, if they meet there first."""
    return F.least(n - at, m - other) * 9 >= (n + m) * 4


def _signatures_allow(a: str, b: str, n: Column, m: Column) -> Column:
    return sum(F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(SHORT)) * 9 <= n + m


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike. Bitmaps of the sets, a 64th of their size, go to the pairs first; whole
    sets only to pairs that these leave."""

    def near(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            rows = zip(*(frame[c].to_pylist() for c in ("pa", "pb", "na", "nb")))
            yield frame.select(["a", "b"]).filter(pa.array([could_be_alike(*r) for r in rows], pa.bool_()))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            good = [alike(np.frombuffer(x.as_py(), dtype=np.uint64), np.frombuffer(y.as_py(), dtype=np.uint64)) for x, y in zip(frame["sa"], frame["sb"])]
            yield frame.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    pairs = (pairs.join(sets.select(F.col("node").alias("a"), F.col("bits").alias("pa"), F.col("n").alias("na")), "a")
             .join(sets.select(F.col("node").alias("b"), F.col("bits").alias("pb"), F.col("n").alias("nb")), "b")
             .select("a", "b", "pa", "pb", "na", "nb").mapInArrow(near, f"a {_NODE}, b {_NODE}"))
    return (pairs.join(sets.select(F.col("node").alias("a"), F.col("body").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("body").alias("sb")), "b")
            .select("a", "b", "sa", "sb").mapInArrow(run, f"a {_NODE}, b {_NODE}"))


def by_fingerprint(nodes: DataFrame, steps: Steps | None = None) -> DataFrame:
    """(a, b): each node (doc, th, n, fp) beside the smallest of the group that SimHash puts it in, sizes permitting.
    A node is an a once at most, and no b is an a."""
    groups = components(simhash_dedup.links(nodes.select("fp").distinct()), within=steps).withColumnRenamed("a", "fp")
    members = (nodes.select(F.struct("doc", "th").alias("node"), "n", "fp").join(groups, "fp", "left")
               .select("node", "n", F.coalesce("root", "fp").alias("root")))
    smallest = members.groupBy("root").agg(F.min(F.struct("node", "n")).alias("least"), F.count("*").alias("many")).where("many > 1")
    return (members.join(spread(smallest.select("root", "least")), "root")
            .where((F.col("node") != F.col("least.node")) & _sizes_allow(F.col("n"), F.col("least.n")))
            .select(F.col("node").alias("a"), F.col("least.node").alias("b")))


def connected(nodes: DataFrame, rows: DataFrame, steps: Steps) -> DataFrame:
    """(a, root): the smallest node that each node (doc, th, n, prefix, short, fp) with an alike set is connected to by pairs of such."""
    node = F.struct("doc", "th").alias("node")
    posted = nodes.select(node, "n", F.posexplode("prefix").alias("at", "h"))
    lists = posted.groupBy("h").agg(F.min(F.struct(F.col("node"), F.col("n"))).alias("least"), F.count("*").alias("many")).where("many > 1")
    shared = steps.keep(posted.join(spread(lists.select("h", "least")), "h").select("h", "node", "n", "at", "least"))

    def bodies(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in uncollected(batches(frames, 512)):
            found = [shingles(t) for t in frame["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [frame["node"], pa.array([len(x) for x in found], pa.int64()), pa.array([parity(x) for x in found], pa.binary()),
                 pa.array([x.tobytes() for x in found], pa.binary())], names=["node", "n", "bits", "body"])

    needed = shared.select("node.doc", "node.th").distinct()
    sets = steps.keep(rows.join(needed, ["doc", "th"], "left_semi").dropDuplicates(["doc", "th"]).select(node, "text")
                      .mapInArrow(bodies, f"node {_NODE}, n long, bits binary, body binary"))
    stars = (shared.where((F.col("node") != F.col("least.node")) & _sizes_allow(F.col("n"), F.col("least.n")))
             .select(F.col("node").alias("a"), F.col("least.node").alias("b")).distinct())
    similar = steps.keep(_verified(by_fingerprint(nodes, steps), sets))  # alike sets share a posted shingle, so sets has both of such a pair
    # Groups as they are: each a beside its group's smallest node, which is no a itself. No rounds are needed.
    known = similar.select("a", F.col("b").alias("root")).unionByName(similar.select(F.col("b").alias("a"), F.col("b").alias("root")).distinct())
    left = (stars.join(known.select("a", F.col("root").alias("ra")), "a", "left").join(known.select(F.col("a").alias("b"), F.col("root").alias("rb")), "b", "left")
            .where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b"))
    first = steps.keep(similar.unionByName(_verified(left, sets)))
    settled = components(first, within=steps)
    roots = settled.select(F.col("a").alias("node"), "root")
    marked = shared.select("h", "node", "n", "at").join(roots, "node", "left").select("h", "node", "n", "at", F.coalesce("root", "node").alias("root"))
    parts = marked.groupBy("h", "root").agg(F.count("*").alias("many"))
    open_lists = parts.groupBy("h").agg(F.max(F.struct("many", "root")).alias("most"), F.count("*").alias("parts")).where("parts > 1")
    held = steps.keep(marked.join(spread(open_lists.select("h", F.col("most.root").alias("main"))), "h").join(nodes.select(node, "short"), "node"))
    outside = held.where("root <> main").select("h", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("at").alias("ax"),
                                                F.col("root").alias("rx"), F.col("short").alias("sx"))
    n, nx = F.col("n"), F.col("nx")
    rest = (held.join(outside, "h").where((F.col("root") != F.col("rx")) & _sizes_allow(n, nx) & _places_allow(n, F.col("at"), nx, F.col("ax"))
                                          & _signatures_allow("short", "sx", n, nx))
            .select(F.greatest("node", "x").alias("a"), F.least("node", "x").alias("b")).distinct())
    # What is found last connects whole groups: rounds go over the groups' smallest nodes that it names, not over all links again.
    last = _verified(rest, sets)
    for end in ("a", "b"):
        last = (last.join(settled.select(F.col("a").alias(end), F.col("root").alias("of")), end, "left").withColumn(end, F.coalesce("of", end)).drop("of"))
    last = steps.keep(last.select("a", "b").distinct())
    merged = components(last, within=steps).select(F.col("a").alias("root"), F.col("root").alias("further"))
    return (settled.unionByName(merged.select(F.col("root").alias("a"), "root").join(settled.select("a"), "a", "left_anti"))
            .join(merged, "root", "left").select("a", F.coalesce("further", "root").alias("root")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, one of each connected group: that with the smallest doc_id (then by a hash of its text)."""
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))
    texts = rows.select("doc", "th", F.col("row.text").alias("text"))
    steps = Steps(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(frequent(texts, steps))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, counts = sent.value
        for frame in uncollected(batches(frames, 512)):
            found = [shingles(t) for t in frame["text"].to_pylist()]
            digests = [xxhash.xxh128_intdigest(x.tobytes()) for x in found]
            yield pa.RecordBatch.from_arrays(
                [frame["doc"], frame["th"], pa.array([(d >> 64) - 2**63 for d in digests], pa.int64()), pa.array([(d & (2**64 - 1)) - 2**63 for d in digests], pa.int64()),
                 pa.array([len(x) for x in found], pa.int64()), pa.array([prefix(x, often, counts).view(np.int64) for x in found], pa.list_(pa.int64())),
                 pa.array([signature(x) for x in found], pa.list_(pa.int64())),
                 pa.array(np.array([simhash_dedup.majority(x) for x in found], dtype=np.uint64).view(np.int64))],
                names=["doc", "th", "d1", "d2", "n", "prefix", "short", "fp"])

    marked = texts.mapInArrow(run, "doc long, th long, d1 long, d2 long, n long, prefix array<long>, short array<long>, fp long")
    nodes = steps.keep(marked.groupBy("d1", "d2").agg(F.min(F.struct("doc", "th", "n", "prefix", "short", "fp")).alias("x")).select("x.*"))
    later = connected(nodes, texts, steps).where("a <> root").select("a.doc", "a.th")
    first = stored(nodes.select("doc", "th").join(later, ["doc", "th"], "left_anti"))
    steps.drop()
    sent.destroy()
    return rows.join(first, ["doc", "th"]).dropDuplicates(["doc", "th"]).select("row.*")
