"""The prefix trie of conversations, by collapsing whole sequences.

Every conversation is rebuilt, and each of its prefixes named by a 128-bit chained digest, which is all that is shuffled from
there on. Identical conversations collapse into one sequence with a weight, the smallest id and a list of ends; sequences
that are a proper prefix of another are dropped by an anti join, which leaves the leaves; each sequence's prefixes, weighted,
are then added up to the nodes. Sums over subtrees need no walk: a node belongs to the sequence with its smallest id, so a
sequence owns the tail of its path, and what it owns from some depth on is what it adds to its prefix of that depth.

A node that most conversations share is one row for each task before it is shuffled; joins that it takes part in are joins of
one row with many, which adaptive execution splits. A list of ends is put together in pieces of at most 4096 ids, so that
the digest of a crowded end reads few rows in order. One conversation's turns are read in order by one task, and not held.

Nulls: null roles and texts are empty, null turns come first; rows with a null conv_id take no part. Equal turns are ordered
by role, then text, and all count. Repeated rows: turns of their own. Empty table: empty result, not even a root. Very long
texts: digested as they are. Other columns are not looked at. For negative ids c % 20 has the sign of c.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from smelter.llm.common import LAST, spread, stored

FAMILY = 20
SHARED = 4
WORD = r"[^\x20\x09-\x0D]+"
END_BITS = 12
ROOT = bytes(16)
PREFIX_SCHEMA = "conv_id long, depth long, prefix binary, parent binary, words long, ends boolean"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def shared_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes from its family's first."""
    return F.crc32(conv_id.cast("string").cast("binary")) % SHARED


def rebuilt_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, own, pos, turn, role, text``: rows that a conversation is rebuilt of, the family's (own = 0) and all of its own.

    Which of its own are skipped is seen in order later. The family's first turns go to every id that could want them, which
    are 19 and at most three turns each, so no join is needed; ids without rows of their own are left out later.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.where(F.col("conv_id").isNotNull())
    in_order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    first = rows.where(F.col("conv_id") % FAMILY == 0).withColumn("pos", F.row_number().over(in_order)).where(F.col("pos") < SHARED)
    b = F.col("conv_id")
    low = F.when((b > 0) | (b < -LAST + FAMILY), b).otherwise(b - FAMILY + 1)
    high = F.when((b < 0) | (b > LAST - FAMILY), b).otherwise(b + FAMILY - 1)
    given = (first.withColumn("target", F.explode(F.sequence(low, high)))
             .where((F.col("target") - F.col("target") % FAMILY == b) & (shared_turns(F.col("target")) >= F.col("pos")))
             .select(F.col("target").alias("conv_id"), F.lit(0).alias("own"), "pos", "turn", "role", "text"))
    return given.unionByName(rows.select("conv_id", F.lit(1).alias("own"), F.lit(0).alias("pos"), "turn", "role", "text"))


def prefixes(conversations: DataFrame) -> DataFrame:
    """Every prefix of every rebuilt conversation, the root among them: its digest and its parent's, the words of its last
    text, and whether the conversation ends there."""
    rows = rebuilt_turns(conversations).select(
        "conv_id", "own", "pos", "turn", "role", "text", F.when(F.col("own") == 1, shared_turns(F.col("conv_id"))).alias("skip"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "own", "pos", F.col("turn").asc_nulls_first(), "role", "text")
    ordered = ordered.select("conv_id", "own", "skip", "role", "text", "words")

    def work(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        talk, out = None, []
        for frame in frames:
            for conv_id, own, skip, role, text, words in zip(*(c.to_pylist() for c in frame.columns), strict=True):
                if talk is None or talk.conv_id != conv_id:
                    if talk is not None and talk.known:
                        out += talk.close()
                    talk = _Path(conv_id)
                if own and not talk.known:
                    talk.known, talk.skip = True, skip
                if own and talk.skip:
                    talk.skip -= 1
                    continue
                talk.step(role, text, words)
                if talk.known and len(talk.rows) > 2000:  # the last row waits, as it may be the end
                    out += talk.rows[:-1]
                    del talk.rows[:-1]
                if len(out) > 10_000:
                    yield _batch(out)
                    out = []
        if talk is not None and talk.known:
            out += talk.close()
        if out:
            yield _batch(out)

    return ordered.mapInArrow(work, PREFIX_SCHEMA)


class _Path:
    """The prefixes of a conversation as its turns come in; known once a row of its own was seen."""

    def __init__(self, conv_id: int) -> None:
        self.conv_id, self.known, self.skip, self.depth = conv_id, False, 0, 0
        self.at = ROOT
        self.rows: list[list] = [[conv_id, 0, ROOT, None, 0, False]]

    def step(self, role: str, text: str, words: int) -> None:
        role_bytes, text_bytes = role.encode(), text.encode()
        parent = self.at
        self.at = hashlib.blake2b(b"".join((parent, struct.pack("<Q", len(role_bytes)), role_bytes, text_bytes)), digest_size=16).digest()
        self.depth += 1
        self.rows.append([self.conv_id, self.depth, self.at, parent, words, False])

    def close(self) -> list[list]:
        self.rows[-1][-1] = True
        return self.rows


def _batch(rows: list[list]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}
    fields = [x.split() for x in PREFIX_SCHEMA.split(", ")]
    return pa.record_batch([pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)], names=[n for n, _ in fields])


def end_digests(paths: DataFrame) -> DataFrame:
    """prefix, ends_sha256 of each prefix at which conversations end: their ids in order, comma-joined."""
    pieces = (paths.where("ends").groupBy("prefix", F.shiftright("conv_id", END_BITS).alias("piece"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")))
    ordered = pieces.repartition("prefix").sortWithinPartitions("prefix", "piece").select("prefix", "ids")

    def work(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for frame in frames:
            done = []
            for prefix, ids in zip(frame.column(0).to_pylist(), frame.column(1).to_pylist(), strict=True):
                if prefix != now:
                    if now is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = prefix, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if done:
                yield pa.record_batch([pa.array(x, kind) for x, kind in zip(zip(*done, strict=True), (pa.binary(), pa.string()), strict=True)], names=["prefix", "ends_sha256"])
        if now is not None:
            yield pa.record_batch([pa.array([now], pa.binary()), pa.array([digest.hexdigest()])], names=["prefix", "ends_sha256"])

    return ordered.mapInArrow(work, "prefix binary, ends_sha256 string")


def sequences(paths: DataFrame) -> DataFrame:
    """The distinct rebuilt conversations: prefix (the whole sequence), conv_id (the smallest), weight (how many) and leaf (no
    other sequence goes on from it)."""
    whole = paths.where("ends").groupBy("prefix").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("weight"))
    proper = paths.where(~F.col("ends")).select("prefix").distinct()
    leaves = whole.join(proper, "prefix", "left_anti").select("prefix", F.lit(True).alias("leaf"))
    return whole.join(leaves, "prefix", "left").withColumn("leaf", F.coalesce("leaf", F.lit(False)))


def trie(conversations: DataFrame) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    paths = stored(prefixes(conversations))
    chosen = sequences(paths).select("conv_id", "weight", "leaf")
    steps = stored(paths.drop("ends").join(chosen, "conv_id"))  # the prefixes of one conversation for each sequence
    nodes = stored(steps.groupBy("prefix").agg(
        F.min("conv_id").alias("conv_id"), F.first("parent").alias("parent"), F.first("depth").alias("depth"),
        F.sum("weight").alias("n_convs"), F.sum(F.col("leaf").cast("long")).alias("n_leaves")))
    owned = steps.select("conv_id", "depth", "prefix", "words").join(nodes.select("prefix", "conv_id", "n_convs"), ["prefix", "conv_id"], "left")
    later = Window.partitionBy("conv_id").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    saved = (owned.withColumn("tail", F.sum(F.coalesce((F.col("n_convs") - 1) * F.col("words"), F.lit(0))).over(later))
             .groupBy("prefix").agg(F.sum("tail").alias("saved_tokens")))
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("prefix")).agg(F.count("*").alias("n_children"))
    above = nodes.select(F.col("prefix").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(saved, "prefix").join(children, "prefix", "left").join(end_digests(paths), "prefix", "left")
    return spread(out).join(spread(above), "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))


def _crc32(s: str) -> str:
    """CRC-32 of an ASCII text in SQL: each byte is followed by eight shifts."""
    step = "CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END"
    byte = "lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]"
    return (f"xor(list_reduce(flatten(list_transform(string_split({s}, ''), {byte})), lambda a, x: {step}, CAST(4294967295 AS BIGINT)), 4294967295)")


TRIE_SQL = f"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, {_crc32('CAST(c AS VARCHAR)')} % 4 AS h FROM (SELECT DISTINCT c FROM t)),
r AS (
  SELECT i.c, 0 AS own, t.pos, t.role, t.text FROM ids i JOIN t ON t.c = i.c - i.c % 20 AND t.pos <= i.h
  UNION ALL SELECT i.c, 1, t.pos, t.role, t.text FROM ids i JOIN t ON t.c = i.c AND t.pos > i.h),
p AS (SELECT i.c, coalesce(list({{'role': r.role, 'text': r.text}} ORDER BY own, pos) FILTER (r.c IS NOT NULL), []) AS turns
      FROM ids i LEFT JOIN r ON r.c = i.c GROUP BY i.c),
m AS (SELECT c, len(turns) AS n, unnest(range(len(turns) + 1)) AS depth, turns FROM p),
k AS (SELECT c, n, depth, turns[:depth] AS prefix FROM m),
node AS (
  SELECT prefix, min(c) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = depth), '')) AS ends_sha256,
         CASE WHEN any_value(depth) = 0 THEN 0 ELSE len(regexp_extract_all(prefix[-1].text, '[^\\x20\\x09-\\x0D]+')) END AS words
  FROM k GROUP BY prefix),
edge AS (SELECT n.*, n.prefix[:n.depth - 1] AS parent FROM node n WHERE depth > 0),
kids AS (SELECT parent AS prefix, count(*) AS n_children FROM edge GROUP BY 1),
up AS (
  SELECT n.prefix[:a.d] AS prefix, count(*) FILTER (kids.prefix IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
  FROM node n LEFT JOIN kids ON kids.prefix = n.prefix, LATERAL (SELECT unnest(range(n.depth + 1)) AS d) a GROUP BY 1)
SELECT node.conv_id, CAST(node.depth AS BIGINT) AS depth, above.conv_id AS parent_conv_id, node.n_convs, coalesce(kids.n_children, 0) AS n_children,
       up.n_leaves, CAST(up.saved_tokens AS BIGINT) AS saved_tokens, node.ends_sha256
FROM node JOIN up ON up.prefix = node.prefix LEFT JOIN kids ON kids.prefix = node.prefix
LEFT JOIN edge ON edge.prefix = node.prefix LEFT JOIN node above ON above.prefix = edge.parent"""
