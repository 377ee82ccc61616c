"""Exact top-k search by inner product with multi-resolution segment statistics.

Every vector is cut into equal segments at several resolutions; each segment keeps its mean and its deviation. For two
vectors the squared distance is at least the sum over segments of length x ((difference of means)^2 + (difference of
deviations)^2), so the inner product is at most that of their statistics, each times the root of the segment's length. Coarse
to fine, a candidate whose bound cannot reach the query's k-th best score so far goes no further (a coarse resolution that
leaves most is passed over from then on); what is left of many is looked at in short floats first, and the survivors' scores are computed
exactly, in integers.

Candidates are packed where they are read and dealt to groups of bounded size, each to one group. The different query vectors,
packed as well, go to every group once and pass the group's candidates block by block, so that what a task holds is bounded, what is
shuffled is the candidates once and the queries once a group, and a group gives k + 1 rows a query. k + 1, as a query's own row is
among the candidates and is left out last.

Nulls: a null vector, a vector with a null or non-finite component, and a null vec_id take no part. Repeated rows: every
row is a candidate, also one that has the query's vec_id or vector; of equal vectors in a group the k + 1 with the smallest
vec_ids are all that can be among a query's best. Every row of a repeated query is answered. Ties go to the smaller vec_id. Vectors
of unequal length are as if filled up with zeros. Very long vectors: blocks and groups hold fewer rows.
Range: scores are exact while |query| x |candidate| stays below 2**63. Empty table: empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import Steps, spread

K, QUERY_BLOCK, CANDIDATE_BLOCK = 10, 1024, 4096
RESOLUTIONS = (2, 8, 32)
GROUP_COMPONENTS, BLOCK_COMPONENTS = 1 << 24, 1 << 19  # of the candidates that a task holds, and of a packed row
GROUPS, GROUP_ROWS = 48, 1024  # small tables: so many groups, if each gets so many rows
TILE_QUERIES, TILE, SEEDS, PAIRS = 512, 4096, 512, 1 << 15
LEAST = -2**63


def usable(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id and v, floor(scale * component), of every usable vector, and n, which is 1."""
    good = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(good)
            .select("vec_id", F.transform("embedding", lambda x: F.floor(x * scale)).alias("v"), F.lit(1).cast("long").alias("n")))


def whole_numbers(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id, v, floor(scale * component) of every usable vector, and n, the number of rows that have both."""
    return usable(vectors, scale).groupBy("vec_id", "v").agg(F.count("*").alias("n"))


def statistics(m: np.ndarray, parts: int) -> np.ndarray:
    """Means and deviations of each row's segments, each times the root of the segment's length, side by side."""
    rows, width = m.shape
    length = -(-width // parts)
    padded = np.zeros((rows, length * parts))
    padded[:, :width] = m
    cut = padded.reshape(rows, parts, length)
    mean = cut.mean(axis=2)
    deviation = np.sqrt(np.maximum((cut * cut).mean(axis=2) - mean * mean, 0))
    return np.concatenate([mean, deviation], axis=1) * length ** 0.5


class Known(NamedTuple):
    """Candidates in the order of their ids: whole numbers, short floats, the root of the largest squared length, and statistics."""

    ids: np.ndarray
    m: np.ndarray
    short: np.ndarray
    longest: float
    levels: list[np.ndarray]


def _levels(m: np.ndarray) -> list[np.ndarray]:
    """Statistics of every resolution, in short floats."""
    return [np.concatenate([statistics(m[a:a + 8192].astype(np.float64), p).astype(np.float32) for a in range(0, max(1, len(m)), 8192)])
            for p in [p for p in RESOLUTIONS if p <= m.shape[1]] or [1]]


def _length(m: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", m, m, dtype=np.float64))


def prepared(ids: np.ndarray, m: np.ndarray, k: int) -> Known:
    """The candidates, of equal vectors the k with the smallest ids."""
    order = np.argsort(ids, kind="stable")
    ids, m = ids[order], np.ascontiguousarray(m[order])
    if len(m) > k:
        _, which, many = np.unique(m.view(np.dtype((np.void, m.itemsize * m.shape[1]))).ravel(), return_inverse=True, return_counts=True)
        if many.max() > k:
            by = np.argsort(which, kind="stable")
            kept = np.sort(by[np.arange(len(by)) - (np.cumsum(many) - many)[which[by]] < k])
            ids, m = ids[kept], m[kept]
    return Known(ids, m, m.astype(np.float32), float(_length(m).max(initial=0)), _levels(m))


def _ranked(r: np.ndarray, s: np.ndarray, i: np.ndarray, rows: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of queries r, scores and ids, the k best of each query in order."""
    order = np.lexsort((i, -s, r))
    r, s, i = r[order], s[order], i[order]
    kept = np.arange(len(r)) - np.searchsorted(r, np.arange(rows))[r] < k
    return r[kept], s[kept], i[kept]


def nearest(q: np.ndarray, known: Known, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the query, score, vec_id) of each query's k best candidates, in order; ties to the smaller id."""
    rows, width = q.shape
    short, qs = q.astype(np.float32), _levels(q)
    # By how much a product of short floats may be off, for candidates of the greatest length.
    slack = (2 * width + 16) * 2.0**-23 * _length(q) * known.longest + 1e-6
    floor = np.full(rows, LEAST)
    best = tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
    waiting: list[tuple[np.ndarray, ...]] = []
    worth = [True] * len(qs)
    at, n = 0, len(known.ids)
    while at < n:
        upto = min(n, at + min(TILE, max(SEEDS, at)))
        size = rows * (upto - at)
        least = np.where(floor > LEAST, floor - slack, -np.inf).astype(np.float32)[:, None]
        alive = None
        if at:
            for level, worthwhile in enumerate(worth):
                if worthwhile:
                    mask = ~(qs[level] @ known.levels[level][at:upto].T < least)
                    alive = mask if alive is None else alive & mask
                    left = np.count_nonzero(alive)
                    worth[level] = left < size / 2 or level == len(worth) - 1
                    if left <= size // 64:
                        break
        if alive is None or np.count_nonzero(alive) > size // 64:
            mask = ~(short @ known.short[at:upto].T < least)
            alive = mask if alive is None else alive & mask
        pairs = np.flatnonzero(alive)
        for a in range(0, len(pairs), PAIRS):
            r, c = np.divmod(pairs[a:a + PAIRS], upto - at)
            c += at
            s = np.einsum("ij,ij->i", q[r], known.m[c], dtype=np.int64)
            # Candidates come by id: one that equals the k-th best comes too late.
            good = (s > floor[r]) | (floor[r] == LEAST)
            waiting.append((r[good], s[good], known.ids[c[good]]))
        at = upto
        if waiting and (at <= 4 * TILE or at >= n or sum(len(x[0]) for x in waiting) > rows * k):
            best = _ranked(*(np.concatenate(x) for x in zip(best, *waiting)), rows, k)
            waiting = []
            ends = np.searchsorted(best[0], np.arange(rows), side="right")
            full = np.bincount(best[0], minlength=rows) >= k
            floor[full] = best[1][ends[full] - 1]
    return best


def best_of_block(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the query, vec_id, score) of each query's k best candidates; ties to the smaller id. The query's own row is
    left out: one candidate with its id and vector."""
    width = max(q.shape[1], c.shape[1])
    q, c = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (q, c))
    r, s, i = nearest(q, prepared(c_ids, c, k + 1), k + 1)
    own = (i == q_ids[r]) & (s == np.einsum("ij,ij->i", q, q)[r])
    own[1:] &= ~(own[:-1] & (r[1:] == r[:-1]))  # such rows are alike and lie together
    r, i, s = r[~own], i[~own], s[~own]
    kept = np.arange(len(r)) - np.searchsorted(r, np.arange(len(q)))[r] < k
    return r[kept], i[kept], s[kept]


def _narrow(m: np.ndarray) -> np.ndarray:
    low, high = int(m.min(initial=0)), int(m.max(initial=0))
    return m.astype(next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def _packed(vectors: DataFrame, kept: list[str], rows: int, copies: int = 1) -> DataFrame:
    """Blocks of at most so many rows, as they are read: part and at, the task's number and the block's in it; how many rows, the
    kept whole numbers of each, and the matrix of their vectors, as bytes. A row of vectors counts n times, copies at most."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for frame in frames:
            lists = frame["v"]
            lengths = np.diff(lists.offsets.to_numpy())
            first = 0
            while first < frame.num_rows:
                widest = np.maximum.accumulate(np.maximum(lengths[first:first + rows], 1))
                last = first + max(1, int(np.searchsorted(widest * np.arange(1, len(widest) + 1), BLOCK_COMPONENTS, side="right")))
                m = np.zeros((last - first, int(widest[last - first - 1])), dtype=np.int64)
                m[np.arange(m.shape[1]) < lengths[first:last, None]] = lists.slice(first, last - first).flatten().to_numpy()
                numbers = np.stack([frame[c].to_numpy()[first:last] for c in kept], axis=1)
                if copies > 1:
                    many = np.minimum(frame["n"].to_numpy()[first:last], copies)
                    m, numbers = np.repeat(m, many, axis=0), np.repeat(numbers, many, axis=0)
                m = _narrow(m)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([at], pa.int64()), pa.array([len(m)], pa.int64()), pa.array([m.shape[1]], pa.int32()),
                     pa.array([m.itemsize], pa.int32()), pa.array([numbers.astype(np.int64).tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary())],
                    names=["part", "at", "rows", "width", "size", "kept", "m"])
                first, at = last, at + 1

    return vectors.select(*kept, "v", "n").mapInArrow(run, "part long, at long, rows long, width int, size int, kept binary, m binary")


def dealt(known: DataFrame, packed: DataFrame, groups: int) -> DataFrame:
    """Packed candidates, each in one group g, and packed queries (asks) in every group."""
    shape = ["part", "at", "width", "size", "kept", "m"]
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    return (known.select(F.pmod(F.col("part") * 31 + F.col("at"), F.lit(groups).cast("long")).alias("g"), F.lit(False).alias("asks"), *shape)
            .unionByName(packed.select(everywhere.alias("g"), F.lit(True).alias("asks"), *shape)))


def search(vectors: DataFrame, queries: DataFrame, *, k: int = K, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id and score; both sides have vec_id, v and n, and a query's own row is left out."""
    most, width_of = k + 1, F.coalesce(F.max("width"), F.lit(1))
    steps, left = Steps(vectors.sparkSession), Steps(vectors.sparkSession)
    key = [F.xxhash64("v").alias("h1"), F.xxhash64(F.lit("other"), "v").alias("h2")]  # 128 bits of the vector
    asked = left.keep(queries.select("vec_id", "v", *key, "n"))
    known = steps.keep(_packed(vectors, ["vec_id"], candidate_block, copies=most))
    packed = steps.keep(_packed(asked.dropDuplicates(["h1", "h2"]), ["h1", "h2"], query_block))
    total = known.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count("*").alias("blocks"), width_of.alias("width")).first()
    width = max(total["width"], packed.agg(width_of.alias("width")).first()["width"])
    groups = max(1, min(total["blocks"], max(-(-total["rows"] * width // GROUP_COMPONENTS), min(GROUPS, -(-total["rows"] // GROUP_ROWS)))))

    def whole(row: dict, numbers: int) -> tuple[np.ndarray, np.ndarray]:
        m = np.frombuffer(row["m"], dtype=f"i{row['size']}").reshape(-1, row["width"])
        return np.frombuffer(row["kept"], dtype=np.int64).reshape(-1, numbers), np.pad(m, ((0, 0), (0, width - m.shape[1])))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of every group first the candidates, then one block of queries after another."""
        group, blocks, ready = None, [], None
        for frame in frames:
            for at in range(frame.num_rows):
                row = {c: frame[c][at].as_py() for c in frame.schema.names}
                if row["g"] != group:
                    group, blocks, ready = row["g"], [], None
                if not row["asks"]:
                    blocks.append(whole(row, 1))
                    continue
                if ready is None:
                    if not blocks:
                        continue  # a group without candidates
                    ready, blocks = prepared(np.concatenate([x[:, 0] for x, _ in blocks]), np.concatenate([m for _, m in blocks]), most), []
                _, q = whole(row, 2)
                found = [nearest(q[a:a + TILE_QUERIES].astype(np.int64), ready, most) for a in range(0, len(q), TILE_QUERIES)]
                r = np.concatenate([x[0] + k * TILE_QUERIES for k, x in enumerate(found)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]], pa.int64()), pa.array([row["at"]], pa.int64()), pa.array([r.astype(np.int32).tobytes()], pa.binary()),
                     *(pa.array([np.concatenate([x[c] for x in found]).tobytes()], pa.binary()) for c in (1, 2))], names=["part", "at", "r", "s", "i"])

    partial = (dealt(known, packed, groups).repartition(4 * groups, "g").sortWithinPartitions("g", "asks", "part", "at")
               .mapInArrow(run, "part long, at long, r binary, s binary, i binary"))

    def merge(found: pa.Table, blocks: pa.Table) -> pa.Table:
        """The best of all groups for a block of queries."""
        row = {c: blocks[c][0].as_py() for c in blocks.schema.names}
        names, q = whole(row, 2)
        r, s, i = (np.concatenate([np.frombuffer(x, dtype=t) for x in found[c].to_pylist()] or [np.zeros(0, dtype=t)]).astype(np.int64) for c, t in (("r", np.int32), ("s", np.int64), ("i", np.int64)))
        r, s, i = _ranked(r, s, i, len(q), most)
        ends = np.concatenate([[0], np.cumsum(np.bincount(r, minlength=len(q)))]).astype(np.int32)
        pairs = pa.StructArray.from_arrays([pa.array(s), pa.array(i)], names=["score", "vec_id"])
        q = q.astype(np.int64)
        return pa.Table.from_arrays([pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array(np.einsum("ij,ij->i", q, q)), pa.ListArray.from_arrays(pa.array(ends), pairs)],
                                    names=["h1", "h2", "own", "best"])

    best = left.keep(partial.groupBy("part", "at").cogroup(packed.groupBy("part", "at"))
                     .applyInArrow(merge, "h1 long, h2 long, own long, best array<struct<score: bigint, vec_id: bigint>>"))
    steps.drop()
    # A query's own row, or one that is like it in all that is returned, is left out.
    met = asked.select(F.col("vec_id").alias("query_id"), "h1", "h2", "n").join(spread(best), ["h1", "h2"])
    own = F.array_position("best", F.struct(F.col("own").alias("score"), F.col("query_id").alias("vec_id"))).cast("int")
    others = F.slice(F.when(own > 0, F.concat(F.slice("best", F.lit(1), own - 1), F.slice("best", own + 1, F.lit(most)))).otherwise(F.col("best")), 1, k)
    return (met.select("query_id", "n", F.posexplode(others).alias("at", "x"))
            .select("query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", "x.score", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).drop("col"))


def hundredths(vectors: DataFrame, *, k: int = K) -> DataFrame:
    """The stated query set, the rows whose vec_id is divisible by 100, against all rows."""
    return search(usable(vectors), whole_numbers(vectors).where(F.col("vec_id") % 100 == 0), k=k)


SEARCH_SQL = """
WITH usable AS MATERIALIZED (
  SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
met AS (
  SELECT q.place, q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.place <> c.place WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id) AS rank FROM met) WHERE rank <= 10"""
