"""What the operators share: reading tables, row keys, cutting lineage, rolling hashes and bounded samples."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LAST = 2**63 - 1
HASH_BASE = 0x9E3779B97F4A7C15
OTHER_BASE = 0xC2B2AE3D27D4EB4F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: str, modulus: int, rest: int) -> Column:
    """True for rows no model may learn labels from: crc32 of the id's decimal text, modulo. False without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == rest, F.lit(False))


def keyed(docs: DataFrame) -> DataFrame:
    """doc, th, text: the id, a 64-bit hash of the text, and the text; doc and th tell rows of other content apart.

    A null text counts as empty. A null doc_id sorts after all others; 2**63 - 1 stands for it. Rows with the same id and
    text share a key, so that what is found out for one holds for each of them, and no join multiplies them. Joins on
    (doc, th) that ask for these three columns and no others exchange the texts once; later ones use that exchange again.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("th"), text.alias("text"))


def doc_id() -> Column:
    """The id again, from doc."""
    return F.when(F.col("doc") < LAST, F.col("doc")).alias("doc_id")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; a temporary one only where none is set, as in tests."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and go on from there; survives the loss of executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write df as a table in the shared folder and go on from there; computes df once, which a checkpoint does twice."""
    path = path or f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Steps:
    """Tables of a computation in steps. Each is stored, its shuffle files go as soon as it is (they would stay until the
    driver's JVM happens to collect garbage), and all of them go when the last step no longer needs them."""

    CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession, within: Steps | None = None) -> None:
        """within: other steps, whose drop takes these along."""
        self.spark, self.folder, self.count = spark, f"{within.folder if within else shared_folder(spark)}/steps-{uuid.uuid4().hex}", 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.count += 1
        before = self.spark.conf.get(self.CLEANUP, "false")
        self.spark.conf.set(self.CLEANUP, "true")
        try:
            return stored(df, f"{self.folder}/{self.count}")
        finally:
            self.spark.conf.set(self.CLEANUP, before)

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """The same rows without the grouping's partitioning, so that a join with them exchanges both sides and adaptive
    execution can split a hot key's rows, which it cannot where one side lies as its aggregate left it."""
    return df.hint("rebalance")


def bounded_sample(df: DataFrame, key: str, bound: int) -> DataFrame:
    """At most bound rows, by hash of key: the same rows in every run. For fitting only."""
    return df.orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(bound)


# ---- rolling hashes, vectorised -------------------------------------------------------------------------------

@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, size: int) -> np.ndarray:
    """base**0 .. base**(size-1) modulo 2**64; tables are kept by rounded size."""
    return _powers(base, 1 << max(12, (size - 1).bit_length()))[:size]


def rolling(values: np.ndarray, width: int, base: int = HASH_BASE) -> np.ndarray:
    """A mixed 64-bit polynomial hash of every run of width values; empty when there are fewer."""
    n = len(values)
    if n < width:
        return np.zeros(0, dtype=np.uint64)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * powers(pow(base, -1, 2**64), n), out=sums[1:])
    out = (sums[width:] - sums[:-width]) * powers(base, n - width + 1)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words), dtype=np.uint64, count=len(words))


def cover_runs(starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [from, to) covered by the width places from each of the sorted starts."""
    if not len(starts):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    new = np.flatnonzero(np.diff(starts) > width) + 1
    return starts[np.concatenate([[0], new])], starts[np.concatenate([new - 1, [len(starts) - 1]])] + width


def split_runs(positions: list[int] | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct positions as runs [from, to)."""
    p = np.unique(np.asarray(positions, dtype=np.int64))
    return cover_runs(p, 1)


def batches(frames: Iterator[pa.RecordBatch], rows: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of at most rows rows and, but for a single longer row, size bytes of the first text column, so that what a
    task holds at once stays small with long texts."""
    for frame in frames:
        texts = next((c for c in frame.columns if pa.types.is_string(c.type) or pa.types.is_large_string(c.type)), None)
        lengths = np.zeros(frame.num_rows) if texts is None else pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        upto = np.cumsum(lengths)
        at = 0
        while at < frame.num_rows:
            fits = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + size, side="right"))
            stop = max(at + 1, min(at + rows, fits))
            yield frame.slice(at, stop - at)
            at = stop


def uncollected(frames: Iterator) -> Iterator:
    """The same items, with Python's cycle collector off meanwhile: it would search large tables that hold no cycles."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield from frames
    finally:
        if was:
            gc.enable()


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 60) -> np.ndarray:
    """Weights, and last a constant, of P(y) = 1 / (1 + exp(-(x w + c))) by damped Newton steps.

    Targets are drawn in a little by the size of their class, so that classes which separate leave finite weights.
    """
    positive, negative = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    design = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    at = np.zeros(design.shape[1])

    def loss(v: np.ndarray) -> float:
        z = design @ v
        return float(np.sum(np.logaddexp(0, z) - target * z) + 5e-4 * (v @ v))

    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -500, 500)))
        curve = design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(len(at))
        step = np.linalg.solve(curve, design.T @ (target - p) - 1e-3 * at)
        damp = 1.0
        while loss(at + damp * step) > loss(at) and damp > 1e-6:
            damp /= 2
        at = at + damp * step
        if np.abs(damp * step).max() < 1e-8:
            break
    return at


def learnable(labels: DataFrame, label: str) -> DataFrame:
    """labelled_id and y (0 or 1), once per document, of the rows that labels may be learned from."""
    return (labels.select(F.col("doc_id").cast("long").alias("labelled_id"), F.col(label).cast("int").alias("y"))
            .where(F.col("labelled_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out("labelled_id", 5, 0))
            .groupBy("labelled_id").agg(F.max("y").alias("y")))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """doc_id, text and y of at most bound labelled documents; the bound is what makes the broadcast of their ids safe.
    Of different texts with one id, that with the smallest hash is learned from."""
    chosen = F.broadcast(bounded_sample(learnable(labels, label), "labelled_id", bound))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
            .join(chosen, F.col("doc_id") == F.col("labelled_id")).groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text", "y")).alias("first"))
            .select("doc_id", "first.text", "first.y"))
