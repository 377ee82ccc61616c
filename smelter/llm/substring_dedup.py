"""Substring deduplication over words with difference-cover anchors.

Anchors are short runs of words at places that lie in a difference cover modulo a period. For any two places some shift
below the period brings both into the cover, so two equal windows share an anchor at the same offset; anchors held by one
document only need no further look. Anchors held by several are extended to the runs of windows that contain one. A run is
cut into blocks before windows whose own hash says so, which copies cut alike; of equal blocks only the smallest
document's is looked at window by window, and the smallest document of each window decides. So what is exchanged grows with
the different texts among the copies. Anchors, blocks and windows are grouped by hash with map-side minima, so a passage
that a third of all documents share is a third of the rows of no task; no pairs are formed.

A window's place is removed if its words also start a window in a document with a smaller doc_id; every word that a
removed window covers goes. Windows are judged on the input.

Nulls: a null text has no words; a null doc_id sorts after all others (so its rows lose what others hold, and keep what
only they hold). Repeated rows are returned each; rows of one doc_id never remove each other's words. Empty table: empty
result. Very long texts: one row each, a few arrays of their length. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import OTHER_BASE, batches, doc_id, keyed, rolling, spread, stored, uncollected, word_hashes

WINDOW = 50
BLOCK = 32  # windows in a block, on average
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)  # every difference modulo 31 is one of two places of the cover


def check_cover(period: int, cover: tuple[int, ...]) -> None:
    if {(a - b) % period for a in cover for b in cover} != set(range(period)):
        raise ValueError("not a difference cover of its period")


def words_of(text: str) -> list[bytes]:
    """Maximal runs of anything but ASCII blanks, unchanged."""
    return text.encode("utf-8", "replace").split()


def anchor_places(n: int, size: int, period: int, cover: tuple[int, ...]) -> np.ndarray:
    places = np.arange(max(0, n - size + 1))
    mask = np.zeros(period, dtype=bool)
    mask[list(cover)] = True
    return places[mask[places % period]]


def window_hashes(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every window."""
    hashes = word_hashes(words)
    return rolling(hashes, window), rolling(hashes, window, OTHER_BASE)


def duplicated_words(docs: DataFrame, *, window: int = WINDOW, period: int = PERIOD, cover: tuple[int, ...] = COVER) -> DataFrame:
    """doc, th, and lists lows and highs: runs [low, high) of places whose windows are to go; see ``keyed``."""
    check_cover(period, cover)
    size = window - period + 1
    if size < 1:
        raise ValueError("the period must not be longer than the window")
    rows = keyed(docs)

    def anchors(with_places: bool):
        def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for frame in uncollected(batches(frames, 512)):
                out: list[list[np.ndarray]] = [[], [], [], []]
                for text, doc, th in zip(frame["text"].to_pylist(), frame["doc"].to_pylist(), frame["th"].to_pylist()):
                    words = words_of(text)
                    if len(words) < window:
                        continue
                    places = anchor_places(len(words), size, period, cover)
                    hashes = rolling(word_hashes(words), size)[places]
                    if not with_places:
                        hashes = np.unique(hashes)
                        places = hashes
                    for column, values in zip(out, (hashes.view(np.int64), np.full(len(hashes), doc), np.full(len(hashes), th, dtype=np.int64), places)):
                        column.append(values)
                if out[0]:
                    columns = [pa.array(np.concatenate(c)) for c in (out if with_places else out[:2])]
                    if with_places:
                        columns[3] = columns[3].cast(pa.int32())
                    yield pa.RecordBatch.from_arrays(columns, names=["h", "doc", "th", "place"][:len(columns)])
        kinds = "h long, doc long" + ", th long, place int" * with_places
        return rows.select("text", "doc", "th").mapInArrow(run, kinds)

    def blocks(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Hash, place and number of windows of the blocks of windows that contain a shared anchor."""
        for frame in uncollected(batches(frames, 64)):
            out: list[list] = [[] for _ in range(6)]
            for text, doc, th, places in zip(*(frame[c].to_pylist() for c in ("text", "doc", "th", "places"))):
                words = words_of(text)
                wanted = np.zeros(len(words) - window + 2, dtype=np.int64)
                at = np.unique(np.array(places))
                np.add.at(wanted, np.maximum(at + size - window, 0), 1)
                np.add.at(wanted, np.minimum(at + 1, len(wanted) - 1), -1)
                starts = np.flatnonzero(np.cumsum(wanted)[:-1])
                w1, w2 = window_hashes(words, window)
                new = np.concatenate([[True], np.diff(starts) > 1]) | (w1[starts] % np.uint64(BLOCK) == 0)
                first = starts[new]
                lengths = np.diff(np.concatenate([np.flatnonzero(new), [len(starts)]]))
                for f, n in zip(first.tolist(), lengths.tolist()):
                    h = xxhash.xxh128_intdigest(w1[f:f + n].tobytes() + w2[f:f + n].tobytes())
                    for column, v in zip(out, ((h >> 64) - 2**63, (h & (2**64 - 1)) - 2**63, doc, th, f, n)):
                        column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, [pa.int64()] * 4 + [pa.int32()] * 2)],
                                             names=["b1", "b2", "doc", "th", "low", "n"])

    def windows(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Both hashes of every window of the blocks chosen."""
        for frame in uncollected(batches(frames, 64)):
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for text, doc, th, chosen in zip(*(frame[c].to_pylist() for c in ("text", "doc", "th", "chosen"))):
                starts = np.unique(np.concatenate([np.arange(x["low"], x["low"] + x["n"]) for x in chosen]))
                w1, w2 = window_hashes(words_of(text), window)
                for column, values in zip(out, (w1[starts].view(np.int64), (w2[starts] >> np.uint64(32)).astype(np.int64).astype(np.int32),
                                                np.full(len(starts), doc), np.full(len(starts), th, dtype=np.int64), starts.astype(np.int32))):
                    column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["w1", "w2", "doc", "th", "low"])

    shared = (anchors(False).groupBy("h").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
              .where("low < high").select("h"))
    found = anchors(True).join(spread(shared), "h").groupBy("doc", "th").agg(F.collect_list("place").alias("places"))
    held = stored(rows.join(found, ["doc", "th"]).select("text", "doc", "th", "places")
                  .mapInArrow(blocks, "b1 long, b2 long, doc long, th long, low int, n int"))
    owned = held.join(spread(held.groupBy("b1", "b2").agg(F.min("doc").alias("owner"))), ["b1", "b2"])
    # Blocks go whole outside the smallest document; there, the windows that another block's smaller document has.
    whole = owned.where("doc > owner").select("doc", "th", "low", (F.col("low") + F.col("n")).alias("high"))
    chosen = owned.where("doc = owner").groupBy("doc", "th").agg(F.collect_list(F.struct("low", "n")).alias("chosen"))
    candidates = (rows.join(chosen, ["doc", "th"]).select("text", "doc", "th", "chosen")
                  .mapInArrow(windows, "w1 long, w2 int, doc long, th long, low int"))
    first = candidates.groupBy("w1", "w2").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    single = (candidates.join(spread(first.select("w1", "w2", "first")), ["w1", "w2"]).where("doc > first")
              .select("doc", "th", "low", (F.col("low") + 1).alias("high")))
    return whole.unionByName(single).groupBy("doc", "th").agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs"))


def _kept(text: str, lows: list[int] | None, highs: list[int] | None, window: int) -> tuple[int, int, bytes]:
    """Number of words, of removed ones, and the kept ones joined."""
    words = words_of(text)
    if not lows:
        return len(words), 0, b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, np.array(lows), 1)
    np.add.at(change, np.array(highs) + window - 1, -1)
    kept = list(compress(words, (np.cumsum(change)[:-1] == 0).tolist()))
    return len(words), len(words) - len(kept), b" ".join(kept)


def _joined(docs: DataFrame, **parameters) -> DataFrame:
    return keyed(docs).join(duplicated_words(docs, **parameters), ["doc", "th"], "left").select(doc_id(), "text", "lows", "highs")


def _answers(window: int, digest: bool):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in uncollected(batches(frames, 256)):
            found = [_kept(t, a, b, window) for t, a, b in zip(*(frame[c].to_pylist() for c in ("text", "lows", "highs")))]
            last = [hashlib.sha256(k).hexdigest() for _, _, k in found] if digest else [k.decode() for _, _, k in found]
            yield pa.RecordBatch.from_arrays([frame["doc_id"], pa.array([n for n, _, _ in found], pa.int64()), pa.array([r for _, r, _ in found], pa.int64()),
                                              pa.array(last, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256" if digest else "kept_text"])
    return run


def remove_duplicated(docs: DataFrame, *, window: int = WINDOW, period: int = PERIOD, cover: tuple[int, ...] = COVER) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (kept words joined by one blank) for every row of docs."""
    return _joined(docs, window=window, period=period, cover=cover).mapInArrow(
        _answers(window, False), "doc_id long, n_words long, n_removed long, kept_text string")


def words_digest(docs: DataFrame) -> DataFrame:
    return _joined(docs).mapInArrow(
        _answers(WINDOW, True), "doc_id long, n_words long, n_removed long, kept_sha256 string")


DIGEST_SQL = r"""
WITH split_up AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (SELECT doc_id, p, array_to_string(ws[p:p + 49], ' ') AS w FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM split_up)),
firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT doc_id, p FROM windows JOIN firsts USING (w) WHERE doc_id > first),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM split_up),
marked AS (SELECT words.doc_id, words.p, word, gone.p IS NOT NULL AND words.p - gone.p < 50 AS removed
           FROM words ASOF LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p >= gone.p),
kept AS (SELECT doc_id, count(*) AS n_words, CAST(sum(CASE WHEN removed THEN 1 ELSE 0 END) AS BIGINT) AS n_removed,
                string_agg(word, ' ' ORDER BY p) FILTER (NOT removed) AS body FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)"""
