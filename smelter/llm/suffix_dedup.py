"""Suffix-array deduplication over bytes, by external induced sorting of shards.

Byte strings of ``width`` that more than one document holds are found with sorted suffixes. All places of one string must
meet in one shard, so each string is dealt by its minimizer: the least hash of the grams inside it, which equal strings
share. Runs of strings with one minimizer form a segment. Of documents with one whole text, the smallest one's only are looked
at; the others lose all of their strings. Which minimizers several documents hold is found by blocks of
64 documents, whose minimizers travel packed, a row for each block and shard. Those that one document only holds need no sorting, nor do those
whose segments are all equal; of equal segments one, in its smallest document, is sorted and stands for all. In a shard, strings that
are alone by hash are left out first, and of segments whose rests are then equal one stands for all (``settled``). A shard is the segments dealt to it, one after
another; its suffixes and their common prefixes come from ``external_suffixes``, whose queues go to disk where a shard is
larger than the memory budget. Suffixes that share width bytes are one string; its smallest document keeps it.
Where one minimizer has more than ``crowd`` different segments, as at the edge of a passage that many documents hold with
different text beside it, no task gets them all: their strings are told apart by 128-bit hashes, and the
smallest document of each is taken map-side.

Every byte covered by a string that also starts in a document with a smaller doc_id is removed. Strings are judged on the
input; none crosses documents. Counts and minima are taken map-side first, so that a passage which a third of all
documents share is no task's third of the rows; no pairs are formed.

Nulls: a null text is empty; a null doc_id sorts after all others. Repeated rows are returned each; rows of one doc_id never
remove each other's bytes. Empty table: empty result. Very long texts: whole. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import HASH_BASE, LAST, Steps, batches, cover_runs, doc_id, keyed, rolling, spread, uncollected
from smelter.llm.external_suffixes import scratch, suffixes

WIDTH, GRAM = 50, 20
SHARD_BYTES, QUEUE_BYTES = 8 << 20, 64 << 20
BLOCK_BITS, PIECE_BYTES, MEETING_BYTES = 6, 1 << 16, 16 << 20
CROWD = 1000
_BYTE = np.random.default_rng(5).integers(1, 2**63, 256).astype(np.uint64)


def minimizers(raw: np.ndarray, width: int, gram: int) -> np.ndarray:
    """The least gram hash inside each string of width bytes."""
    low = rolling(_BYTE[raw], gram, HASH_BASE)
    reach, done = width - gram + 1, 1
    if len(low) < reach:
        return np.zeros(0, dtype=np.int64)
    while 2 * done <= reach:
        low = np.minimum(low[:-done], low[done:])
        done *= 2
    if done < reach:
        low = np.minimum(low[:done - reach], low[reach - done:])
    return low.view(np.int64)


def segments(raw: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimizer, first string and end of strings (both as places) of each run of strings with one minimizer."""
    low = minimizers(raw, width, gram)
    if not len(low):
        return low, low, low
    starts = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1])
    return low[starts], starts, np.concatenate([starts[1:], [len(low)]])


def many_segments(body: np.ndarray, sizes: np.ndarray, width: int, gram: int, piece: int = PIECE_BYTES) -> tuple[np.ndarray, ...]:
    """Minimizer, document (its number), first string and end of strings (places in the document) of the segments of documents
    that lie one after another in body; pieces of some documents are worked on at once."""
    ends = np.cumsum(sizes)
    out: list[tuple[np.ndarray, ...]] = []
    first, at = 0, 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(ends, at + piece, side="right")))
        low = minimizers(body[at:ends[last - 1]], width, gram)
        if len(low):
            borders = ends[first:last] - at
            inside = np.ones(len(low), dtype=bool)  # strings that cross no border
            crossing = (borders[:-1, None] - np.arange(1, width)).ravel()
            inside[crossing[(crossing >= 0) & (crossing < len(low))]] = False
            edges = np.concatenate([[0], np.flatnonzero((low[1:] != low[:-1]) | (inside[1:] != inside[:-1])) + 1, [len(low)]])
            starts, stops = edges[:-1][inside[edges[:-1]]], edges[1:][inside[edges[:-1]]]
            doc = np.searchsorted(borders, starts, side="right")
            begin = np.concatenate([[0], borders[:-1]])[doc]
            out.append((low[starts], doc + first, starts - begin, stops - begin))
        first, at = last, int(ends[last - 1])
    return tuple(np.concatenate(c) for c in zip(*out)) if out else tuple(np.zeros(0, dtype=np.int64) for _ in range(4))


def _short(m: np.ndarray, bits: int) -> np.ndarray:
    """32 + bits bits of minimizers: a shard's number and 32 bits inside it. Different ones that fall together are looked at in
    vain, no more. Minimizers are least hashes, whose first bits are mostly 0: they are mixed first."""
    return (m.view(np.uint64) * np.uint64(HASH_BASE)) >> np.uint64(32 - bits)


def shard_firsts(parts: list[bytes], owners: np.ndarray, width: int, queue_bytes: int = QUEUE_BYTES, leaf: int = 1 << 24) -> list[tuple[int, np.ndarray]]:
    """(segment, places inside it) of the strings that a segment with a smaller owner holds too."""
    lengths = np.array([len(p) for p in parts], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])
    with scratch() as folder:
        # Symbols: 0 the end, 1 between segments, bytes from 2.
        text = np.memmap(os.path.join(folder, "text"), dtype=np.uint16, mode="w+", shape=(int(begins[-1]) + 1,))
        for p, at in zip(parts, begins):
            text[at:at + len(p)] = np.frombuffer(p, dtype=np.uint8).astype(np.uint16) + 2
            text[at + len(p)] = 1
        text[-1] = 0
        found: list[np.ndarray] = []
        for _, places, shared in suffixes(text, width, folder, budget=queue_bytes, leaf=leaf):
            group = np.cumsum(shared < width)
            part = np.searchsorted(begins, places, side="right") - 1
            whole = (part < len(parts)) & (places + width <= begins[np.minimum(part, len(parts) - 1)] + lengths[np.minimum(part, len(parts) - 1)])
            places, part, group = places[whole], part[whole], group[whole]
            if not len(places):
                continue
            edges = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1])
            first = np.repeat(np.minimum.reduceat(owners[part], edges), np.diff(np.concatenate([edges, [len(places)]])))
            found.append(places[first < owners[part]].astype(np.int64))
        del text
    places = np.sort(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)
    part = np.searchsorted(begins, places, side="right") - 1
    edges = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]]) if len(part) else [0]
    return [(int(part[a]), places[a:b] - begins[part[a]]) for a, b in zip(edges[:-1], edges[1:])]


def may_share(m: np.ndarray, parts: list[bytes], width: int, gram: int) -> np.ndarray:
    """Whether a segment may have a string of another one with its minimizer. A string holds the minimizer's gram and, before or
    after it, at least half of its other bytes; segments with neither half in common with another have no string in common."""
    half = -(-(width - gram) // 2)
    lengths = np.array([len(p) for p in parts], dtype=np.int64)
    begins = np.cumsum(lengths) - lengths
    values = _BYTE[np.frombuffer(b"".join(parts), dtype=np.uint8)]
    found = np.flatnonzero(rolling(values, gram, HASH_BASE).view(np.int64) == np.repeat(m, lengths)[:len(values) - gram + 1])
    part = np.searchsorted(begins, found, side="right") - 1
    inside = found + gram <= (begins + lengths)[part]
    found, part = found[inside], part[inside]
    out = np.bincount(part, minlength=len(parts)) != 1  # a gram that a segment holds twice: it stays
    once = ~out[part]
    found, part = found[once], part[once]
    halves = rolling(values, gram + half, HASH_BASE)
    for first, there in ((found - half, found - half >= begins[part]), (found, found + gram + half <= (begins + lengths)[part])):
        _, which, many = np.unique(halves[first[there]], return_inverse=True, return_counts=True)
        out[part[there]] |= many[which] > 1
    return out


def trimmed(parts: list[bytes], width: int) -> list[tuple[int, int, int]]:
    """(part, first, end) of the places from a part's first string that may be in another part to its last such; by hash, so
    that only strings alone among the parts, which nothing can be found about, are left out. Strings are hashed a piece of the
    parts at once: most places of a part begin none, and a shard's places have no arrays of their own."""
    body, lengths = np.frombuffer(b"".join(parts), dtype=np.uint8), np.array([len(p) for p in parts], dtype=np.int64)
    ends, many = np.cumsum(lengths), np.maximum(lengths - width + 1, 0)
    part, upto = np.repeat(np.arange(len(parts)), many), np.cumsum(many)
    whole = (ends - lengths - upto + many)[part] + np.arange(len(part))
    h = np.zeros(len(whole), dtype=np.uint64)
    first, at, done = 0, 0, 0
    while first < len(parts):
        last = max(first + 1, int(np.searchsorted(ends, at + PIECE_BYTES, side="right")))
        here = slice(done, int(upto[last - 1]))
        h[here] = rolling(_BYTE[body[at:ends[last - 1]]], width, HASH_BASE)[whole[here] - at]
        first, at, done = last, int(ends[last - 1]), here.stop
    ordered = np.sort(h)
    several = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(several):
        return []
    kept = several[np.minimum(np.searchsorted(several, h), len(several) - 1)] == h
    places, part = whole[kept], part[kept]
    edges = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
    begins = ends - lengths
    return [(int(part[a]), int(places[a] - begins[part[a]]), int(places[b - 1] - begins[part[a]]) + width) for a, b in zip(edges[:-1], edges[1:])]


def settled(parts: list[bytes], owners: np.ndarray, width: int, queue_bytes: int = QUEUE_BYTES) -> list[tuple[int, np.ndarray]]:
    """What ``shard_firsts`` finds, with less to sort: parts are trimmed, and of those that are then equal one, of the smallest
    owner, stands for all. What is alone among these in turn is not sorted."""
    cuts = trimmed(parts, width)
    alike: dict[bytes, int] = {}
    of = np.array([alike.setdefault(parts[k][a:b], len(alike)) for k, a, b in cuts], dtype=np.int64)
    who = owners[[k for k, _, _ in cuts]]
    first = np.full(len(alike), LAST, dtype=np.int64)
    np.minimum.at(first, of, who)
    bodies = list(alike)
    again = trimmed(bodies, width) if bodies else []
    found = shard_firsts([bodies[c][a:b] for c, a, b in again], first[[c for c, _, _ in again]], width, queue_bytes) if again else []
    inside = {again[k][0]: places + again[k][1] for k, places in found}
    out = []
    for (k, a, b), c, beyond in zip(cuts, of.tolist(), (who > first[of]).tolist()):
        if beyond:
            out.append((k, np.arange(a, b - width + 1)))
        elif c in inside:
            out.append((k, inside[c] + a))
    return out


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    return np.split(column.flatten().to_numpy(), (column.offsets.to_numpy() - column.offsets[0].as_py())[1:-1])


def _joined(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """The bytes of some texts one after another, and how many each has."""
    found = texts.cast(pa.binary())
    return b"".join(found.to_pylist()), pc.binary_length(found).to_numpy().astype(np.int64)


def _digests(parts: list[bytes]) -> np.ndarray:
    """The 64-bit hash of each."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, parts)), dtype=">i8").astype(np.int64)


def whole_copies(docs: DataFrame) -> DataFrame:
    """doc, th, size: rows whose whole text, by 128 bits, a smaller doc_id has, and the text's bytes. Such a row loses all of its
    strings and is no string's smallest document, so that its strings need not be looked at. Only hashes are shuffled."""
    rows = keyed(docs).select("doc", "th", F.xxhash64(F.lit("other"), "text").alias("other"), F.octet_length("text").alias("size"))
    firsts = rows.groupBy("th", "other").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").select("th", "other", "first")
    return rows.join(spread(firsts), ["th", "other"]).where("doc > first").select("doc", "th", "size").distinct()


def _firsts(docs: pa.Table, copies: pa.Table) -> pa.Table:
    """The rows of docs that are not among the copies."""
    gone = set(zip(copies["doc"].to_pylist(), copies["th"].to_pylist()))
    return docs.filter(pa.array([x not in gone for x in zip(docs["doc"].to_pylist(), docs["th"].to_pylist())], pa.bool_())) if gone else docs


def dealt(docs: DataFrame, *, width: int = WIDTH, gram: int = GRAM, crowd: int = CROWD,
          steps: Steps | None = None, passing: Steps | None = None, copies: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Segments of shared minimizers by place; the owner of each different one; the bodies of those that are not alone with
    their minimizer; of these the ones to be sorted, of at most crowd segments a minimizer; and the strings of the others.

    Whole copies (``whole_copies``) take no part. The first three are stored, as each is read more than once: the places in steps, the other two in passing. A segment goes by its minimizer and a hash of its bytes, 64 bits
    each: only segments of one minimizer are told apart by the hash."""
    rows, spark = keyed(docs), docs.sparkSession
    steps, passing, early, brief = steps or Steps(spark), passing or Steps(spark), Steps(spark), Steps(spark)

    def held(docs: pa.Table, copies: pa.Table) -> pa.Table:
        """A block's different minimizers by shard, in short; those that two of its documents hold are there twice."""
        number, docs = docs["block"][0].as_py() if docs.num_rows else 0, _firsts(docs, copies)
        body, sizes = _joined(docs["text"].combine_chunks())
        m, doc, _, _ = many_segments(np.frombuffer(body, dtype=np.uint8), sizes, width, gram)
        order = np.argsort(m, kind="stable")
        x, doc = _short(m[order], bits), doc[order]
        order = np.argsort(x, kind="stable")  # m is signed
        x, doc = x[order], doc[order]
        edges = np.concatenate([[0], np.flatnonzero(x[1:] != x[:-1]) + 1]) if len(x) else np.zeros(0, dtype=np.int64)
        twice = np.minimum.reduceat(doc, edges) < np.maximum.reduceat(doc, edges) if len(x) else edges
        x = np.repeat(x[edges], 1 + twice)
        shards = (x >> np.uint64(32)).astype(np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(shards[1:] != shards[:-1]) + 1, [len(x)]]) if len(x) else np.zeros(1, dtype=np.int64)
        keys = x.astype(np.uint32)
        return pa.Table.from_arrays(
            [pa.array(np.full(len(cuts) - 1, number, dtype=np.int64)), pa.array(shards[cuts[:-1]]),
             pa.array([keys[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())], names=["block", "shard", "keys"])

    def meet(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each block, those of its keys that its shard holds more than once."""
        blocks, found = [], []
        for frame in frames:
            blocks.extend(frame["block"].to_pylist())
            found.extend(np.frombuffer(k, dtype=np.uint32) | (np.uint64(s) << np.uint64(32)) for s, k in zip(frame["shard"].to_pylist(), frame["keys"].to_pylist()))
        if not found:
            return
        ordered = np.sort(np.concatenate(found))
        several = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not len(several):
            return
        for at in range(0, len(found), 4096):
            kept = [x[several[np.minimum(np.searchsorted(several, x), len(several) - 1)] == x].tobytes() for x in found[at:at + 4096]]
            yield pa.RecordBatch.from_arrays([pa.array(blocks[at:at + 4096], pa.int64()), pa.array(kept, pa.binary())], names=["block", "shared"])

    def cut_up(docs: pa.Table, found: pa.Table) -> pa.Table:
        """Segments of a block's shared minimizers by hash and place. found: its shared minimizers, and its copies."""
        docs = _firsts(docs, found.filter(pc.is_null(found["shared"])))
        found = found.filter(pc.is_valid(found["shared"]))
        body, sizes = _joined(docs["text"].combine_chunks())
        m, of, starts, stops = many_segments(np.frombuffer(body, dtype=np.uint8), sizes, width, gram)
        shared = np.sort(np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in found["shared"].to_pylist()] or [np.zeros(0, dtype=np.uint64)]))
        x = _short(m, bits)
        chosen = shared[np.minimum(np.searchsorted(shared, x), len(shared) - 1)] == x if len(shared) else np.zeros(len(m), dtype=bool)
        m, of, starts, stops = m[chosen], of[chosen], starts[chosen], stops[chosen]
        begin = (np.cumsum(sizes) - sizes)[of]
        s = _digests([body[a:b] for a, b in zip((begin + starts).tolist(), (begin + stops + width - 1).tolist())])
        return pa.Table.from_arrays([pa.array(c) for c in (m, s, docs["doc"].to_numpy()[of], docs["th"].to_numpy()[of], starts.astype(np.int32), (stops - starts).astype(np.int32))],
                                    names=["m", "s1", "doc", "th", "at", "n"])

    def bodies(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes of the segments chosen."""
        for frame in uncollected(batches(frames, 64)):
            texts = [t.encode("utf-8", "replace") for t in frame["text"].to_pylist()]
            lists = frame["chosen"]
            x = lists.flatten()
            of = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            at, n = (x.field(c).to_numpy(zero_copy_only=False) for c in ("at", "n"))
            found = [texts[k][a:b] for k, a, b in zip(of.tolist(), at.tolist(), (at + n + width - 1).tolist())]
            yield pa.RecordBatch.from_arrays([x.field("m"), x.field("s1"), pa.array(frame["doc"].to_numpy()[of]), x.field("crowded"), pa.array(found, pa.binary())],
                                             names=["m", "s1", "doc", "crowded", "body"])

    def strings(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The strings of the segments of crowded minimizers, by hash and place inside the segment."""
        for frame in uncollected(frames):
            for at in range(0, frame.num_rows, 1024):
                part = frame.slice(at, 1024)
                found = part["body"].to_pylist()
                many = np.array([len(x) - width + 1 for x in found], dtype=np.int64)
                of = np.repeat(np.arange(len(found)), many)
                w = np.frombuffer(b"".join(xxhash.xxh128_digest(x[k:k + width]) for x, n in zip(found, many.tolist()) for k in range(n)), dtype=">i8").astype(np.int64).reshape(-1, 2)
                k = np.arange(len(of)) - (np.cumsum(many) - many)[of]
                yield pa.RecordBatch.from_arrays([*(pa.array(part[c].to_numpy()[of]) for c in ("m", "s1", "doc")), pa.array(k.astype(np.int32)), pa.array(w[:, 0]), pa.array(w[:, 1])],
                                                 names=["m", "s1", "doc", "k", "w1", "w2"])

    # A row's block follows from the row, so that no copy of the texts is stored to keep it. Repeated rows would share one.
    counted = rows.agg(F.count("*").alias("texts"), F.sum(F.octet_length("text")).alias("size")).first()
    repeated = (rows.groupBy("doc").count().agg(F.max("count")).first()[0] or 0) > 1
    once = rows.dropDuplicates(["doc", "th"]) if repeated else rows
    block = F.pmod(F.xxhash64("doc", "th"), F.lit((counted["texts"] >> BLOCK_BITS) + 1).cast("long")).alias("block")
    blocks, copied = once.select(block, "doc", "th", "text"), (copies if copies is not None else whole_copies(docs)).select(block, "doc", "th")
    bits = min(32, max(4, (int(counted["size"] or 0) // MEETING_BYTES).bit_length()))  # shards: 16 at least
    # What meets in a shard is packed: a row for each block, not for each of its minimizers; a hot one is there once or twice a block.
    met = early.keep(blocks.groupBy("block").cogroup(copied.groupBy("block")).applyInArrow(held, "block long, shard long, keys binary")
                     .repartition(1 << bits, "shard").mapInArrow(meet, "block long, shared binary"))
    told = met.unionByName(copied, allowMissingColumns=True)
    places = steps.keep(blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(cut_up, "m long, s1 long, doc long, th long, at int, n int"))
    early.drop()
    first = brief.keep(places.groupBy("m", "s1").agg(F.min(F.struct("doc", "th", "at", "n")).alias("o"), F.max("doc").alias("high")))
    # Where all segments of a minimizer are equal, so are their strings, and there is nothing to sort.
    several = (first.groupBy("m").agg(F.count("*").alias("segments")).where("segments > 1")
               .select("m", (F.col("segments") > crowd).alias("crowded")))
    chosen = early.keep(first.select("o.doc", "o.th", "m", "s1", "o.at", "o.n").join(spread(several), "m")
                        .select("doc", "th", F.struct("m", "s1", "at", "n", "crowded").alias("x"))
                        .repartition("doc", "th").groupBy("doc", "th").agg(F.collect_list("x").alias("chosen")))
    # From here on the owner is its document only.
    owned = passing.keep(first.select("m", "s1", F.col("o.doc").alias("owner"), "high")).select("m", "s1", F.struct(F.col("owner").alias("doc"), "m").alias("o"), "high")
    brief.drop()
    # Repeated rows bring a segment twice, which changes no minimum.
    found = passing.keep(rows.join(chosen, ["doc", "th"]).select("text", "doc", "chosen").mapInArrow(bodies, "m long, s1 long, doc long, crowded boolean, body binary"))
    early.drop()
    sorted_in = found.where("not crowded").select("m", "s1", F.col("m").alias("s2"), "doc", "body")
    single = found.where("crowded").select("m", "s1", "doc", "body").mapInArrow(strings, "m long, s1 long, doc long, k int, w1 long, w2 long")
    return places, owned, found, sorted_in, single


def duplicated_bytes(docs: DataFrame, *, width: int = WIDTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, queue_bytes: int = QUEUE_BYTES,
                     crowd: int = CROWD) -> DataFrame:
    """doc, th, and lists lows and highs: runs [low, high) of places whose strings are to go; see ``keyed``. A stored table."""
    steps, passing = Steps(docs.sparkSession), Steps(docs.sparkSession)
    copies = steps.keep(whole_copies(docs))
    places, owned, found, sorted_in, single = dealt(docs, width=width, gram=gram, crowd=crowd, steps=steps, passing=passing, copies=copies)

    def sort_shard(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, owners, m, s1 = [], [], [], []
        for frame in frames:
            parts.extend(frame["body"].to_pylist())
            for column, name in ((owners, "doc"), (m, "m"), (s1, "s1")):
                column.append(frame[name].to_numpy())
        if parts:
            m, s1 = np.concatenate(m), np.concatenate(s1)
            found = settled(parts, np.concatenate(owners), width, queue_bytes)
            for at in range(0, len(found), 4096):
                some = found[at:at + 4096]
                which = [k for k, _ in some]
                runs = [cover_runs(p, 1) for _, p in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(m[which]), pa.array(s1[which]), pa.array([a.tolist() for a, _ in runs], pa.list_(pa.int32())),
                     pa.array([b.tolist() for _, b in runs], pa.list_(pa.int32()))], names=["m", "s1", "froms", "tos"])

    size = found.where("not crowded").agg(F.sum(F.octet_length("body") + 1).alias("size")).first()["size"] or 0
    again = (sorted_in.select("m", "s1", "doc", "body").repartition(max(1, -(-int(size) // shard_bytes)), "m")
             .mapInArrow(sort_shard, "m long, s1 long, froms array<int>, tos array<int>"))
    single = passing.keep(single)
    firsts = spread(single.groupBy("w1", "w2").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("w1", "w2", "low"))
    # A repeated row brings a string twice: a set.
    singly = (single.join(firsts, ["w1", "w2"]).where("doc > low").groupBy("m", "s1").agg(F.collect_set("k").alias("froms"))
              .select("m", "s1", "froms", F.transform("froms", lambda k: k + 1).alias("tos")))
    again = passing.keep(again).unionByName(passing.keep(singly))
    # Whole segments go outside their first document; inside it, the strings that another segment's smaller document has.
    # Segments that have neither are left out before they meet the places.
    marks = steps.keep(owned.select("m", "s1", F.col("o.doc").alias("owner"), "high").join(again, ["m", "s1"], "left")
                       .where("high > owner or froms is not null").select("m", "s1", "owner", "froms", "tos"))
    passing.drop()
    at, n = F.col("at"), F.col("n")
    whole = F.array(F.struct(at.alias("low"), (at + n).alias("high")))
    inner = F.transform(F.arrays_zip("froms", "tos"), lambda r: F.struct((at + r["froms"]).alias("low"), (at + r["tos"]).alias("high")))
    gone = (places.select("m", "s1", "doc", "th", "at", "n").join(marks, ["m", "s1"])
            .select("doc", "th", F.explode(F.when(F.col("doc") > F.col("owner"), whole).otherwise(inner)).alias("r"))
            .select("doc", "th", "r.low", "r.high")
            .unionByName(copies.where(F.col("size") >= width).select("doc", "th", F.lit(0).alias("low"), (F.col("size") - (width - 1)).alias("high"))))
    # The places and their shuffle go before what is found goes to the documents.
    last, left = Steps(docs.sparkSession), Steps(docs.sparkSession)
    gone = last.keep(gone)
    steps.drop()
    runs = left.keep(gone.repartition("doc", "th").groupBy("doc", "th").agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs")))
    last.drop()
    return runs


def _kept(text: str, lows: list[int] | None, highs: list[int] | None, width: int) -> tuple[int, list[tuple[int, int]], bytes]:
    """Bytes, removed runs, and what is kept."""
    body = text.encode("utf-8", "replace")
    if not lows:
        return len(body), [], body
    change = np.zeros(len(body) + 1, dtype=np.int64)
    np.add.at(change, np.array(lows), 1)
    np.add.at(change, np.array(highs) + width - 1, -1)
    gone = np.cumsum(change)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    return len(body), list(zip(edges[::2].tolist(), edges[1::2].tolist())), np.frombuffer(body, dtype=np.uint8)[~gone].tobytes()


def remove_duplicated(docs: DataFrame, *, digest: bool = False, width: int = WIDTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES,
                      queue_bytes: int = QUEUE_BYTES, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes; with digest kept_sha256) for every row of docs."""
    runs = duplicated_bytes(docs, width=width, gram=gram, shard_bytes=shard_bytes, queue_bytes=queue_bytes, crowd=crowd)
    joined = keyed(docs).join(runs, ["doc", "th"], "left").select(doc_id(), "text", "lows", "highs")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in uncollected(batches(frames, 128)):
            found = [_kept(t, a, b, width) for t, a, b in zip(*(frame[c].to_pylist() for c in ("text", "lows", "highs")))]
            last = pa.array([hashlib.sha256(k).hexdigest() for _, _, k in found], pa.string()) if digest else pa.array([k for _, _, k in found], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [frame["doc_id"], pa.array([n for n, _, _ in found], pa.int64()), pa.array([sum(b - a for a, b in r) for _, r, _ in found], pa.int64()),
                 pa.array([len(r) for _, r, _ in found], pa.int64()), last],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256" if digest else "kept"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, " + ("kept_sha256 string" if digest else "kept binary"))


DIGEST_SQL = """
WITH coded AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
strings AS (SELECT doc_id, p, substr(x, CAST(2 * p + 1 AS BIGINT), 100) AS s
            FROM (SELECT doc_id, x, unnest(range(0, CAST(length(x) / 2 - 49 AS BIGINT))) AS p FROM coded)),
firsts AS (SELECT s, min(doc_id) AS first FROM strings GROUP BY s HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT doc_id, p FROM strings JOIN firsts USING (s) WHERE doc_id > first),
bytes AS (SELECT doc_id, p, substr(x, CAST(2 * p + 1 AS BIGINT), 2) AS b
          FROM (SELECT doc_id, x, unnest(range(0, CAST(length(x) / 2 AS BIGINT))) AS p FROM coded)),
marked AS (SELECT bytes.doc_id, bytes.p, b, gone.p IS NOT NULL AND bytes.p - gone.p < 50 AS removed
           FROM bytes ASOF LEFT JOIN gone ON bytes.doc_id = gone.doc_id AND bytes.p >= gone.p),
turns AS (SELECT *, removed AND NOT coalesce(lag(removed) OVER (PARTITION BY doc_id ORDER BY p), FALSE) AS turn FROM marked),
kept AS (SELECT doc_id, count(*) AS n_bytes, CAST(sum(CASE WHEN removed THEN 1 ELSE 0 END) AS BIGINT) AS n_removed,
                CAST(sum(CASE WHEN turn THEN 1 ELSE 0 END) AS BIGINT) AS n_spans, string_agg(b, '' ORDER BY p) FILTER (NOT removed) AS body FROM turns GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(body, ''))) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)"""
