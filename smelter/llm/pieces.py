"""Encoding and decoding with a merge-type SentencePiece vocabulary by a score-ordered agenda.

Each chunk of a text (a run of blanks with the word after it, or a line end) starts as single characters. All adjacent
pairs that are a piece wait on an agenda ordered by score, then place; the best is merged and its new neighbours join the
agenda. No piece holds a blank after another character or a line end (checked when the model is read), so chunks merge
independently of each other; their results are kept in a bounded table, which only saves time. Short chunks of an Arrow
batch are merged side by side, a row of scores being the agenda of each; long ones have a heap. What is not in the
vocabulary becomes byte pieces. Each batch's new chunks are encoded and decoded by the sentencepiece library too; a
difference raises. Whole texts are put together from the chunks' results, as ids and as bytes, a batch at once.

Null text: as empty, no tokens. Very long texts and chunks: the heap makes it n log n. Rows, repeated ones too, are
independent of each other; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import HASH_BASE, batches, uncollected

BLANK = "▁"
CHUNKS = re.compile(" *[^ \n]+| +|\n")
REMEMBERED, SHORT, BATCH_ROWS, BATCH_BYTES, ROWS_AT_ONCE, SHOWN_AT_ONCE, SLOT_BITS = 300_000, 32, 256, 1 << 20, 4096, 64, 19
NONE = np.iinfo(np.int32).max


class Agenda:
    """Encoder and decoder for one model file, which is read where the work is done."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = lib.vocab_size()
        self.pieces = [lib.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        self.scores = {self.pieces[i]: -lib.get_score(i) for i in plain}
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in range(size) if lib.is_byte(i)}
        if any(BLANK in p.lstrip(BLANK) or "\n" in p for p in self.ids) or len(self.byte_ids) != 256 or any(map(lib.is_unused, range(size))):
            raise ValueError("needs a byte-fallback model whose pieces hold blanks at their start only, no line ends, none unused")
        if lib.encode("a  b") == lib.encode("a b") or lib.encode("①") == lib.encode("1"):
            raise ValueError("needs a model that leaves texts as they are")
        # Bytes below 128 are characters by themselves; only the others are put together when decoding.
        self.shown = ["" if lib.is_control(i) else p.replace(BLANK, " ") for i, p in enumerate(self.pieces)]
        for b in range(128):
            self.shown[self.byte_ids[b]] = chr(b)
        self.byte_of = {i: b for b, i in self.byte_ids.items() if b >= 128}
        # As bytes, to be taken by id: the same, and decimal numbers with the comma after them.
        self.shown_bytes = pa.array([bytes([self.byte_of[i]]) if i in self.byte_of else p.encode() for i, p in enumerate(self.shown)], pa.large_binary())
        self.decimals = pa.array([b"%d," % i for i in range(size)], pa.large_binary())
        self.forget()
        # For merging side by side: the id of each character, and rank and id of what each pair of ids makes.
        self.char_id = np.full(0x110000, size, dtype=np.int32)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.char_id[ord(p)] = i
        rank = {s: k for k, s in enumerate(sorted(set(self.scores.values())))}
        made = {self.ids[p[:k]] * (size + 1) + self.ids[p[k:]]: p for p in self.ids for k in range(1, len(p))
                if p[:k] in self.ids and p[k:] in self.ids}
        self.pairs = np.array(sorted(made), dtype=np.int64)
        self.pair_rank = np.array([rank[self.scores[made[k]]] for k in sorted(made)], dtype=np.int32)
        self.pair_made = np.array([self.ids[made[k]] for k in sorted(made)], dtype=np.int32)
        self.size = size
        # The place of a pair by its hash; pairs that share one are looked up by bisection.
        slot = self._slot(self.pairs)
        self.slots = np.zeros(1 << SLOT_BITS, dtype=np.int32)
        self.slots[slot] = np.arange(len(self.pairs))
        self.crowded = np.bincount(slot, minlength=1 << SLOT_BITS) > 1

    def merge(self, chunk: str) -> list[int]:
        """Ids of one chunk whose blanks are already the blank mark."""
        scores, n = self.scores, len(chunk)
        symbols: list[str] = list(chunk)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(s, i, pair) for i in range(n - 1) if (s := scores.get(pair := chunk[i:i + 2])) is not None]
        heapify(agenda)
        while agenda:
            _, i, pair = heappop(agenda)
            left = symbols[i]
            j = after[i]
            if not left or j >= n or len(left) + len(symbols[j]) != len(pair):
                continue  # one of the two has been merged meanwhile
            symbols[i], symbols[j] = pair, ""
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                if (s := scores.get(new := pair + symbols[j])) is not None:
                    heappush(agenda, (s, i, new))
            h = before[i]
            if h >= 0 and (s := scores.get(new := symbols[h] + pair)) is not None:
                heappush(agenda, (s, h, new))
        out: list[int] = []
        for s in symbols:
            if s:
                k = self.ids.get(s)
                if k is None:
                    out.extend(self.byte_ids[b] for b in s.encode())
                else:
                    out.append(k)
        return out

    def forget(self) -> None:
        """Known chunks have a number, by which their ids lie in one array."""
        self.memory: dict[str, int] = {}
        self.known, self.counts = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the piece that two ids make (NONE if none) and its place in the table."""
        keys = left.astype(np.int64) * (self.size + 1) + right
        slot = self._slot(keys)
        at = self.slots[slot]
        missed = np.nonzero(self.crowded[slot] & (self.pairs[at] != keys))
        at[missed] = np.minimum(np.searchsorted(self.pairs, keys[missed]), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.pair_rank[at], NONE), at

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(HASH_BASE)) >> np.uint64(64 - SLOT_BITS)).view(np.int64)

    def merge_rows(self, chunks: list[str]) -> list[list[int]]:
        """The same for many short chunks at once."""
        ids, counts = self._side_by_side(chunks)
        return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]

    def _side_by_side(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids, one chunk's after the other, and how many each has: in each step every row merges its best pair, leftmost on ties."""
        lengths = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        width = int(lengths.max())
        codes = np.frombuffer("".join(chunks).encode("utf-32-le"), dtype=np.uint32)
        columns = np.arange(width)
        there = columns < lengths[:, None]
        symbols = np.full((len(chunks), width), self.size, dtype=np.int32)
        symbols[there] = self.char_id[codes]
        agenda = np.full((len(chunks), width), NONE, dtype=np.int32)
        agenda[:, :-1], _ = self._lookup(symbols[:, :-1], symbols[:, 1:])
        strange = (there & (symbols == self.size)).any(axis=1)
        done = symbols.copy()
        count = lengths.copy()
        rows = np.flatnonzero(~strange)
        symbols, agenda = symbols[rows], agenda[rows]
        while len(rows):
            best = agenda.argmin(axis=1)
            line = np.arange(len(rows))
            going = agenda[line, best] != NONE
            if not going.all():
                done[rows[~going]] = symbols[~going]
                rows, symbols, agenda, best = rows[going], symbols[going], agenda[going], best[going]
                line = np.arange(len(rows))
                if not len(rows):
                    break
            _, at = self._lookup(symbols[line, best], symbols[line, best + 1])
            after = columns[:-1] > best[:, None]
            symbols[:, :-1] = np.where(after, symbols[:, 1:], symbols[:, :-1])
            agenda[:, :-1] = np.where(after, agenda[:, 1:], agenda[:, :-1])
            symbols[:, -1], agenda[:, -1] = self.size, NONE
            symbols[line, best] = self.pair_made[at]
            count[rows] -= 1
            following = np.minimum(best + 1, width - 1)
            ranks, _ = self._lookup(symbols[line, best], symbols[line, following])
            agenda[line, best] = np.where(best + 1 < width, ranks, NONE)
            front = np.flatnonzero(best > 0)
            agenda[front, best[front] - 1], _ = self._lookup(symbols[front, best[front] - 1], symbols[front, best[front]])
        if not strange.any():
            return done[columns < count[:, None]], count
        out = [row[:n] for row, n in zip(done, count)]
        for k in np.flatnonzero(strange):
            out[k] = np.array(self.merge(chunks[k]), dtype=np.int32)
            count[k] = len(out[k])
        return np.concatenate(out), count

    def merge_all(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids, one chunk's after the other, and how many each has; short chunks go in rows of similar length."""
        lengths = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        order = np.argsort(lengths, kind="stable")
        short = int((lengths <= SHORT).sum())
        made = [self._side_by_side([chunks[k] for k in order[at:min(at + ROWS_AT_ONCE, short)]]) for at in range(0, short, ROWS_AT_ONCE)]
        for k in order[short:]:
            ids = np.array(self.merge(chunks[k]), dtype=np.int32)
            made.append((ids, np.array([len(ids)])))
        ids, counts = (np.concatenate(x) for x in zip(*made))
        back = np.argsort(order)
        return gathered(ids, counts, back), counts[back]

    def decode(self, ids: list[int]) -> str:
        """Pieces put together; byte pieces in a row are read as UTF-8; the blank put before a text is taken off."""
        out: list[str] = []
        raw = bytearray()
        byte_of, shown = self.byte_of, self.shown
        if byte_of.keys().isdisjoint(ids):
            text = "".join([shown[i] for i in ids])
        else:
            for i in ids:
                if i in byte_of:
                    raw.append(byte_of[i])
                    continue
                if raw:
                    out.append(raw.decode("utf-8", "replace"))
                    raw.clear()
                out.append(shown[i])
            out.append(raw.decode("utf-8", "replace"))
            text = "".join(out)
        return text[1:] if text[:1] == " " else text

    def _checked(self, chunks: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        """The library encodes and decodes these chunks, in order of ``_kind``, as we do. No piece reaches over the blank or line
        end before a chunk, so many are shown to it one after the other, behind a letter, those without a blank each in a line."""
        letter, end = (np.array(self.merge(c), dtype=np.int32) for c in (BLANK + "a", "\n"))
        upto = np.concatenate([[0], np.cumsum(counts)])
        lines, alone = (bisect_left(chunks, k, key=_kind) for k in (1, 2))
        shown = [("a" + "".join(chunks[a:b]), np.concatenate([letter, ids[upto[a]:upto[b]]]))
                 for a, b in ((at, min(at + SHOWN_AT_ONCE, lines)) for at in range(0, lines, SHOWN_AT_ONCE))]
        shown += [("\n".join(["a", *chunks[a:b]]), np.concatenate([letter, *(x for k in range(a, b) for x in (end, ids[upto[k]:upto[k + 1]]))]))
                  for a, b in ((at, min(at + SHOWN_AT_ONCE, alone)) for at in range(lines, alone, SHOWN_AT_ONCE))]
        # No text gives a single blank as a chunk.
        shown += [(chunks[k][1:], ids[upto[k]:upto[k + 1]]) for k in range(alone, len(chunks)) if chunks[k] != " "]
        texts, ours = [t for t, _ in shown], [k for _, k in shown]
        if not texts:
            return
        theirs = self.library.encode(texts, num_threads=1, return_type="numpy")
        back = self.library.decode([k.tolist() for k in ours], num_threads=1)
        for text, k, other, t in zip(texts, ours, theirs, back):
            if t != text or not np.array_equal(k, other):
                raise AssertionError(f"differs from the library: {text[:800]!r}: {k[:20]}, {other[:20]}")

    def encode_flat(self, texts: list[str], check: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one text's after the other, and where each text's begin and end."""
        split = [CHUNKS.findall((" " + t).replace(BLANK, " ")) if t else [] for t in texts]
        if len(self.memory) > REMEMBERED or len(self.known) > 16 * REMEMBERED:
            self.forget()
        memory = self.memory
        used = list(chain.from_iterable(split))
        fresh = sorted(set(used) - memory.keys(), key=_kind)
        if fresh:
            ids, counts = self.merge_all([c.replace(" ", BLANK) for c in fresh])
            if check:
                self._checked(fresh, ids, counts)
            memory.update(zip(fresh, range(len(self.counts), len(self.counts) + len(fresh))))
            self.known, self.counts = np.concatenate([self.known, ids]), np.concatenate([self.counts, counts])
        numbers = np.fromiter(map(memory.__getitem__, used), dtype=np.int64, count=len(used))
        for c in fresh:
            if len(c) > SHORT:
                del memory[c]
        upto = np.concatenate([[0], np.cumsum(self.counts[numbers])])
        return gathered(self.known, self.counts, numbers), upto[np.cumsum([0, *map(len, split)])]

    def encode_batch(self, texts: list[str], check: bool = True) -> Iterator[list[int]]:
        """Ids of each text of a batch."""
        ids, ends = self.encode_flat(texts, check)
        for a, b in zip(ends[:-1], ends[1:]):
            yield ids[a:b].tolist()

    def decode_flat(self, ids: np.ndarray, ends: np.ndarray, texts: list[str]) -> list[bytes]:
        """Each text decoded, in UTF-8. Pieces give their bytes; where those are not what was encoded, ``decode`` says how they read."""
        out = []
        for body, t, a, b in zip(slices(self.shown_bytes, ids, ends), texts, ends[:-1], ends[1:]):
            body = bytes(body)
            if body != (" " + t.replace(BLANK, " ") if t else "").encode():
                out.append(self.decode(ids[a:b].tolist()).encode())
            else:
                out.append(body[1:])
        return out


def _kind(chunk: str) -> int:
    """0 for a word behind blanks, 1 for a chunk without a blank, 2 for blanks alone."""
    return 1 if chunk[0] != " " else 2 if chunk[-1] == " " else 0


def gathered(values: np.ndarray, counts: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Of values that lie in groups of counts, the chosen groups one after the other."""
    begins, many = (np.cumsum(counts) - counts)[chosen], counts[chosen]
    return values[np.repeat(begins - (np.cumsum(many) - many), many) + np.arange(many.sum())]


def slices(table: pa.Array, ids: np.ndarray, ends: np.ndarray) -> Iterator[memoryview]:
    """The bytes that table has for the ids between each two ends, put together."""
    taken = table.take(pa.array(ids))
    _, offsets, data = taken.buffers()
    at = np.frombuffer(offsets, dtype=np.int64, count=len(ids) + 1, offset=8 * taken.offset)[ends].tolist()
    whole = memoryview(data or b"")
    for a, b in zip(at[:-1], at[1:]):
        yield whole[a:b]


_loaded: dict[str, Agenda] = {}


def agenda(model_file: str) -> Agenda:
    if model_file not in _loaded:
        _loaded[model_file] = Agenda(model_file)
    return _loaded[model_file]


def encode_decode(docs: DataFrame, model_file: str, *, check: bool = True, keep_ids: bool = True, keep_text: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids (unless keep_ids is off) and decoded (unless keep_text is) of every row of docs.

    model_file must be readable on every executor.
    """
    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids + ", decoded string" * keep_text

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = agenda(model_file)
        for frame in uncollected(batches(frames, BATCH_ROWS, BATCH_BYTES)):
            texts = [t or "" for t in frame.column(1).to_pylist()]
            ids, ends = coder.encode_flat(texts, check)
            decoded = coder.decode_flat(ids, ends, texts)
            columns = [frame.column(0), pa.array(np.diff(ends), pa.int64()), pa.array([hashlib.sha256(x[:-1]).hexdigest() for x in slices(coder.decimals, ids, ends)]),
                       pa.array([hashlib.sha256(t).hexdigest() for t in decoded])]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())))
                names.append("ids")
            if keep_text:
                columns.append(pa.array([t.decode() for t in decoded], pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(run, kinds)


def piece_digest(docs: DataFrame, model_file: str) -> DataFrame:
    return encode_decode(docs, model_file, keep_ids=False, keep_text=False)
