"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are compared as lower-case words joined by single blanks. An item may be found with up to a share of
its length in edits (insertions, deletions, substitutions). It is split into one piece more than that budget; an occurrence
within the budget leaves at least one piece untouched, so exact hits of the pieces (one Aho-Corasick pass over a text) find
every candidate place, and Myers' bit-parallel distance decides, in one pass over each stretch of overlapping places. Items are taken in blocks of bounded size, each
of which passes over all documents, so what a task holds does not grow with the benchmark.

Items shorter than min_chars, which a part of a longer word might equal by chance, are found exactly and at word borders.

Nulls: a null text holds nothing; null item texts, items without a word and items with a null item_id are not searched. Repeated rows: each row of docs is answered, repeated items count once. Empty tables: no leaks. Very long
texts: whole, linear in their length for each item that has candidate places in them. Other columns of docs pass through ``keep_clean`` untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import batches

ERROR_SHARE, MIN_CHARS, BLOCK_CHARS = 0.05, 24, 1_000_000
WORDS = re.compile(r"\w+")


def plain(text: str | None) -> str:
    return " ".join(WORDS.findall((text or "").lower()))


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece) of budget + 1 pieces of near-equal length."""
    n = budget + 1
    cuts = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_match(pattern: str, masks: dict[str, int], text: str) -> tuple[int, int]:
    """Fewest edits that turn the pattern into a part of the text, and where that part ends; Myers' bit vectors."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, m, 0
    for k, ch in enumerate(text):
        eq = masks.get(ch, 0)
        x = eq | down
        diagonal = (((eq & up) + up) ^ up) | eq
        plus = down | ~(diagonal | up) & full
        minus = up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = (plus << 1) & full
        minus = (minus << 1) & full
        up = minus | ~(x | plus) & full
        down = plus & x
        if score < best:
            best, end = score, k + 1
            if not best:
                break
    return best, end


def regions(starts: set[int], before: int, after: int) -> list[tuple[int, int]]:
    """The stretches from before each start to after it, those that overlap as one, so that a place is looked at once."""
    out: list[tuple[int, int]] = []
    for start in sorted(starts):
        begin, stop = max(0, start - before), start + after
        if out and begin <= out[-1][1]:
            begin = out.pop()[0]
        out.append((begin, stop))
    return out


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], error_share: float, min_chars: int = MIN_CHARS):
        import ahocorasick

        self.items = [(i, text, 0 if len(text) < min_chars else int(len(text) * error_share)) for i, text in items]
        self.min_chars = min_chars
        self.masks: list[dict[str, int] | None] = [None] * len(items)
        places: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text, budget) in enumerate(self.items):
            for offset, piece in pieces(text, budget):
                places.setdefault(piece, []).append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def mask(self, n: int) -> dict[str, int]:
        if self.masks[n] is None:
            made: dict[str, int] = {}
            for k, ch in enumerate(self.items[n][1]):
                made[ch] = made.get(ch, 0) | 1 << k
            self.masks[n] = made
        return self.masks[n]

    def find(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item_id, edits, end in the plain text) of the best occurrence of each item found."""
        if not self.items:
            return []
        body = plain(text)
        best: dict[int, tuple[int, int]] = {}
        places: dict[int, set[int]] = {}
        for last, (size, where) in self.automaton.iter(body):
            for n, offset in where:
                if n in best:
                    continue
                _, item, budget = self.items[n]
                start = last + 1 - size - offset
                if len(item) < self.min_chars:
                    if (not start or body[start - 1] == " ") and body[last + 1:last + 2] in ("", " "):
                        best[n] = (0, last + 1)
                    continue
                if start in places.setdefault(n, set()):
                    continue
                places[n].add(start)
                if start >= 0 and body.startswith(item, start):
                    best[n] = (0, start + len(item))
        for n, starts in places.items():
            if n in best:
                continue
            _, item, budget = self.items[n]
            for begin, stop in regions(starts, budget, len(item) + budget):
                edits, end = best_match(item, self.mask(n), body[begin:stop])
                if edits <= budget and (n not in best or edits < best[n][0]):
                    best[n] = (edits, begin + end)
        return sorted((self.items[n][0], e, end) for n, (e, end) in best.items())


_built: dict[int, Matcher] = {}


def item_blocks(items: DataFrame, *, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """(item_id, plain text) in blocks of at most block_chars characters, or one item; a block at a time is on the driver."""
    block, size = [], 0
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null").distinct().orderBy("item_id", "text")
    for row in rows.toLocalIterator():
        text = plain(row.text)
        if not text:
            continue
        if block and size + len(text) > block_chars:
            yield block
            block, size = [], 0
        block.append((row.item_id, text))
        size += len(text)
    if block:
        yield block


def _matcher(shared, error_share: float, min_chars: int):
    def get() -> Matcher:
        if shared.id not in _built:
            _built.clear()
            _built[shared.id] = Matcher(shared.value, error_share, min_chars)
        return _built[shared.id]
    return get


class Block:
    """One block of items as every task gets it."""

    def __init__(self, spark, number: int, items: list[tuple[int, str]]):
        self.id = f"{id(self)}-{number}-{hash(tuple(items))}"
        self._sent = spark.sparkContext.broadcast(items)

    @property
    def value(self):
        return self._sent.value


def _cleaner(get):
    @F.pandas_udf("boolean")
    def clean(texts):
        import pandas as pd

        matcher = get()
        return pd.Series([not matcher.find(t) for t in texts], dtype=bool)
    return clean


def leaks(docs: DataFrame, items: DataFrame, *, error_share: float = ERROR_SHARE, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, n_edits and stop (end of the best occurrence in the plain text): a row for each row of docs and item it holds."""
    kinds = "doc_id long, item_id long, n_edits long, stop long"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    out = docs.sparkSession.createDataFrame([], kinds)
    for number, block in enumerate(item_blocks(items, block_chars=block_chars)):
        get = _matcher(Block(docs.sparkSession, number, block), error_share, min_chars)

        def run(frames: Iterator[pa.RecordBatch], get=get) -> Iterator[pa.RecordBatch]:
            matcher = get()
            for frame in batches(frames, 512):
                found = [(d, *hit) for d, t in zip(frame[0].to_pylist(), frame[1].to_pylist()) for hit in matcher.find(t)]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(4)], names=["doc_id", "item_id", "n_edits", "stop"])

        found = texts.mapInArrow(run, kinds)
        out = found if number == 0 else out.unionByName(found)
    return out


def keep_clean(docs: DataFrame, items: DataFrame, *, error_share: float = ERROR_SHARE, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of docs, all columns, that hold no item."""
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("body"))
    for number, block in enumerate(item_blocks(items, block_chars=block_chars)):
        get = _matcher(Block(docs.sparkSession, number, block), error_share, min_chars)

        rows = rows.where(_cleaner(get)("body"))
    return rows.select("row.*")
