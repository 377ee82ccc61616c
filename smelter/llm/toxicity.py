"""Toxicity: a weighted lexicon matched by Aho-Corasick after folding, normalised by length, with exception phrases.

Folding lowers the case, takes accents, invisible characters and homoglyphs away and reads digits and signs inside words
as the letters they stand for, so that a disguised word meets the lexicon's entry. The lexicon and its weights are
learned from a bounded sample of labelled rows (``fit_rows``): words and word stems that are found in enough different
surroundings in toxic documents and far more often than in others. Exception phrases are pairs of a lexicon word and its neighbour that
clean documents use; a hit inside one does not count. The score is a logistic curve over the hits' weights, whole and
relative to the text's length. Every row is scored over its whole text.

Nulls: null text as empty (the score of a text without hits); null label or id: not learned from; without rows of both
classes every score is 0.5. Repeated rows are scored each. Empty table: empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import batches, held_out, labelled_texts, logistic

FIT_ROWS, MOST_WORDS = 6000, 4000
STEM, LONGEST = 4, 12  # entries of STEM letters or more stand for all words that begin with them, shorter ones for themselves

# i, l and 1 look alike, so all three fold to i, in lexicon and text.
LOOKS = {"0": "o", "1": "i", "l": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
LOOKS |= dict(zip("абвеёкмнорстухіїјѕԁһԛԝ", "abbeekmhopctyxiijsdhqw"))
LOOKS |= dict(zip("αβγεηικνορτυχω", "abyenikvoptuxw"))
LOOKS |= {"ı": "i", "ł": "i", "ø": "o", "đ": "d", "ß": "ss", "æ": "ae"}
INVISIBLE = [0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF]
FOLD = str.maketrans(LOOKS | {chr(c): None for c in [*range(0x300, 0x370), *INVISIBLE]})
SIGNS = re.compile(r"[$@!]+(?=[^\W_])")
WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """The text as the lexicon sees it."""
    low = text.lower()
    if not low.isascii():
        low = unicodedata.normalize("NFKD", low).lower()
    low = low.translate(FOLD)
    if "$" in low or "@" in low or "!" in low:
        low = SIGNS.sub(lambda m: m[0].translate({36: "s", 64: "a", 33: "i"}) if m.start() and low[m.start() - 1].isalnum() or m[0] != "!" else m[0], low)
    return low


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: list[str]
    curve: np.ndarray | None = None
    _automaton: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "curve": self.curve, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            self._automaton = machine = ahocorasick.Automaton()
            for word, weight in self.weights.items():
                machine.add_word(word, (len(word), weight))
            for phrase in self.exceptions:
                machine.add_word(phrase, (len(phrase), 0.0))
            machine.make_automaton()
        return self._automaton

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """(from, to, weight) of the hits at word starts that no exception phrase covers; the longest of each place. Places
        are those in the words joined by one blank, so that a phrase is seen whatever stands between its words."""
        if not self.weights:
            return []
        folded = " ".join(WORD.findall(folded))
        found: dict[int, tuple[int, int, float]] = {}
        spans = []
        for last, (size, weight) in self.automaton().iter(folded):
            start, stop = last + 1 - size, last + 1
            if start and folded[start - 1].isalnum():
                continue
            ends = not (stop < len(folded) and folded[stop].isalnum())
            if not weight:
                if ends:
                    spans.append((start, stop))
            elif ends or size >= STEM:
                found[start] = (start, stop, weight)  # hits come by their ends, so the longest last
        if not spans:
            return list(found.values())
        return [h for h in found.values() if not any(a <= h[0] and h[1] <= b for a, b in spans)]

    def measures(self, texts: list[str]) -> np.ndarray:
        """For each text: whether it has hits, the log of their weight, their weight by the root of its length."""
        out = np.zeros((len(texts), 3))
        for k, text in enumerate(texts):
            folded = fold(text)
            weight = sum(w for _, _, w in self.hits(folded))
            if weight:
                out[k] = 1, np.log1p(weight), weight / (1 + folded.count(" ")) ** 0.5
        return out

    def probability(self, texts: list[str]) -> np.ndarray:
        if self.curve is None:
            return np.full(len(texts), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.measures(texts) @ self.curve[:-1] + self.curve[-1], -500, 500)))


@lru_cache(maxsize=100_000)
def _entries(word: str) -> frozenset[str]:
    """The lexicon entries that would match a word."""
    return frozenset(word[:n] for n in range(STEM, min(len(word), LONGEST) + 1)) or frozenset([word] if len(word) > 1 else [])


def learn(texts: list[str], labels: np.ndarray, *, least: int = 5, odds: float = 1.5, usual: float = 0.3, most_words: int = MOST_WORDS) -> Lexicon:
    """A lexicon with weights, exceptions and curve from labelled texts.

    A word's support is its number of different surroundings (the words beside it), so that copies of one document count
    once. It is kept if the log ratio of its rates in toxic and other documents, less two standard errors, reaches odds.
    """
    sizes = [max(1, int((labels == y).sum())) for y in (0, 1)]
    words = [[*map(sys.intern, WORD.findall(fold(t)))] for t in texts]
    rates = [Counter(), Counter()]
    for w, y in zip(words, labels):
        if y == 1:
            rates[1].update(set().union(*map(_entries, set(w))))
    frequent = {e for e, n in rates[1].items() if n >= least}
    rates[1] = Counter({e: rates[1][e] for e in frequent})
    entries = [frequent & set().union(*map(_entries, set(w))) for w in words]
    around = defaultdict(set)
    for w, e, y in zip(words, entries, labels):
        if y == 0:
            rates[0].update(e)
            continue
        padded = ["", *w, ""]
        for k, x in enumerate(w):
            for entry in _entries(x):
                if entry in frequent and len(around[entry]) < 4 * least:
                    around[entry].add((padded[k], x, padded[k + 2]))
    weights = {}
    for e in frequent:
        n1, n0 = rates[1][e] + 0.5, rates[0][e] + 0.5
        ratio = np.log(n1 / sizes[1]) - np.log(n0 / sizes[0])
        if len(around[e]) >= least and ratio - 2 * (1 / min(n1, len(around[e]) + 0.5) + 1 / n0) ** 0.5 >= odds:
            weights[e] = float(ratio)
    # Strongest first; a word that is much rarer than the strongest must add toxic documents that no other word finds.
    order = sorted(weights, key=lambda w: (-weights[w] * rates[1][w], -len(w), w))[:most_words]
    holders = defaultdict(set)
    for k, (e, y) in enumerate(zip(entries, labels)):
        if y == 1:
            for x in e & weights.keys():
                holders[x].add(k)
    covered: set[int] = set()
    kept = []
    for w in order:
        nested = any(w.startswith(x) or x.startswith(w) for x in kept)
        more = len(holders[w] - covered)
        alone = np.log((more + 0.5) / sizes[1]) - np.log((rates[0][w] + 0.5) / sizes[0])
        if not nested and len(holders[w]) >= usual * len(holders[order[0]]) or more >= least and alone >= odds:
            kept.append(w)
            covered |= holders[w]
    weights = {w: weights[w] for w in kept}
    beside = [Counter(), Counter()]
    for w, y in zip(words, labels):
        pairs = {(a, b) for a, b in zip(w, w[1:]) if not weights.keys().isdisjoint(_entries(a) | _entries(b))}
        beside[y].update(pairs)
    exceptions = sorted(" ".join(p) for p, n in beside[0].items() if n >= least and beside[1][p] * 10 < n)
    lexicon = Lexicon(weights, exceptions)
    if min((labels == 0).sum(), (labels == 1).sum()) > 0:
        lexicon.curve = logistic(lexicon.measures(texts), labels)
    return lexicon


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", fit_rows: int = FIT_ROWS) -> Lexicon:
    """Learn from at most fit_rows labelled rows outside the held-out fold; only that sample reaches the driver."""
    rows = labelled_texts(docs, labels, label, fit_rows).select("doc_id", "text", "y")
    found = sorted((r.doc_id, r.text, r.y) for r in rows.collect())
    return learn([t for _, t, _ in found], np.array([y for _, _, y in found], dtype=int))


def classify(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted and the number of hits for every row of docs."""
    lexicon = fit(docs, labels, fit_rows=fit_rows)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches(frames, 256):
            texts = [t or "" for t in frame.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(lexicon.probability(texts))], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
