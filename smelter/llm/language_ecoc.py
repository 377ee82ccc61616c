"""Language identification with error-correcting output codes.

Each language has a codeword; a binary classifier for each of its bits weighs hashed byte trigrams by the log ratio of
their frequencies in the languages with that bit set and in the others. Decoding is weighted by loss: the language whose
codeword costs least under the bits' margins, each bit counting by its accuracy in fitting, is chosen, and a text whose
second language costs nearly as little is flagged as ambiguous. Fitting uses a bounded sample of rows (``fit_rows``, by
hash of the id); every row is decided by its whole text.

Nulls: null text, and text without a letter, is ``und`` with score 0; null lang or id: not learned from. With one
language learned every text with a letter has that; with none it is ``und``. Repeated rows are decided each. Empty table:
empty result. Only doc_id, text and lang are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import batches, bounded_sample, held_out

FIT_ROWS, MOST_LANGS, BITS = 8000, 512, 15
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[ord("A"):ord("Z") + 1] += 32
_FOLDED[:ord("A")] = 32
for _between in (range(ord("Z") + 1, ord("a")), range(ord("z") + 1, 128)):
    _FOLDED[list(_between)] = 32


def trigrams(text: str) -> np.ndarray:
    """Hash slots of the text's byte trigrams, ASCII letters in lower case, runs of all else in ASCII as one blank."""
    raw = _FOLDED[np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace"), dtype=np.uint8)]
    raw = raw[np.concatenate([[True], (raw[1:] != 32) | (raw[:-1] != 32)])].astype(np.uint32)
    code = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    return ((code * np.uint32(2654435769)) >> np.uint32(32 - BITS)).astype(np.int64)


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """n rows of +1 and -1: all ways to part up to 5 languages in two; beyond that the best of many random codes."""
    if n <= 5:
        columns = [[1 if (m >> k) & 1 else -1 for k in range(n)] for m in range(1, 2 ** (n - 1))]
        return np.array(columns, dtype=np.int8).T.reshape(n, -1)
    random, width = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    best, most = None, -1
    for _ in range(60):
        code = random.choice(np.array([-1, 1], dtype=np.int8), size=(n, width))
        apart = code.astype(np.int32) @ code.T
        np.fill_diagonal(apart, -width)
        least = (width - apart.max()) // 2
        if least > most and (np.abs(code.sum(axis=0)) < n).all():
            best, most = code, least
    return best


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray
    weights: np.ndarray  # trigram slots x bits
    trust: np.ndarray
    sharp: float = 1.0

    def losses(self, slots: np.ndarray) -> np.ndarray:
        """Loss of each language; a bit's evidence grows with the root of the text's length."""
        margin = self.weights[slots].mean(axis=0) * min(len(slots), 100) ** 0.5 * self.sharp
        return (np.logaddexp(0, -self.code * margin) * self.trust).sum(axis=1)

    def predict(self, text: str | None, gap: float = 0.2) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, and whether the decision is ambiguous."""
        if not text or not self.langs or not LETTER.search(text):
            return UNKNOWN, 0.0, False
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False
        losses = self.losses(trigrams(text))
        share = np.exp(losses.min() - losses)
        share /= share.sum()
        order = np.argsort(-share, kind="stable")
        return self.langs[order[0]], float(share[order[0]]), bool(share[order[0]] - share[order[1]] < gap)


def build(langs: list[str], counts: np.ndarray, smooth: float = 0.5) -> Model:
    """From trigram counts, a row for each language. A bit's trust is how well it parts the languages' own trigrams."""
    if len(langs) < 2:
        return Model(langs, np.zeros((len(langs), 0)), np.zeros((1 << BITS, 0), dtype=np.float32), np.zeros(0))
    code = codewords(len(langs))
    share = (counts + smooth) / (counts + smooth).sum(axis=1, keepdims=True)
    weights = np.stack([np.log(share[code[:, b] > 0].mean(axis=0)) - np.log(share[code[:, b] < 0].mean(axis=0))
                        for b in range(code.shape[1])], axis=1)
    expected = code * (share @ weights)  # of each language and bit: the mean margin towards the right side
    trust = np.clip(expected.mean(axis=0), 1e-3, None)
    return Model(langs, code, weights.astype(np.float32), trust / trust.mean())


def fit(docs: DataFrame, *, fit_rows: int = FIT_ROWS, most_langs: int = MOST_LANGS) -> Model:
    """Fit on at most fit_rows rows outside the held-out fold, of the most_langs most frequent languages among them."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id", 4, 2))
    chosen = F.broadcast(bounded_sample(rows.select("doc_id").distinct(), "doc_id", fit_rows))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches(frames, 1024):
            by: dict[str, np.ndarray] = {}
            for lang, text in zip(frame.column(0).to_pylist(), frame.column(1).to_pylist()):
                by[lang] = by.get(lang, 0) + np.bincount(trigrams(text), minlength=1 << BITS)
            for lang, n in by.items():
                slots = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([slots.astype(np.int32).tobytes()]),
                                                  pa.array([n[slots].astype(np.int64).tobytes()])], names=["lang", "slots", "n"])

    found = rows.join(chosen, "doc_id").select("lang", "text").mapInArrow(run, "lang string, slots binary, n binary").collect()
    total: dict[str, np.ndarray] = {}
    for r in found:
        total.setdefault(r.lang, np.zeros(1 << BITS))[np.frombuffer(r.slots, dtype=np.int32)] += np.frombuffer(r.n, dtype=np.int64)
    langs = sorted(sorted(total, key=lambda k: (-total[k].sum(), k))[:most_langs])
    return build(langs, np.array([total[k] for k in langs]).reshape(len(langs), 1 << BITS))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and ambiguous for every row of docs."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches(frames, 512):
            found = [model.predict(t) for t in frame.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()),
                                              pa.array([x[2] for x in found], pa.bool_())], names=["doc_id", "lang_pred", "score", "ambiguous"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")
            .select("doc_id", F.coalesce(held_out("doc_id", 4, 2), F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous"))
