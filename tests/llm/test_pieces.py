"""op3: what the library is asked, and texts put together from known chunks."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest

from smelter.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


class Asked:
    """The library, and the characters it was asked to encode and the ids it was asked to decode."""

    def __init__(self, library):
        self.library, self.n = library, 0

    def encode(self, texts, **options):
        self.n += sum(map(len, texts))
        return self.library.encode(texts, **options)

    def decode(self, ids, **options):
        self.n += sum(map(len, ids))
        return self.library.decode(ids, **options)


def test_the_library_sees_each_chunk_once(spark):
    """Texts of known chunks cost it nothing: before, it decoded every text."""
    r = random.Random(4)
    words = ["".join(r.choice("abcdeé日🙂.") for _ in range(r.randrange(1, 12))) for _ in range(300)]
    texts = [r.choice(["", " ", "\n"]).join(r.choice([w, w + "\n", w + "  "]) for w in r.choices(words, k=200)) for _ in range(40)] * 5
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    library = pieces.agenda(MODEL).library
    got = {x.doc_id: (x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in pieces.piece_digest(docs, MODEL).collect()}
    for k, ids in enumerate(library.encode(texts)):
        want = len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert got[k] == want
    coder = pieces.Agenda(MODEL)
    coder.library = asked = Asked(coder.library)
    mixed = [" ".join(r.choices(words, k=60)) for _ in range(200)]
    list(coder.encode_batch(mixed))
    once = asked.n
    assert 0 < once < sum(map(len, mixed)) / 2
    ids, ends = coder.encode_flat(mixed[::-1])
    assert coder.decode_flat(ids, ends, mixed[::-1]) == [t.encode() for t in mixed[::-1]]
    assert asked.n == once


def test_a_difference_from_the_library_raises():
    coder = pieces.Agenda(MODEL)
    coder.pair_rank[:] = coder.pair_rank[::-1].copy()
    with pytest.raises(AssertionError):
        list(coder.encode_batch(["these are plain words of a text", "and\nlines"]))


def test_odd_texts_in_one_batch():
    coder = pieces.Agenda(MODEL)
    r = random.Random(3)
    texts = ["", " ", "  ", "\n", " \n ", "<s>", "x" * 5000, " " * 500, "▁", "▁▁a", "\0", "a\0 b"]
    for letters in (" ▁ab\t\n\0é日🙂lethe", "\n  a", "<s></s>é́  \r\n.,the", "  ▁▁"):
        texts += ["".join(r.choice(letters) for _ in range(r.randrange(90))) for _ in range(200)]
    ids, ends = coder.encode_flat(texts)
    want = coder.library.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == want
    assert coder.decode_flat(ids, ends, texts) == [t.encode() for t in coder.library.decode(want)]
