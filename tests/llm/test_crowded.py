"""op9: minimizers with many different segments."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from smelter.llm import suffix_dedup

PLAIN = "doc_id long, text string"


def test_no_task_gets_all_segments_of_a_crowded_minimizer(spark):
    """A passage that all documents hold with different text beside it: few segments of a minimizer are sorted together."""
    r = random.Random(8)
    passage = "".join(r.choice("abcdefgh ") for _ in range(200))
    texts = []
    for i in range(80):
        left, right = ("".join(r.choice("ijklmnop ") for _ in range(r.randrange(70))) for _ in range(2))
        texts.append((r.randrange(70), left + passage[r.choice([0, 0, 20]):r.choice([200, 200, 170])] + right))
    texts += [texts[0], texts[0], (None, texts[1][1])]
    docs = spark.createDataFrame(texts, PLAIN)
    key = lambda d: 2**63 - 1 if d is None else d
    first = {}
    for d, t in texts:
        for p in range(len(t) - 49):
            first[t[p:p + 50]] = min(key(d), first.get(t[p:p + 50], key(d)))
    want = []
    for d, t in texts:
        gone = {q for p in range(len(t) - 49) if first[t[p:p + 50]] < key(d) for q in range(p, p + 50)}
        want.append((str(d), len(t), len(gone), "".join(x for k, x in enumerate(t) if k not in gone).encode()))
    found = suffix_dedup.remove_duplicated(docs, crowd=8).select("doc_id", "n_bytes", "n_removed", "kept").collect()
    assert sorted((str(x.doc_id), x.n_bytes, x.n_removed, bytes(x.kept)) for x in found) == sorted(want)
    _, owned, _, sorted_in, single = suffix_dedup.dealt(docs, crowd=8)
    assert owned.groupBy("o.m").count().agg(F.max("count")).first()[0] > 8
    assert sorted_in.select("m", "s1", "s2").distinct().groupBy("m").count().agg(F.max("count")).first()[0] <= 8
    assert single.count() > 0


def test_only_minimizers_with_different_segments_are_sorted_and_no_step_is_computed_again(spark):
    """Whole copies need no sorting, an edge does; what was stored is read, not planned anew, by the query that is returned."""
    r = random.Random(9)
    word = lambda n, letters: "".join(r.choice(letters) for _ in range(n))
    copy, passage = word(400, "abcdefgh "), word(300, "qrstuvwx ")
    docs = spark.createDataFrame([(1, copy), (2, copy), (3, passage + word(100, "ijklm ")), (4, passage + word(100, "ijklm "))], PLAIN)
    _, owned, _, sorted_in, _ = suffix_dedup.dealt(docs)
    assert sorted_in.where("doc <= 2").count() == 0 < sorted_in.where("doc = 3").count() <= 3 < owned.where("o.doc = 3").count()
    found = suffix_dedup.remove_duplicated(docs)
    assert {x.doc_id: x.n_removed for x in found.collect()} == {1: 0, 2: 400, 3: 0, 4: 300}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_segments_left_out_before_sorting_have_no_string_of_another():
    """A string of 50 bytes holds the gram of its minimizer and 15 bytes beside it on one side."""
    r = random.Random(10)
    found = {}
    gram = "".join(r.choice("abcd") for _ in range(20))
    for doc in range(300):
        left, right = (r.choice(["x" * k + "".join(r.choice("efgh") for _ in range(40 - k)) for k in (0, 10, 20, 30)]) for _ in range(2))
        body = (left[::-1] + gram + right).encode()
        for m, a, b in zip(*(x.tolist() for x in suffix_dedup.segments(np.frombuffer(body, dtype=np.uint8), 50, 20))):
            found.setdefault((m, body[a:b + 49]), doc)
    parts, m, owners = [p for _, p in found], np.array([m for m, _ in found], dtype=np.int64), np.array(list(found.values()))
    kept = suffix_dedup.may_share(m, parts, 50, 20)
    holders = {}
    for k, p in enumerate(parts):
        for at in range(len(p) - 49):
            holders.setdefault(p[at:at + 50], set()).add(k)
    needed = {k for x in holders.values() if len(x) > 1 for k in x}
    assert needed and needed <= set(np.flatnonzero(kept).tolist()) and not kept.all()
    whole = {(k, *p.tolist()) for k, p in suffix_dedup.shard_firsts(parts, owners, 50)}
    chosen = np.flatnonzero(kept)
    assert {(int(chosen[k]), *p.tolist()) for k, p in suffix_dedup.shard_firsts([parts[k] for k in chosen], owners[chosen], 50)} == whole


def test_segments_of_many_documents_at_once():
    r = random.Random(1)
    docs = [bytes(r.choice(b"ab cde") for _ in range(r.choice([0, 1, 10, 49, 50, 51, 200, 9000]))) for _ in range(60)]
    found = suffix_dedup.many_segments(np.frombuffer(b"".join(docs), dtype=np.uint8), np.array([len(x) for x in docs]), 50, 20, piece=5000)
    want = [(int(m), k, int(a), int(b)) for k, x in enumerate(docs) for m, a, b in zip(*suffix_dedup.segments(np.frombuffer(x, dtype=np.uint8), 50, 20))]
    assert list(zip(*(c.tolist() for c in found))) == want


def test_less_is_sorted_with_the_same_result(monkeypatch):
    """Different text on both sides of few passages: hardly anything is left to sort once equal rests stand for each other."""
    r = random.Random(7)
    passages = [bytes(r.choice(b"abcdefgh") for _ in range(70)) for _ in range(4)]
    other = lambda n: bytes(r.randrange(128, 256) for _ in range(n))
    parts = [other(r.randrange(40)) + r.choice(passages)[r.randrange(3):] + other(r.randrange(40)) for _ in range(300)]
    parts += [other(90), passages[0] + passages[1], b"z" * 120, b"z" * 60, b"short"]
    owners = np.array([r.randrange(80) for _ in parts])
    owner_of = {}
    for p, o in zip(parts, owners.tolist()):
        for k in range(len(p) - 49):
            owner_of[p[k:k + 50]] = min(o, owner_of.get(p[k:k + 50], o))
    want = {n: {k for k in range(len(p) - 49) if owner_of[p[k:k + 50]] < o} for n, (p, o) in enumerate(zip(parts, owners.tolist()))}
    asked = []
    whole = suffix_dedup.shard_firsts
    monkeypatch.setattr(suffix_dedup, "shard_firsts", lambda p, *rest: asked.append(sum(map(len, p))) or whole(p, *rest))
    found = dict(suffix_dedup.settled(parts, owners, 50))
    assert {n: set(found[n].tolist()) if n in found else set() for n in want} == want and all(len(set(v.tolist())) == len(v) for v in found.values())
    assert 0 < sum(asked) < sum(map(len, parts)) / 3


def test_minimizers_meet_in_even_shards():
    body = np.random.default_rng(3).integers(32, 127, 400_000).astype(np.uint8)
    m = np.unique(suffix_dedup.segments(body, 50, 20)[0])
    many = np.bincount((suffix_dedup._short(m, 6) >> np.uint64(32)).astype(np.int64), minlength=64)
    assert len(many) == 64 and many.max() < 1.5 * many.mean()


def test_the_texts_are_not_stored_again_and_the_bodies_once(spark, monkeypatch):
    """No table of a step holds the texts, and tables go before the next texts are shuffled: what lies on disk stays below the input."""
    r = random.Random(11)
    word = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    passage = word(300)
    docs = spark.createDataFrame([(k, word(3000) + passage + word(3000)) for k in range(60)] * 2, PLAIN)
    kept = []
    keep = suffix_dedup.Steps.keep
    monkeypatch.setattr(suffix_dedup.Steps, "keep", lambda self, df: kept.append(keep(self, df)) or kept[-1])
    found = suffix_dedup.remove_duplicated(docs).collect()
    assert len(found) == 120 and all(x.n_removed == 0 if x.doc_id == 0 else 300 <= x.n_removed < 320 for x in found)
    names = [set(df.columns) for df in kept]
    assert not any("text" in x for x in names) and sum("body" in x for x in names) == 1 and not any("s2" in x for x in names)


def test_trimmed_by_pieces(monkeypatch):
    r = random.Random(12)
    parts = [bytes(r.choice(b"ab") for _ in range(r.choice([0, 3, 49, 50, 51, 60, 130]))) for _ in range(200)] + [b"", b"ab" * 60]
    whole = suffix_dedup.trimmed(parts, 12)
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", 100)
    holders = {}
    for k, p in enumerate(parts):
        for at in range(len(p) - 11):
            holders.setdefault(p[at:at + 12], []).append((k, at))
    places = sorted(x for found in holders.values() if len(found) > 1 for x in found)
    want = [(k, min(a for j, a in places if j == k), max(a for j, a in places if j == k) + 12) for k in sorted({k for k, _ in places})]
    assert suffix_dedup.trimmed(parts, 12) == whole == want


def test_whole_copies_are_not_looked_at(spark):
    """Their smallest document only is; they lose all, also in blocks that hold copies only, and near copies are judged as before."""
    r = random.Random(13)
    word = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    copy, short = word(400), word(49)
    texts = [(1000 - k, copy) for k in range(300)] + [(k, short) for k in range(5)] + [(5, copy[:200] + word(200)), (6, word(300)), (2000, copy + "x"), (6, copy), (6, copy), (None, copy), (None, "")]
    docs = spark.createDataFrame(texts, PLAIN)
    assert {x.doc for x in suffix_dedup.whole_copies(docs).collect()} == {*range(701, 1001), 2**63 - 1, *range(1, 5)}
    places, *_ = suffix_dedup.dealt(docs)
    assert {x.doc for x in places.select("doc").distinct().collect()} == {5, 6, 2000}
    key = lambda d: 2**63 - 1 if d is None else d
    first = {}
    for d, t in texts:
        for p in range(len(t) - 49):
            first[t[p:p + 50]] = min(key(d), first.get(t[p:p + 50], key(d)))
    want = []
    for d, t in texts:
        gone = {q for p in range(len(t) - 49) if first[t[p:p + 50]] < key(d) for q in range(p, p + 50)}
        want.append((str(d), len(t), len(gone), "".join(x for k, x in enumerate(t) if k not in gone).encode()))
    found = suffix_dedup.remove_duplicated(docs).select("doc_id", "n_bytes", "n_removed", "kept").collect()
    assert sorted((str(x.doc_id), x.n_bytes, x.n_removed, bytes(x.kept)) for x in found) == sorted(want)
