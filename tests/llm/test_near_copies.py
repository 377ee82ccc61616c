"""The pipeline's near copies against brute force over true five-word Jaccard similarities."""

from __future__ import annotations

import os
import random

import corpus_pipeline
import numpy as np
from smelter.llm import near_copies, simhash_dedup

PLAIN = "doc_id long, text string"


def kept_by_brute_force(texts):
    sets = []
    for _, t in texts:
        w = (t or "").lower().split()
        n = min(5, len(w))
        sets.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set())
    label = list(range(len(texts)))
    pairs = [(a, b) for a in range(len(texts)) for b in range(a) if sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) > 0]
    while any(label[a] != label[b] for a, b in pairs):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    groups = {}
    for k, (d, _) in enumerate(texts):
        groups.setdefault(label[k], []).append(d)
    return sorted(min(g) for g in groups.values())


def test_near_copies_with_changed_words(spark):
    """Chains of copies with more and more words changed, a passage that all hold, short and empty texts."""
    r = random.Random(4)
    passage = [f"p{k}" for k in range(60)]
    texts = [(900, None), (901, ""), (902, "a"), (903, "A"), (904, "a b")]
    for group in range(12):
        words = [f"g{group}w{r.randrange(500)}" for _ in range(r.choice([6, 20, 90, 300]))]
        for _ in range(12):
            texts.append((len(texts) + 1000 * r.randrange(3), " ".join(words + passage * (group % 2))))
            if r.random() < 0.8:
                words = list(words)
                for _ in range(r.randrange(1 + len(words) // 60 + 1)):
                    words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    r.shuffle(texts)
    docs = spark.createDataFrame(texts, PLAIN)
    want = kept_by_brute_force(texts)
    assert sorted(x.doc_id for x in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == want


def test_near_copies_of_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = near_copies.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == kept_by_brute_force([(r.doc_id, r.text) for r in docs.collect()])


def test_bitmaps_never_refuse_alike_sets():
    pick = np.random.default_rng(4)
    refused = 0
    for _ in range(400):
        n = int(pick.integers(1, 3000))
        a = np.unique(pick.integers(0, 2**63, n).astype(np.uint64))
        share = pick.random()
        b = np.unique(np.concatenate([a[pick.random(len(a)) < 0.75 + share / 4], pick.integers(0, 2**63, int(pick.integers(0, 1 + n // 5))).astype(np.uint64)]))
        other = np.unique(pick.integers(0, 2**63, n).astype(np.uint64))
        for x, y in ((a, b), (b, a), (a, a), (a, other)):
            could = near_copies.could_be_alike(near_copies.parity(x), near_copies.parity(y), len(x), len(y))
            assert could or not near_copies.alike(x, y)
            refused += not could
    assert refused > 380  # unlike sets hardly ever pass


def test_keep_one_with_odd_rows_and_clashing_names(spark):
    kind = "doc_id long, text string, doc string, th int, n double, prefix string, root long, row string"
    long = " ".join(f"w{i % 7000}x{i}" for i in range(30_000))
    texts = [(4, long), (3, long + " tail"), (None, "some five words or more here"), (9, "some five words or more here"), (9, "some five words or more here"),
             (7, None), (8, ""), (2, "a b"), (1, "b a"), (None, "x"), (None, "y")]
    docs = spark.createDataFrame([(i, t, "d", k, 0.5, "p", k, "r") for k, (i, t) in enumerate(texts)], kind)
    out = near_copies.keep_one(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert sorted((r.doc_id for r in got if r.doc_id is not None)) == [1, 2, 3, 7, 9]
    assert sorted(r.text for r in got if r.doc_id is None) == ["x", "y"] and {(r.doc, r.row) for r in got} == {("d", "r")}
    assert near_copies.keep_one(docs.where("false")).collect() == []


def test_the_stage_goes_through_simhash(spark, monkeypatch):
    """The stage's fingerprints pass the inverted index, and what links there is what is compared first."""
    r = random.Random(9)
    base = [" ".join(f"g{g}w{r.randrange(400)}" for _ in range(200)) for g in range(6)]
    texts = [(10 * g + k, t + " end" * k) for g, t in enumerate(base) for k in range(3)]
    prints = {i: simhash_dedup.majority(near_copies.shingles(t)) for i, t in texts}
    asked = []
    index = simhash_dedup.links
    monkeypatch.setattr(simhash_dedup, "links", lambda distinct: asked.append({x.fp for x in distinct.collect()}) or index(distinct))
    docs = spark.createDataFrame(texts, PLAIN)
    assert sorted(x.doc_id for x in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == kept_by_brute_force(texts)
    assert asked == [{p - 2**64 if p >= 2**63 else p for p in prints.values()}]
    rows = [(i, 0, len(near_copies.shingles(t)), p - 2**64 if p >= 2**63 else p) for (i, t), p in zip(texts, prints.values())]
    pairs = near_copies.by_fingerprint(spark.createDataFrame(rows, "doc long, th long, n long, fp long")).collect()
    near = {(a, b) for a in prints for b in prints if b < a and (prints[a] ^ prints[b]).bit_count() <= 3}
    assert near and {(x.a.doc, x.b.doc) for x in pairs} >= {(a, b) for a, b in near if b % 10 == 0}
    assert all(x.a.doc // 10 == x.b.doc // 10 for x in pairs)


def test_components_of_stars_and_chains(spark):
    """Stars are settled by their first labels; no round, with its jobs and broadcasts on the driver, follows. Chains are not."""
    r = random.Random(2)
    stars = [(k, k // 10 * 10) for k in range(400) if k % 10]
    order = r.sample(range(1000, 1300), 300)
    chain = list(zip(order, order[1:]))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup
    counts = []
    for name, edges, want in (("stars", stars, {k: k // 10 * 10 for k in range(400)}), ("both", stars + chain, {k: k // 10 * 10 for k in range(400)} | dict.fromkeys(order, 1000))):
        spark.sparkContext.setJobGroup(f"components-{name}", name)
        found = simhash_dedup.components(spark.createDataFrame(edges, "a long, b long"))
        counts.append(len(jobs(f"components-{name}")))
        spark.sparkContext.setJobGroup("", "")
        assert {x.a: x.root for x in found.collect()} == want
    assert counts[0] <= 14 < counts[1], counts


def test_components_leave_their_last_labels_only(spark, tmp_path):
    steps = simhash_dedup.Steps(spark)
    found = simhash_dedup.components(spark.createDataFrame([(k, k + 1) for k in range(40)], "a long, b long"), within=steps)
    left = os.listdir(steps.folder.removeprefix("file:"))
    assert len(left) == 1 and {x.root for x in found.collect()} == {0}
    steps.drop()
    assert not os.path.exists(steps.folder.removeprefix("file:"))
