"""The operators for training data against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from smelter.llm import decontamination, language_ecoc, line_dedup, near_copies, pieces, quality_nbsvm, simhash_dedup, substring_dedup, suffix_dedup, topk_segments, toxicity
from smelter.llm.external_suffixes import scratch, suffixes
from tests.oracle import connect, differences

SMALL = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
KIND = "doc_id long, text string, lang string, source string, n_chars long, score double, th int, row string"
PLAIN = "doc_id long, text string"


def rows(texts):
    return [(i, t, "en", "s", len(t or ""), 0.1, 1, "x") for i, t in texts]


LONG = " ".join(f"w{i}" for i in range(120))
ODD = [(1, LONG), (2, None), (3, ""), (4, "a"), (5, LONG), (5, LONG), (None, LONG), (7, "x y " * 20000), (8, "line " * 12 + "\n" + LONG)]


def every(spark, docs):
    """All operators over documents, as lists of rows."""
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "w5 w6 w7 w8 w9 w10 w11 w12 w13"), (2, None), (None, "x"), (3, "")], "item_id long, text string")
    out = {
        1: quality_nbsvm.classify(docs, labels), 3: pieces.piece_digest(docs, MODEL), 4: decontamination.leaks(docs, items), 5: substring_dedup.words_digest(docs),
        6: toxicity.classify(docs, labels), 7: simhash_dedup.cluster_digest(docs), 8: language_ecoc.identify(docs, language_ecoc.fit(docs)),
        9: suffix_dedup.remove_duplicated(docs, digest=True), 10: line_dedup.line_digest(docs), 11: quality_nbsvm.keep_good(docs, labels),
        12: line_dedup.without_repeated_lines(docs), 13: simhash_dedup.keep_one(docs), 14: decontamination.keep_clean(docs, items)}
    for k in (11, 12, 13, 14):
        assert out[k].columns == docs.columns
    return {k: v.collect() for k, v in out.items()}


def test_odd_rows_and_clashing_names(spark):
    docs = spark.createDataFrame(rows(ODD), KIND)
    out = every(spark, docs)
    for k in (1, 3, 5, 6, 7, 8, 9, 10, 12):
        assert len(out[k]) == len(ODD), k
    five = {(r.doc_id, r.n_words): r.n_removed for r in out[5]}
    assert five[(1, 120)] == 0 and five[(5, 120)] == 120 and five[(None, 120)] == 120 and five[(2, 0)] == 0
    assert {r.component_id for r in out[7] if r.doc_id in (1, 5, None)} == {1}
    assert {r.component_id for r in out[7] if r.doc_id in (2, 3)} == {2}
    assert sorted(r.doc_id for r in out[4] if r.doc_id) == [1, 5, 5, 8] and sum(r.doc_id is None for r in out[4]) == 1
    assert sorted(r.doc_id for r in out[13]) == [1, 2, 4, 7, 8]
    assert {r.lang_pred for r in out[8] if r.doc_id in (2, 3)} == {"und"}
    assert len(out[14]) == 4


def test_empty_tables(spark):
    assert all(not v for v in every(spark, spark.createDataFrame([], KIND)).values())


@pytest.mark.parametrize("name", ["op2_topk_segments", "op5_substring_dedup", "op9_suffix_dedup", "op10_line_dedup"])
def test_against_sql(spark, name):
    from smelter.llm import registry

    assert differences(registry.QUERIES[name](spark, SMALL), connect(SMALL), registry.ORACLE[name]) == []


def test_suffixes_against_sorting():
    r = np.random.default_rng(3)
    for trial in range(60):
        text = np.concatenate([r.integers(1, 1 + r.integers(1, 4), r.integers(1, 80)), [0]]).astype(np.uint16)
        cap = int(r.choice([3, 60]))
        with scratch() as folder:
            found = list(suffixes(text, cap, folder, budget=64 if trial % 2 else 1 << 20, leaf=4 if trial % 2 else 1000))[::-1]
        places = np.concatenate([p for _, p, _ in found])
        tails = [tuple(text[p:]) for p in places]
        assert sorted(places.tolist()) == list(range(len(text)))
        assert all(a[:cap] <= b[:cap] for a, b in zip(tails, tails[1:]))
        shared = np.concatenate([s for _, _, s in found])
        for k in range(1, len(tails)):
            n = next((i for i, (x, y) in enumerate(zip(tails[k - 1], tails[k])) if x != y), 0)
            assert shared[k] == min(n, cap)


def test_pieces_against_library():
    coder = pieces.Agenda(MODEL)
    r = random.Random(1)
    texts = ["".join(r.choice(" ▁ab\t\n\0é日🙂lethe") for _ in range(r.randrange(90))) for _ in range(300)]
    ids = list(coder.encode_batch(texts))
    assert ids == [coder.library.encode(t) for t in texts]
    assert [coder.decode(k) for k in ids] == coder.library.decode(ids)
    chunk = "▁" + "the" * 30
    assert coder.merge(chunk) == coder.library.encode("the" * 30)
    assert coder.merge_rows(["▁these", "▁of"]) == [coder.merge("▁these"), coder.merge("▁of")]


def test_fingerprints_and_components_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r.doc_id: r for r in simhash_dedup.cluster(docs, longest=2).collect()}
    prints = {}
    for d in docs.collect():
        low = re.sub("[A-Z]", lambda m: m[0].lower(), d.text)
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        n = min(3, len(words))
        hashes = [xxhash.xxh64_intdigest(" ".join(words[k:k + n]), 42) for k in range(len(words) - n + 1)] if words else []
        prints[d.doc_id] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert got[d.doc_id].fp % 2**64 == prints[d.doc_id]
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 3 and label[b] < label[a]:
                    label[a], changed = label[b], True
    assert {i: r.component_id for i, r in got.items()} == label


def test_myers_and_pigeonhole_against_plain_distance():
    r = random.Random(5)

    def plain(p, t):
        row = [0] * (len(t) + 1)
        for i, x in enumerate(p, 1):
            new = [i]
            for j, y in enumerate(t, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return min(row)

    for _ in range(200):
        p, t = ("".join(r.choice("abc ") for _ in range(n)) for n in (r.randint(1, 20), r.randint(0, 30)))
        masks = {c: sum(1 << k for k, x in enumerate(p) if x == c) for c in set(p)}
        assert decontamination.best_match(p, masks, t)[0] == plain(p, t)
    item = " ".join("".join(r.choice("abcdef") for _ in range(5)) for _ in range(20))
    matcher = decontamination.Matcher([(9, item)], 0.05)
    for edits in range(10):
        body = list(item)
        for at in r.sample(range(len(body)), edits):
            body[at] = "z"
        text = "before " + "".join(body) + " after"
        assert bool(matcher.find(text)) == (plain(item, decontamination.plain(text)) <= int(len(item) * 0.05))


def test_decontamination_in_blocks(spark):
    docs, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(decontamination.leaks(docs, items).collect())
    assert whole and whole == sorted(decontamination.leaks(docs, items, block_chars=500).collect())
    kept = {r.doc_id for r in decontamination.keep_clean(docs, items, block_chars=500).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - {r.doc_id for r in whole}


def test_folding_and_exceptions():
    texts = [f"you{k % 50} {'idiot' if k % 2 else 'friend'} n{k} of {k * 7}" for k in range(600)]
    lexicon = toxicity.learn(texts, np.array([k % 2 for k in range(600)]))
    assert list(lexicon.weights) == ["idiot"]
    p = lexicon.probability(["an 1d10t", "an ΙDIOT!", "mу idiоt", "a friend", "", "an id iot"])
    assert (p[:3] > 0.5).all() and (p[3:] < 0.5).all()
    lexicon = toxicity.Lexicon({"trash": 5.0, "ass": 3.0}, ["trash can"])
    assert [lexicon.hits(t) for t in ("a trash can", "pass assets")] == [[], []]
    assert [h[2] for h in lexicon.hits("trashy ass trash can")] == [5.0, 3.0]


def test_codewords_and_held_out_accuracy(spark):
    code = language_ecoc.codewords(12)
    apart = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
    assert min(apart) >= 8
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language_ecoc.identify(docs, language_ecoc.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert out.where("lang_pred = lang").count() / out.count() > 0.95


def test_held_out_quality_and_toxicity(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    for out, label in ((quality_nbsvm.classify(docs, labels), "quality"), (toxicity.classify(docs, labels), "toxic")):
        joined = out.join(labels, "doc_id").where("held_out")
        assert joined.where(F.col("predicted") == F.col(label)).count() / joined.count() > 0.97


def test_topk_edges(spark):
    nan = float("nan")
    table = spark.createDataFrame([(0, [1.0, 0.0]), (100, [0.5, None]), (200, [1.0, nan]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (None, [1.0, 1.0]), (4, [2.0])],
                                  "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk_segments.hundredths(table, k=3).orderBy("rank").collect()] == [(0, 1, 4, 2 * 2**20), (0, 2, 1, 2**20), (0, 3, 2, 2**20)]
    assert topk_segments.hundredths(table.limit(0)).count() == 0


def test_segment_bounds_lose_nothing():
    r = np.random.default_rng(2)
    c = np.floor(1024 * r.normal(size=(700, 24))).astype(np.int64)
    q_ids, found, scores = topk_segments.best_of_block(np.arange(5), c[:5], np.arange(700), c, 10)
    for q in range(5):
        want = sorted((-int(c[q] @ c[i]), i) for i in range(700) if i != q)[:10]
        assert list(zip((-scores[q_ids == q]).tolist(), found[q_ids == q].tolist())) == want


def test_pipeline_against_its_parts(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {r.doc_id: r for r in docs.collect()}
    scores = {r.doc_id: r.score for r in quality_nbsvm.classify(docs, spark.read.parquet(f"{SMALL}/labels.parquet")).collect()}
    kept = {i: r.text or "" for i, r in kept.items() if scores[i] >= 0.3}
    holders = {}
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    for i, t in kept.items():
        for line in t.split("\n"):
            holders.setdefault(key(line), set()).add(i)
    common = {k: max(v) for k, v in holders.items() if len(k) >= 40 and len(v) >= 5}
    kept = {i: "\n".join(x for x in t.split("\n") if common.get(key(x), i) == i) for i, t in kept.items()}
    sets = {i: near_copies.shingles(t) for i, t in kept.items()}
    pairs = [(a, b) for a in sorted(sets) for b in sorted(sets) if a < b and near_copies.alike(sets[a], sets[b])]
    label = {i: i for i in sets}
    for _ in range(5):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    kept = {i: t for i, t in kept.items() if label[i] == i}
    items = [decontamination.plain(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    kept = {i: t for i, t in kept.items() if not any(len(x) >= 24 and x in decontamination.plain(t) for x in items)}
    library = pieces.agenda(MODEL).library
    want = {i: hashlib.sha256(",".join(map(str, library.encode(t))).encode()).hexdigest() for i, t in kept.items()}
    assert {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SMALL).collect()} == want


def test_repeated_passages_against_brute_force(spark):
    """Copies with changed words, passages at other places, passages twice in one document, one id with several texts."""
    random.seed(12)
    passages = [[f"p{k}w{random.randrange(40)}" for _ in range(random.choice([49, 50, 51, 90, 200]))] for k in range(8)] + [["same"] * 150]
    texts = []
    for i in range(60):
        words = [f"own{i}-{j}" for j in range(random.randrange(70))]
        for _ in range(random.randrange(4)):
            part = list(random.choice(passages))
            if random.random() < 0.5:
                part[random.randrange(len(part))] = f"new{i}"
            words += part[random.choice([0, 0, 5]):] + [f"own{i}"] * random.randrange(2)
        texts.append((random.randrange(45), " ".join(words)))
    texts += [(50, texts[0][1]), (50, texts[1][1]), (50, texts[1][1])]
    first = {}
    for d, t in texts:
        w = t.split()
        for p in range(len(w) - 49):
            key = tuple(w[p:p + 50])
            first[key] = min(d, first.get(key, d))
    expected = []
    for d, t in texts:
        w = t.split()
        gone = {q for p in range(len(w) - 49) if first[tuple(w[p:p + 50])] < d for q in range(p, p + 50)}
        expected.append((d, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    found = substring_dedup.remove_duplicated(spark.createDataFrame(texts, PLAIN)).collect()
    assert sorted(map(tuple, found)) == sorted(expected) and any(n for _, _, n, _ in expected)
