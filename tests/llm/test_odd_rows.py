"""Rows that share an id, rows without one, texts of many repeats, phrases with other signs between their words."""

from __future__ import annotations

import time
from collections import Counter

import numpy as np
from smelter.llm import common, decontamination, quality_nbsvm, topk_segments, toxicity


def best_by_brute_force(rows, k):
    vectors = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows]
    out = []
    for a, (i, v) in enumerate(vectors):
        if i % 100 == 0:
            scores = sorted((-sum(x * y for x, y in zip(v, w)), j) for b, (j, w) in enumerate(vectors) if a != b)
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scores[:k])]
    return Counter(out)


def test_every_row_of_an_id_is_a_candidate(spark):
    r = np.random.default_rng(8)
    plain = [(0, [1.0]), (7, [5.0]), (7, [-5.0]), (3, [2.0])]
    ids = [0, 0, 100, 100, 200, 5, 5, 7]
    mixed = [(int(r.choice(ids)), [float(x) for x in r.integers(-2, 3, 3)]) for _ in range(120)]
    copies = [(0, [1.0, 2.0])] * 15 + [(9, [3.0])] * 30 + [(9, [3.0, 0.0])]
    padded = [(0, [1.0]), (0, [1.0, 0.0]), (4, [0.5])]
    for rows in (plain, mixed, copies, padded):
        table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        numbers = topk_segments.whole_numbers(table)
        for size in (4096, 3):
            found = topk_segments.search(numbers, numbers.where("vec_id % 100 = 0"), query_block=size, candidate_block=size)
            assert found.columns == ["query_id", "rank", "vec_id", "score"]
            assert Counter(map(tuple, found.collect())) == best_by_brute_force(rows, 10)


def test_sql_of_search_with_repeated_ids(spark):
    import duckdb
    import pandas as pd

    embeddings = pd.DataFrame({"vec_id": [0, 7, 7, 3, 0], "embedding": [[1.0], [5.0], [-5.0], [2.0], [1.0]]})  # noqa: F841  read by the SQL
    want = Counter(duckdb.sql(topk_segments.SEARCH_SQL).fetchall())
    found = topk_segments.hundredths(spark.createDataFrame(embeddings.values.tolist(), "vec_id long, embedding array<double>"))
    assert Counter(map(tuple, found.select("query_id", "rank", "vec_id", "score").collect())) == want
    assert (0, 1, 7, 5 * 2**20) in want and (0, 4, 7, -5 * 2**20) in want


def test_held_out_is_never_null(spark):
    docs = spark.createDataFrame([(None, "fine words here"), (1, "fine words here"), (1, "trash talk"), (2, None), (3, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for out in (quality_nbsvm.classify(docs, labels), toxicity.classify(docs, labels)):
        got = out.collect()
        assert len(got) == 5 and all(r.held_out is not None for r in got) and [r.held_out for r in got if r.doc_id is None] == [False]


def test_a_repeated_id_is_learned_from_by_its_least_hash(spark):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    runs = {tuple(map(tuple, common.labelled_texts(docs.repartition(n), labels, "quality", 5).collect())) for n in (1, 3, 7)}
    assert len(runs) == 1 and len(next(iter(runs))) == 1


def test_phrases_are_excepted_whatever_stands_between_their_words():
    lexicon = toxicity.Lexicon({"trash": 5.0}, ["trash can"])
    assert [len(lexicon.hits(toxicity.fold(t))) for t in ("trash can", "trash  can", "trash\ncan", "Trash, can", "trash-can", "trash cat", "can trash", "trash")] == [0] * 5 + [1] * 3


def distance_within(item, body):
    """Fewest edits that turn item into a part of body, by the plain table."""
    row = [0] * (len(body) + 1)
    for k, ch in enumerate(item):
        new = [k + 1]
        for j, other in enumerate(body):
            new.append(min(row[j] + (ch != other), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_leaks_of_a_table_against_plain_distance(spark):
    r = np.random.default_rng(3)
    words = ["ab", "cd", "efg", "h", "ij"]
    items = [(k, " ".join(r.choice(words, int(r.integers(9, 40))))) for k in range(25)] + [(90, "ab cd " * 30)]
    texts = [(0, "ab cd " * 60), (1, None), (2, "")]
    for k in range(60):
        body = list(items[int(r.integers(len(items)))][1])
        for _ in range(int(r.integers(0, 6))):
            body[int(r.integers(len(body)))] = "xz "[int(r.integers(3))]
        texts.append((10 + k, " ".join(r.choice(words, int(r.integers(1, 30)))) + " " + "".join(body) + " " + "".join(body[::2])))
    want = set()
    for d, t in texts:
        body = decontamination.plain(t)
        for i, item in items:
            item = decontamination.plain(item)
            if len(item) >= decontamination.MIN_CHARS and (edits := distance_within(item, body)) <= int(len(item) * decontamination.ERROR_SHARE):
                want.add((d, i, edits))
    docs, asked = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.leaks(docs, asked.where(f"length(trim(text)) >= {decontamination.MIN_CHARS}"))
    assert {(x.doc_id, x.item_id, x.n_edits) for x in found.collect()} == want and len(want) > 40


def test_repetitive_texts_take_linear_time():
    matcher = decontamination.Matcher([(1, decontamination.plain("ab cd " * 20 + "other words " * 20))], 0.05)
    text = "ab cd " * 17_000
    start = time.perf_counter()
    assert matcher.find(text) == []
    assert time.perf_counter() - start < 2
