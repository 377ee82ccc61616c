"""op4: items of few characters."""

from __future__ import annotations

from smelter.llm import decontamination


def test_short_items_are_found_whole_at_word_borders(spark):
    docs = spark.createDataFrame([(1, "So: Two plus TWO, is four!"), (2, "two plus twofold"), (3, "stwo plus two"), (4, "two plus two"), (5, "two plus twp"),
                                  (6, "stwo plus two; two plus two"), (7, None)], "doc_id long, text string")
    items = spark.createDataFrame([(10, "Two plus two"), (11, "..."), (None, "four")], "item_id long, text string")
    assert sorted(map(tuple, decontamination.leaks(docs, items).collect())) == [(1, 10, 0, 15), (4, 10, 0, 12), (6, 10, 0, 26)]
    assert sorted(r.doc_id for r in decontamination.keep_clean(docs, items).collect()) == [2, 3, 5, 7]
