"""Merge semantics."""

import datetime as dt
import itertools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from smelter.operators import merge
from smelter.operators.dedup import dedup_latest, explode_list
from smelter.plans import silver
from smelter.schemas import bronze_schema
from smelter.sources.tables import empty_table

T = [f"2024-01-0{d} 00:00:00" for d in range(1, 8)]
OPEN = dt.datetime(9999, 12, 31)


def at(i):
    return dt.datetime(2024, 1, i + 1)


def businesses(spark, *rows):
    """Rows of (business_id, name, review_count, stars, latitude)."""
    schema = bronze_schema("business")
    names = [f.name for f in schema.fields]
    full = []
    for key, name, count, stars, lat in rows:
        values = {"business_id": key, "name": name, "review_count": count, "stars": stars, "latitude": lat}
        full.append(tuple(values.get(n) for n in names))
    return spark.createDataFrame(full, schema)


def load(spark, batches):
    table = empty_table(spark, "business")
    for i, batch in enumerate(batches):
        stage, _ = silver.stage_businesses(businesses(spark, *batch))
        table = merge.scd2_merge(table, stage, "business_id", T[i])
    return table


def versions(table):
    rows = table.orderBy("business_id", "valid_from").collect()
    return [(r.business_id, r.name, r.is_current, r.valid_from, r.valid_to) for r in rows]


A, B = ("k", "A", 1, 1.0, 0.0), ("k", "B", 1, 1.0, 0.0)


class TestVersions:
    def test_first_load(self, spark):
        row = load(spark, [[A]]).first()
        assert (row.is_current, row.valid_from, row.valid_to) == (True, at(0), OPEN)
        assert (row._ingested_at, row._processed_at, row._schema_version, row._source_file) == (at(0), at(0), 1, "bronze_external_table")

    def test_same_batch_twice_changes_nothing(self, spark):
        once, twice = load(spark, [[A]]), load(spark, [[A], [A]])
        assert [tuple(r) for r in once.collect()] == [tuple(r) for r in twice.collect()]

    def test_a_b_a_gives_three_abutting_versions(self, spark):
        assert versions(load(spark, [[A], [B], [A]])) == [
            ("k", "A", False, at(0), at(1)), ("k", "B", False, at(1), at(2)), ("k", "A", True, at(2), OPEN)]

    def test_closing_touches_only_three_columns(self, spark):
        old = load(spark, [[A], [B]]).where("not is_current").first()
        assert (old._ingested_at, old._processed_at, old.valid_from, old.name) == (at(0), at(1), at(0), "A")

    def test_absent_key_stays_current(self, spark):
        assert versions(load(spark, [[A], [("z", "Z", 1, 1.0, 0.0)]]))[0] == ("k", "A", True, at(0), OPEN)

    def test_untracked_column_waits_for_a_tracked_change(self, spark):
        table = load(spark, [[A], [("k", "A", 1, 1.0, 9.0)]])
        assert [(r.latitude, r.is_current) for r in table.collect()] == [(0.0, True)]

    def test_padded_key_is_the_same_key(self, spark):
        assert versions(load(spark, [[A], [(" k ", "B", 1, 1.0, 0.0)]])) == [
            ("k", "A", False, at(0), at(1)), ("k", "B", True, at(1), OPEN)]

    def test_null_becoming_value_is_a_change(self, spark):
        assert len(versions(load(spark, [[("k", None, 1, 1.0, 0.0)], [A]]))) == 2


def test_null_keys_are_quarantined(spark):
    stage, bad = silver.stage_businesses(businesses(spark, A, (None, "N", 1, 1.0, 0.0), ("  ", "M", 1, 1.0, 0.0)))
    assert stage.count() == 1 and sorted(r.name for r in bad.collect()) == ["M", "N"]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.sampled_from("abcde"), st.integers(0, 2), max_size=5), min_size=1, max_size=3))
def test_versions_hold_together(spark, batches):
    loaded = [[(k, str(v), 1, 1.0, 0.0) for k, v in b.items()] for b in batches]
    rows = versions(load(spark, loaded))
    seen = {k for b in batches for k in b}
    assert {r[0] for r in rows} == seen
    for key, group in itertools.groupby(rows, key=lambda r: r[0]):
        group = list(group)
        assert [r[2] for r in group] == [False] * (len(group) - 1) + [True]
        assert all(a[4] == b[3] and a[1] != b[1] for a, b in zip(group, group[1:])) and group[-1][4] == OPEN
        states = [str(b[key]) for b in batches if key in b]
        assert [r[1] for r in group] == [s for s, _ in itertools.groupby(states)]


def test_as_of_is_half_open(spark):
    table = load(spark, [[A], [B]])
    assert [r.name for r in merge.as_of(table, T[1]).collect()] == ["B"]
    assert [r.name for r in merge.as_of(table, "2024-01-01 23:59:59").collect()] == ["A"]
    assert merge.as_of(table, "2023-12-31 00:00:00").count() == 0


def test_insert_set(spark):
    table = load(spark, [[A, ("m", "M", 1, 1.0, 0.0)]])
    stage, _ = silver.stage_businesses(businesses(spark, B, ("m", "M", 1, 1.0, 0.0), ("n", "N", 1, 1.0, 0.0)))
    assert sorted(r.business_id for r in merge.scd2_insert_set(table, stage, "business_id").collect()) == ["k", "n"]


def reviews(spark, *rows):
    ddl = "review_id string, user_id string, business_id string, stars double, useful bigint, funny bigint, cool bigint, text string, date string"
    return spark.createDataFrame([(k, "u", "b", stars, 1, 2, 3, text, date) for k, stars, text, date in rows], ddl)


def test_matched_review_keeps_its_first_date_and_measures(spark):
    first, _ = silver.stage_reviews(reviews(spark, ("r", 4.0, "old!", "2024-01-01T10:00:00"), ("s", 1.0, "x", "bad")))
    second, _ = silver.stage_reviews(reviews(spark, ("r", 4.7, "new text", "2024-02-02T10:00:00"), ("t", None, None, None)))
    table = merge.scd1_merge(empty_table(spark, "review"), first, ["review_id"], silver.REVIEW_UPDATES, T[0])
    table = merge.scd1_merge(table, second, ["review_id"], silver.REVIEW_UPDATES, T[1])
    rows = {r.review_id: r for r in table.collect()}
    r = rows["r"]
    assert (r.stars, r.text, r.word_count) == (5, "new text", 2)
    assert (r.char_length, r.exclamation_count, r.date, r._ingested_at, r._processed_at) == (4, 1, dt.date(2024, 1, 1), at(0), at(1))
    assert rows["s"].date is None and rows["s"]._processed_at == at(0)
    assert (rows["t"].stars, rows["t"].word_count, rows["t"]._ingested_at) == (None, None, at(1)) and len(rows) == 3


def test_latest_review_of_a_batch_wins_and_ties_repeat(spark):
    rows = [("r", 1.0, "a", "2024-01-01"), ("r", 2.0, "b", "2024-01-03"), ("r", 3.0, "c", "2024-01-03"), ("r", 4.0, "d", "2024-01-02")]
    picks = {silver.stage_reviews(reviews(spark, *p).repartition(3))[0].first().text for p in itertools.permutations(rows, 4)
             if p[0] in rows[:2]}
    assert len(picks) == 1 and picks <= {"b", "c"}


def test_tips_merge_by_day_and_quarantine_unreadable_days(spark):
    ddl = "user_id string, business_id string, text string, date string, compliment_count bigint"
    raw = spark.createDataFrame([("u", "b", "one", "2024-01-01 08:00:00", 1), ("u", "b", "two", "2024-01-01 09:00:00", 2),
                                 ("u", "b", "bad", "soon", 3), ("u", "b", "none", None, 4)], ddl)
    stage, bad = silver.stage_tips(raw)
    assert [(r.text, r.date) for r in stage.collect()] == [("two", dt.date(2024, 1, 1))]
    assert sorted(r.text for r in bad.collect()) == ["bad", "none"]
    table = empty_table(spark, "tip")
    for i in range(2):
        table = silver.merge_tips(table, raw, T[i])
    assert [(r.compliment_count, r._ingested_at, r._processed_at) for r in table.collect()] == [(2, at(0), at(1))]


def test_checkins_insert_once(spark):
    raw = spark.createDataFrame([("b", "2024-01-01 10:00:00, ,2024-01-02,,soon"), ("b", "2024-01-02 00:00:00")], "business_id string, date string")
    stage, bad = silver.stage_checkins(raw)
    assert stage.count() == 2 and bad.count() == 1
    table = silver.merge_checkins(silver.merge_checkins(empty_table(spark, "checkin"), raw, T[0]), raw, T[1])
    assert sorted(r.date for r in table.collect()) == [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 2)]
    assert {r._ingested_at for r in table.collect()} == {at(0)}


def test_users_mask_the_name_and_load_compliments(spark):
    schema = bronze_schema("user")
    values = {"user_id": "u", "name": "Ann", "review_count": 3, "yelping_since": "2020-02-03 10:00:00", "friends": "x, y", "compliment_hot": 4}
    raw = spark.createDataFrame([tuple(values.get(f.name) for f in schema.fields)], schema)
    row = silver.stage_users(raw)[0].first()
    assert (row.name, row.yelping_since, row.friends, row.compliment_hot) == ("A**", dt.date(2020, 2, 3), "x, y", 4)
    assert silver.stage_users(raw, mask_pii=True)[0].first().friends == "*, *"
    assert "compliment_hot" not in silver.stage_users(raw, load_compliments=False)[0].columns


def test_dedup_prefers_values_over_nulls(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", 5, 2), ("k", 3, 3)], "key string, n int, v int")
    assert dedup_latest(df, ["key"], ["n"]).first().v == 2


def test_explode_keeps_unreadable_items_as_null(spark):
    df = spark.createDataFrame([("a", "1| x |3||")], "k string, l string")
    assert [r.n for r in explode_list(df, "l", "n", sep="|", cast="int").collect()] == [1, None, 3]


def test_pair_rows_keeps_both_sides(spark):
    table = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "k int, v string")
    batch = spark.createDataFrame([(i, f"s{i}") for i in range(40, 90)], "k int, v string")
    pairs = merge.pair_rows(table, batch, ["k"])
    assert pairs.count() == 90 and pairs.where(F.col("_t").isNull()).count() == 40 and pairs.where(F.col("_s").isNull()).count() == 40


def test_latest_is_by_instant_not_by_text(spark):
    rows = [("a", 1.0, "morning", "2024-01-01T08:00:00"), ("a", 2.0, "evening", "2024-01-01 20:00:00"),
            ("b", 1.0, "next day in text", "2024-01-02T01:00:00Z"), ("b", 2.0, "later", "2024-01-01T23:00:00-08:00")]
    staged, _ = silver.stage_reviews(reviews(spark, *rows))
    assert {r.review_id: r.text for r in staged.collect()} == {"a": "evening", "b": "later"}
