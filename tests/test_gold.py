"""Edge rows of the aggregate tables, by hand."""

import datetime as dt

from pyspark.sql import functions as F

from smelter.operators.topk import merged_top, top_sketch, top_values
from smelter.plans import gold
from smelter.schemas import COMPLIMENTS
from smelter.sources.tables import empty_table

AT = "2024-06-30 20:00:00"


def rows(spark, entity, *dicts):
    """Rows of a cleaned table; columns not given are null."""
    schema = empty_table(spark, entity).schema
    return spark.createDataFrame([tuple(d.get(f.name) for f in schema.fields) for d in dicts], schema)


def business(key, current=True, **more):
    return {"business_id": key, "is_current": current, "city": "X", "state": None, "stars": 3.0, "review_count": 10, "is_open": 1,
            "categories": "Food", "latitude": 1.0, "longitude": 2.0, **more}


def review(key, biz, stars, **more):
    return {"review_id": key, "business_id": biz, "user_id": "u", "stars": stars, "useful": 1, "funny": 1, "cool": 1, "text": "ok then",
            "date": dt.date(2024, 1, 7), **more}


def test_business_without_reviews_has_nulls_and_history_is_left_out(spark):
    out = gold.business_performance(
        rows(spark, "business", business("a"), business("a", False), business("b")),
        rows(spark, "review", review("1", "a", 4), review("2", "a", None), review("3", "zzz", 5)),
        rows(spark, "tip", {"user_id": "u", "business_id": "a"}, {"user_id": "u", "business_id": "a"}), AT, full=True)
    got = {r.business_id: r for r in out.collect()}
    assert set(got) == {"a", "b"}
    a, b = got["a"], got["b"]
    assert (a.total_reviews, a.avg_review_stars, a.unique_tippers, a.total_useful_votes, a.positive_reviews) == (2, 4.0, 1, 2, 1)
    assert (b.total_reviews, b.avg_review_stars, b.unique_tippers) == (None, None, None)


def test_city_with_null_state_threshold_and_unweighted_quality(spark):
    many = [business(str(i), is_open=i % 2, categories=["Food", "Bars", None][i % 3]) for i in range(6)]
    extra = [business("lone", city="Y"), business("nowhere", city=None), business("old", False)]
    facts = rows(spark, "review", review("1", "0", 1), review("2", "0", 1), review("3", "1", 5, cool=None))
    for exact in (True, False):
        out = gold.city_analytics(rows(spark, "business", *many, *extra), facts, AT, exact=exact, ordered=True).collect()
        assert len(out) == 1
        r = out[0]
        assert (r.city, r.state, r.total_businesses, r.open_businesses, r.closed_businesses, r.closure_rate) == ("X", None, 6, 3, 3, 0.5)
        assert r.avg_review_quality == 3.0  # mean of 1 and 5, not of 1, 1, 5
        assert r.total_engagement == 6  # the null vote makes its row's sum null
        assert sorted(((e.value or ""), e["count"]) for e in r.top_category_combinations) == [("", 2), ("Bars", 2), ("Food", 2)]


def user(key, **more):
    return {"user_id": key, "is_current": True, "review_count": 10, "useful": 1, "funny": 2, "cool": 3, "elite": "", "friends": "None", "fans": 0,
            "yelping_since": dt.date(2024, 6, 30), **{c: 1 for c in COMPLIMENTS}, **more}


def test_user_engagement_edges(spark):
    out = gold.user_engagement(rows(
        spark, "user", user("a"), user("b", elite=None, friends=None, review_count=0, cool=None, compliment_hot=None, yelping_since=None),
        user("c", elite="2019,2020", friends="x, y, z", yelping_since=dt.date(2024, 7, 1)), user("d", is_current=False)), AT)
    a, b, c = sorted(out.collect(), key=lambda r: r.user_id)
    assert (a.is_elite, a.elite_years_count, a.total_votes_received, a.avg_votes_per_review, a.total_compliments, a.friend_count) == (False, 1, 6, 0.6, 11, 0)
    assert (a.days_on_platform, a.reviews_per_year, a.user_tier) == (1, 3650.0, "Regular User")  # already July 1st in Jakarta
    assert (b.elite_years_count, b.total_votes_received, b.avg_votes_per_review, b.total_compliments, b.friend_count) == (None, None, None, None, 0)
    assert (b.days_on_platform, b.reviews_per_year, b.user_tier) == (None, None, "Casual User")
    assert (c.is_elite, c.elite_years_count, c.friend_count, c.days_on_platform, c.reviews_per_year) == (True, 2, 3, 0, 3650.0)


def test_features_need_rating_text_and_both_current_dimensions(spark):
    facts = rows(spark, "review", review("1", "a", 4), review("2", "a", None), review("3", "a", 4, text=""), review("4", "a", 4, text=None),
                 review("5", "b", 4), review("6", "a", 4, user_id="gone"))
    for hot in (None, {"business_id": ["a"], "user_id": ["u", "gone"]}):
        out = gold.star_features(facts, rows(spark, "business", business("a", categories="Food, Restaurants"), business("a", False)),
                                 rows(spark, "user", user("u", elite="2019")), AT, hot=hot).collect()
        assert [r.review_id for r in out] == ["1"]
        r = out[0]
        assert (r.label, r.business_category_group, r.user_is_elite, r.review_text_length, r.review_word_count, r.user_tenure_days) == (4, "Restaurant", 1, 7, 2, 1)
        assert (r.review_day_of_week, r.review_month, r.review_year) == (1, 1, 2024)  # Sunday is 1
        assert len(r) == 23


def test_merged_sketches_equal_one_pass(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), (F.col("id") % 4).alias("day"), F.pmod(F.xxhash64("id"), F.lit(11)).cast("string").alias("v"))
    merged = merged_top(df.groupBy("g", "day").agg(top_sketch("v").alias("s")), ["g"], "s", k=20)
    once = top_values(df, ["g"], "v", k=20, exact=False)
    as_dict = lambda rows: {r.g: {(e["value"], e["count"]) for e in r.top_values} for r in rows.collect()}
    assert as_dict(merged) == as_dict(once) == as_dict(top_values(df, ["g"], "v", k=20))
