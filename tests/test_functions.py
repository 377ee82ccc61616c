import datetime as dt

import pytest
from pyspark.sql import functions as F

from smelter.functions import casts, labels, text
from smelter.functions.hashing import fingerprint

c = F.col


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_whole_numbers(spark):
    df = spark.createDataFrame([("4", 4.7), ("4.7", -2.5), ("x", None), (" 5 ", 1e30), (None, 0.5)], "s string, d double")
    assert values(df, casts.safe_int(c("s")), casts.round_int(c("d")), casts.trunc_int(c("d")), casts.round_int(c("s"))) == [
        (4, 5, 4, 4), (None, -3, -2, 5), (None, None, None, None), (5, None, None, 5), (None, 1, 0, None)]


def test_dates(spark):
    rows = ["2024-01-05T10:00:00", "2024-01-05 10:00:00", " 2024-01-05", "05/01/2024", "", None]
    df = spark.createDataFrame([(r,) for r in rows], "s string")
    day = dt.date(2024, 1, 5)
    assert values(df, casts.safe_date(c("s")), casts.plain_date(c("s"))) == [
        (day, None), (day, day), (day, day), (None, None), (None, None), (None, None)]


def test_local_day_turns_over_before_utc(spark):
    assert casts.run_date("2024-06-30T16:59:59") == "2024-06-30"
    assert casts.run_date("2024-06-30T17:00:00") == "2024-07-01"
    got = spark.range(1).select(casts.local_today("2024-06-30 17:00:00"), casts.local_today("2024-06-30 16:59:59")).first()
    assert tuple(got) == (dt.date(2024, 7, 1), dt.date(2024, 6, 30))
    with pytest.raises(TypeError):
        casts.run_date(dt.date(2024, 1, 1))


def test_greatest_keeps_null(spark):
    df = spark.createDataFrame([(None,), (0,), (5,)], "a int")
    assert values(df, casts.greatest_or_null(c("a"), F.lit(1))) == [(None,), (1,), (5,)]


def test_hours_between_cuts(spark):
    hours = casts.hours_between(casts.instant("2024-01-02 01:59:00"), casts.instant("2024-01-01 00:00:00"))
    assert values(spark.range(1), hours) == [(25,)]


def test_masks(spark):
    df = spark.createDataFrame([("Zoë",), ("A",), ("",), (None,)], "n string")
    assert values(df, text.mask_name(c("n"))) == [("Z**",), ("A",), ("Anonymous",), ("Anonymous",)]
    df = spark.createDataFrame([("a.b+c@x-y.org and (415) 555-1234, 415.555.1234 5551234567!",)], "t string")
    assert values(df, text.mask_text(c("t"))) == [("[EMAIL] and [PHONE], [PHONE] [PHONE]!",)]


def test_text_measures(spark):
    df = spark.createDataFrame([("a b  c!?!",), ("",), (None,)], "t string")
    assert values(df, text.word_count(c("t")), text.char_length(c("t")), text.count_char(c("t"), "!"), text.non_empty_flag(c("t"))) == [
        (4, 9, 2, 1), (1, 0, 0, 0), (None, None, None, 0)]
    lists = spark.createDataFrame([("2019,2020",), ("",)], "t string")
    assert values(lists, text.list_size(c("t"))) == [(2,), (1,)]


def test_labels(spark):
    df = spark.createDataFrame([(500, 50), (500, 10), (500, 9), (100, None), (9, 99), (None, 1)], "r int, f int")
    assert [r[0] for r in values(df, labels.user_tier(c("r"), c("f")))] == [
        "Power User", "Active User", "Regular User", "Regular User", "Casual User", "Casual User"]
    df = spark.createDataFrame([("Food, Restaurants",), ("Home, Shopping",), ("Homes",), ("restaurants",), (None,)], "c string")
    assert [r[0] for r in values(df, labels.category_group(c("c")))] == ["Restaurant", "Shopping", "Home Services", "Other", "Other"]
    df = spark.createDataFrame([(25,), (24,), (7,), (6,)], "h int")
    assert [r[0][2:] for r in values(df, labels.freshness_status(c("h")))] == ["LAGGING", "DELAYED", "DELAYED", "HEALTHY"]


def test_fingerprint_tells_null_positions_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", "a"), (None, None)], "x string, y string")
    assert len({r[0] for r in values(df, fingerprint(["x", "y"]))}) == 4


def test_coerce(spark):
    raw = spark.createDataFrame(
        [("b1", "4.5", "7", ("x",), None)], "business_id string, stars string, review_count string, attributes struct<k:string>, hours string")
    row = casts.coerce(raw, "business", "2024-01-01 00:00:00").first()
    assert (row.stars, row.review_count, row.attributes_json, row.hours_json, row._schema_version) == (4.5, 7, '{"k":"x"}', None, 1)
    review = spark.createDataFrame([(4.7, "2024-01-01 10:00:00", "n/a")], "stars double, date string, useful string")
    row = casts.coerce(review, "review", "2024-01-01 00:00:00").first()
    assert (row.stars, row.date, row.useful) == (4, dt.date(2024, 1, 1), None)
