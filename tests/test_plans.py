"""What the physical plans must and must not contain, and skew handling checked against plain joins."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from smelter.operators import joins
from smelter.operators.dedup import dedup_latest

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
NO_TRAINING = [n for n in entry.queries() if n in entry.oracle_sql()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark):
    """A third of the rows on one key, and keys the dimension lacks."""
    fact = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("k"))
    dim = spark.range(-1, 450).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    return fact, dim


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    fact, dim = skewed(spark)
    salted = joins.join_dimension(fact, dim, "k", spread_by="id", how=how, hot=[-1])
    plain = fact.join(dim, "k", how)
    assert sorted(map(tuple, salted.select("id", "k", "v").collect()), key=str) == sorted(map(tuple, plain.select("id", "k", "v").collect()), key=str)


def test_one_pass_finds_the_hot_values_of_every_key(spark):
    fact, _ = skewed(spark)
    fact = fact.withColumn("t", F.when(F.col("id") % 10 == 1, "ten").when(F.col("id") % 10 == 2, None).otherwise(F.col("id").cast("string")))
    assert joins.heavy_hitters(fact, ["k", "t"]) == {"k": [-1], "t": ["ten"]}
    assert joins.heavy_hitters(fact, ["k"], share=0.5) == {"k": []} == joins.heavy_hitters(fact.where("false"), ["k"])


def test_sketch_with_few_entries_misses_no_heavy_key(spark):
    fact = spark.range(200_000).select(F.when(F.col("id") % 50 == 0, F.col("id") % 150).otherwise(F.col("id") * 1000).alias("k")).repartition(7)
    assert {0, 50, 100} <= set(joins.heavy_hitters(fact, ["k"], entries=2048)["k"])


def test_only_hot_keys_are_salted(spark):
    fact, dim = skewed(spark)
    assert "_salt" not in plan(joins.join_dimension(fact, dim, "k", spread_by="id", hot=[]))
    assert "_salt" in plan(joins.join_dimension(fact, dim, "k", spread_by="id", hot=[-1]))


@needs_data
def test_a_business_with_a_third_of_the_reviews_is_salted(spark):
    assert re.search(r"_salt#\d+", plan(entry.queries()["star_features_hot"](spark, SF_DIR)))


def test_dedup_cuts_before_the_shuffle(spark):
    fact, _ = skewed(spark)
    text = plan(dedup_latest(fact, ["k"], ["id"]))
    exchange = text.index("Exchange hashpartitioning")
    assert "row_number(), 1, Partial" in text[exchange:] and "row_number(), 1, Final" in text[:exchange]


@needs_data
@pytest.mark.parametrize("name", NO_TRAINING)
def test_no_python_no_cross_join_no_single_partition_window(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"Window \[[^\]]*\][^\n]*\n[^\n]*Exchange SinglePartition", text)


@needs_data
def test_only_needed_columns_are_read(spark):
    text = plan(entry.queries()["business_performance"](spark, SF_DIR))
    assert not re.search(r"ReadSchema: struct<[^>]*(l_comment|l_extendedprice|o_totalprice|s_nationkey)", text)
    assert "l_returnflag" in text


@needs_data
def test_filters_reach_the_scan(spark):
    text = plan(entry.queries()["dq_fact_unique"](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate", text)
