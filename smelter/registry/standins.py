"""The driver's tables seen as the library's tables.

The driver has no review data, so each view maps whole driver tables, column by column, to a raw or
cleaned table. Batches are consecutive date ranges that together cover the table. Nothing is sampled.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.schemas import COMPLIMENTS
from smelter.session import ensure_checkpoint_dir, tune
from smelter.sources.tables import ensure_silver_tables

AS_OF = "2024-06-30 20:00:00"
LOADED = "2024-07-01 00:00:00"

# Part types stand for category lists; the text is what the category ladder looks for.
CATEGORY_OF_TYPE = {
    "ECONOMY": "Food, Restaurants", "LARGE": "Shopping, Home", "MEDIUM": "Food, Coffee",
    "PROMO": "Nightlife, Bars", "SMALL": "Beauty & Spas", "STANDARD": "Automotive",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def lake(spark: SparkSession, buckets: int = 8) -> str:
    """A new place with empty cleaned tables, in the folder that the cluster's machines share."""
    root = os.path.join(ensure_checkpoint_dir(spark), f"lake-{uuid.uuid4().hex}")
    ensure_silver_tables(spark, root, buckets=buckets)
    return root


def lookup(c: Column, values: dict[str, str], otherwise: str | None = None) -> Column:
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[c], F.lit(otherwise))


def text(c: str) -> Column:
    return F.col(c).cast("string")


def stars() -> Column:
    """Rating 1 to 5: the digit an order priority starts with."""
    return F.substring("o_orderpriority", 1, 1).cast("bigint")


def ntz(df: DataFrame) -> DataFrame:
    """Timestamps as plain UTC clock readings, the form both engines print alike."""
    return df.select(*[
        F.col(f"`{name}`").cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(f"`{name}`")
        for name, kind in df.dtypes
    ])


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Fractional results rounded, because the order of a floating-point sum is free."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def line_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of an order is a review: by the customer, of the supplier (or part)."""
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")
    order = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus", "o_orderpriority")
    return line.join(order, "l_orderkey")


def supplier_businesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        text("s_suppkey").alias("business_id"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("stars"), F.lit(True).alias("is_current"))


def customer_businesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as businesses: nation is the city, region the state, the segment the categories."""
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        text("c_custkey").alias("business_id"), F.col("n_name").alias("city"), F.col("r_name").alias("state"),
        (F.col("c_acctbal") / 2000).alias("stars"),
        F.floor("c_acctbal").alias("review_count"),
        F.when(F.col("c_acctbal") >= 0, 1).otherwise(0).cast("bigint").alias("is_open"),
        F.col("c_mktsegment").alias("categories"),
        (F.col("c_acctbal") / 100).alias("latitude"), (F.col("c_acctbal") / -50).alias("longitude"),
        F.lit(True).alias("is_current"))


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as reviews of the customer; the votes are null for status P, so sums must skip them."""
    votes = F.floor("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("review_id"), text("o_custkey").alias("business_id"), stars().alias("stars"),
        votes.alias("useful"), (votes % 7).alias("funny"),
        F.when(F.col("o_orderstatus") != "P", votes % 5).alias("cool"))


def order_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as users, with measures of all their orders."""
    year = F.year("o_orderdate").cast("string")
    per_customer = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.to_date(F.min("o_orderdate")).alias("_first"),
        F.count_if(F.col("o_orderstatus") == "F").alias("_f"),
        F.count_if(F.col("o_orderstatus") == "O").alias("_o"),
        F.count_if(F.col("o_orderstatus") == "P").alias("_p"),
        F.sum(stars()).alias("_stars"),
        # at most one entry per year, so the list has a fixed bound
        F.concat_ws(",", F.sort_array(F.collect_set(F.when(stars() == 1, year)))).alias("_elite"),
    )
    n = F.col("_n")
    compliments = [
        F.when(F.col("c_acctbal") >= 0, F.col("_f") * (i + 1) + F.col("_o")).alias(name)
        for i, name in enumerate(COMPLIMENTS)
    ]
    return table(spark, sf_dir, "customer").join(per_customer, "c_custkey", "left").select(
        text("c_custkey").alias("user_id"), F.col("c_name").alias("name"), (n * 12).alias("review_count"),
        F.col("_first").alias("yelping_since"), F.col("_f").alias("useful"), F.col("_o").alias("funny"),
        F.col("_p").alias("cool"), F.col("_elite").alias("elite"),
        F.when(F.col("c_acctbal") < 0, F.lit(None)).when(F.col("c_acctbal") < 1000, "None")
        .otherwise(F.concat_ws(", ", "c_name", "c_mktsegment", text("c_nationkey"))).alias("friends"),
        (F.col("_f") * 6).alias("fans"), F.try_divide(F.col("_stars"), n).alias("average_stars"),
        *compliments, F.lit(True).alias("is_current"))
