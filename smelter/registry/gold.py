"""Queries: aggregate and feature tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.functions.labels import category_group, user_tier
from smelter.operators.joins import heavy_hitters
from smelter.operators.topk import merged_top, top_sketch, value_counts_ranked
from smelter.plans import gold
from smelter.registry.standins import (
    AS_OF, CATEGORY_OF_TYPE, LOADED, customer_businesses, line_reviews, lookup, ntz, order_reviews, order_users, rounded,
    stars, supplier_businesses, table, text,
)
from smelter.schemas import COMPLIMENTS
from smelter.session import ensure_checkpoint_dir
from smelter.sources.tables import read_gold, write_gold


def business_performance(spark: SparkSession, sf: str) -> DataFrame:
    lines = line_reviews(spark, sf)
    reviews = lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("review_id"), text("l_suppkey").alias("business_id"),
        stars().alias("stars"), F.col("l_quantity").cast("bigint").alias("useful"))
    tips = lines.where("l_returnflag = 'R'").select(
        text("l_suppkey").alias("business_id"), text("o_custkey").alias("user_id"))
    out = gold.business_performance(supplier_businesses(spark, sf), reviews, tips, LOADED, full=True)
    return ntz(rounded(out, "avg_review_stars"))


def gold_replaced(spark: SparkSession, sf: str) -> DataFrame:
    """The stored table of customers' measures after it was replaced by a newer one as a whole."""
    root = os.path.join(ensure_checkpoint_dir(spark), f"lake-{uuid.uuid4().hex}")
    for at in (AS_OF, LOADED):
        write_gold(user_engagement(spark, sf).withColumn("_refreshed_at", F.lit(at).cast("timestamp_ntz")), root, "user_engagement")
    return read_gold(spark, root, "user_engagement")


def city_analytics(spark: SparkSession, sf: str) -> DataFrame:
    out = gold.city_analytics(customer_businesses(spark, sf), order_reviews(spark, sf), LOADED,
                              min_businesses=60, top_k=3, exact=True, ordered=True)
    best = F.array_join(F.transform("top_category_combinations",
                                    lambda e: F.concat(e["value"], F.lit("="), e["count"].cast("string"))), "; ")
    out = rounded(out, "closure_rate", "avg_business_stars", "avg_reviews_per_business", "center_latitude",
                  "center_longitude", "avg_review_quality")
    return ntz(out.withColumn("top_category_combinations", best))


def top_categories(spark: SparkSession, sf: str) -> DataFrame:
    return value_counts_ranked(table(spark, sf, "part"), ["p_brand"], "p_type", 3)


def top_categories_approx(spark: SparkSession, sf: str) -> DataFrame:
    """Sketches per brand and size, as daily ones would be stored, merged to one per brand. They keep every type of a
    brand (six at most), so the counts are exact here."""
    parts = table(spark, sf, "part").groupBy("p_brand", "p_size").agg(top_sketch("p_type").alias("sketch"))
    top = merged_top(parts, ["p_brand"], "sketch", k=10)
    return top.select("p_brand", F.explode("top_values").alias("e")).select("p_brand", "e.value", "e.count")


def user_engagement(spark: SparkSession, sf: str) -> DataFrame:
    out = gold.user_engagement(order_users(spark, sf), AS_OF, LOADED)
    return ntz(rounded(out, "average_stars", "avg_votes_per_review", "reviews_per_year"))


def user_tiers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey", user_tier(F.floor(F.col("c_acctbal") / 10), F.col("c_nationkey") * 4).alias("user_tier"))


def category_groups(spark: SparkSession, sf: str) -> DataFrame:
    categories = lookup(F.col("p_type"), CATEGORY_OF_TYPE)
    return table(spark, sf, "part").groupBy("p_type", category_group(categories).alias("category_group")).agg(
        F.count(F.lit(1)).alias("parts"))


def feature_table(spark: SparkSession, sf: str, measured: bool = False, crowd: bool = False) -> DataFrame:
    """Line reviews x part (business) x customer (user). ``measured`` looks up hot keys and salts them; with ``crowd``
    the third and sixth line of each order (about a third of the rows) are reviews of part 1."""
    reviews = line_reviews(spark, sf).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("review_id"),
        (F.when(F.col("l_linenumber") % 3 == 0, "1").otherwise(text("l_partkey")) if crowd else text("l_partkey")).alias("business_id"),
        text("o_custkey").alias("user_id"),
        F.when(F.col("o_orderstatus") != "P", stars()).alias("stars"),
        F.col("l_quantity").cast("bigint").alias("useful"), F.col("l_linenumber").cast("bigint").alias("funny"),
        F.round(F.col("l_tax") * 100, 0).cast("bigint").alias("cool"),
        F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(
            F.concat_ws(" ", "o_orderpriority", "l_returnflag", "l_linestatus")).alias("text"),
        F.to_date("l_shipdate").alias("date"))
    businesses = table(spark, sf, "part").select(
        text("p_partkey").alias("business_id"), (F.col("p_retailprice") / 500).alias("stars"),
        F.col("p_size").cast("bigint").alias("review_count"),
        F.when(F.col("p_size") > 25, 1).otherwise(0).cast("bigint").alias("is_open"),
        lookup(F.col("p_type"), CATEGORY_OF_TYPE).alias("categories"), F.col("p_brand").alias("city"),
        F.col("p_type").alias("state"), F.lit(True).alias("is_current"))
    users = table(spark, sf, "customer").select(
        text("c_custkey").alias("user_id"), F.floor("c_acctbal").alias("review_count"),
        (F.col("c_acctbal") / 2000).alias("average_stars"), (F.col("c_nationkey") * 2).cast("bigint").alias("fans"),
        F.col("c_nationkey").cast("bigint").alias("useful"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None)).when(F.col("c_mktsegment") == "MACHINERY", F.lit(""))
        .otherwise(F.lit("2019,2020")).alias("elite"),
        F.date_add(F.lit("2010-01-01").cast("date"), F.col("c_nationkey") * 100).alias("yelping_since"),
        F.lit(True).alias("is_current"))
    hot = heavy_hitters(reviews, ["business_id", "user_id"]) if measured else None
    return gold.star_features(reviews, businesses, users, AS_OF, LOADED, hot=hot)


def star_features(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(rounded(feature_table(spark, sf), "business_avg_stars", "user_avg_stars"))


def star_features_salted(spark: SparkSession, sf: str) -> DataFrame:
    """The same table with hot keys looked up first, in one pass over both keys; the given data have none."""
    return ntz(rounded(feature_table(spark, sf, measured=True), "business_avg_stars", "user_avg_stars"))


def star_features_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Features where one business holds about a third of the reviews: its rows are dealt over the salts."""
    return ntz(rounded(feature_table(spark, sf, measured=True, crowd=True), "business_avg_stars", "user_avg_stars"))


QUERIES = {
    "business_performance": business_performance,
    "city_analytics": city_analytics,
    "top_categories": top_categories,
    "top_categories_approx": top_categories_approx,
    "user_engagement": user_engagement, "gold_replaced": gold_replaced,
    "user_tier": user_tiers,
    "category_group": category_groups,
    "star_features": star_features,
    "star_features_salted": star_features_salted, "star_features_hot": star_features_hot,
}

_LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"
_STARS = "CAST(left(o_orderpriority, 1) AS BIGINT)"
_CATEGORIES = "CASE p_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CATEGORY_OF_TYPE.items()) + " END"
_GROUP_OF_TYPE = """CASE p_type WHEN 'ECONOMY' THEN 'Restaurant' WHEN 'LARGE' THEN 'Shopping' WHEN 'MEDIUM' THEN 'Food'
    WHEN 'PROMO' THEN 'Nightlife' WHEN 'SMALL' THEN 'Beauty' ELSE 'Other' END"""
_TODAY = "DATE '2024-07-01'"  # 20:00 UTC is already the next day in Jakarta
_N_COMPLIMENTS = len(COMPLIMENTS)

_STAR_FEATURES = f"""
    SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS review_id, {_STARS} AS label,
        round(p_retailprice / 500, 6) AS business_avg_stars, CAST(p_size AS BIGINT) AS business_review_count,
        CAST(p_size > 25 AS BIGINT) AS business_is_open, {_GROUP_OF_TYPE} AS business_category_group,
        p_brand AS business_city, p_type AS business_state,
        CAST(floor(c_acctbal) AS BIGINT) AS user_review_count, round(c_acctbal / 2000, 6) AS user_avg_stars,
        CAST(c_nationkey * 2 AS BIGINT) AS user_fans, CAST(c_nationkey AS BIGINT) AS user_useful_votes,
        CAST(c_mktsegment NOT IN ('BUILDING', 'MACHINERY') AS BIGINT) AS user_is_elite,
        CAST({_TODAY} - (DATE '2010-01-01' + c_nationkey * 100) AS BIGINT) AS user_tenure_days,
        CAST(length(o_orderpriority) + 4 AS BIGINT) AS review_text_length,
        CAST(CASE WHEN o_orderpriority LIKE '% %' THEN 4 ELSE 3 END AS BIGINT) AS review_word_count,
        CAST(l_quantity AS BIGINT) AS review_useful_votes, CAST(l_linenumber AS BIGINT) AS review_funny_votes,
        CAST(round(l_tax * 100) AS BIGINT) AS review_cool_votes,
        CAST(dayofweek(l_shipdate) + 1 AS INTEGER) AS review_day_of_week,
        CAST(month(l_shipdate) AS INTEGER) AS review_month, CAST(year(l_shipdate) AS INTEGER) AS review_year,
        TIMESTAMP '{LOADED}' AS _feature_generated_at
    FROM {_LINES} JOIN part ON p_partkey = l_partkey JOIN customer ON c_custkey = o_custkey
    WHERE o_orderstatus <> 'P' AND l_returnflag <> 'N'"""

ORACLE = {
    "business_performance": f"""
        WITH lines AS (SELECT *, {_STARS} AS stars FROM {_LINES})
        SELECT CAST(s_suppkey AS VARCHAR) AS business_id, s_name AS name, s_acctbal AS snapshot_stars,
            r.n AS total_reviews, round(r.mean, 6) AS avg_review_stars, t.n AS unique_tippers,
            r.votes AS total_useful_votes, r.good AS positive_reviews, TIMESTAMP '{LOADED}' AS _refreshed_at
        FROM supplier
        LEFT JOIN (SELECT l_suppkey, count(*) AS n, avg(stars) AS mean,
                       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS votes,
                       count(*) FILTER (stars >= 4) AS good FROM lines GROUP BY 1) r ON r.l_suppkey = s_suppkey
        LEFT JOIN (SELECT l_suppkey, count(DISTINCT o_custkey) AS n FROM lines WHERE l_returnflag = 'R' GROUP BY 1) t
            ON t.l_suppkey = s_suppkey""",
    "city_analytics": f"""
        WITH biz AS (
            SELECT c_custkey, n_name AS city, r_name AS state, c_acctbal, c_mktsegment,
                CAST(floor(c_acctbal) AS BIGINT) AS rc
            FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
        q AS (SELECT o_custkey, avg({_STARS}) AS mean,
                  sum(CASE WHEN o_orderstatus <> 'P' THEN v + v % 7 + v % 5 END) AS votes
              FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS v FROM orders) GROUP BY 1),
        cats AS (SELECT city, state, string_agg(c_mktsegment || '=' || n, '; ' ORDER BY n DESC, c_mktsegment) AS best
                 FROM (SELECT *, row_number() OVER (PARTITION BY city, state ORDER BY n DESC, c_mktsegment) AS rk
                       FROM (SELECT city, state, c_mktsegment, count(*) AS n FROM biz GROUP BY 1, 2, 3))
                 WHERE rk <= 3 GROUP BY 1, 2)
        SELECT city, state, count(*) AS total_businesses, count(*) FILTER (c_acctbal >= 0) AS open_businesses,
            count(*) FILTER (c_acctbal < 0) AS closed_businesses,
            round(count(*) FILTER (c_acctbal < 0) / count(*), 6) AS closure_rate,
            round(avg(c_acctbal / 2000), 6) AS avg_business_stars, CAST(sum(rc) AS BIGINT) AS total_reviews,
            round(avg(rc), 6) AS avg_reviews_per_business, any_value(best) AS top_category_combinations,
            round(avg(c_acctbal / 100), 6) AS center_latitude, round(avg(c_acctbal / -50), 6) AS center_longitude,
            round(avg(mean), 6) AS avg_review_quality, CAST(sum(votes) AS BIGINT) AS total_engagement,
            TIMESTAMP '{LOADED}' AS _refreshed_at
        FROM biz LEFT JOIN q ON o_custkey = c_custkey JOIN cats USING (city, state)
        GROUP BY city, state HAVING count(*) >= 60""",
    "top_categories": """
        SELECT p_brand, p_type AS value, n AS count, CAST(rk AS INTEGER) AS rank FROM (
            SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS rk
            FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2)) WHERE rk <= 3""",
    "top_categories_approx": "SELECT p_brand, p_type AS value, count(*) AS count FROM part GROUP BY ALL",
    "user_engagement": f"""
        WITH o AS (
            SELECT o_custkey, count(*) AS n, CAST(min(o_orderdate) AS DATE) AS first,
                count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o,
                count(DISTINCT year(o_orderdate)) FILTER (o_orderpriority LIKE '1%') AS elite,
                sum({_STARS}) AS stars
            FROM orders GROUP BY 1)
        SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS name, n * 12 AS review_count, first AS yelping_since,
            f * 6 AS fans, round(stars / n, 6) AS average_stars, coalesce(elite, 0) > 0 AS is_elite,
            CASE WHEN elite > 0 THEN elite WHEN n > 0 THEN 1 END AS elite_years_count,
            n AS total_votes_received, round(1 / 12, 6) * sign(n) AS avg_votes_per_review,
            CASE WHEN c_acctbal >= 0
                THEN CAST(f * {sum(range(1, _N_COMPLIMENTS + 1))} + o * {_N_COMPLIMENTS} AS BIGINT) END
                AS total_compliments,
            CAST(CASE WHEN c_acctbal >= 1000 THEN 3 ELSE 0 END AS BIGINT) AS friend_count,
            CAST({_TODAY} - first AS BIGINT) AS days_on_platform,
            round(n * 12 / ({_TODAY} - first) * 365, 6) AS reviews_per_year,
            CASE WHEN n * 12 >= 500 AND f * 6 >= 50 THEN 'Power User' WHEN n * 12 >= 100 AND f * 6 >= 10
                THEN 'Active User' WHEN n * 12 >= 10 THEN 'Regular User' ELSE 'Casual User' END AS user_tier,
            TIMESTAMP '{LOADED}' AS _refreshed_at
        FROM customer LEFT JOIN o ON o_custkey = c_custkey""",
    "user_tier": """
        SELECT c_custkey, CASE WHEN floor(c_acctbal / 10) >= 500 AND c_nationkey * 4 >= 50 THEN 'Power User'
            WHEN floor(c_acctbal / 10) >= 100 AND c_nationkey * 4 >= 10 THEN 'Active User'
            WHEN floor(c_acctbal / 10) >= 10 THEN 'Regular User' ELSE 'Casual User' END AS user_tier
        FROM customer""",
    "category_group": f"SELECT p_type, {_GROUP_OF_TYPE} AS category_group, count(*) AS parts FROM part GROUP BY ALL",
    "star_features": _STAR_FEATURES,
    "star_features_salted": _STAR_FEATURES,
    "star_features_hot": _STAR_FEATURES.replace("p_partkey = l_partkey", "p_partkey = CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE l_partkey END"),
}
ORACLE["gold_replaced"] = ORACLE["user_engagement"]
