"""Aggregate and feature tables built from the cleaned tables.

Each function is one declarative plan: facts are aggregated to one row per key before they meet a
dimension, so no join multiplies rows and a hot key is combined map-side.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.functions.casts import greatest_or_null, instant, local_today
from smelter.functions.labels import category_group, user_tier
from smelter.functions.text import char_length, list_size, non_empty_flag, word_count
from smelter.operators.joins import join_dimension
from smelter.operators.merge import current
from smelter.operators.topk import top_values
from smelter.schemas import COMPLIMENTS

Instant = datetime | str


def _add(*terms: Column) -> Column:
    """Sum of columns; null if any term is null."""
    return reduce(lambda a, b: a + b, terms)


def business_performance(businesses: DataFrame, reviews: DataFrame, tips: DataFrame, processing_time: Instant,
                         full: bool = False) -> DataFrame:
    """Per current business: reviews, their mean rating and the number of different tippers.

    A business without reviews (tips) has nulls there. ``full`` adds useful votes and positive reviews.
    """
    per_review = reviews.groupBy("business_id").agg(
        F.count("review_id").alias("total_reviews"),
        F.avg("stars").alias("avg_review_stars"),
        F.sum("useful").alias("total_useful_votes"),
        F.count_if(F.col("stars") >= 4).alias("positive_reviews"),
    )
    per_tip = tips.groupBy("business_id").agg(F.count_distinct("user_id").alias("unique_tippers"))
    extra = ["total_useful_votes", "positive_reviews"] if full else []
    return (
        current(businesses)
        .select("business_id", "name", F.col("stars").alias("snapshot_stars"))
        .join(per_review, "business_id", "left")
        .join(per_tip, "business_id", "left")
        .select("business_id", "name", "snapshot_stars", "total_reviews", "avg_review_stars", "unique_tippers", *extra,
                instant(processing_time).alias("_refreshed_at"))
    )


def city_analytics(businesses: DataFrame, reviews: DataFrame, processing_time: Instant, min_businesses: int = 5,
                   top_k: int = 5, exact: bool = True, ordered: bool = False) -> DataFrame:
    """Per (city, state) of current businesses: sizes, closures, ratings, centre, engagement, top categories.

    ``avg_review_quality`` is the plain mean of the businesses' own means. ``exact`` counts categories
    exactly instead of by sketch. ``ordered`` puts the largest places first, for reading; a stored table
    has no order.
    """
    place = ["city", "state"]
    kept = current(businesses).where(F.col("city").isNotNull())
    quality = reviews.groupBy("business_id").agg(
        F.avg("stars").alias("_mean_stars"),
        F.sum(_add(F.col("useful"), F.col("funny"), F.col("cool"))).alias("_engagement"),
    )
    closed = F.count_if(F.col("is_open") == 0)
    businesses_here = F.count_distinct("business_id")
    measures = [
        businesses_here.alias("total_businesses"),
        F.count_if(F.col("is_open") == 1).alias("open_businesses"),
        closed.alias("closed_businesses"),
        F.try_divide(closed, businesses_here).alias("closure_rate"),
        F.avg("stars").alias("avg_business_stars"),
        F.sum("review_count").alias("total_reviews"),
        F.avg("review_count").alias("avg_reviews_per_business"),
        F.avg("latitude").alias("center_latitude"),
        F.avg("longitude").alias("center_longitude"),
        F.avg("_mean_stars").alias("avg_review_quality"),
        F.sum("_engagement").alias("total_engagement"),
    ]
    per_place = (
        kept.select(*place, "business_id", "is_open", "stars", "review_count", "latitude", "longitude")
        .join(quality, "business_id", "left")
        .groupBy(*place).agg(*measures)
        .where(F.col("total_businesses") >= min_businesses)
    )
    # The categories have an aggregate of their own: beside a distinct count, Spark would keep one sketch
    # per business. The state may be null, so the two results meet on a null-safe comparison.
    best = top_values(kept, place, "categories", top_k, exact, out="top_category_combinations")
    best = best.withColumnsRenamed({"city": "_city", "state": "_state"})
    out = per_place.join(
        best, (F.col("city") == F.col("_city")) & F.col("state").eqNullSafe(F.col("_state")), "left").select(
        *place, "total_businesses", "open_businesses", "closed_businesses", "closure_rate", "avg_business_stars",
        "total_reviews", "avg_reviews_per_business", "top_category_combinations", "center_latitude",
        "center_longitude", "avg_review_quality", "total_engagement", instant(processing_time).alias("_refreshed_at"))
    return out.orderBy(F.desc("total_businesses"), *place) if ordered else out


def friend_count(friends: Column) -> Column:
    """Entries of the friends list; 0 for null and for the word ``None``."""
    return F.when(friends.isNotNull() & (friends != "None"), list_size(friends)).otherwise(0).cast("bigint")


def total_compliments(nulls_as_zero: bool = True) -> Column:
    """Sum of the compliment columns; without ``nulls_as_zero`` one null makes the sum null."""
    terms = [F.col(name) for name in COMPLIMENTS]
    return _add(*[F.coalesce(t, F.lit(0)) if nulls_as_zero else t for t in terms])


def user_engagement(users: DataFrame, as_of: Instant, processing_time: Instant | None = None) -> DataFrame:
    """Per current user: votes, compliments, friends, tenure, yearly rate and tier. No shuffle."""
    u = F.col
    votes = _add(u("useful"), u("funny"), u("cool"))
    days = F.datediff(local_today(as_of), u("yelping_since")).cast("bigint")
    return current(users).where(u("user_id").isNotNull()).select(
        "user_id", "name", "review_count", "yelping_since", "fans", "average_stars",
        (non_empty_flag(u("elite")) == 1).alias("is_elite"),
        list_size(u("elite")).alias("elite_years_count"),
        votes.alias("total_votes_received"),
        F.try_divide(votes, u("review_count")).alias("avg_votes_per_review"),
        total_compliments(nulls_as_zero=False).alias("total_compliments"),
        friend_count(u("friends")).alias("friend_count"),
        days.alias("days_on_platform"),
        (F.try_divide(u("review_count"), greatest_or_null(days, F.lit(1))) * 365).alias("reviews_per_year"),
        user_tier(u("review_count"), u("fans")).alias("user_tier"),
        instant(processing_time or as_of).alias("_refreshed_at"),
    )


def star_features(reviews: DataFrame, businesses: DataFrame, users: DataFrame, as_of: Instant,
                  processing_time: Instant | None = None, hot: dict[str, list] | None = None) -> DataFrame:
    """One training row per review that has a rating and text, with its current business and user.

    Only the columns used are carried through the joins; the text itself is reduced to its measures
    first. Each dimension has one row per key. ``hot`` names the businesses and users that hold a large share of the
    reviews, as :func:`smelter.operators.joins.heavy_hitters` finds them in one pass; their rows are salted.
    """
    c = F.col
    facts = reviews.where(c("stars").isNotNull() & (F.length("text") > 0)).select(
        "review_id", c("stars").alias("label"), "business_id", "user_id",
        char_length(c("text")).alias("review_text_length"),
        word_count(c("text")).alias("review_word_count"),
        c("useful").alias("review_useful_votes"),
        c("funny").alias("review_funny_votes"),
        c("cool").alias("review_cool_votes"),
        F.dayofweek("date").alias("review_day_of_week"),
        F.month("date").alias("review_month"),
        F.year("date").alias("review_year"),
    )
    business = current(businesses).select(
        "business_id",
        c("stars").alias("business_avg_stars"),
        c("review_count").alias("business_review_count"),
        c("is_open").alias("business_is_open"),
        category_group(c("categories")).alias("business_category_group"),
        c("city").alias("business_city"),
        c("state").alias("business_state"),
    )
    user = current(users).select(
        "user_id",
        c("review_count").alias("user_review_count"),
        c("average_stars").alias("user_avg_stars"),
        c("fans").alias("user_fans"),
        c("useful").alias("user_useful_votes"),
        non_empty_flag(c("elite")).alias("user_is_elite"),
        F.datediff(local_today(as_of), c("yelping_since")).cast("bigint").alias("user_tenure_days"),
    )
    hot = hot or {}
    joined = join_dimension(facts, business, "business_id", spread_by="review_id", hot=hot.get("business_id"))
    joined = join_dimension(joined, user, "user_id", spread_by="review_id", hot=hot.get("user_id"))
    return joined.select(
        "review_id", "label",
        "business_avg_stars", "business_review_count", "business_is_open", "business_category_group",
        "business_city", "business_state",
        "user_review_count", "user_avg_stars", "user_fans", "user_useful_votes", "user_is_elite", "user_tenure_days",
        "review_text_length", "review_word_count", "review_useful_votes", "review_funny_votes", "review_cool_votes",
        "review_day_of_week", "review_month", "review_year",
        instant(processing_time or as_of).alias("_feature_generated_at"),
    )
