"""Ordered labels: user tiers, category groups, freshness status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (least reviews, least fans or None, label), best first.
USER_TIERS = ((500, 50, "Power User"), (100, 10, "Active User"), (10, None, "Regular User"))
USER_TIER_ELSE = "Casual User"

# Text to look for, label; the first hit wins.
CATEGORY_GROUPS = (
    ("Restaurants", "Restaurant"), ("Shopping", "Shopping"), ("Food", "Food"), ("Health", "Health"),
    ("Beauty", "Beauty"), ("Home", "Home Services"), ("Nightlife", "Nightlife"),
)
CATEGORY_ELSE = "Other"

# More hours than this, label; oldest first.
FRESHNESS = ((24, "🔴 LAGGING"), (6, "🟡 DELAYED"))
FRESHNESS_ELSE = "🟢 HEALTHY"


def first_match(rules: list[tuple[Column, str]], otherwise: str) -> Column:
    """Label of the first rule that holds. A rule that is null does not hold."""
    label = F
    for condition, name in rules:
        label = label.when(condition, F.lit(name))
    return label.otherwise(F.lit(otherwise))


def user_tier(review_count: Column, fans: Column) -> Column:
    rules = []
    for reviews, least_fans, name in USER_TIERS:
        rule = review_count >= reviews
        rules.append((rule if least_fans is None else rule & (fans >= least_fans), name))
    return first_match(rules, USER_TIER_ELSE)


def category_group(categories: Column) -> Column:
    return first_match([(categories.contains(text), name) for text, name in CATEGORY_GROUPS], CATEGORY_ELSE)


def freshness_status(hours: Column) -> Column:
    return first_match([(hours > limit, name) for limit, name in FRESHNESS], FRESHNESS_ELSE)
