"""Type coercion, dates and null-aware arithmetic, as plain column expressions.

Every cast here yields null on bad input (never an error), also under ANSI mode.
"""

from __future__ import annotations

from datetime import date, datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.schemas import get_schema

LOCAL_ZONE = "Asia/Jakarta"  # fixed value: the zone run dates are cut in


def safe_int(c: Column) -> Column:
    """Whole number from text or an integer; ``'4.7'``, ``'x'`` and overflow give null."""
    return c.cast("string").try_cast("bigint")


def round_int(c: Column) -> Column:
    """Whole number from a fractional one, rounded half away from zero (4.7 gives 5)."""
    return F.round(c.try_cast("double"), 0).try_cast("bigint")


def trunc_int(c: Column) -> Column:
    """Whole number from a fractional one, fraction cut off (4.7 gives 4)."""
    return c.try_cast("double").try_cast("bigint")


def safe_double(c: Column) -> Column:
    return c.try_cast("double")


def safe_timestamp(c: Column) -> Column:
    return F.trim(c.cast("string")).try_cast("timestamp")


def safe_date(c: Column) -> Column:
    """Date part of text, a timestamp or a date. The text may carry a time of day, with blank or ``T``."""
    return F.to_date(safe_timestamp(c))


def plain_date(c: Column) -> Column:
    """Date from the text before the first blank, which must be exactly ``yyyy-MM-dd``."""
    return F.to_date(F.try_to_timestamp(F.substring_index(F.trim(c.cast("string")), " ", 1), F.lit("yyyy-MM-dd")))


def greatest_or_null(a: Column, b: Column) -> Column:
    """The larger value; null if either is null (``greatest`` alone skips nulls)."""
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def hours_between(later: Column, earlier: Column) -> Column:
    """Whole hours from ``earlier`` to ``later``, cut toward zero."""
    return F.timestamp_diff("HOUR", earlier, later)


def month_of(c: Column) -> Column:
    """First day of the month of a date, as a date: the partition value of monthly tables."""
    return F.to_date(F.trunc(c, "MM"))


def local_date(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """Calendar date, in ``zone``, of an instant."""
    return F.to_date(F.from_utc_timestamp(ts, zone))


def instant(value: datetime | str | Column) -> Column:
    """A timestamp literal. Naive datetimes and text without an offset are UTC (the session's zone)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        value = value.astimezone(timezone.utc).replace(tzinfo=None) if value.tzinfo else value
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp")


def local_today(as_of: datetime | str | Column, zone: str = LOCAL_ZONE) -> Column:
    """Today's date in ``zone`` at the instant ``as_of``."""
    return local_date(instant(as_of), zone)


def run_date(at: datetime | str, zone: str = LOCAL_ZONE) -> str:
    """Partition value (``yyyy-MM-dd``) of a run started at ``at``. There is no fallback to 'now'."""
    if isinstance(at, str):
        at = datetime.fromisoformat(at)
    elif isinstance(at, date) and not isinstance(at, datetime):
        raise TypeError("run_date needs an instant, not a calendar date")
    if at.tzinfo is None:
        at = at.replace(tzinfo=timezone.utc)
    return at.astimezone(ZoneInfo(zone)).date().isoformat()


def coerce(df, entity: str, processing_time: datetime | str, schema_version: int = 1):
    """Bring raw columns to the cleaned types, fill missing metadata, and turn nested fields to JSON text.

    Columns of ``df`` that the entity's cleaned schema does not know pass through unchanged.
    """
    from smelter.operators.flatten import json_text

    target = {f.name: f.dataType for f in get_schema(entity).fields}
    df = df.withColumnsRenamed({"attributes": "attributes_json", "hours": "hours_json"}) if entity == "business" else df
    out = []
    for name, have in ((f.name, f.dataType) for f in df.schema.fields):
        c, want = F.col(f"`{name}`"), target.get(name)
        if name in ("attributes_json", "hours_json"):
            c = json_text(c, have)
        elif want is None or have == want or entity == "checkin":
            pass  # a raw check-in's date is a list; it stays text until it is exploded
        elif isinstance(want, T.LongType):
            c = safe_int(c) if isinstance(have, (T.StringType, T.IntegralType)) else trunc_int(c)
        elif isinstance(want, T.DoubleType):
            c = safe_double(c)
        elif isinstance(want, T.DateType):
            c = plain_date(c)
        else:
            c = c.try_cast(want)
        out.append(c.alias(name))
    if "_ingested_at" not in df.columns:
        out.append(instant(processing_time).alias("_ingested_at"))
    if "_schema_version" not in df.columns:
        out.append(F.lit(schema_version).cast("bigint").alias("_schema_version"))
    return df.select(*out)
