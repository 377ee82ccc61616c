"""Health report over the layers: volume, version balance, latency, keys."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.functions.casts import hours_between, instant
from smelter.functions.labels import freshness_status
from smelter.operators.merge import current

Tables = dict[str, dict[str, DataFrame]]


def _created(df: DataFrame) -> list[Column]:
    """The time of the oldest file; null where the rows are not read from files."""
    try:
        df.select("_metadata.file_modification_time")
    except AnalysisException:
        return [F.lit(None).cast("timestamp").alias("created_at")]
    return [F.min("_metadata.file_modification_time").alias("created_at")]


def audit_volume(tables: Tables, with_created: bool = True) -> DataFrame:
    """Row count and creation time per layer and table. Names with ``$`` are internal and left out.

    The creation time is that of the oldest file. Without ``with_created`` counting needs no column, so parquet answers
    from its footers.
    """
    parts = []
    for layer, entities in tables.items():
        for name, df in entities.items():
            if "$" in name:
                continue
            created = _created(df) if with_created else []
            parts.append(df.agg(F.count(F.lit(1)).alias("row_count"), *created).select(
                F.lit("1. VOLUME").alias("category"), F.lit(layer).alias("layer"), F.lit(name).alias("entity"),
                "row_count", *(["created_at"] if with_created else [])))
    return reduce(DataFrame.unionByName, parts).orderBy("layer", F.desc("row_count"))


def audit_scd2(df: DataFrame, table: str) -> DataFrame:
    """Current and closed versions of a dimension, and the share of closed ones in percent."""
    closed = F.count_if(~F.col("is_current"))
    return df.agg(
        F.lit("2. SCD2 HEALTH").alias("category"), F.lit(table).alias("table"),
        F.count_if(F.col("is_current")).alias("active_records"), closed.alias("history_records"),
        F.round(F.try_divide(closed, F.count(F.lit(1))) * 100, 2).alias("overlap_pct"))


def audit_latency(df: DataFrame, as_of: datetime | str, metric: str = "Overall Pipeline") -> DataFrame:
    """Newest processing time, whole hours since then, and the status they mean."""
    newest = df.agg(F.max("_processed_at").alias("last_ingested_record"))
    hours = hours_between(instant(as_of), F.col("last_ingested_record"))
    return newest.select(
        F.lit("3. LATENCY").alias("category"), F.lit(metric).alias("metric"), "last_ingested_record",
        hours.alias("hours_since_sync"), freshness_status(hours).alias("status"))


def audit_keys(df: DataFrame, key: str = "business_id", name: str = "name", label: str = "Business Key Check") -> DataFrame:
    """Null keys and names among the current rows."""
    return current(df).agg(
        F.lit("4. DQ AUDIT").alias("category"), F.lit(label).alias("audit_type"),
        F.count_if(F.col(key).isNull()).alias("null_keys"), F.count_if(F.col(name).isNull()).alias("null_names"),
        F.count(F.lit(1)).alias("total_rows"))


def audit_report(tables: Tables, businesses: DataFrame, users: DataFrame, as_of: datetime | str) -> dict[str, DataFrame]:
    """The four sections of the report."""
    return {
        "volume": audit_volume(tables),
        "scd2_health": audit_scd2(businesses, "silver.businesses").unionByName(audit_scd2(users, "silver.users")),
        "latency": audit_latency(businesses, as_of),
        "keys": audit_keys(businesses),
    }
