"""Merging a batch into a table: update-in-place, insert-only, and versioned (SCD-2).

All functions return the whole new table as one plan; ``smelter.sources.tables`` writes only the parts
that changed. The batch must hold one row per key, with no null key (``dedup_latest`` and
``split_null_keys`` see to that); the table's current rows have one row per key by construction.
So neither side of a merge join can be skewed by a hot key.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.functions.casts import instant
from smelter.functions.hashing import fingerprint
from smelter.schemas import DEFAULT_SOURCE, OPEN_END

Instant = datetime | str


def with_hash_diff(df: DataFrame, columns: list[str | Column], out: str = "hash_diff") -> DataFrame:
    """Add the change fingerprint of the tracked columns."""
    return df.withColumn(out, fingerprint(columns))


# ---- reading versions --------------------------------------------------------------------------

def current(df: DataFrame) -> DataFrame:
    """Newest version of every key."""
    return df.where(F.col("is_current"))


def as_of(df: DataFrame, at: Instant) -> DataFrame:
    """The versions that held at an instant: ``valid_from <= at < valid_to``."""
    t = instant(at)
    return df.where((F.col("valid_from") <= t) & (F.col("valid_to") > t))


# ---- pairing a table with a batch --------------------------------------------------------------

def pair_rows(table: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer match of table and batch as two struct columns ``_t`` and ``_s`` (null where absent).

    One plan whatever the sizes: each side is read and shuffled once. The table is only what the batch can touch
    (buckets or months, see :mod:`smelter.sources.tables`), so a small batch does not move a large table.
    """
    t = table.select(F.struct(*table.columns).alias("_t"), *keys)
    s = batch.select(F.struct(*batch.columns).alias("_s"), *keys)
    return t.join(s, keys, "full_outer").select("_t", "_s")


def _typed(sql: str, have, want) -> str:
    return sql if have == want else f"CAST({sql} AS {want.simpleString()})"


def _metadata_sql(has_source: bool, schema_version: int = 1) -> dict[str, str]:
    """Metadata of a freshly inserted row, over the columns ``_s`` (batch row) and ``_at`` (batch time)."""
    return {
        "_ingested_at": "_at",
        "_source_file": "_s._source_file" if has_source else f"'{DEFAULT_SOURCE}'",
        "_schema_version": f"CAST({int(schema_version)} AS BIGINT)",
        "_processed_at": "_at",
    }


def _inserted(table: DataFrame, batch: DataFrame, **extra: str) -> dict[str, str]:
    """SQL of every table column for a row that comes from the batch; what the batch lacks is null."""
    have = {f.name: f.dataType for f in batch.schema.fields}
    meta = {**_metadata_sql("_source_file" in have), **extra}
    out = {}
    for f in table.schema.fields:
        if f.name in meta:
            out[f.name] = meta[f.name]
        elif f.name in have:
            out[f.name] = _typed(f"_s.`{f.name}`", have[f.name], f.dataType)
        else:
            out[f.name] = f"CAST(NULL AS {f.dataType.simpleString()})"
    return out


# ---- SCD-2 -------------------------------------------------------------------------------------

def scd2_apply_to_current(now: DataFrame, stage: DataFrame, key: str, processing_time: Instant) -> DataFrame:
    """New versions and expired versions that follow from a batch, plus the untouched current rows.

    ``now`` holds only current rows. One match classifies every key:

    * only in the table, or equal fingerprint: keep the row as it is;
    * fingerprint differs: close the old version at ``processing_time`` and open a new one;
    * only in the batch: open a first version.
    """
    actions = F.expr("""CASE WHEN _t IS NULL THEN array('open')
                             WHEN _s IS NULL OR _t.hash_diff = _s.hash_diff THEN array('keep')
                             ELSE array('close', 'open') END""")
    pairs = pair_rows(now, stage, [key]).select(
        "_t", "_s", instant(processing_time).alias("_at"), F.explode(actions).alias("_do"))
    opened = _inserted(now, stage, is_current="true", valid_from="_at", valid_to=f"TIMESTAMP '{OPEN_END}'")
    closed = {"is_current": "_do = 'keep'", "valid_to": "IF(_do = 'close', _at, _t.valid_to)",
              "_processed_at": "IF(_do = 'close', _at, _t._processed_at)"}
    return pairs.selectExpr(*[
        f"IF(_do = 'open', {opened[c]}, {closed.get(c, f'_t.`{c}`')}) AS `{c}`" for c in now.columns])


def scd2_first_versions(table: DataFrame, stage: DataFrame, processing_time: Instant) -> DataFrame:
    """The rows of a batch as first versions: what the match gives where the table has no current rows."""
    packed = stage.select(F.struct(*stage.columns).alias("_s"), instant(processing_time).alias("_at"))
    opened = _inserted(table, stage, is_current="true", valid_from="_at", valid_to=f"TIMESTAMP '{OPEN_END}'")
    return packed.selectExpr(*[f"{opened[c]} AS `{c}`" for c in table.columns])


def scd2_merge(target: DataFrame, stage: DataFrame, key: str, processing_time: Instant) -> DataFrame:
    """The whole table after a batch. History rows bypass the join: only current rows can change."""
    history = target.where(~F.col("is_current"))
    return history.unionByName(
        scd2_apply_to_current(current(target), stage, key, processing_time))


def scd2_insert_set(target: DataFrame, stage: DataFrame, key: str) -> DataFrame:
    """Batch rows that are new or changed: no current row has the same (trimmed) key and fingerprint."""
    seen = current(target).select(F.trim(key).alias("_key"), F.col("hash_diff").alias("_hash"))
    return stage.join(seen, (F.trim(F.col(key)) == F.col("_key")) & (F.col("hash_diff") == F.col("_hash")), "left_anti")


# ---- SCD-1 and insert-only ---------------------------------------------------------------------

def scd1_merge(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str],
               processing_time: Instant) -> DataFrame:
    """Update ``update_cols`` of matched rows, insert unmatched rows, leave all else alone."""
    fresh = _inserted(target, source)
    pairs = pair_rows(target, source, keys).select("_t", "_s", instant(processing_time).alias("_at"))
    taken = set(update_cols) | {"_processed_at"}
    return pairs.selectExpr(*[
        f"IF(_t IS NULL{' OR _s IS NOT NULL' if c in taken else ''}, {fresh[c]}, _t.`{c}`) AS `{c}`"
        for c in target.columns])


def as_new_rows(table: DataFrame, batch: DataFrame, processing_time: Instant) -> DataFrame:
    """Batch rows shaped as freshly inserted rows of the table."""
    packed = batch.select(F.struct(*batch.columns).alias("_s"), instant(processing_time).alias("_at"))
    return packed.selectExpr(*[f"{sql} AS `{c}`" for c, sql in _inserted(table, batch).items()])


def new_rows(target: DataFrame, source: DataFrame, keys: list[str], processing_time: Instant) -> DataFrame:
    """Batch rows whose key the table lacks, shaped as table rows. A null key part never matches."""
    return as_new_rows(target, source.join(target.select(*keys), keys, "left_anti"), processing_time)


def insert_only_merge(target: DataFrame, source: DataFrame, keys: list[str], processing_time: Instant) -> DataFrame:
    """The table plus the batch rows whose key it lacks."""
    return target.unionByName(new_rows(target, source, keys, processing_time))
