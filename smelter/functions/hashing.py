"""Row fingerprints that tell nulls apart by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NESTED = (T.StructType, T.MapType, T.ArrayType, T.VariantType)


def fingerprint(columns: list[str | Column]) -> Column:
    """64-bit hash of scalar columns.

    ``xxhash64`` skips nulls, so alone it gives ``(null, 'a')`` and ``('a', null)`` one value. Hashing
    the null flags beside the values keeps them apart, and stays inside generated code (no JSON text
    per row).
    """
    values = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.xxhash64(*values, *[v.isNull() for v in values])


def row_fingerprint(df: DataFrame) -> Column:
    """Fingerprint of a whole row; nested columns count by their JSON text."""
    return fingerprint([
        F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, _NESTED) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
