"""Nested columns to flat ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_text(c: Column, data_type: T.DataType) -> Column:
    """JSON text of a column: text passes through, null stays null, all else is encoded."""
    if isinstance(data_type, T.StringType):
        return c
    if isinstance(data_type, (T.StructType, T.MapType, T.ArrayType, T.VariantType)):
        return F.to_json(c)
    return c.cast("string")


def flatten(df: DataFrame, sep: str = "_", max_depth: int = 3) -> DataFrame:
    """Lift struct fields to top-level columns named by their path.

    ``max_depth`` levels are lifted; a struct below that becomes JSON text. An array becomes JSON text,
    an empty array null. The schema alone decides the projection, so this is one narrow step.
    """
    def leaves(c: Column, name: str, data_type: T.DataType, depth: int):
        if isinstance(data_type, T.StructType):
            if depth > 0:
                for f in data_type.fields:
                    yield from leaves(c.getField(f.name), f"{name}{sep}{f.name}", f.dataType, depth - 1)
                return
            yield F.to_json(c).alias(name)
        elif isinstance(data_type, T.ArrayType):
            yield F.when(F.size(c) > 0, F.to_json(c)).alias(name)
        else:
            yield c.alias(name)

    columns = [leaf for f in df.schema.fields for leaf in leaves(F.col(f"`{f.name}`"), f.name, f.dataType, max_depth)]
    return df.select(*columns)
