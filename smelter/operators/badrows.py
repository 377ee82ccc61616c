"""Route JSON lines that cannot be loaded to a dead-letter table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

EMPTY = "Empty line"
NOT_OBJECT = "Expected JSON object"
BAD_JSON = "JSON parse error"
BAD_TYPE = "Type mismatch"
_CORRUPT = "_corrupt"


def parse_lines(lines: DataFrame, schema: T.StructType, col: str = "value") -> DataFrame:
    """Add ``_parsed`` (struct of ``schema``) and ``_error`` (null for a good line) to text lines.

    Unknown fields drop out, absent fields are null. A well-formed line is parsed once; only a line that
    did not fit is parsed again, to say why. The parse is exploded from a one-element array because
    Catalyst would otherwise copy it into every filter on ``_error`` and parse each line twice.
    """
    with_corrupt = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    line = F.trim(F.col(col))
    once = F.explode(F.array(F.from_json(F.col(col), with_corrupt, options)))
    parsed = lines.select("*", once.alias("_parsed"))
    error = (F.when(line.isNull() | (line == ""), F.lit(EMPTY))
             .when(~line.startswith("{"), F.when(F.try_parse_json(line).isNull(), F.lit(BAD_JSON)).otherwise(F.lit(NOT_OBJECT)))
             .when(F.col(f"_parsed.{_CORRUPT}").isNull(), F.lit(None).cast("string"))
             .when(F.try_parse_json(line).isNull(), F.lit(BAD_JSON))
             .otherwise(F.lit(BAD_TYPE)))
    return parsed.withColumn("_error", error)


def split_bad_records(lines: DataFrame, schema: T.StructType, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Good rows (the schema's columns and the other columns of ``lines``) and bad rows (line and error)."""
    parsed = parse_lines(lines, schema, col)
    others = [c for c in lines.columns if c != col]
    good = parsed.where(F.col("_error").isNull()).select(*[F.col(f"_parsed.`{f.name}`") for f in schema.fields], *others)
    bad = parsed.where(F.col("_error").isNotNull()).select(F.col(col).alias("line"), F.col("_error").alias("error"), *others)
    return good, bad


def number_lines(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """Line numbers, counted from 1 in each file, for the ``wanted`` lines of a text scan.

    ``lines`` is the scan with :func:`tag_position` columns; ``wanted`` a filter of it. Rows of a file
    split are consecutive, so the number is the count of lines in the file's earlier splits plus the
    position in the split. Only one row per split is shuffled, not the lines.
    """
    split = ["_file", "_start"]
    per_split = lines.groupBy(*split).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    before = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_split.withColumn("_before", F.coalesce(F.sum("_lines").over(before), F.lit(0))).drop("_lines")
    numbered = wanted.join(offsets, split)
    return numbered.withColumn("line_number", F.col("_before") + F.col("_pos") - F.col("_first") + 1).drop(
        "_pos", "_first", "_before", "_start").withColumnRenamed("_file", "source_file")


def tag_position(lines: DataFrame) -> DataFrame:
    """Tag lines of a text scan with file, split start and a running position inside the task."""
    return lines.select("*", F.col("_metadata.file_path").alias("_file"),
                        F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_pos"))
