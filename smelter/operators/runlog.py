"""Reading the log of earlier runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.functions.casts import instant

# Event names at the start of a log line.
EVENTS = ("PIPELINE_FAILURE", "PIPELINE_RETRY", "PIPELINE_SUCCESS")
FIELDS = ("dag", "task", "execution_date", "try_number", "error")


def parse_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """Lines ``EVENT|key=value|..|error=..`` as columns; other lines drop out.

    ``error`` comes last and may hold bars and equals signs itself, so it is cut off first.
    """
    line = F.col(col)
    head = F.regexp_extract(line, r"(?s)^(.*?)(?:\|error=|$)", 1)
    pairs = F.str_to_map(head, F.lit(r"\|"), F.lit("="))
    values = [F.when(F.instr(line, "|error=") > 0, F.regexp_extract(line, r"(?s)\|error=(.*)$", 1)) if f == "error"
              else pairs[f] for f in FIELDS]
    return lines.select(F.substring_index(line, "|", 1).alias("event"), *[v.alias(f) for v, f in zip(values, FIELDS)]).where(
        F.col("event").isin(*EVENTS))


def failed_runs(runs: DataFrame, as_of: datetime | str, minutes: int = 10, limit: int | None = None, dag: str | None = None) -> DataFrame:
    """The newest failed runs that started in the last ``minutes``, newest first; all of them, or the ``limit`` newest.

    ``runs`` has ``dag, run_id, state, start_date, logical_date``. With a limit every task keeps its
    newest rows only.
    """
    cutoff = F.timestamp_add("MINUTE", F.lit(-minutes), instant(as_of))
    found = runs.where((F.col("state") == "failed") & (F.col("start_date") >= cutoff))
    if dag is not None:
        found = found.where(F.col("dag") == dag)
    ordered = found.orderBy(F.desc("logical_date"), "run_id")
    return ordered if limit is None else ordered.limit(limit)
