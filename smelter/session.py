"""Session settings the library relies on.

Nothing here fixes a cluster's size: the number of shuffle partitions, the executor memory and the
checkpoint folder belong to whoever starts the job. Only the settings that change *results* (time
zone) or that the skew handling depends on (adaptive execution) are set.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    # Instants are compared and printed in UTC; a local zone is applied only where an operator says so.
    "spark.sql.session.timeZone": "UTC",
    # Re-plan at run time: merge small shuffle partitions, split skewed ones, demote sort-merge joins.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed partition even where that costs one more exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A task that writes to a few partitions (good rows and dead letters) keeps a file open for each
    # instead of sorting its rows by partition first.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}


def build_session(app: str = "smelter", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Start (or get) a session. ``conf`` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else started."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster; a scratch folder only where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    current = spark.sparkContext.getCheckpointDir()
    if named and not current:
        spark.sparkContext.setCheckpointDir(named)
    elif not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="smelter-checkpoint-"))
    return spark.sparkContext.getCheckpointDir()


def land(df: DataFrame) -> DataFrame:
    """Write a DataFrame once to the checkpoint folder and go on from there.

    Chained merges read their table more than once; landing each batch, as a table would, keeps the
    plan of the next one small. The copy survives the loss of executors.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Write a DataFrame once as a table in the checkpoint folder and read that, column by column, from then on.

    For what many passes read, as the stages of a model do: each pass would compute it again, shuffles included.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
