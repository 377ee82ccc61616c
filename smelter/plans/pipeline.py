"""The layers in order: raw, cleaned, checks, aggregates, models. Plain functions, run by any scheduler.

Every step can be repeated for the same batch: it leaves the same tables.
"""

from __future__ import annotations

import os
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.functions.casts import instant
from smelter.operators.quality import (
    BRONZE_KEYS, bronze_key_stats, check_fact_keys, check_null_keys, check_single_active, required_columns, run_checks,
    silver_checks,
)
from smelter.operators.joins import heavy_hitters
from smelter.operators.merge import current
from smelter.operators.pii import inspect_pii
from smelter.plans import gold, ml, silver
from smelter.schemas import ENTITIES, LAYOUT, SILVER_TABLES, pii_columns
from smelter.session import tune
from smelter.sources import growth
from smelter.sources.bronze import available_entities, batch_path, bronze_lines, land_batch, landed_path, read_landed
from smelter.sources.tables import (
    apply_insert_only, apply_scd1, apply_scd2, ensure_silver_tables, is_dimension, path_exists, read_gold, read_silver,
    write_gold,
)

Instant = datetime | str


class ValidationFailed(ValueError):
    pass


def pii_findings_path(root: str, entity: str, dt: str) -> str:
    return os.path.join(root, "pii_findings", f"entity={entity}", f"dt={dt}")


def run_bronze(spark: SparkSession, raw: str, root: str, dt: str, max_bad_records: int | None = None) -> dict[str, dict[str, int]]:
    """Parse a raw batch into ``landed/`` and report bad lines, null keys and repeated keys per entity.

    Only too many bad lines stop the batch; the rest is for warning. Dead letters stay in ``landed/``.
    """
    report = {}
    for entity in available_entities(tune(spark), raw):
        if not path_exists(spark, batch_path(raw, entity, dt)):
            continue
        growth.learn(spark, root, entity, bronze_lines(spark, raw, entity, dt), f"{dt} 00:00:00", dt)
        bad = land_batch(spark, raw, root, entity, dt, extra=growth.raw_extra(spark, root, entity), limit=max_bad_records)
        keys, null_cols = BRONZE_KEYS[entity]
        stats = bronze_key_stats(read_landed(spark, root, entity, dt), list(keys), list(null_cols)).first()
        report[entity] = {"bad_records": bad, "null_rows": stats["total_nulls"], "duplicate_keys": stats["total_duplicates"]}
    return report


def run_silver(spark: SparkSession, root: str, dt: str, processing_time: Instant, mask_pii: bool = False,
               entities: tuple[str, ...] = ENTITIES) -> dict[str, list]:
    """Merge a landed batch into the cleaned tables; rows without a usable key go to ``quarantine/``.

    ``mask_pii`` also masks the registered columns that are otherwise loaded in the clear: business
    names and addresses, and friends lists. Counts of personal data in the raw rows go to ``pii_findings/``. Returns the
    months or buckets of each table that the batch has written to.
    """
    written = {}
    ensure_silver_tables(tune(spark), root)
    for entity in entities:
        if not path_exists(spark, landed_path(root, entity, dt)):
            continue
        rows = read_landed(spark, root, entity, dt, extra=growth.raw_extra(spark, root, entity))
        marked = pii_columns(entity)
        if marked:  # the raw rows, all of them, before anything is masked
            inspect_pii(rows, marked, min_likelihood="possible").write.mode("overwrite").parquet(pii_findings_path(root, entity, dt))
        if entity == "business":
            stage, bad = silver.stage_businesses(rows, mask_pii=mask_pii)
        elif entity == "user":
            stage, bad = silver.stage_users(rows, mask_pii=mask_pii)
        else:
            stage, bad = getattr(silver, f"stage_{SILVER_TABLES[entity]}")(rows)
        bad.write.mode("overwrite").parquet(os.path.join(root, "quarantine", f"entity={entity}", f"dt={dt}"))
        if is_dimension(entity):
            written[entity] = apply_scd2(spark, root, entity, stage, processing_time, batch=dt)
        elif entity == "checkin":
            written[entity] = apply_insert_only(spark, root, entity, stage, processing_time)
        else:
            updates = silver.REVIEW_UPDATES if entity == "review" else silver.TIP_UPDATES
            written[entity] = apply_scd1(spark, root, entity, stage, updates, processing_time)
    return written


def validate_silver(spark: SparkSession, root: str, processing_time: Instant, entities: tuple[str, ...] = ENTITIES,
                    written: dict[str, list] | None = None) -> dict[str, dict]:
    """Check the rows of one batch (those processed at ``processing_time``); raise on a failure.

    The batch is told by its own timestamp, not by a calendar date, so a late run is checked as well;
    the report says how many rows were seen. A key the batch touched has a row of the batch among the
    current ones, so the history of a dimension is not read for the uniqueness check. With ``written``, as
    :func:`run_silver` returns it, only the months and buckets the batch has written to are read.
    """
    in_batch = F.col("_processed_at") == instant(processing_time)
    report, problems = {}, []
    for entity in entities:
        parts = None if written is None else written.get(entity, [])
        where = {"buckets" if is_dimension(entity) else "months": parts}
        table, keys = read_silver(spark, root, entity, **where), list(LAYOUT[entity].keys)
        if is_dimension(entity):
            found = check_null_keys(table, keys, in_batch).first().asDict()
            found["duplicate_keys"] = check_single_active(current(table), keys[0], in_batch).count()
        else:
            found = check_fact_keys(table, keys, in_batch).first().asDict()
        report[entity] = found
        problems += [f"{entity}: {found[k]} {k}" for k in ("null_keys", "duplicate_keys") if found[k]]
    if problems:
        raise ValidationFailed("; ".join(problems))
    return report


def standing_checks(spark: SparkSession, root: str, as_of: Instant) -> DataFrame:
    """Results of the checks every cleaned table must pass as a whole. Reads whole tables: run it daily, say,
    rather than per batch; :func:`smelter.operators.quality.raise_if_failed` makes a gate of it."""
    parts = [required_columns(read_silver(spark, root, "business"), "businesses", ["business_id", "name", "address", "city"])]
    for entity in ENTITIES:
        checks = silver_checks(entity, as_of)
        if checks:
            parts.append(run_checks(read_silver(spark, root, entity), SILVER_TABLES[entity], checks))
    return reduce(DataFrame.unionByName, parts)


def run_gold(spark: SparkSession, root: str, as_of: Instant, processing_time: Instant | None = None, min_businesses: int = 5) -> None:
    """Rebuild the four aggregate tables from the cleaned ones."""
    at = processing_time or as_of
    tune(spark)
    businesses, users, reviews, tips = (read_silver(spark, root, e) for e in ("business", "user", "review", "tip"))
    write_gold(gold.business_performance(businesses, reviews, tips, at), root, "business_performance")
    write_gold(gold.city_analytics(businesses, reviews, at, min_businesses), root, "city_analytics")
    write_gold(gold.user_engagement(users, as_of, at), root, "user_engagement")
    hot = heavy_hitters(reviews, ["business_id", "user_id"])
    write_gold(gold.star_features(reviews, businesses, users, as_of, at, hot=hot), root, "ml_features_star_prediction")


def run_ml(spark: SparkSession, root: str, as_of: Instant, seed: int = 1, kind: str = "gbt") -> dict[str, dict]:
    """Train, store and evaluate the three models, and store star predictions and ``model_metrics``. Returns the metrics.

    The two supervised models are measured on the rows they have not learned from. ``kind="boosted"`` trains trees with
    an L2 term instead of Spark's own.
    """
    features = read_gold(spark, root, "ml_features_star_prediction")
    elite = ml.elite_frame(read_silver(spark, root, "user"), as_of)
    segments = ml.cluster_frame(read_silver(spark, root, "business"))
    models = {"star_rating_model": (ml.train_stars(features, kind, seed), ml.unseen(features, "review_id"), "regression"),
              "elite_user_model": (ml.train_elite(elite, kind, seed), ml.unseen(elite, "user_id"), "classification"),
              "business_clusters": (ml.train_clusters(segments, seed=seed), segments, "clustering")}
    metrics = {}
    for name, (model, frame, task) in models.items():
        ml.save_model(spark, model, os.path.join(root, "models", name))
        metrics[name] = ml.evaluate(model, frame, task).first().asDict()
    rows = [(name, task, metric, None if value is None else float(value)) for name, (_, _, task) in models.items() for metric, value in metrics[name].items()]
    stored = spark.createDataFrame(rows, "model string, task string, metric string, value double")
    write_gold(stored.withColumn("_evaluated_at", instant(as_of)), root, "model_metrics")
    write_gold(ml.predict_stars(models["star_rating_model"][0], features), root, "star_predictions")
    return metrics


def run_batch(spark: SparkSession, raw: str, root: str, dt: str, processing_time: Instant) -> dict:
    """One batch through all layers but the models. The aggregates are rebuilt only if validation passes."""
    report = {"bronze": run_bronze(spark, raw, root, dt)}
    written = run_silver(spark, root, dt, processing_time)
    report["silver"] = validate_silver(spark, root, processing_time, written=written)
    run_gold(spark, root, processing_time)
    return report
