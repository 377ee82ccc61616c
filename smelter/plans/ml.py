"""Train, apply, evaluate and explain the three models: stars, elite users, business segments.

Everything runs on Spark's own estimators, so data stays distributed; the driver sees only model
parameters, one row of metrics and, for segments, one row per cluster.
"""

from __future__ import annotations

from datetime import datetime
from math import dist

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.functions.casts import local_today
from smelter.functions.text import non_empty_flag
from smelter.operators.merge import current
from smelter.operators.ranking import calibration_error, roc_auc
from smelter.plans import boosting
from smelter.plans.gold import friend_count, total_compliments
from smelter.session import ensure_checkpoint_dir

# The features each model reads.
STAR_NUMERIC = ["business_avg_stars", "business_review_count", "business_is_open", "user_review_count", "user_avg_stars",
                "user_fans", "user_is_elite", "review_text_length", "review_word_count", "review_day_of_week", "review_month"]
STAR_CATEGORICAL = ["business_category_group"]
LINEAR_SCALED = ["business_avg_stars", "business_review_count", "user_review_count", "user_avg_stars", "user_fans",
                 "review_text_length", "review_word_count", "user_tenure_days"]
LINEAR_PLAIN = ["business_is_open", "user_is_elite", "review_day_of_week", "review_month"]
LINEAR_CATEGORICAL = ["business_category_group", "business_state"]
ELITE_NUMERIC = ["review_count", "average_stars", "fans", "useful_votes", "funny_votes", "cool_votes", "total_compliments",
                 "days_on_platform"]
CLUSTER_NUMERIC = ["avg_stars", "review_count", "is_open_float", "latitude", "longitude"]
# Training settings.
MAX_ITERATIONS, MIN_PROGRESS, L2 = 20, 0.001, 0.001
CLUSTERS, CLUSTER_ITERATIONS = 6, 50


# ---- frames ------------------------------------------------------------------------------------

TRAINING_SHARE = 0.8


def in_training(key: str, frac: float = TRAINING_SHARE) -> Column:
    """Is the row one a model may learn from? By the leading four digits of the key's MD5: the same rows on every run,
    cluster and engine. A null key is for evaluation."""
    leading = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 4), 16, 10).cast("int")
    return F.coalesce(leading < int(frac * 65536), F.lit(False))


def hash_split(df: DataFrame, key: str, frac: float = TRAINING_SHARE) -> tuple[DataFrame, DataFrame]:
    """Training and evaluation rows; see :func:`in_training`."""
    chosen = in_training(key, frac)
    return df.where(chosen), df.where(~chosen)


def unseen(df: DataFrame, key: str) -> DataFrame:
    """The rows no model of this module has learned from: what metrics are measured on."""
    return hash_split(df, key)[1]


def star_frame(features: DataFrame) -> DataFrame:
    return features.where(F.col("label").isNotNull()).withColumn("label", F.col("label").cast("double"))


def elite_frame(users: DataFrame, as_of: datetime | str, current_only: bool = True, nulls_as_zero: bool = True) -> DataFrame:
    """One row per user with at least one review: key, name, features and the label ``is_elite``."""
    kept = (current(users) if current_only else users).where(F.col("user_id").isNotNull() & (F.col("review_count") > 0))
    return kept.select(
        "user_id", "name", non_empty_flag(F.col("elite")).cast("double").alias("is_elite"), "review_count", "average_stars",
        "fans", F.col("useful").alias("useful_votes"), F.col("funny").alias("funny_votes"), F.col("cool").alias("cool_votes"),
        total_compliments(nulls_as_zero).alias("total_compliments"), friend_count(F.col("friends")).alias("friend_count"),
        F.datediff(local_today(as_of), F.col("yelping_since")).alias("days_on_platform"))


def cluster_frame(businesses: DataFrame) -> DataFrame:
    placed = current(businesses).where("latitude IS NOT NULL AND longitude IS NOT NULL AND review_count IS NOT NULL")
    return placed.select(
        "business_id", "name", F.col("stars").alias("avg_stars"), "review_count",
        F.when(F.col("is_open") == 1, 1.0).otherwise(0.0).alias("is_open_float"), "latitude", "longitude")


# ---- feature preparation -----------------------------------------------------------------------

def feature_stages(numeric: list[str], categorical: list[str], scaled: list[str] | None = None, one_hot: bool = False) -> list:
    """Stages that turn columns into the vector ``features``.

    Numeric nulls take the mean; a category unseen in training has an index of its own. ``scaled``
    columns are brought to mean 0 and deviation 1; with ``one_hot`` categories become indicator columns.
    """
    scaled = scaled or []
    every = scaled + [c for c in numeric if c not in scaled]
    filled = [f"{c}_filled" for c in every]
    indexed = [f"{c}_index" for c in categorical]
    stages = [Imputer(inputCols=every, outputCols=filled, strategy="mean")]
    inputs = filled
    if scaled:
        stages += [VectorAssembler(inputCols=filled[:len(scaled)], outputCol="_to_scale"),
                   StandardScaler(inputCol="_to_scale", outputCol="scaled", withMean=True, withStd=True)]
        inputs = ["scaled"] + filled[len(scaled):]
    if categorical:
        stages.append(StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep"))
        if one_hot:
            hot = [f"{c}_hot" for c in categorical]
            stages.append(OneHotEncoder(inputCols=indexed, outputCols=hot, handleInvalid="keep"))
            indexed = hot
    stages.append(VectorAssembler(inputCols=inputs + indexed, outputCol="features"))
    return stages


def numbers_as_double(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def standardize(df: DataFrame, cols: list[str]) -> DataFrame:
    """Columns brought to mean 0 and (sample) deviation 1 over the whole table; no deviation gives 0.

    The means and deviations are one row, fetched by one aggregate, and used as constants. A window over
    the whole table would pull every row into one task.
    """
    fit = df.agg(*[F.avg(c).alias(f"{c}_m") for c in cols], *[F.stddev_samp(c).alias(f"{c}_s") for c in cols]).first()
    return df.withColumns({
        c: ((F.col(c) - fit[f"{c}_m"]) / fit[f"{c}_s"]) if fit[f"{c}_s"] else F.when(F.col(c).isNotNull(), 0.0) for c in cols})


# ---- training ----------------------------------------------------------------------------------

def train_stars(features: DataFrame, kind: str = "gbt", seed: int = 1, key: str = "review_id", rounds: int = MAX_ITERATIONS,
                depth: int = 5) -> PipelineModel | boosting.Boosted:
    """Rating model: boosted trees that stop early on held-out rows, or a regularised linear model.

    ``gbt`` are Spark's trees, which have no L2 term; ``boosted`` are trees with one (:mod:`smelter.plans.boosting`).
    """
    frame = numbers_as_double(star_frame(features), list(dict.fromkeys(STAR_NUMERIC + LINEAR_SCALED)))
    if kind == "gbt":
        ensure_checkpoint_dir(frame.sparkSession)
        stages = feature_stages(STAR_NUMERIC, STAR_CATEGORICAL) + [GBTRegressor(
            labelCol="label", maxIter=MAX_ITERATIONS, validationIndicatorCol="_held_out", validationTol=MIN_PROGRESS, seed=seed)]
        return Pipeline(stages=stages).fit(frame.withColumn("_held_out", ~in_training(key)))
    if kind == "boosted":
        return boosting.train(frame, STAR_NUMERIC, "label", rounds=rounds, depth=depth, l2=L2, held_out=~in_training(key),
                              least_progress=MIN_PROGRESS, categorical=tuple(STAR_CATEGORICAL))
    if kind == "linear":
        stages = feature_stages(LINEAR_PLAIN, LINEAR_CATEGORICAL, scaled=LINEAR_SCALED, one_hot=True) + [LinearRegression(
            labelCol="label", regParam=L2, maxIter=MAX_ITERATIONS, tol=MIN_PROGRESS)]
        return Pipeline(stages=stages).fit(hash_split(frame, key)[0])
    raise ValueError(f"unknown kind {kind!r}")


def with_class_weights(frame: DataFrame, label: str) -> DataFrame:
    """Add ``_weight``: rows / (classes * rows of the own class), so that every class weighs the same."""
    counts = {r[label]: r["n"] for r in frame.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per class
    total = sum(counts.values())
    weight = F
    for value, n in counts.items():
        weight = weight.when(F.col(label) == value, total / (len(counts) * n))
    return frame.withColumn("_weight", weight)


def train_elite(frame: DataFrame, kind: str = "gbt", seed: int = 1, key: str = "user_id", rounds: int = MAX_ITERATIONS,
                depth: int = 5) -> PipelineModel | boosting.Boosted:
    """Elite-user model on an :func:`elite_frame`: boosted trees (``gbt``, or ``boosted`` with an L2 term) or logistic
    regression, classes balanced."""
    inputs = ELITE_NUMERIC + ["friend_count"] if kind == "logistic" else ELITE_NUMERIC
    weighted = with_class_weights(numbers_as_double(frame, inputs), "is_elite")
    if kind == "gbt":
        ensure_checkpoint_dir(frame.sparkSession)
        stages = feature_stages(inputs, []) + [GBTClassifier(
            labelCol="is_elite", weightCol="_weight", maxIter=MAX_ITERATIONS, validationIndicatorCol="_held_out",
            validationTol=MIN_PROGRESS, seed=seed)]
        return Pipeline(stages=stages).fit(weighted.withColumn("_held_out", ~in_training(key)))
    if kind == "boosted":
        return boosting.train(weighted, inputs, "is_elite", loss="logistic", rounds=rounds, depth=depth, l2=L2, weight="_weight",
                              held_out=~in_training(key), least_progress=MIN_PROGRESS)
    if kind == "logistic":
        stages = feature_stages([], [], scaled=inputs) + [LogisticRegression(
            labelCol="is_elite", weightCol="_weight", maxIter=MAX_ITERATIONS)]
        return Pipeline(stages=stages).fit(hash_split(weighted, key)[0])
    raise ValueError(f"unknown kind {kind!r}")


def train_clusters(frame: DataFrame, k: int = CLUSTERS, seed: int = 1) -> PipelineModel:
    """Segments of businesses on a :func:`cluster_frame`, by standardised features."""
    stages = feature_stages([], [], scaled=CLUSTER_NUMERIC) + [KMeans(k=k, maxIter=CLUSTER_ITERATIONS, seed=seed)]
    return Pipeline(stages=stages).fit(numbers_as_double(frame, CLUSTER_NUMERIC))


def save_model(spark: SparkSession, model: PipelineModel | boosting.Boosted, path: str) -> None:
    """Store a model under a name, replacing an older one."""
    if isinstance(model, boosting.Boosted):
        model.save(spark, path)
    else:
        model.write().overwrite().save(path)


# ---- prediction --------------------------------------------------------------------------------

def predict_stars(model: PipelineModel, features: DataFrame, key: str = "review_id") -> DataFrame:
    """Actual and predicted rating with the absolute error, for every review."""
    rows = numbers_as_double(features, list(dict.fromkeys(STAR_NUMERIC + LINEAR_SCALED)))
    return model.transform(rows).select(
        key, F.col("label").alias("actual_stars"), F.col("prediction").alias("predicted_stars"),
        F.abs(F.col("label") - F.col("prediction")).alias("prediction_error"))


def worst_predictions(scored: DataFrame, label: str, n: int, *keys: str) -> DataFrame:
    """The ``n`` scored rows with the largest absolute error (to five digits), ties by key."""
    error = F.round(F.abs(F.col(label) - F.col("prediction")), 5)
    return scored.withColumn("prediction_error", error).orderBy(F.desc("prediction_error"), *keys).limit(n)


def predict_elite(model: PipelineModel, frame: DataFrame) -> DataFrame:
    rows = model.transform(numbers_as_double(frame, ELITE_NUMERIC + ["friend_count"]))
    return rows.select("user_id", "name", F.col("prediction").cast("bigint").alias("predicted_is_elite"),
                       _likelihood(rows).alias("probability_of_elite"))


def _likelihood(scored: DataFrame) -> Column:
    """The probability of class 1; Spark's models give a vector, the trees with an L2 term an array."""
    return F.col("probability")[1] if dict(scored.dtypes)["probability"].startswith("array") else vector_to_array("probability")[1]


def assign_clusters(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """The segment of each business, counted from 1."""
    rows = model.transform(numbers_as_double(frame, CLUSTER_NUMERIC))
    return rows.select("business_id", "name", (F.col("prediction") + 1).alias("cluster_id"), F.col("avg_stars").alias("stars"),
                       "review_count")


def score_row(spark: SparkSession, model: PipelineModel, values: dict) -> float:
    """Prediction for one hand-written row of features; features left out count as missing."""
    numeric = list(dict.fromkeys(STAR_NUMERIC + LINEAR_SCALED))
    names = numeric + LINEAR_CATEGORICAL
    unknown = set(values) - set(names)
    if unknown:
        raise ValueError(f"not features of the model: {sorted(unknown)}")
    row = tuple(float(values[c]) if c in numeric and values.get(c) is not None else values.get(c) for c in names)
    ddl = ", ".join(f"{c} {'double' if c in numeric else 'string'}" for c in names)
    return model.transform(spark.createDataFrame([row], ddl)).first()["prediction"]


# ---- evaluation --------------------------------------------------------------------------------

def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row of regression metrics from one aggregate; the median is approximate."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    error = y - p
    spread = F.var_pop(y)
    return df.agg(
        F.avg(F.abs(error)).alias("mean_absolute_error"), F.avg(error * error).alias("mean_squared_error"),
        F.avg(F.pow(F.log1p(y) - F.log1p(F.greatest(p, F.lit(0.0))), F.lit(2))).alias("mean_squared_log_error"),
        F.percentile_approx(F.abs(error), 0.5).alias("median_absolute_error"),
        (1 - F.try_divide(F.avg(error * error), spread)).alias("r2_score"),
        (1 - F.try_divide(F.var_pop(error), spread)).alias("explained_variance"))


def classification_metrics(df: DataFrame, label: str, prediction: str, probability: str) -> DataFrame:
    """One row of metrics for a 0/1 label; ``probability`` is that of class 1."""
    y, hit = F.col(label) == 1, F.col(prediction) == 1
    true_pos = F.count_if(y & hit)
    precision, recall = F.try_divide(true_pos, F.count_if(hit)), F.try_divide(true_pos, F.count_if(y))
    p = F.greatest(F.least(F.when(y, F.col(probability)).otherwise(1 - F.col(probability)), F.lit(1.0)), F.lit(1e-15))
    return df.agg(
        precision.alias("precision"), recall.alias("recall"),
        F.try_divide(F.count_if(y == hit), F.count(F.lit(1))).alias("accuracy"),
        F.try_divide(2 * precision * recall, precision + recall).alias("f1_score"), F.avg(-F.log(p)).alias("log_loss"))


def clustering_metrics(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Mean squared distance to the own centre, and the Davies-Bouldin index (IEEE PAMI 1979).

    Distances are aggregated to one row per cluster; only those rows and the centres reach the driver.
    """
    kmeans: KMeansModel = model.stages[-1]
    centres = [[float(x) for x in c] for c in kmeans.clusterCenters()]
    placed = model.transform(numbers_as_double(df, CLUSTER_NUMERIC)).select("prediction", vector_to_array("features").alias("x"))
    centre = F.array(*[F.array(*[F.lit(x) for x in c]) for c in centres])[F.col("prediction")]
    squared = F.aggregate(F.zip_with("x", centre, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
    rows = placed.withColumn("_d2", squared).groupBy("prediction").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_d2").alias("d2"), F.avg(F.sqrt("_d2")).alias("scatter")).collect()
    worst = [max(((a["scatter"] + b["scatter"]) / dist(centres[a["prediction"]], centres[b["prediction"]])
                  for b in rows if b is not a), default=0.0) for a in rows]
    metrics = (sum(worst) / len(worst), sum(r["d2"] for r in rows) / sum(r["n"] for r in rows))
    return df.sparkSession.createDataFrame([metrics], "davies_bouldin_index double, mean_squared_distance double")


def evaluate(model: PipelineModel, df: DataFrame, task: str) -> DataFrame:
    """One row of metrics; ``task`` is 'regression', 'classification' or 'clustering'. Give it :func:`unseen` rows."""
    if task == "clustering":
        return clustering_metrics(model, df)
    if task == "regression":
        rows = numbers_as_double(star_frame(df), list(dict.fromkeys(STAR_NUMERIC + LINEAR_SCALED)))
        return regression_metrics(model.transform(rows))
    if task == "classification":
        scored = model.transform(numbers_as_double(df, ELITE_NUMERIC + ["friend_count"]))
        scored = scored.withColumn("_p", _likelihood(scored))
        metrics = classification_metrics(scored, "is_elite", "prediction", "_p")
        return metrics.withColumns({"roc_auc": F.lit(roc_auc(scored, "is_elite", "_p")).cast("double"),
                                    "calibration_error": F.lit(calibration_error(scored, "is_elite", "_p")).cast("double")})
    raise ValueError(f"unknown task {task!r}")


def feature_names(scored: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector's slots, in order, from the column's metadata."""
    attrs = scored.schema[column].metadata["ml_attr"]["attrs"]
    return [a["name"] for a in sorted((a for group in attrs.values() for a in group), key=lambda a: a["idx"])]


def input_of(model: PipelineModel, slot: str) -> str:
    """The input column that a slot of the feature vector comes from."""
    if slot.startswith("scaled_"):
        scaled = next(s for s in model.stages if isinstance(s, VectorAssembler) and s.getOutputCol() == "_to_scale")
        slot = scaled.getInputCols()[int(slot.split("_")[1])]
    for s in model.stages:
        if isinstance(s, StringIndexerModel):
            for column in s.getInputCols():
                if slot == f"{column}_index" or slot.startswith(f"{column}_hot_"):
                    return column
    return slot.removesuffix("_filled")


def explain(model: PipelineModel | boosting.Boosted, df: DataFrame, key: str = "review_id") -> DataFrame:
    """Weight of each input column: mean absolute Shapley value for trees with an L2 term, else tree importance, or size of
    a linear coefficient times the feature's deviation, summed over the slots a column fills."""
    if isinstance(model, boosting.Boosted):
        return boosting.explain(model, df, key)
    last = model.stages[-1]
    columns = list(dict.fromkeys(STAR_NUMERIC + LINEAR_SCALED + ELITE_NUMERIC + ["friend_count"]))
    scored = model.transform(numbers_as_double(df, [c for c in columns if c in df.columns]))
    names = feature_names(scored)
    if hasattr(last, "featureImportances"):
        weights = last.featureImportances.toArray().tolist()
    else:
        deviations = scored.select(Summarizer.std(F.col("features")).alias("s")).first()["s"].toArray()
        weights = [abs(float(c)) * float(s) for c, s in zip(last.coefficients.toArray(), deviations)]
    totals: dict[str, float] = {}
    for name, weight in zip(names, weights):
        column = input_of(model, name)
        totals[column] = totals.get(column, 0.0) + float(weight)
    return df.sparkSession.createDataFrame(list(totals.items()), "feature string, attribution double")


