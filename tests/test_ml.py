import math

import pytest
from pyspark.sql import functions as F

from smelter.operators import ranking
from smelter.plans import ml, pipeline
from smelter.registry import ml as registry_ml
from smelter.registry.gold import feature_table
from smelter.sources import tables


@pytest.fixture(scope="module")
def features(spark):
    n = F.col("id")

    def noise(i):
        return F.pmod(F.xxhash64(n, F.lit(i)), F.lit(1000)) / 1000

    return spark.range(600).select(
        n.cast("string").alias("review_id"), (1 + F.floor(noise(1) * 5)).alias("label"),
        (1 + F.floor(noise(1) * 5) + noise(2) / 2).alias("business_avg_stars"),
        *[(noise(i + 3) * 100).alias(c) for i, c in enumerate(ml.STAR_NUMERIC[1:] + ["user_tenure_days"])],
        F.when(noise(40) < 0.5, "Food").otherwise("Other").alias("business_category_group"),
        F.when(noise(41) < 0.3, None).otherwise("TX").alias("business_state")).withColumn(
            "user_fans", F.when(F.col("review_id").endswith("7"), None).otherwise(F.col("user_fans"))).cache()


@pytest.mark.parametrize("kind", ["gbt", "linear"])
def test_star_models_learn_repeat_and_explain(spark, features, kind, tmp_path):
    model = ml.train_stars(features, kind)
    metrics = ml.evaluate(model, features, "regression").first()
    assert metrics.r2_score > 0.8 and metrics.mean_absolute_error < 0.6
    top = ml.explain(model, features).orderBy(F.desc("attribution")).first()
    assert "business_avg_stars" in top.feature
    first = ml.predict_stars(model, features)
    assert first.count() == features.count() and first.columns == ["review_id", "actual_stars", "predicted_stars", "prediction_error"]
    assert sorted(ml.predict_stars(ml.train_stars(features, kind), features).collect()) == sorted(first.collect())
    one = ml.score_row(spark, model, {"business_avg_stars": 4.5, "business_category_group": "Unseen"})
    assert 3 < one < 6
    with pytest.raises(ValueError):
        ml.score_row(spark, model, {"weekday": "Monday"})
    path = str(tmp_path / "m")
    for _ in range(2):
        ml.save_model(spark, model, path)
    assert ml.PipelineModel.load(path).transform(ml.numbers_as_double(features, ml.STAR_NUMERIC + ml.LINEAR_SCALED)).count() == 600


@pytest.mark.parametrize("kind", ["gbt", "logistic"])
def test_elite_models(spark, kind):
    n = F.col("id")
    h = F.pmod(F.xxhash64(n), F.lit(100))
    frame = spark.range(400).select(
        n.cast("string").alias("user_id"), F.lit("n").alias("name"), F.when(h < 10, 1.0).otherwise(0.0).alias("is_elite"),
        h.alias("review_count"), *[F.pmod(F.xxhash64(n, F.lit(i)), F.lit(50)).alias(c)
                                   for i, c in enumerate(ml.ELITE_NUMERIC[1:] + ["friend_count"])])
    model = ml.train_elite(frame, kind)
    metrics = ml.evaluate(model, frame, "classification").first()
    assert metrics.recall > 0.9 and metrics.roc_auc > 0.95
    out = ml.predict_elite(model, frame)
    assert out.where("(probability_of_elite > 0.5) = (predicted_is_elite = 1)").count() == 400
    assert ml.explain(model, frame).orderBy(F.desc("attribution")).first().feature == "review_count"


def test_class_weights_balance(spark):
    frame = spark.createDataFrame([(1.0,)] * 3 + [(0.0,)] * 9, "y double")
    sums = {r.y: r.w for r in ml.with_class_weights(frame, "y").groupBy("y").agg(F.sum("_weight").alias("w")).collect()}
    assert math.isclose(sums[0.0], 0.5 * 1) or math.isclose(sums[0.0], sums[1.0])


def test_clusters_and_their_quality(spark):
    points = [(f"b{i}", "n", float(5 * (i % 3)), 10 * (i % 3), 1.0, 10.0 * (i % 3) + i * 0.001, float(i % 3)) for i in range(60)]
    frame = spark.createDataFrame(points, "business_id string, name string, avg_stars double, review_count long, is_open_float double, latitude double, longitude double")
    model = ml.train_clusters(frame, k=3)
    assigned = ml.assign_clusters(model, frame)
    assert sorted(r["count"] for r in assigned.groupBy("cluster_id").count().collect()) == [20, 20, 20]
    assert {r.cluster_id for r in assigned.collect()} == {1, 2, 3}
    # brute force on the 60 points
    scored = [(r.prediction, r.features.toArray()) for r in model.transform(ml.numbers_as_double(frame, ml.CLUSTER_NUMERIC)).collect()]
    centres = model.stages[-1].clusterCenters()
    gap = {c: [math.dist(x, centres[c]) for p, x in scored if p == c] for c in range(3)}
    spread = {c: sum(v) / len(v) for c, v in gap.items()}
    index = sum(max((spread[a] + spread[b]) / math.dist(centres[a], centres[b]) for b in range(3) if b != a) for a in range(3)) / 3
    got = ml.evaluate(model, frame, "clustering").first()
    assert math.isclose(got.davies_bouldin_index, index, rel_tol=1e-9)
    assert math.isclose(got.mean_squared_distance, sum(d * d for v in gap.values() for d in v) / 60, rel_tol=1e-9)


def test_hash_split_is_a_stable_partition(spark):
    df = spark.range(5000)
    a, b = ml.hash_split(df, "id")
    assert a.count() + b.count() == 5000 and 0.77 < a.count() / 5000 < 0.83
    assert a.join(b, "id").count() == 0 and a.collect() == ml.hash_split(df, "id")[0].collect()


def test_standardize_constant_column(spark):
    out = ml.standardize(spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double"), ["a", "b"]).collect()
    assert [r.b for r in out] == [0.0] * 3 and out[2].a is None and math.isclose(out[0].a, -math.sqrt(0.5))


def test_auc_with_ties_equals_all_pairs(spark):
    df = spark.range(300).select((F.pmod(F.xxhash64("id"), F.lit(23)) / 23).alias("p"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)).alias("k")).withColumn(
        "y", (F.col("k") == 0).cast("int"))
    rows = df.collect()
    pairs = [(a.p, b.p) for a in rows for b in rows if a.y == 1 and b.y == 0]
    want = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs)
    assert math.isclose(ranking.roc_auc(df.repartition(6), "y", "p"), want, rel_tol=1e-12)
    assert ranking.roc_auc(df.withColumn("p", F.lit(0.5)), "y", "p") == 0.5
    assert ranking.roc_auc(df.where("y = 1"), "y", "p") is None and ranking.roc_auc(df.where("false"), "y", "p") is None
    assert ranking.calibration_error(df.where("false"), "y", "p") is None
    some = df.unionByName(spark.createDataFrame([(None, 0, 1), (0.3, 0, None)], df.schema.simpleString()[7:-1].replace(":", " ")))
    assert math.isclose(ranking.roc_auc(some, "y", "p"), want, rel_tol=1e-12)
    text = ranking.rank_sums(df, "y", "p")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text


def test_models_are_measured_on_rows_they_have_not_seen(spark, features, monkeypatch, tmp_path):
    n = F.col("id")
    users = spark.range(300).select(n.cast("string").alias("user_id"), F.lit("n").alias("name"), (F.pmod(F.xxhash64(n), F.lit(9)) / 3).alias("v"))
    frame = users.select("user_id", "name", (F.col("v") < 1).cast("double").alias("is_elite"),
                         *[(F.col("v") * i).alias(c) for i, c in enumerate(ml.ELITE_NUMERIC + ["friend_count"])])
    places = spark.range(90).select(n.cast("string").alias("business_id"), F.lit("n").alias("name"), *[(n * i % 17).cast("double").alias(c) for i, c in enumerate(ml.CLUSTER_NUMERIC, 1)])
    monkeypatch.setattr(pipeline, "read_gold", lambda *a: features)
    monkeypatch.setattr(pipeline, "read_silver", lambda s, root, entity: {"user": frame, "business": places}[entity])
    monkeypatch.setattr(ml, "elite_frame", lambda df, as_of: df)
    monkeypatch.setattr(ml, "cluster_frame", lambda df: df)
    boosted = ml.boosting.train
    monkeypatch.setattr(ml.boosting, "train", lambda *a, **k: boosted(*a, **{**k, "rounds": 2, "depth": 2}))
    seen, real = {}, ml.evaluate

    def spy(model, df, task):
        seen[task] = df
        return real(model, df, task)

    monkeypatch.setattr(ml, "evaluate", spy)
    metrics = pipeline.run_ml(spark, str(tmp_path), "2024-01-01 00:00:00", kind="boosted")
    for task, key, whole in (("regression", "review_id", features), ("classification", "user_id", frame)):
        keys = {r[0] for r in seen[task].select(key).collect()}
        assert keys == {r[0] for r in whole.where(~ml.in_training(key)).select(key).collect()} and 0 < len(keys) < whole.count() / 3
    stored = {(r.model, r.metric): r.value for r in tables.read_gold(spark, str(tmp_path), "model_metrics").collect()}
    assert stored[("elite_user_model", "roc_auc")] == metrics["elite_user_model"]["roc_auc"] > 0.9
    assert ("star_rating_model", "r2_score") in stored and ("business_clusters", "davies_bouldin_index") in stored
    loaded = ml.boosting.Boosted.load(spark, f"{tmp_path}/models/elite_user_model")
    assert ml.predict_elite(loaded, frame).where("(probability_of_elite > 0.5) = (predicted_is_elite = 1)").count() == 300


def test_explanation_names_input_columns(spark, features):
    out = {r.feature for r in ml.explain(ml.train_stars(features, "linear"), features).collect()}
    assert out == set(ml.LINEAR_SCALED + ml.LINEAR_PLAIN + ml.LINEAR_CATEGORICAL)


@pytest.mark.parametrize("query", ["star_gbt", "star_linear", "explain"])
def test_rating_models_pass_over_a_stored_table(spark, monkeypatch, query):
    """No pass of a model joins the feature table together again, and the table holds every row of it."""
    seen, train = [], ml.train_stars
    monkeypatch.setattr(ml, "train_stars", lambda features, **kw: seen.append(features) or train(features, **kw))
    assert registry_ml.QUERIES[query](spark, "/root/testdata/sf0.001").count()
    (features,) = seen
    assert "Join" not in features._jdf.queryExecution().executedPlan().toString()
    want = feature_table(spark, "/root/testdata/sf0.001").select(*features.columns)
    assert features.count() == want.count() and features.exceptAll(want).count() == 0
