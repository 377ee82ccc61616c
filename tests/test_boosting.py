"""Boosted trees with an L2 term, against arithmetic written out."""

import math

import pytest
from pyspark.sql import functions as F

from smelter.plans import boosting, ml


def frame(spark, n=240):
    return spark.range(n).select(
        "id", F.when(F.col("id") % 17 == 0, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(10)).cast("double")).alias("x"),
        (F.col("id") % 7).cast("double").alias("z"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("c")).withColumn(
            "y", F.coalesce(F.col("x") * 2, F.lit(1.0)) + F.when(F.col("c") == "a", 5.0).otherwise(0.0) + F.col("z") / 10).repartition(5)


def plain_stump(rows, l2, rate, splits, base):
    """The best split by trying all, and its leaves."""
    residual = [r.y - base for r in rows]
    best = None
    for name in splits:
        for t in splits[name]:
            left = [g for r, g in zip(rows, residual) if r[name] is None or r[name] <= t]
            if not left or len(left) == len(rows):
                continue
            right_sum, right_n = sum(residual) - sum(left), len(rows) - len(left)
            gain = sum(left) ** 2 / (len(left) + l2) + right_sum ** 2 / (right_n + l2)
            if best is None or gain > best[0] + 1e-7:
                best = (gain, name, t, rate * sum(left) / (len(left) + l2), rate * right_sum / (right_n + l2))
    return best[1:]


@pytest.mark.parametrize("l2", [0.0, 25.0])
def test_stump_equals_the_formula(spark, l2):
    df = frame(spark)
    splits = {"x": [2.0, 4.0, 6.0], "z": [1.0, 3.0]}
    model = boosting.train(df, ["x", "z"], "y", rounds=1, depth=1, l2=l2, rate=0.5, thresholds=splits)
    rows = df.collect()
    base = sum(r.y for r in rows) / len(rows)
    feature, at_most, left, right = plain_stump(rows, l2, 0.5, splits, base)
    (tree,) = model.trees
    assert (tree["feature"], tree["at_most"]) == (feature, at_most) and model.base == pytest.approx(base)
    assert tree["left"]["value"] == pytest.approx(left) and tree["right"]["value"] == pytest.approx(right)


def test_trees_learn_and_l2_shrinks(spark, tmp_path):
    df = frame(spark)
    model = boosting.train(df, ["x", "z"], "y", rounds=6, depth=3, l2=0.001, rate=0.5, categorical=("c",))
    scored = model.transform(df)
    assert scored.columns == df.columns + ["prediction"]
    assert scored.agg(F.avg(F.pow(F.col("y") - F.col("prediction"), 2))).first()[0] < 0.5
    small = boosting.train(df, ["x", "z"], "y", rounds=1, depth=3, l2=1e6, rate=0.5)
    assert small.transform(df).agg(F.stddev("prediction")).first()[0] < 0.1
    model.save(spark, str(tmp_path / "m"))
    again = boosting.Boosted.load(spark, str(tmp_path / "m"))
    assert again == model and again.transform(df).agg(F.sum("prediction")).first() == scored.agg(F.sum("prediction")).first()


def test_logistic_and_early_end(spark):
    df = frame(spark).withColumn("k", (F.col("c") == "a").cast("int"))
    model = boosting.train(df, ["z"], "k", loss="logistic", rounds=10, depth=2, l2=1.0, rate=0.8, categorical=("c",),
                           held_out=F.col("id") % 5 == 0, least_progress=0.2)
    assert 1 <= len(model.trees) < 10
    rows = model.transform(df).collect()
    assert all(r.prediction == r.k and (r.probability[1] > 0.5) == (r.k == 1) and math.isclose(sum(r.probability), 1) for r in rows)
    constant = boosting.train(df.where("k = 1"), ["z"], "k", loss="logistic", rounds=2, depth=2)
    assert constant.transform(df).where("prediction = 1").count() == df.count()


def by_subsets(model, row, f):
    """The Shapley value of a feature by all subsets of the others."""
    import itertools
    others = [c for c in model.inputs if c != f]

    def worth(node, known):
        if "value" in node:
            return node["value"]
        c, x = node["feature"], row[node["feature"]]
        if c in known:
            return worth(node["left"] if x is None or x <= node["at_most"] else node["right"], known)
        return sum(node[s]["cover"] / node["cover"] * worth(node[s], known) for s in ("left", "right"))

    total = 0.0
    for k in range(len(others) + 1):
        for known in itertools.combinations(others, k):
            weight = math.factorial(k) * math.factorial(len(others) - k) / math.factorial(len(others) + 1)
            total += weight * sum(worth(t, {*known, f}) - worth(t, set(known)) for t in model.trees)
    return total


def test_contributions_add_up_and_equal_all_subsets(spark):
    df = frame(spark).withColumn("w", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(5)).cast("double"))
    model = boosting.train(df, ["x", "z", "w"], "y", rounds=3, depth=3, l2=0.5, rate=0.6)
    parts = {r.id: r for r in boosting.contributions(model, df, "id").collect()}
    for r in model.transform(df).collect():
        p = parts[r.id]
        assert p._mean + p.x + p.z + p.w == pytest.approx(r.prediction, abs=1e-9)
        if r.id < 25:
            assert all(p[f] == pytest.approx(by_subsets(model, r, f), abs=1e-9) for f in "xzw")
    grouped = boosting.train(df, ["x"], "y", rounds=3, depth=2, rate=0.5, categorical=("c",))
    got = {r.feature: r.attribution for r in boosting.explain(grouped, df, "id").collect()}
    assert set(got) == {"x", "c"} and min(got.values()) > 0.5


def test_explanation_names_the_one_column_that_matters(spark):
    df = frame(spark).withColumn("y", F.coalesce(F.col("x"), F.lit(0.0)) * 3)
    model = boosting.train(df, ["z", "x"], "y", rounds=4, depth=2, rate=0.8)
    got = {r.feature: r.attribution for r in boosting.explain(model, df, "id").collect()}
    assert got["x"] > 3 and got["z"] < 0.1


def test_odd_frames(spark):
    empty = boosting.train(frame(spark).where("false"), ["x"], "y", rounds=1, depth=2)
    assert (empty.base, empty.trees) == (0.0, [{"value": 0.0, "cover": 0.0}])
    flat = boosting.train(frame(spark).withColumn("x", F.lit(None).cast("double")), ["x"], "y", rounds=1, depth=2, rate=1.0)
    assert set(flat.trees[0]) == {"value", "cover"} and abs(flat.trees[0]["value"]) < 1e-9
    with pytest.raises(ValueError):
        boosting.train(frame(spark), ["x"], "y", loss="other")
