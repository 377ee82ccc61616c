"""Boosted trees with an L2 term on the leaves, grown from histograms.

A leaf weighs ``rate * sum(gradient) / (sum(hessian) + l2)``; for squared loss the hessian counts rows. Each level of a tree is
one grouped aggregate over (node, feature, bin), combined map-side; the driver sees at most nodes x features x bins rows and
picks the splits. Rows hold their bins and the margin so far; lineage is cut by a checkpoint every few trees, so a lost
executor repeats little.

A null feature goes left at every split. Ties go to the first feature, then the lowest threshold.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from math import factorial, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from smelter.session import ensure_checkpoint_dir

BINS = 32
CUT_EVERY = 4
SAME = 1e-9  # gains this near to each other count as equal


@dataclass
class Boosted:
    """A trained model: ``base`` plus the trees. A tree is a leaf ``{"value"}`` or ``{"feature", "at_most", "left", "right"}``;
    ``cover`` is the sum of the hessian (for squared loss: the rows) that training saw there."""

    inputs: list[str]
    loss: str
    base: float
    trees: list[dict] = field(default_factory=list)
    categories: dict[str, list[str]] = field(default_factory=dict)

    def margin(self) -> Column:
        total = F.lit(self.base)
        for tree in self.trees:
            total = total + _value(tree)
        return total

    def transform(self, df: DataFrame) -> DataFrame:
        """``prediction``; for logistic loss the likelier class, with ``probability`` as array of both."""
        scored = with_categories(df, self.categories).withColumn("_margin", self.margin())
        if self.loss == "logistic":
            p = 1 / (1 + F.exp(-F.col("_margin")))
            scored = scored.withColumn("probability", F.array(1 - p, p)).withColumn("prediction", (F.col("_margin") > 0).cast("double"))
        else:
            scored = scored.withColumn("prediction", F.col("_margin"))
        return scored.drop("_margin", *_category_columns(self.categories))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Boosted:
        return Boosted(**json.loads(spark.read.text(path).first()["value"]))


def _value(tree: dict) -> Column:
    if "value" in tree:
        return F.lit(tree["value"])
    left = F.coalesce(F.col(f"`{tree['feature']}`") <= tree["at_most"], F.lit(True))
    return F.when(left, _value(tree["left"])).otherwise(_value(tree["right"]))


def _category_columns(categories: dict[str, list[str]]) -> list[str]:
    return [f"{c}={v}" for c, values in categories.items() for v in values]


def with_categories(df: DataFrame, categories: dict[str, list[str]]) -> DataFrame:
    """An indicator column, 0 or 1, for each known value of each categorical column."""
    return df.withColumns({f"{c}={v}": F.when(F.col(c) == v, 1.0).otherwise(0.0) for c, values in categories.items() for v in values}) if categories else df


def thresholds_of(df: DataFrame, inputs: list[str], bins: int = BINS) -> dict[str, list[float]]:
    """At most bins - 1 split points per feature at its approximate quantiles, from one aggregate."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    row = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), shares, 10000).alias(str(i)) for i, c in enumerate(inputs)]).first()
    return {c: sorted(set(row[i] or [])) for i, c in enumerate(inputs)}


def _gradients(loss: str) -> tuple[Column, Column]:
    y, m, w = F.col("y"), F.col("margin"), F.col("w")
    if loss == "squared":
        return (y - m) * w, w
    p = 1 / (1 + F.exp(-m))
    return (y - p) * w, p * (1 - p) * w


def _node(tree: dict, places: dict[str, int], splits: dict[str, list[float]]) -> Column:
    """The number of the open leaf a row falls into, from its bins."""
    if "left" not in tree:
        return F.lit(tree.get("node", -1))
    bin_of = F.col("bins")[places[tree["feature"]]]
    return F.when(bin_of <= splits[tree["feature"]].index(tree["at_most"]), _node(tree["left"], places, splits)).otherwise(
        _node(tree["right"], places, splits))


def _best_split(parts: list[tuple[int, int, float, float]], inputs: list[str], splits: dict[str, list[float]], l2: float) -> tuple | None:
    """(gain, feature, threshold, left and right sums) of one node from its (feature, bin, gradient, hessian)."""
    best = None
    for f, name in enumerate(inputs):
        sums = sorted((b, g, h) for feature, b, g, h in parts if feature == f)
        total_g, total_h = sum(g for _, g, _ in sums), sum(h for _, _, h in sums)
        g = h = 0.0
        for b, gb, hb in sums[:-1]:
            g, h = g + gb, h + hb
            gain = g * g / (h + l2) + (total_g - g) ** 2 / (total_h - h + l2) - total_g * total_g / (total_h + l2)
            if gain > SAME and (best is None or gain > best[0] * (1 + SAME)):
                best = (gain, name, splits[name][b], (g, h), (total_g - g, total_h - h))
    return best


def _grow(rows: DataFrame, inputs: list[str], splits: dict[str, list[float]], loss: str, depth: int, l2: float, rate: float) -> dict:
    """One tree, level by level."""
    places = {c: i for i, c in enumerate(inputs)}
    g, h = _gradients(loss)
    tree: dict = {"node": 0}
    open_nodes = [tree]
    for level in range(depth):
        counts = (rows.select(_node(tree, places, splits).alias("node"), "bins", g.alias("g"), h.alias("h")).where("node >= 0")
                  .select("node", F.posexplode("bins").alias("feature", "bin"), "g", "h")
                  .groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect())
        by_node: dict[int, list] = {}
        for r in counts:
            by_node.setdefault(r["node"], []).append((r["feature"], r["bin"], r["g"], r["h"]))
        following = []
        for node in open_nodes:
            parts = by_node.get(node.pop("node"), [])
            whole = [(g_, h_) for f, _, g_, h_ in parts if f == 0]
            node["cover"] = sum(x for _, x in whole)
            node["value"] = rate * sum(x for x, _ in whole) / (sum(x for _, x in whole) + l2) if whole else 0.0
            if (best := _best_split(parts, inputs, splits, l2)) is None:
                continue
            _, name, at_most, left, right = best
            node.pop("value")
            node |= {"feature": name, "at_most": at_most, **{
                side: {"value": rate * sums[0] / (sums[1] + l2), "cover": sums[1]} for side, sums in (("left", left), ("right", right))}}
            following += [node["left"], node["right"]]
        if level + 1 < depth:
            for i, node in enumerate(following):
                node["node"] = i
        open_nodes = following
        if not open_nodes:
            break
    return tree


def _clean(tree: dict) -> dict:
    """The tree without what only growing needs."""
    cover = {"cover": float(tree.get("cover", 0.0))}
    if "left" in tree:
        return {"feature": tree["feature"], "at_most": tree["at_most"], "left": _clean(tree["left"]), "right": _clean(tree["right"])} | cover
    return {"value": float(tree["value"])} | cover


def _loss(loss: str) -> Column:
    y, m = F.col("y"), F.col("margin")
    if loss == "squared":
        return F.avg((y - m) * (y - m) * F.col("w")) / F.avg("w")
    return F.avg((F.log1p(F.exp(-F.abs(m))) + F.greatest(m, F.lit(0.0)) - y * m) * F.col("w")) / F.avg("w")


def train(frame: DataFrame, inputs: list[str], label: str, loss: str = "squared", rounds: int = 20, depth: int = 5, l2: float = 1.0,
          rate: float = 0.1, bins: int = BINS, weight: str | None = None, held_out: Column | None = None, least_progress: float = 0.0,
          thresholds: dict[str, list[float]] | None = None, categorical: tuple[str, ...] = ()) -> Boosted:
    """Fit ``rounds`` trees. With ``held_out`` (a condition) those rows only measure, and training ends with the first tree that
    lowers their loss by less than ``least_progress`` of it; that tree is not kept. Rows without a label take no part."""
    if loss not in ("squared", "logistic"):
        raise ValueError(f"unknown loss {loss!r}")
    frame = frame.where(F.col(label).isNotNull())
    # Values of a categorical column are meant to be few (labels of a ladder, say); they become columns.
    categories = {c: sorted(r[0] for r in frame.where(F.col(c).isNotNull()).select(c).distinct().collect()) for c in categorical}
    frame, inputs = with_categories(frame, categories), inputs + _category_columns(categories)
    splits = {c: sorted(v) for c, v in (thresholds or thresholds_of(frame, inputs, bins)).items()}

    def bin_of(c: str) -> Column:
        x = F.col(f"`{c}`").cast("double")
        return F.coalesce(F.size(F.filter(F.array(*[F.lit(float(t)) for t in splits[c]]), lambda t: t < x)), F.lit(0)) if splits[c] else F.lit(0)

    y = F.col(label).cast("double")
    fit = (~held_out if held_out is not None else F.lit(True))
    rows = frame.select(y.alias("y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"), fit.alias("fit"),
                        F.array(*[bin_of(c) for c in inputs]).alias("bins"))
    mean = rows.where("fit").agg(F.sum(F.col("y") * F.col("w")) / F.sum("w")).first()[0] or 0.0
    near = min(max(mean, 1e-6), 1 - 1e-6)
    base = mean if loss == "squared" else float(_log_odds(near))
    model = Boosted(inputs, loss, base, [], categories)
    ensure_checkpoint_dir(frame.sparkSession)
    rows = rows.withColumn("margin", F.lit(base)).persist(StorageLevel.MEMORY_AND_DISK)
    before = rows.where("NOT fit").agg(_loss(loss)).first()[0] if held_out is not None else None
    for n in range(rounds):
        tree = _clean(_grow(rows.where("fit"), inputs, splits, loss, depth, l2, rate))
        places = {c: i for i, c in enumerate(inputs)}
        grown = rows.withColumn("margin", F.col("margin") + _binned_value(tree, places, splits))
        grown = grown.checkpoint() if n % CUT_EVERY == CUT_EVERY - 1 else grown
        grown = grown.persist(StorageLevel.MEMORY_AND_DISK)
        if before is not None:
            now = grown.where("NOT fit").agg(_loss(loss)).first()[0]
            if now is None or before - now < least_progress * max(before, 0.01):
                grown.unpersist()
                break
            before = now
        else:
            grown.count()
        rows.unpersist()
        rows = grown
        model.trees.append(tree)
    rows.unpersist()
    return model


def _binned_value(tree: dict, places: dict[str, int], splits: dict[str, list[float]]) -> Column:
    if "value" in tree:
        return F.lit(tree["value"])
    return F.when(F.col("bins")[places[tree["feature"]]] <= splits[tree["feature"]].index(tree["at_most"]),
                  _binned_value(tree["left"], places, splits)).otherwise(_binned_value(tree["right"], places, splits))


# ---- explanation -------------------------------------------------------------------------------

def leaf_games(tree: dict) -> list[tuple[float, dict[str, float], list[tuple[str, float, bool]]]]:
    """Per leaf: its value, per feature on its path the share of rows that go its way, and the path's tests."""
    def walk(node: dict, shares: dict[str, float], tests: list) -> list:
        if "value" in node:
            return [(node["value"], shares, tests)]
        out = []
        for side in ("left", "right"):
            share = node[side]["cover"] / node["cover"] if node["cover"] else 0.5
            f = node["feature"]
            out += walk(node[side], shares | {f: shares.get(f, 1.0) * share}, [*tests, (f, node["at_most"], side == "left")])
        return out

    return walk(tree, {}, [])


def tree_values(tree: dict, columns: dict[str, np.ndarray], rows: int) -> tuple[float, dict[str, np.ndarray]]:
    """The tree's mean by cover, and each feature's Shapley value for each row.

    A leaf pays its value if every feature on its path agrees: a feature that is known says 0 or 1, one that is not says the
    share of training rows that go the leaf's way. So a leaf is a product of at most ``depth`` players, and a player's
    value is its own step times the others' products, weighted over how many of them are known.
    """
    mean, out = 0.0, {}
    for value, shares, tests in leaf_games(tree):
        mean += value * float(np.prod(list(shares.values())))
        agrees = {f: np.ones(rows, dtype=bool) for f in shares}
        for f, at_most, left in tests:
            goes_left = np.isnan(columns[f]) | (columns[f] <= at_most)
            agrees[f] &= goes_left if left else ~goes_left
        n = len(shares)
        for f, share in shares.items():
            # known[k]: sum over the sets of k other features that are known of the others' products
            known = [np.ones(rows)] + [np.zeros(rows) for _ in range(n - 1)]
            for other, s in shares.items():
                if other != f:
                    for k in range(n - 1, 0, -1):
                        known[k] = known[k] * s + known[k - 1] * agrees[other]
                    known[0] = known[0] * s
            weights = [factorial(k) * factorial(n - 1 - k) / factorial(n) for k in range(n)]
            step = value * (agrees[f] - share) * sum(w * x for w, x in zip(weights, known))
            out[f] = out.get(f, 0.0) + step
    return mean, out


def contributions(model: Boosted, df: DataFrame, key: str) -> DataFrame:
    """``key``, ``_mean`` and for each input column its Shapley value: they add up to the row's margin. The indicators of a
    categorical column count as one. Computed in Arrow batches, row by row independent of the others."""
    columns = list(dict.fromkeys([c for c in model.inputs if c not in _category_columns(model.categories)] + list(model.categories)))
    owner = {c: c for c in columns} | {f"{c}={v}": c for c, values in model.categories.items() for v in values}
    trees, base, inputs = model.trees, model.base, model.inputs

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            values = {c: np.array(frame[c].to_numpy(zero_copy_only=False), dtype=np.float64) for c in inputs}
            total, parts = base, {c: np.zeros(frame.num_rows) for c in columns}
            for tree in trees:
                mean, found = tree_values(tree, values, frame.num_rows)
                total += mean
                for f, x in found.items():
                    parts[owner[f]] += x
            yield pa.RecordBatch.from_arrays([frame[key], pa.array(np.full(frame.num_rows, total)), *[pa.array(parts[c]) for c in columns]], names=[key, "_mean", *columns])

    wide = with_categories(df, model.categories).select(F.col(key).alias("_k"), *[F.col(f"`{c}`").cast("double").alias(c) for c in inputs])
    schema = T.StructType([T.StructField("_k", df.schema[key].dataType), T.StructField("_mean", T.DoubleType()), *[T.StructField(c, T.DoubleType()) for c in columns]])
    key_name, key = key, "_k"
    return wide.mapInArrow(run, schema).withColumnRenamed("_k", key_name)


def explain(model: Boosted, df: DataFrame, key: str) -> DataFrame:
    """Mean absolute Shapley value of each input column over the rows of df."""
    parts = contributions(model, df, key)
    columns = [c for c in parts.columns if c not in (key, "_mean")]
    means = parts.agg(*[F.avg(F.abs(F.col(f"`{c}`"))).alias(c) for c in columns])
    return means.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("attribution")) for c in columns])).alias("e")).select("e.*")


def _log_odds(p: float) -> float:
    return log(p / (1 - p))
