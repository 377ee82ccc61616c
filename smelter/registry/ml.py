"""Queries: models. Those that train return rows without an SQL counterpart; the arithmetic around them has one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.operators.ranking import calibration, calibration_error, roc_auc
from smelter.plans import boosting, ml
from smelter.registry.gold import feature_table
from smelter.registry.standins import AS_OF, customer_businesses, order_users, rounded, stars, table
from smelter.session import stored


def standardize(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return rounded(ml.standardize(lines, ["l_quantity", "l_extendedprice"]), "l_quantity", "l_extendedprice")


def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Slots of the indicator vector that are set, per part type: one each."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    parts = table(spark, sf, "part").select("p_partkey", "p_type", F.col("p_size").cast("double").alias("p_size"))
    model = Pipeline(stages=ml.feature_stages(["p_size"], ["p_type"], one_hot=True)).fit(parts)
    hot = vector_to_array(F.col("p_type_hot"))
    return model.transform(parts).groupBy("p_type").agg(
        F.count(F.lit(1)).alias("parts"), F.sum(F.aggregate(hot, F.lit(0.0), lambda a, x: a + x)).alias("ones"))


def split_hash(spark: SparkSession, sf: str) -> DataFrame:
    training, held_out = ml.hash_split(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")
    return training.withColumn("part", F.lit("train")).unionByName(held_out.withColumn("part", F.lit("eval")))


def regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """How well the order priority's digit is 'predicted' by the price."""
    scored = table(spark, sf, "orders").select(stars().alias("label"), (F.col("o_totalprice") / 100000).alias("prediction"))
    out = ml.regression_metrics(scored).drop("median_absolute_error")
    return rounded(out, *out.columns)


def classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("c_acctbal") / 20000 + 0.25
    scored = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") < "C", 1).otherwise(0).alias("label"), p.alias("p"), (p > 0.5).cast("int").alias("prediction"))
    out = ml.classification_metrics(scored, "label", "prediction", "p")
    return rounded(out, *out.columns)


def _star_table(spark: SparkSession, sf: str) -> DataFrame:
    """What the rating models read of the feature table, stored once: training alone passes over it several times."""
    columns = ["review_id", "label", *ml.STAR_NUMERIC, *ml.STAR_CATEGORICAL, *ml.LINEAR_SCALED, *ml.LINEAR_PLAIN, *ml.LINEAR_CATEGORICAL]
    return stored(feature_table(spark, sf).select(*dict.fromkeys(columns)))


def star_gbt(spark: SparkSession, sf: str) -> DataFrame:
    features = _star_table(spark, sf)
    return ml.predict_stars(ml.train_stars(features), features)


def star_linear(spark: SparkSession, sf: str) -> DataFrame:
    features = _star_table(spark, sf)
    return ml.evaluate(ml.train_stars(features, kind="linear"), ml.unseen(features, "review_id"), "regression")


def topn_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """The ten lines whose price the boosted stumps miss by most, the worst first."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_extendedprice") / 1000).alias("y"), *LINE_SPLITS)
    model = boosting.train(lines, list(LINE_SPLITS), "y", rounds=STUMP_ROUNDS, depth=1, l2=STUMP_L2, rate=STUMP_RATE, thresholds=LINE_SPLITS)
    scored = ml.worst_predictions(model.transform(lines), "y", 10, "l_orderkey", "l_linenumber", "l_partkey")
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", "y", "prediction_error")


def elite_gbt(spark: SparkSession, sf: str) -> DataFrame:
    frame = ml.elite_frame(order_users(spark, sf), AS_OF)
    return ml.predict_elite(ml.train_elite(frame), frame)


def elite_logistic(spark: SparkSession, sf: str) -> DataFrame:
    frame = ml.elite_frame(order_users(spark, sf), AS_OF)
    return ml.evaluate(ml.train_elite(frame, kind="logistic"), ml.unseen(frame, "user_id"), "classification")


def ranking_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """How well the balance, in steps so that many customers tie, ranks a market segment above the others; only customers
    of the evaluation part count."""
    score = F.floor(F.col("c_acctbal") / 250) / 45 + 0.1
    scored = ml.unseen(table(spark, sf, "customer"), "c_custkey").select(
        F.when(F.col("c_mktsegment") < "C", 1).otherwise(0).alias("label"), score.alias("p"))
    out = spark.createDataFrame([(roc_auc(scored, "label", "p"), calibration_error(scored, "label", "p"))], "roc_auc double, calibration_error double")
    return rounded(out, *out.columns)


def calibration_bins(spark: SparkSession, sf: str) -> DataFrame:
    scored = table(spark, sf, "orders").select((F.col("o_orderstatus") == "F").cast("int").alias("label"), (F.col("o_totalprice") % 1000 / 1000).alias("p"))
    return rounded(calibration(scored, "label", "p"), "mean_probability", "positive_share")


STUMP_ROUNDS, STUMP_L2, STUMP_RATE = 3, 50.0, 0.5
LINE_SPLITS = {"l_quantity": [10.0, 20.0, 30.0, 40.0], "l_discount": [0.025, 0.055, 0.085], "l_tax": [0.015, 0.045]}
CUSTOMER_SPLITS = {"c_acctbal": [0.0, 2500.0, 5000.0, 7500.0], "c_nationkey": [4.5, 9.5, 14.5, 19.5]}


def boosted_stumps(spark: SparkSession, sf: str) -> DataFrame:
    """Line prices by boosted trees of depth one with an L2 term, for every line."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_extendedprice") / 1000).alias("y"), *LINE_SPLITS)
    model = boosting.train(lines, list(LINE_SPLITS), "y", rounds=STUMP_ROUNDS, depth=1, l2=STUMP_L2, rate=STUMP_RATE, thresholds=LINE_SPLITS)
    return rounded(model.transform(lines).select("l_orderkey", "l_linenumber", "l_partkey", "prediction"), "prediction", digits=5)


def boosted_explain(spark: SparkSession, sf: str) -> DataFrame:
    """What each column moves the predicted price of a line by, on average."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_extendedprice") / 1000).alias("y"), *LINE_SPLITS)
    model = boosting.train(lines, list(LINE_SPLITS), "y", rounds=STUMP_ROUNDS, depth=1, l2=STUMP_L2, rate=STUMP_RATE, thresholds=LINE_SPLITS)
    return rounded(boosting.explain(model, lines, "l_orderkey"), "attribution", digits=5)


def boosted_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Is a customer of an early market segment? The same trees with logistic loss."""
    people = table(spark, sf, "customer").withColumn("y", (F.col("c_mktsegment") < "F").cast("int"))
    model = boosting.train(people, list(CUSTOMER_SPLITS), "y", loss="logistic", rounds=2, depth=1, l2=1.0, rate=1.0, thresholds=CUSTOMER_SPLITS)
    return rounded(model.transform(people).select("c_custkey", F.col("probability")[1].alias("p")), "p")


def elite_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ml.elite_frame(order_users(spark, sf), AS_OF), "average_stars")


def segment_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_segments(spark, sf), "avg_stars", "latitude", "longitude")


def _segments(spark: SparkSession, sf: str) -> DataFrame:
    return ml.cluster_frame(customer_businesses(spark, sf).withColumn("name", F.col("city")))


def clusters(spark: SparkSession, sf: str) -> DataFrame:
    frame = _segments(spark, sf)
    return ml.assign_clusters(ml.train_clusters(frame), frame)


def cluster_quality(spark: SparkSession, sf: str) -> DataFrame:
    frame = _segments(spark, sf)
    return ml.evaluate(ml.train_clusters(frame), frame, "clustering")


def explain(spark: SparkSession, sf: str) -> DataFrame:
    features = _star_table(spark, sf)
    return ml.explain(ml.train_stars(features, kind="linear"), features)


QUERIES = {
    "standardize": standardize, "one_hot": one_hot, "split_hash": split_hash, "regression_metrics": regression_metrics,
    "classification_metrics": classification_metrics, "elite_features": elite_features, "segment_features": segment_features, "star_gbt": star_gbt,
    "star_linear": star_linear, "topn_predictions": topn_predictions, "elite_gbt": elite_gbt,
    "elite_logistic": elite_logistic, "ranking_metrics": ranking_metrics, "calibration": calibration_bins,
    "boosted_stumps": boosted_stumps, "boosted_explain": boosted_explain, "boosted_classes": boosted_classes, "clusters": clusters, "cluster_quality": cluster_quality, "explain": explain,
}



def _stumps_sql(source: str, keys: str, splits: dict[str, list[float]], rounds: int, l2: float, rate: float, logistic: bool, out: str) -> str:
    """Boosting by trees of depth one, one step after the other: all thresholds are tried, the best by the gain is taken."""
    base = "ln(avg(y) / (1 - avg(y)))" if logistic else "avg(y)"
    names = {"g": "y - 1 / (1 + exp(-m))", "h": "(1 / (1 + exp(-m))) * (1 - 1 / (1 + exp(-m)))"} if logistic else {"g": "y - m", "h": "1.0"}
    tried = ", ".join(f"('{c}', {i}, CAST({t} AS DOUBLE))" for i, c in enumerate(splits) for t in splits[c])
    ctes = [f"src AS ({source})", f"cut(f, i, t) AS (VALUES {tried})", f"r0 AS (SELECT *, (SELECT {base} FROM src) AS m FROM src)"]
    for n in range(rounds):
        value = "CASE f " + " ".join(f"WHEN '{c}' THEN {c}" for c in splits) + " END"
        ctes += [f"""e{n} AS (SELECT f, i, t, {value} <= t AS at_most, {names['g']} AS g, {names['h']} AS h FROM r{n}, cut)""",
                 f"""s{n} AS (SELECT f, i, t, sum(g) FILTER (at_most) AS gl, sum(h) FILTER (at_most) AS hl, sum(g) FILTER (NOT at_most) AS gr,
                     sum(h) FILTER (NOT at_most) AS hr FROM e{n} GROUP BY 1, 2, 3)""",
                 f"""b{n} AS (SELECT * FROM s{n} ORDER BY gl * gl / (hl + {l2}) + gr * gr / (hr + {l2}) DESC, i, t LIMIT 1)""",
                 f"""r{n + 1} AS (SELECT r{n}.* REPLACE (m + {rate} * CASE WHEN {value} <= t THEN gl / (hl + {l2}) ELSE gr / (hr + {l2}) END AS m) FROM r{n}, b{n})"""]
    if not out:  # per column: the mean size of its leaves' distances from their trees' means
        part = "CASE WHEN f = '{c}' THEN {rate} * (CASE WHEN {c} <= t THEN gl / (hl + {l2}) ELSE gr / (hr + {l2}) END - (hl * gl / (hl + {l2}) + hr * gr / (hr + {l2})) / (hl + hr)) ELSE 0 END"
        sums = {c: " + ".join(f"(SELECT {part.format(c=c, rate=rate, l2=l2)} FROM b{n})" for n in range(rounds)) for c in splits}
        return f"WITH {', '.join(ctes)} " + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(avg(abs({total})), 5) AS attribution FROM src" for c, total in sums.items())
    return f"WITH {', '.join(ctes)} SELECT {keys}, {out} FROM r{rounds}"


ORACLE = {
    "standardize": """
        WITH s AS (SELECT avg(l_quantity) AS qm, stddev_samp(l_quantity) AS qs, avg(l_extendedprice) AS pm,
                       stddev_samp(l_extendedprice) AS ps FROM lineitem)
        SELECT l_orderkey, l_linenumber, round((l_quantity - qm) / qs, 6) AS l_quantity,
            round((l_extendedprice - pm) / ps, 6) AS l_extendedprice FROM lineitem, s""",
    "one_hot": "SELECT p_type, count(*) AS parts, CAST(count(*) AS DOUBLE) AS ones FROM part GROUP BY 1",
    "split_hash": """
        SELECT o_orderkey, o_custkey, CASE WHEN CAST('0x' || left(md5(CAST(o_orderkey AS VARCHAR)), 4) AS INTEGER) < 52428
            THEN 'train' ELSE 'eval' END AS part FROM orders""",
    "ranking_metrics": """
        WITH s AS (SELECT CAST(c_mktsegment < 'C' AS INTEGER) AS y, floor(c_acctbal / 250) / 45 + 0.1 AS p FROM customer
                   WHERE CAST('0x' || left(md5(CAST(c_custkey AS VARCHAR)), 4) AS INTEGER) >= 52428),
        pairs AS (SELECT avg(CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0.0 END) AS auc FROM s a, s b WHERE a.y = 1 AND b.y = 0),
        bins AS (SELECT count(*) AS n, abs(avg(p) - avg(y)) AS gap FROM s GROUP BY least(greatest(floor(p * 10), 0), 9))
        SELECT round(auc, 6) AS roc_auc, (SELECT round(sum(n * gap) / sum(n), 6) FROM bins) AS calibration_error FROM pairs""",
    "calibration": """
        WITH s AS (SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS y, o_totalprice % 1000 / 1000 AS p FROM orders)
        SELECT CAST(least(greatest(floor(p * 10), 0), 9) AS BIGINT) AS bin, count(*) AS rows, round(avg(p), 6) AS mean_probability,
            round(avg(y), 6) AS positive_share FROM s GROUP BY 1""",
    "boosted_stumps": _stumps_sql(
        "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / 1000 AS y, l_quantity, l_discount, l_tax FROM lineitem",
        "l_orderkey, l_linenumber, l_partkey", LINE_SPLITS, STUMP_ROUNDS, STUMP_L2, STUMP_RATE, False, "round(m, 5) AS prediction"),
    "topn_predictions": _stumps_sql(
        "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / 1000 AS y, l_quantity, l_discount, l_tax FROM lineitem",
        "l_orderkey, l_linenumber, l_partkey, y", LINE_SPLITS, STUMP_ROUNDS, STUMP_L2, STUMP_RATE, False, "round(abs(y - m), 5) AS prediction_error")
    + " ORDER BY prediction_error DESC, l_orderkey, l_linenumber, l_partkey LIMIT 10",
    "boosted_explain": _stumps_sql("SELECT l_extendedprice / 1000 AS y, l_quantity, l_discount, l_tax FROM lineitem", "",
                                   LINE_SPLITS, STUMP_ROUNDS, STUMP_L2, STUMP_RATE, False, ""),
    "boosted_classes": _stumps_sql(
        "SELECT c_custkey, CAST(c_mktsegment < 'F' AS INTEGER) AS y, c_acctbal, CAST(c_nationkey AS DOUBLE) AS c_nationkey FROM customer",
        "c_custkey", CUSTOMER_SPLITS, 2, 1.0, 1.0, True, "round(1 / (1 + exp(-m)), 6) AS p"),
    "regression_metrics": """
        WITH s AS (SELECT CAST(left(o_orderpriority, 1) AS DOUBLE) AS y, o_totalprice / 100000 AS p FROM orders)
        SELECT round(avg(abs(y - p)), 6) AS mean_absolute_error, round(avg((y - p) * (y - p)), 6) AS mean_squared_error,
            round(avg(pow(ln(1 + y) - ln(1 + p), 2)), 6) AS mean_squared_log_error,
            round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2_score,
            round(1 - var_pop(y - p) / var_pop(y), 6) AS explained_variance FROM s""",
    "classification_metrics": """
        WITH s AS (SELECT c_mktsegment < 'C' AS y, c_acctbal / 20000 + 0.25 AS p FROM customer),
        c AS (SELECT count(*) FILTER (y AND p > 0.5) AS tp, count(*) FILTER (p > 0.5) AS pp, count(*) FILTER (y) AS pos,
                  count(*) FILTER (y = (p > 0.5)) AS hits, count(*) AS n,
                  avg(-ln(CASE WHEN y THEN p ELSE 1 - p END)) AS ll FROM s)
        SELECT round(tp / pp, 6) AS precision, round(tp / pos, 6) AS recall, round(hits / n, 6) AS accuracy,
            round(2 * tp / (pp + pos), 6) AS f1_score, round(ll, 6) AS log_loss FROM c""",
    "elite_features": """
        WITH o AS (
            SELECT o_custkey, count(*) AS n, CAST(min(o_orderdate) AS DATE) AS first,
                count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o,
                count(*) FILTER (o_orderstatus = 'P') AS p, count(*) FILTER (o_orderpriority LIKE '1%') AS urgent,
                sum(CAST(left(o_orderpriority, 1) AS BIGINT)) AS stars FROM orders GROUP BY 1)
        SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS name, CAST(urgent > 0 AS DOUBLE) AS is_elite,
            n * 12 AS review_count, round(stars / n, 6) AS average_stars, f * 6 AS fans, f AS useful_votes, o AS funny_votes,
            p AS cool_votes, CASE WHEN c_acctbal >= 0 THEN f * 66 + o * 11 ELSE 0 END AS total_compliments,
            CAST(CASE WHEN c_acctbal >= 1000 THEN 3 ELSE 0 END AS BIGINT) AS friend_count,
            CAST(DATE '2024-07-01' - first AS INTEGER) AS days_on_platform
        FROM customer JOIN o ON o_custkey = c_custkey""",
    "segment_features": """
        SELECT CAST(c_custkey AS VARCHAR) AS business_id, n_name AS name, round(c_acctbal / 2000, 6) AS avg_stars,
            CAST(floor(c_acctbal) AS BIGINT) AS review_count, CAST(c_acctbal >= 0 AS DOUBLE) AS is_open_float,
            round(c_acctbal / 100, 6) AS latitude, round(c_acctbal / -50, 6) AS longitude
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
}
