"""Checks, audit, personal data, schema growth, run logs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter import schemas
from smelter.operators import audit, evolution, pii, quality, runlog
from smelter.operators.flatten import flatten, json_text


def results(df):
    return {r["check"]: (r["observed"], r["passed"], r["rows_checked"]) for r in df.collect()}


def test_checks(spark):
    df = spark.createDataFrame(
        [("a", 1, True), ("a", 2, False), ("b", 9, True), (None, None, True), (None, 3, True)], "k string, stars int, is_current boolean")
    df = df.withColumn("at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    got = results(quality.run_checks(df, "t", [
        quality.row_count(), quality.missing("k"), quality.invalid("stars", [1, 2, 3, 4, 5]), quality.duplicate("k"),
        quality.duplicate("k", "is_current"), quality.freshness("at", 24, "2024-01-01 23:59:00"), quality.freshness("at", 24, "2024-01-02 00:00:00")]))
    assert got["row_count >= 1"] == (5.0, True, 5)
    assert got["missing_count(k)"] == (2.0, False, 5) and got["invalid_count(stars)"] == (1.0, False, 5)
    assert got["duplicate_count(k)"] == (1.0, False, 5) and got["duplicate_count(k) where is_current"] == (0.0, True, 4)
    ages = quality.run_checks(df, "t", [quality.freshness("at", 24, "2024-01-02 00:00:00")])
    assert [r.passed for r in ages.collect()] == [False]


def test_empty_table_fails_its_checks_without_error(spark):
    df = spark.createDataFrame([], "k string, at timestamp")
    got = results(quality.run_checks(df, "t", [quality.row_count(), quality.freshness("at", 24, "2024-01-01"), quality.duplicate("k")]))
    assert [got[n][1] for n in got] == [False, False, True]


def test_gate(spark):
    df = spark.range(3)
    soft = quality.required_columns(df, "t", ["id", "name"])
    assert [r["level"] for r in quality.raise_if_failed(soft)] == ["warn"]
    with pytest.raises(quality.CheckFailed, match="row_count"):
        quality.raise_if_failed(quality.run_checks(df, "t", [quality.row_count(4)]))


def test_bronze_stats(spark):
    df = spark.createDataFrame([("u", "b", "d"), ("u", "b", "d"), ("u", None, "d"), (None, "b", None), ("u", "b", None), ("u", "b", None)],
                               "user_id string, business_id string, date string")
    row = quality.bronze_key_stats(df, ["user_id", "business_id", "date"], ["user_id", "business_id"]).first()
    assert (row.total_nulls, row.total_duplicates) == (2, 1)


def test_batch_checks(spark):
    df = spark.createDataFrame([("a", True, 1), ("a", True, 2), ("b", True, 1), ("b", True, 1), ("c", True, 2), ("c", False, 2), (None, True, 2)],
                               "k string, is_current boolean, batch int")
    assert [(r.k, r.active_count) for r in quality.check_single_active(df, "k", F.col("batch") == 2).collect()] == [("a", 2)]
    row = quality.check_fact_keys(df, ["k", "batch"], F.col("batch") > 0).first()
    assert (row.null_keys, row.duplicate_keys, row.rows_checked) == (1, 2, 7)
    assert tuple(quality.check_null_keys(df, ["k"], F.col("batch") == 2).first()) == (1, 4)
    assert tuple(quality.check_null_keys(df, ["k"], F.col("batch") == 9).first()) == (0, 0)


def test_audit(spark):
    dim = spark.createDataFrame([("a", None, True), ("a", "x", False), ("b", "y", True)], "business_id string, name string, is_current boolean")
    dim = dim.withColumn("_processed_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    report = audit.audit_report({"Silver": {"b": dim, "x$y": dim}, "Gold": {"g": spark.range(9)}}, dim, dim, "2024-01-01 07:30:00")
    assert [(r.layer, r.entity, r.row_count) for r in report["volume"].collect()] == [("Gold", "g", 9), ("Silver", "b", 3)]
    assert [(r.active_records, r.history_records, r.overlap_pct) for r in report["scd2_health"].collect()] == [(2, 1, 33.33)] * 2
    assert [(r.hours_since_sync, r.status[2:]) for r in report["latency"].collect()] == [(7, "DELAYED")]
    assert tuple(report["keys"].first())[2:] == (0, 1, 2)


def test_pii_counts_by_hand(spark):
    df = spark.createDataFrame([
        ("Ann Lee lives at 12 Oak St, ann@x.org", "ip 10.0.0.1"), ("4111 1111 1111 1111 and 4111 1111 1111 1112", None),
        ("123-45-6789 born 1990-01-02 http://a.b/c", "x")], "a string, b string")
    got = {(r["column"], r["info_type"]): (r["rows_found"], r["findings"], r["rows_seen"])
           for r in pii.inspect_pii(df, ["a", "b"], min_likelihood="possible").collect()}
    assert got["a", "EMAIL_ADDRESS"] == got["a", "STREET_ADDRESS"] == got["a", "URL"] == (1, 1, 3)
    assert got["a", "PERSON_NAME"] == (1, 2, 3)  # a hint only: 'Oak St' looks like a name
    assert got["a", "CREDIT_CARD_NUMBER"] == (1, 1, 3)  # the second number fails its check digit
    assert got["a", "US_SOCIAL_SECURITY_NUMBER"] == got["a", "DATE_OF_BIRTH"] == got["b", "IP_ADDRESS"] == (1, 1, 3)
    assert got["b", "URL"] == (0, 0, 3)
    assert pii.inspect_pii(df, ["a"]).where("likelihood = 'possible'").count() == 0


def test_mask_and_tokens(spark, tmp_path):
    df = spark.createDataFrame([("Zoë\nx", "p"), ("Zoë\nx", None), ("", "q")], "a string, b string")
    assert [r.a for r in pii.deidentify(df, ["a"]).collect()] == ["*****", "*****", ""]
    keys = {"key": b"k" * 32, "iv_key": b"other"}
    sealed = pii.deidentify(df, ["a", "b"], mode="token", **keys)
    rows = sealed.collect()
    assert rows[0].a == rows[1].a != rows[2].a and rows[1].b is None and rows[0].a.startswith("PII_TOKEN:")
    assert pii.reidentify(sealed, ["a", "b"], keys["key"]).collect() == df.collect()
    assert {r.a for r in pii.reidentify(sealed, ["a"], b"w" * 32).collect()} == {None}
    with pytest.raises(ValueError):
        pii.deidentify(df, ["a"], mode="token")
    copy = pii.deidentify_table(df, ["a"], str(tmp_path / "copy"), str(tmp_path / "found"))
    assert copy.count() == 3 and spark.read.parquet(str(tmp_path / "found")).count() > 0


def test_secure_view_uses_field_metadata(spark):
    df = spark.createDataFrame([], schemas.get_schema("user"))
    assert pii.columns_marked_pii(df) == schemas.pii_columns("user") == ["name", "friends"]
    assert pii.secure_view(df, privileged=True) is df
    seen = pii.secure_view(spark.createDataFrame([("u", "n")], "user_id string, name string"), ["name"])
    assert [tuple(r) for r in seen.collect()] == [("u", None)] and schemas.pii_columns("other") == []


def test_registry():
    assert schemas.partition_config("tip").month_of == "date" and schemas.partition_config("x") is None
    with pytest.raises(ValueError):
        schemas.get_schema("menu")
    assert set(schemas.SCHEMA_VERSIONS) == set(schemas.ENTITIES)


def test_flatten(spark):
    df = spark.createDataFrame([("v",)], "v string").select(
        F.struct(F.lit(1).alias("b"), F.struct(F.lit(2).alias("d"), F.struct(F.struct(F.lit(3).alias("g")).alias("f")).alias("e")).alias("c")).alias("a"),
        F.array(F.lit(1), F.lit(2)).alias("l"), F.array().cast("array<int>").alias("none"), "v")
    row = flatten(df).first().asDict()
    assert row == {"a_b": 1, "a_c_d": 2, "a_c_e_f": '{"g":3}', "l": "[1,2]", "none": None, "v": "v"}
    assert df.select(json_text(F.col("a.c"), df.schema["a"].dataType["c"].dataType)).first()[0].startswith('{"d":2')


def test_infer_and_diff(spark):
    lines = spark.createDataFrame([('{"a": 1, "b": "x", "c": {"d": 1}, "_m": 1}',), ('{"a": 2.5, "b": 1, "e": true, "f": null}',), ("nonsense",), ("[1]",)],
                                  "value string")
    got = evolution.inferred_schema(evolution.infer_fields(lines))
    assert got == {"a": "double", "b": "string", "c": "json", "_m": "bigint", "e": "boolean", "f": "string"}
    assert evolution.inferred_schema(evolution.infer_fields(lines, strict=True))["b"] == "bigint"
    assert evolution.inferred_schema(evolution.infer_fields(lines, strict=True))["a"] == "string"
    changes = evolution.diff_schema(T.StructType.fromDDL("a bigint, b string, e string, gone int"), got)
    assert set(changes.new_columns) == {("c", "json"), ("f", "string")}
    assert set(changes.type_changes) == {("a", "bigint", "double"), ("e", "string", "boolean")} and not changes.is_compatible
    assert evolution.SchemaChanges(type_changes=[("a", "bigint", "double")]).is_compatible


def test_grow_a_table(spark, tmp_path):
    spark.sql(f"CREATE TABLE grown (a BIGINT) USING parquet LOCATION '{tmp_path / 't'}'")
    try:
        spark.sql("INSERT INTO grown VALUES (1)")
        changes = evolution.SchemaChanges(new_columns=[("b", "double"), ("c", "json")])
        log = str(tmp_path / "log")
        planned = evolution.evolve_table(spark, "grown", changes, dry_run=True, log_path=log, at="2024-01-01 00:00:00")
        assert spark.table("grown").columns == ["a"]
        assert evolution.evolve_table(spark, "grown", changes, log_path=log, at="2024-01-02 00:00:00") == planned
        assert [tuple(r) for r in spark.table("grown").collect()] == [(1, None, None)]
        assert [(r.dry_run, r.new_columns) for r in spark.read.parquet(log).orderBy("timestamp").collect()] == [
            (True, ["b double", "c json"]), (False, ["b double", "c json"])]
    finally:
        spark.sql("DROP TABLE grown")


def test_union_refuses_unsafe_changes(spark):
    with pytest.raises(ValueError):
        evolution.evolve_union(spark.sql("select 'x' as a"), spark.sql("select 1L as a"))
    both = evolution.evolve_union(spark.sql("select 1L as a"), spark.sql("select 2.5D as a, 'n' as b"))
    assert sorted(tuple(r) for r in both.collect()) == [(1.0, None), (2.5, "n")]


def test_run_log(spark):
    lines = spark.createDataFrame([("PIPELINE_FAILURE|dag=d|task=t|execution_date=2024-01-01|error=a|b=c",), ("PIPELINE_RETRY|dag=d|task=t|try_number=2|error=",),
                                   ("PIPELINE_SUCCESS|dag=e|execution_date=2024-01-02",), ("other|dag=d",)], "value string")
    rows = {r.event: r for r in runlog.parse_log(lines).collect()}
    assert rows["PIPELINE_FAILURE"].error == "a|b=c" and rows["PIPELINE_RETRY"].try_number == "2" and rows["PIPELINE_SUCCESS"].task is None
    assert len(rows) == 3
    now = dt.datetime(2024, 1, 1, 12)
    runs = spark.createDataFrame([("d", str(i), "failed" if i % 2 else "success", now - dt.timedelta(minutes=i), now - dt.timedelta(minutes=i)) for i in range(30)],
                                 "dag string, run_id string, state string, start_date timestamp, logical_date timestamp")
    assert [r.run_id for r in runlog.failed_runs(runs, now).collect()] == ["1", "3", "5", "7", "9"]
    assert runlog.failed_runs(runs, now, minutes=60, limit=3).count() == 3 and runlog.failed_runs(runs, now, dag="x").count() == 0


def test_peek_and_creation_time(spark, tmp_path):
    spark.createDataFrame([("x" * 300, 1)], "a string, b int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    count, rows = quality.peek(df)
    assert count == 1 and rows == [{"a": "x" * 100, "b": 1}]
    volume = audit.audit_volume({"Bronze": {"t": df}}, with_created=True).first()
    assert volume.row_count == 1 and volume.created_at is not None
