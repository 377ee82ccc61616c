"""Tables on storage: what a batch rewrites, and that repeating a batch is harmless."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from smelter.plans import pipeline, silver
from smelter.sources import bronze, growth, keyindex, tables, versions
from tests import raw_batches
from tests.test_merge import A, B, T, businesses, reviews


def snapshot(folder):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")}


@pytest.fixture
def root(tmp_path, spark):
    tables.ensure_silver_tables(spark, str(tmp_path))
    return str(tmp_path)


def apply_businesses(spark, root, batch, i):
    stage, _ = silver.stage_businesses(businesses(spark, *batch))
    tables.apply_scd2(spark, root, "business", stage, T[i], batch=f"b{i}")


def state(spark, root):
    return sorted((r.business_id, r.name, r.is_current, r.valid_from, r.valid_to) for r in tables.read_silver(spark, root, "business").collect())


def test_absent_tables_are_empty_with_schema(spark, root):
    for entity in ("business", "review", "user", "checkin", "tip"):
        df = tables.read_silver(spark, root, entity)
        assert df.count() == 0 and df.dtypes == tables.empty_table(spark, entity).dtypes


def test_dimension_history_is_never_rewritten(spark, root):
    apply_businesses(spark, root, [A, ("m", "M", 1, 1.0, 0.0)], 0)
    apply_businesses(spark, root, [B], 1)
    path = os.path.join(tables.silver_path(root, "business"), "is_current=false")
    before = snapshot(path)
    apply_businesses(spark, root, [A], 2)
    after = snapshot(path)
    assert before and before.items() <= after.items() and len(after) > len(before)
    assert [(k, n, c) for k, n, c, *_ in state(spark, root)] == [
        ("k", "A", False), ("k", "A", True), ("k", "B", False), ("m", "M", True)]


def test_dimension_batch_can_be_repeated(spark, root):
    apply_businesses(spark, root, [A], 0)
    apply_businesses(spark, root, [B], 1)
    want = state(spark, root)
    apply_businesses(spark, root, [B], 1)
    assert state(spark, root) == want


def test_dimension_batch_repeated_after_a_crash_between_its_writes(spark, root, monkeypatch):
    apply_businesses(spark, root, [A], 0)
    real, calls = tables._overwrite_parts, []

    def dies_second(*args, **kw):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("driver lost")
        real(*args, **kw)

    monkeypatch.setattr(tables, "_overwrite_parts", dies_second)
    with pytest.raises(RuntimeError):
        apply_businesses(spark, root, [B], 1)
    monkeypatch.setattr(tables, "_overwrite_parts", real)
    apply_businesses(spark, root, [B], 1)
    assert [(n, c) for _, n, c, *_ in state(spark, root)] == [("A", False), ("B", True)]


def test_corrected_batch_keeps_the_versions_its_first_run_closed(spark, root):
    apply_businesses(spark, root, [A, ("m", "M", 1, 1.0, 0.0)], 0)
    for i, name in ((1, "B"), (2, "C")):
        stage, _ = silver.stage_businesses(businesses(spark, ("k", name, 1, 1.0, 0.0)))
        tables.apply_scd2(spark, root, "business", stage, T[i], batch="same")
    assert [(n, c, f.day, t.year) for k, n, c, f, t in state(spark, root) if k == "k"] == [
        ("A", False, 1, 2024), ("B", False, 2, 2024), ("C", True, 3, 9999)]


def test_repeat_at_another_time_after_a_crash_leaves_no_double(spark, root, monkeypatch):
    apply_businesses(spark, root, [A], 0)
    stage, _ = silver.stage_businesses(businesses(spark, B))
    real = tables._overwrite_parts

    calls = []

    def only_history(*args, **kw):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("driver lost")
        real(*args, **kw)

    monkeypatch.setattr(tables, "_overwrite_parts", only_history)
    with pytest.raises(RuntimeError):
        tables.apply_scd2(spark, root, "business", stage, T[1], batch="b1")
    monkeypatch.setattr(tables, "_overwrite_parts", real)
    tables.apply_scd2(spark, root, "business", stage, T[2], batch="b1")
    assert [(n, c, t.day) for _, n, c, _, t in state(spark, root)] == [("A", False, 3), ("B", True, 31)]


def test_one_row_rewrites_one_bucket(spark, root):
    many = [(f"k{i}", "N", 1, 1.0, 0.0) for i in range(400)]
    apply_businesses(spark, root, many, 0)
    path = os.path.join(tables.silver_path(root, "business"), "is_current=true", "batch=current")
    before = snapshot(path)
    assert len(before) > 50  # nearly all of the 64 buckets
    stage, _ = silver.stage_businesses(businesses(spark, ("k7", "other", 1, 1.0, 0.0)))
    touched = tables.apply_scd2(spark, root, "business", stage, T[1], batch="b1")
    changed = set(before.items()) ^ set(snapshot(path).items())
    assert len(touched) == 1 and {os.path.basename(os.path.dirname(f)) for f, _ in changed} == {f"bucket={touched[0]}"}
    assert {(r.name, r.is_current) for r in tables.read_silver(spark, root, "business").where("business_id = 'k7'").collect()} == {("N", False), ("other", True)}
    assert tables.read_silver(spark, root, "business").count() == 401
    plan = tables.read_silver(spark, root, "business", buckets=touched)._jdf.queryExecution().executedPlan().toString()
    assert "bucket#" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    files = tables.read_silver(spark, root, "business", buckets=touched).select(F.input_file_name()).distinct().collect()
    assert files and all(f"bucket={touched[0]}/" in r[0] for r in files)


def test_empty_batch_writes_nothing(spark, root):
    stage, _ = silver.stage_businesses(businesses(spark, A))
    assert tables.apply_scd2(spark, root, "business", stage.where("false"), T[0], batch="b0") == []
    assert not snapshot(tables.silver_path(root, "business"))


def test_bucket_count_is_fixed_with_the_table(spark, tmp_path):
    tables.ensure_silver_tables(spark, str(tmp_path), buckets=3)
    tables.ensure_silver_tables(spark, str(tmp_path), buckets=9)
    assert tables.table_properties(spark, str(tmp_path), "user") == {"buckets": 3}
    tables.reset_table(spark, str(tmp_path), "user")
    assert tables.table_properties(spark, str(tmp_path), "user") == {"buckets": 3}


def load_reviews(spark, root, i, *rows):
    stage, _ = silver.stage_reviews(reviews(spark, *rows))
    return tables.apply_scd1(spark, root, "review", stage, silver.REVIEW_UPDATES, T[i])


def test_only_touched_months_are_rewritten(spark, root):
    load_reviews(spark, root, 0, ("r1", 1.0, "a", "2024-01-05"), ("r2", 2.0, "b", "2024-02-05"), ("r3", 3.0, "c", None))
    path = tables.silver_path(root, "review")
    january = snapshot(os.path.join(path, "month=2024-01-01"))
    # r2 says March now, but its first date rules: February is touched, and March only by the new r4.
    months = load_reviews(spark, root, 1, ("r2", 5.0, "bb", "2024-03-09"), ("r4", 4.0, "d", "2024-03-01"), ("r3", 1.0, "cc", None))
    assert set(months) == {dt.date(2024, 2, 1), dt.date(2024, 3, 1), None}
    assert january and snapshot(os.path.join(path, "month=2024-01-01")) == january
    rows = {r.review_id: (r.stars, r.text, r.date) for r in tables.read_silver(spark, root, "review").collect()}
    assert rows == {"r1": (1, "a", dt.date(2024, 1, 5)), "r2": (5, "bb", dt.date(2024, 2, 5)), "r3": (1, "cc", None),
                    "r4": (4, "d", dt.date(2024, 3, 1))}
    assert [r.review_id for r in tables.read_silver(spark, root, "review", months=["2024-03-01"]).collect()] == ["r4"]


def test_month_filter_prunes_partitions(spark, root):
    load_reviews(spark, root, 0, ("r1", 1.0, "a", "2024-01-05"), ("r2", 2.0, "b", "2024-02-05"))
    plan = tables.read_silver(spark, root, "review", months=["2024-02-01"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan or "PartitionFilters: [month" in plan


def test_reading_current_skips_history(spark, root):
    apply_businesses(spark, root, [A], 0)
    apply_businesses(spark, root, [B], 1)
    plan = tables.read_silver(spark, root, "business").where("is_current")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_current" in plan


def test_checkins_append_once(spark, root):
    raw = spark.createDataFrame([("b", "2024-01-01 10:00:00, 2024-01-02")], "business_id string, date string")
    for i in range(2):
        tables.apply_insert_only(spark, root, "checkin", silver.stage_checkins(raw)[0], T[i])
    assert tables.read_silver(spark, root, "checkin").count() == 2


def checkins(spark, *rows):
    return silver.stage_checkins(spark.createDataFrame(list(rows), "business_id string, date string"))[0]


def test_only_months_that_may_hold_a_key_are_read(spark, root):
    days = ", ".join(f"2024-{m:02d}-03 10:00:00" for m in range(1, 7))
    tables.apply_insert_only(spark, root, "checkin", checkins(spark, *[(f"b{i}", days) for i in range(20)]), T[0])
    path = tables.silver_path(root, "checkin")
    before = snapshot(path)
    # A new key in January, one that is known in March and a month the table lacks.
    stage = checkins(spark, ("new", "2024-01-03 10:00:00"), ("b4", "2024-03-03 10:00:00"), ("b4", "2024-09-01"))
    dated = stage.withColumn("month", F.to_date(F.trunc("date", "MM")))
    coming = [dt.date(2024, m, 1) for m in (1, 3, 9)]
    possible = tables.possible_keys(spark, root, "checkin", keyindex.probes(dated, ["business_id", "date"], keyindex.BLOCKS), coming)
    held, months = tables.held_keys(spark, root, "checkin", possible)
    assert months == [dt.date(2024, 3, 1)]
    assert [r.business_id for r in held.collect()] == ["b4"]
    plan = held._jdf.queryExecution().executedPlan().toString()
    scans = {x.split("PartitionFilters: ")[1].split("PushedFilters")[0] for x in plan.splitlines() if "ReadSchema: struct<business_id:string,date:timestamp>" in x}
    assert len(scans) == 1 and "2024-03-01" in str(scans) and "2024-01-01" not in str(scans) and "2024-09-01" not in str(scans)
    assert sorted(tables.apply_insert_only(spark, root, "checkin", stage, T[1])) == coming
    after = snapshot(path)
    assert before.items() <= after.items() and len(after) == len(before) + 2
    assert tables.read_silver(spark, root, "checkin").count() == 122
    tables.compact_index(spark, root, "checkin")
    assert tables.apply_insert_only(spark, root, "checkin", stage, T[2])
    assert tables.read_silver(spark, root, "checkin").count() == 122


def test_insert_only_after_a_crash_between_index_and_rows(spark, root, monkeypatch):
    stage, real = checkins(spark, ("a", "2024-01-01, 2024-02-01")), tables._overwrite_parts

    def dies(*args, **kw):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(tables, "_overwrite_parts", dies)
    with pytest.raises(RuntimeError):
        tables.apply_insert_only(spark, root, "checkin", stage, T[0])
    monkeypatch.setattr(tables, "_overwrite_parts", real)
    for i in range(2):
        tables.apply_insert_only(spark, root, "checkin", stage, T[i])
    assert tables.read_silver(spark, root, "checkin").count() == 2


def test_key_index_never_misses_and_seldom_errs(spark):
    keyed = keyindex.probes(spark.range(20000).select(F.col("id").alias("k"), F.lit("2024-01-01").cast("date").alias("month")), ["k"], 512)
    known, others = keyed.where("k % 2 = 0"), keyed.where("k % 2 = 1")
    parts = keyindex.filters(known.where("k < 10000")).unionByName(keyindex.filters(known.where("k >= 10000")))
    for index in (parts, keyindex.merged(parts)):
        assert keyindex.possible(known, index, ["k"]).count() == 10000
        assert keyindex.possible(others, index, ["k"]).count() < 200
    assert keyindex.merged(parts).count() <= 512 < parts.count()


def test_gold_and_file_overwrite(spark, root, tmp_path):
    tables.write_gold(spark.range(3), root, "g")
    tables.write_gold(spark.range(2), root, "g")
    assert tables.read_gold(spark, root, "g").count() == 2
    copy = tables.overwrite_from_files(spark, versions.current_path(spark, tables.gold_path(root, "g")), str(tmp_path / "copy"))
    assert copy.count() == 2


def test_readers_see_whole_versions_only(spark, root):
    tables.write_gold(spark.range(1000).repartition(4), root, "g")
    reader = tables.read_gold(spark, root, "g")  # begun before the rewrite
    tables.write_gold(spark.range(7), root, "g")
    assert reader.count() == 1000 and tables.read_gold(spark, root, "g").count() == 7
    path = tables.gold_path(root, "g")
    spark.range(3).write.parquet(versions.data_path(path, "killed"))  # a writer that died before its pointer
    os.makedirs(os.path.join(path, "pointers"), exist_ok=True)
    open(os.path.join(path, "pointers", "_half"), "w").write('{"vers')
    assert tables.read_gold(spark, root, "g").count() == 7
    failing = spark.range(10).select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception):
        tables.write_gold(failing, root, "g")
    assert tables.read_gold(spark, root, "g").count() == 7
    with pytest.raises(versions.Conflict):
        versions.publish(spark, path, {"version": "x"}, after=0)
    tables.write_gold(spark.range(8), root, "g")
    versions.vacuum(spark, path, keep=1)
    assert len(os.listdir(os.path.join(path, "data"))) == 1 and tables.read_gold(spark, root, "g").count() == 8
    with pytest.raises(FileNotFoundError):
        tables.read_gold(spark, root, "none")


def test_reset(spark, root):
    apply_businesses(spark, root, [A], 0)
    schema = tables.reset_table(spark, root, "business")
    assert tables.read_silver(spark, root, "business").count() == 0 and "is_current" in schema.names


def test_two_batches_through_all_layers(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "lake")
    small = {"business": 30, "user": 30, "review": 80, "checkin": 20, "tip": 20}
    raw_batches.write(raw, "2026-03-31", small, "a")
    raw_batches.write(raw, "2026-04-01", small, "b")
    reports = [pipeline.run_batch(spark, raw, root, d, f"{d} 05:00:00") for d in ("2026-03-31", "2026-04-01")]
    assert all(r["silver"][e]["duplicate_keys"] == 0 for r in reports for e in r["silver"])
    assert reports[0]["silver"]["review"]["rows_checked"] == 80
    for entity, key in raw_batches.SHARED.items():
        mine = tables.read_silver(spark, root, entity).where(F.col(f"{entity}_id") == key)
        assert sorted(r.is_current for r in mine.collect()) == [False, True]
    tags = tables.read_silver(spark, root, "business").where("data_quality_tag is not null")
    assert tags.count() == 2  # the grown column is loaded
    assert tables.read_gold(spark, root, "business_performance").count() == 63  # 32 keys each, one shared
    assert tables.read_gold(spark, root, "ml_features_star_prediction").count() == 160
    assert pipeline.standing_checks(spark, root, "2026-04-01 06:00:00").where("not passed").count() == 0
    text = tables.read_silver(spark, root, "review").first().text
    assert "[EMAIL]" in text and "[PHONE]" in text


def test_unknown_fields_are_kept_and_their_types_grow(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "lake")
    review = {"review_id": "r1", "user_id": "u", "business_id": "b", "stars": 4.0, "text": "Ann Lee, 555-123-4567", "date": "2024-01-05"}
    batches = {"2026-03-31": [{**review, "photos": 3, "source": {"app": "web"}}, {**review, "review_id": "r2", "photos": None, "Stars": 9}],
               "2026-04-01": [{**review, "photos": 2.5}, {**review, "review_id": "r3", "bad name": 1, "seen": True}]}
    shop = {"business_id": "b", "name": "Shop", "city": "Here", "stars": 3.0, "review_count": 1, "is_open": 1}
    shops = {"2026-03-31": [shop], "2026-04-01": [{**shop, "wifi": True, "review_count": 2}]}
    for day in batches:
        for entity, rows in (("review", batches[day]), ("business", shops[day])):
            folder = tmp_path / "raw" / f"entity={entity}" / f"dt={day}"
            folder.mkdir(parents=True)
            (folder / "x.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
    for day in batches:
        pipeline.run_bronze(spark, raw, root, day)
        written = pipeline.run_silver(spark, root, day, f"{day} 05:00:00")
        assert written["review"] == [dt.date(2024, 1, 1)] and len(written["business"]) == 1
        found = pipeline.validate_silver(spark, root, f"{day} 05:00:00", ("review", "business"), written)
        assert found["review"]["rows_checked"] == 2 and found["business"]["duplicate_keys"] == 0
    table = tables.read_silver(spark, root, "review")
    assert dict(table.dtypes)["photos"] == "double" and dict(table.dtypes)["seen"] == "boolean"
    assert "Stars" not in table.columns and "bad name" not in table.columns
    rows = {r.review_id: r for r in table.collect()}
    assert (rows["r1"].photos, rows["r2"].photos, rows["r3"].seen) == (2.5, None, True)
    assert rows["r1"].source is None  # the newer row of the key lacks it
    assert sorted((r.is_current, r.wifi) for r in tables.read_silver(spark, root, "business").collect()) == [(False, None), (True, True)]
    log = spark.read.parquet(growth.change_log_path(root)).where("table = 'reviews'").orderBy("batch").collect()
    assert [sorted(r.new_columns) for r in log] == [["Stars bigint", "photos bigint", "source json"], ["bad name bigint", "seen boolean"]]
    assert [r.type_changes for r in log] == [[], ["photos: bigint -> double"]] and len({r.version for r in log}) == 2
    pii = spark.read.parquet(pipeline.pii_findings_path(root, "review", "2026-04-01"))
    assert {r.info_type: r.rows_found for r in pii.where("column = 'text'").collect()}["PHONE_NUMBER"] == 2


def test_keys_that_are_data_are_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(growth, "MOST_FIELDS", 3)
    lines = spark.createDataFrame([(json.dumps({f"k{i}": 1}),) for i in range(5)], "value string")
    with pytest.raises(growth.TooManyFields):
        growth.learn(spark, str(tmp_path), "tip", lines, "2024-01-01 00:00:00", "b")


def test_batch_with_bad_lines_and_rows_without_key(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "lake")
    folder = tmp_path / "raw" / "entity=tip" / "dt=2026-03-31"
    folder.mkdir(parents=True)
    tip = '{"user_id": "u", "business_id": "b", "date": "%s"}\n'
    (folder / "t.json").write_text(tip % "2026-03-01" + tip % "soon" + "{bad\n\n" + tip % "2026-03-01")
    report = pipeline.run_batch(spark, raw, root, "2026-03-31", "2026-03-31 05:00:00")
    assert report["bronze"] == {"tip": {"bad_records": 1, "null_rows": 0, "duplicate_keys": 1}}
    assert tables.read_silver(spark, root, "tip").count() == 1
    assert spark.read.parquet(root + "/quarantine/entity=tip/dt=2026-03-31").first().date == "soon"
    with pytest.raises(bronze.TooManyBadRecords):
        pipeline.run_bronze(spark, raw, root, "2026-03-31", max_bad_records=0)


def test_month_parts_are_not_one_file_per_task(spark, root):
    rows = [(f"r{i}", 1.0, "a", f"2024-{i % 3 + 1:02d}-05") for i in range(600)]
    load_reviews(spark, root, 0, *rows)
    assert len(snapshot(tables.silver_path(root, "review"))) == 3


def test_failed_validation_stops_before_gold(spark, tmp_path, monkeypatch):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "lake")
    raw_batches.write(raw, "2026-03-31", {"business": 5, "user": 5, "review": 5, "checkin": 5, "tip": 5})
    monkeypatch.setattr(pipeline, "check_single_active", lambda df, key, in_batch: df.limit(1))
    with pytest.raises(pipeline.ValidationFailed):
        pipeline.run_batch(spark, raw, root, "2026-03-31", "2026-03-31 05:00:00")
    assert not tables.path_exists(spark, tables.gold_path(root, "business_performance"))
