import pytest
from pyspark.sql import types as T

from smelter.operators.badrows import number_lines, split_bad_records, tag_position
from smelter.sources import bronze


def put(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.fixture
def raw(tmp_path):
    put(tmp_path / "entity=checkin" / "dt=2024-01-01", "a.json", '{"business_id": "b1", "date": "2024-01-01", "more": 1}', "", "{bad", "[1]", "7")
    put(tmp_path / "entity=checkin" / "dt=2024-01-02", "b.json", '{"business_id": "b2"}')
    put(tmp_path / "entity=review" / "dt=2024-01-01", "r.json", '{"review_id": "r", "stars": "x", "useful": 1}',
        '{"review_id": "s", "stars": 4.7, "user_id": "u", "business_id": "b"}')
    return str(tmp_path)


def test_good_rows_keep_partition_and_file(spark, raw):
    rows = sorted(bronze.read_bronze(spark, raw, "checkin").collect())
    assert [(r.business_id, r.date, r.dt) for r in rows] == [("b1", "2024-01-01", "2024-01-01"), ("b2", None, "2024-01-02")]
    assert rows[0]._source_file.endswith("a.json") and dict(bronze.read_bronze(spark, raw, "checkin").dtypes)["dt"] == "string"


def test_only_the_batch_folder_is_listed(spark, raw):
    df = bronze.read_bronze(spark, raw, "checkin", "2024-01-02")
    assert [f.rsplit("/", 2)[-2:] for f in bronze.bronze_lines(spark, raw, "checkin", "2024-01-02").inputFiles()] == [["dt=2024-01-02", "b.json"]]
    assert [r.dt for r in df.collect()] == ["2024-01-02"]


def test_landing_needs_no_sort(spark, raw, tmp_path):
    refused = bronze.land_batch(spark, raw, str(tmp_path / "lake"), "checkin", "2024-01-01")
    assert refused == 3
    assert bronze.read_landed(spark, str(tmp_path / "lake"), "checkin", "2024-01-01").count() == 1
    assert bronze.read_landed(spark, str(tmp_path / "lake"), "checkin", "2024-01-01", bad=True).count() == 4
    dead = {r._line: (r._source_file.rsplit("/", 1)[1], r.line_number) for r in bronze.read_landed(spark, str(tmp_path / "lake"), "checkin", "2024-01-01", bad=True).collect()}
    assert dead == {"": ("a.json", 2), "{bad": ("a.json", 3), "[1]": ("a.json", 4), "7": ("a.json", 5)}
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 2


def test_bad_lines_say_why(spark, raw):
    bad = bronze.split_bronze(spark, raw, "checkin")[1]
    assert {(r.line, r.error) for r in bad.collect()} == {
        ("", "Empty line"), ("{bad", "JSON parse error"), ("[1]", "Expected JSON object"), ("7", "Expected JSON object")}
    bad = bronze.split_bronze(spark, raw, "review")[1]
    assert [r.error for r in bad.collect()] == ["Type mismatch"]


def test_bad_record_cap(spark, raw):
    assert bronze.check_bad_records(spark, raw, "checkin") == 3  # blank lines do not count
    with pytest.raises(bronze.TooManyBadRecords):
        bronze.check_bad_records(spark, raw, "checkin", limit=2)


def test_inferred_schema(spark, raw):
    rows = bronze.read_bronze(spark, raw, "checkin", "2024-01-02", infer=True)
    assert set(rows.columns) == {"business_id", "date", "more", "dt", "_source_file"}


def test_extra_column(spark, raw):
    rows = bronze.read_bronze(spark, raw, "checkin", "2024-01-01", extra="more bigint")
    assert rows.first().more == 1


def test_line_numbers_across_splits(spark, tmp_path):
    lines = [f'{{"k": {i}}}' if i % 7 else f"broken {i}" for i in range(1, 2001)]
    put(tmp_path, "one.json", *lines)
    put(tmp_path, "two.json", "bad first", '{"k": 1}', "bad third")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        scan = tag_position(spark.read.text(str(tmp_path)))
        assert scan.select("_file", "_start").distinct().count() > 4
        got = number_lines(scan, scan.where("value not like '{%'")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {(r.value, r.line_number) for r in got if r.source_file.endswith("one.json")} == {
        (f"broken {i}", i) for i in range(7, 2001, 7)}
    assert {(r.value, r.line_number) for r in got if r.source_file.endswith("two.json")} == {("bad first", 1), ("bad third", 3)}


def test_nested_json_stays_text(spark):
    lines = spark.createDataFrame([('{"a": {"b": [1, 2]}, "n": 1}',)], "value string")
    good, bad = split_bad_records(lines, T.StructType.fromDDL("a string, n bigint"))
    assert good.first().a == '{"b":[1,2]}' and bad.count() == 0


def test_discovery(spark, raw, tmp_path):
    assert bronze.available_entities(spark, raw) == ["review", "checkin"]
    with pytest.raises(FileNotFoundError):
        bronze.available_entities(spark, str(tmp_path / "nowhere"))


def test_write_and_paths(spark, tmp_path):
    root = str(tmp_path)
    for _ in range(2):
        bronze.write_bronze(spark.createDataFrame([("b", "x")], "business_id string, date string"), root, "checkin", "2024-05-06T20:00:00")
    assert [r.dt for r in bronze.read_bronze(spark, root, "checkin").collect()] == ["2024-05-07"]
    assert bronze.partition_path("r", "tip", "2024-01-15T01:02:03") == "r/entity=tip/dt=2024-01-15/data_20240115_010203.json"
    assert bronze.sample_lines(spark, bronze.entity_path(root, "checkin"), 1).count() == 1
