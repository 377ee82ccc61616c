import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from smelter.streaming import weather

AT = "2024-01-01 00:00:00"


def message(**change):
    values = {"city": "Tampa", "temp_c": 20.0, "condition": "Rain", "humidity": 50, "wind_speed": 21.0, "api_timestamp": 1700000000,
              "ingest_timestamp": "2024-01-01T00:00:00+00:00", "source": "MockData"}
    return json.dumps({**values, **change})


def drop(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.fixture
def feed(tmp_path, spark):
    source, sink, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        stream = weather.weather_stream(spark, str(source), max_files=1)
        query = weather.start_weather(stream, sink, checkpoint, trigger=None, processing_time=AT)
        query.awaitTermination()
        return query

    return source, sink, checkpoint, run


def test_good_and_bad_messages(spark, feed):
    source, sink, _, run = feed
    drop(source, "a", message(), message(temp_c=None, wind_speed=20), message(temp_c=10), "{broken", '"text"')
    run()
    rows = sorted(weather.read_weather(spark, sink).collect(), key=lambda r: (r.temp_f is None, r.temp_f))
    assert [(r.temp_f, r.is_windy) for r in rows] == [(50.0, True), (68.0, True), (None, False)]
    assert rows[0]._processed_at == dt.datetime(2024, 1, 1)
    dead = spark.read.parquet(os.path.join(sink, "dead_letters"))
    assert {(r.line, r.error) for r in dead.collect()} == {("{broken", "JSON parse error"), ('"text"', "Expected JSON object")}


def test_restart_reads_only_what_is_new(spark, feed):
    source, sink, _, run = feed
    drop(source, "a", message())
    run()
    drop(source, "b", message(city="Boise"))
    drop(source, "c", message(city="Tucson"))
    run()
    run()
    rows = weather.read_weather(spark, sink)
    assert sorted(r.city for r in rows.collect()) == ["Boise", "Tampa", "Tucson"]
    assert rows.select("batch_id").distinct().count() == 3  # one file per trigger


def test_replayed_batch_writes_nothing_twice(spark, feed):
    source, sink, checkpoint, run = feed
    drop(source, "a", message())
    drop(source, "b", message(city="Boise"))
    run()
    # A crash after the write and before the commit: the last batch is not marked done and comes again.
    for name in os.listdir(os.path.join(checkpoint, "commits")):
        if name.strip(".").startswith("1"):
            os.remove(os.path.join(checkpoint, "commits", name))
    run()
    assert sorted(r.city for r in weather.read_weather(spark, sink).collect()) == ["Boise", "Tampa"]


def test_error_fails_the_query(spark, feed, monkeypatch):
    source, sink, _, run = feed
    drop(source, "a", message())
    monkeypatch.setattr(weather, "enrich_weather", lambda *a: 1 / 0)
    with pytest.raises(Exception):
        run()


def test_new_checkpoint_on_an_old_sink_loses_and_doubles_nothing(spark, feed, tmp_path):
    source, sink, _, run = feed
    drop(source, "a", message(), "{broken")
    drop(source, "b", message(city="Boise"), message(city="Boise", api_timestamp=1700090000))
    run()
    drop(source, "c", message(city="Tucson"), "[1]")
    stream = weather.weather_stream(spark, str(source), max_files=1)
    weather.start_weather(stream, sink, str(tmp_path / "other"), trigger=None, processing_time=AT).awaitTermination()
    rows = weather.read_weather(spark, sink)
    assert sorted(r.city for r in rows.collect()) == ["Boise", "Boise", "Tampa", "Tucson"]
    assert rows.select("run").distinct().count() == 2
    assert {r.day for r in rows.where("city = 'Boise'").collect()} == {dt.date(2023, 11, 14), dt.date(2023, 11, 15)}
    assert sorted(r.line for r in spark.read.parquet(os.path.join(sink, "dead_letters")).collect()) == ["[1]", "{broken"]


def test_late_events_are_dead_letters(spark, tmp_path):
    source, sink = tmp_path / "in", str(tmp_path / "out")
    now = 1700000000
    drop(source, "a", message(api_timestamp=now), message(city="Boise", api_timestamp=now - 9000))  # nothing seen before: not late
    os.utime(source / "a", (1, 1))
    drop(source, "b", message(city="Tucson", api_timestamp=now - 3601), message(city="Reno", api_timestamp=now - 3600))
    stream = weather.weather_stream(spark, str(source), max_files=1)
    weather.start_weather(stream, sink, str(tmp_path / "c"), trigger=None, processing_time=AT, late_after=3600).awaitTermination()
    assert sorted(r.city for r in weather.read_weather(spark, sink).collect()) == ["Boise", "Reno", "Tampa"]
    (dead,) = spark.read.parquet(os.path.join(sink, "dead_letters")).collect()
    assert dead.error == weather.LATE and json.loads(dead.line)["city"] == "Tucson"


def test_redelivered_events_are_kept_once(spark, tmp_path):
    source, sink = tmp_path / "in", str(tmp_path / "out")
    drop(source, "a", message(), message(source="other"), message(api_timestamp=1700000001))
    os.utime(source / "a", (1, 1))
    drop(source, "b", message(temp_c=3.0), message(city="Boise"))
    stream = weather.weather_stream(spark, str(source), max_files=1)
    weather.start_weather(stream, sink, str(tmp_path / "c"), trigger=None, processing_time=AT, once=True).awaitTermination()
    assert sorted((r.city, r.api_timestamp) for r in weather.read_weather(spark, sink).collect()) == [
        ("Boise", 1700000000), ("Tampa", 1700000000), ("Tampa", 1700000001)]


def test_compaction_keeps_every_event_once(spark, feed, monkeypatch):
    source, sink, _, run = feed
    for i, name in enumerate("abcd"):
        drop(source, name, message(city=f"city {i}", api_timestamp=1700000000 + i * 50000))
        os.utime(source / name, (i + 1, i + 1))
    run()
    want = sorted(map(tuple, weather.read_weather(spark, sink).collect()))
    real = weather.versions.publish
    monkeypatch.setattr(weather.versions, "publish", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):  # dies before the pointer
        weather.compact_weather(spark, sink)
    assert sorted(map(tuple, weather.read_weather(spark, sink).collect())) == want
    monkeypatch.setattr(weather.versions, "publish", real)
    monkeypatch.setattr(weather.versions, "discard", lambda *a: None)  # dies before the folders are gone
    assert weather.compact_weather(spark, sink) == 3
    assert sorted(map(tuple, weather.read_weather(spark, sink).collect())) == want
    monkeypatch.undo()
    assert weather.compact_weather(spark, sink) == 0
    (folder,) = os.listdir(os.path.join(sink, "events"))
    assert sum(n.startswith("batch_id=") for n in os.listdir(os.path.join(sink, "events", folder))) == 1
    drop(source, "e", message(city="city 4"))
    run()
    assert weather.compact_weather(spark, sink) == 1
    assert sorted(r.city for r in weather.read_weather(spark, sink).collect()) == [f"city {i}" for i in range(5)]


def test_payload_and_messages(spark):
    raw = spark.createDataFrame([('{"name": "Tampa", "main": {"temp": 7, "humidity": 3}, "weather": [{"main": "Rain"}, {"main": "x"}], "dt": 5}',), ("{}",)],
                                "value string")
    rows = weather.weather_payload_to_event(raw, AT).collect()
    assert (rows[0].city, rows[0].temp_c, rows[0].condition, rows[0].humidity, rows[0].wind_speed, rows[0].api_timestamp) == ("Tampa", 7.0, "Rain", 3, None, 5)
    assert rows[1].city is None and rows[1].source == "OpenWeatherMap"
    good, bad = weather.parse_weather(weather.as_messages(weather.weather_payload_to_event(raw, AT)))
    assert bad.count() == 0 and sorted(r.temp_c or 0 for r in good.collect()) == [0, 7.0]
