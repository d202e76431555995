"""Decoding and the ingest stream: defects, repeats, restarts, retries."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sunledger.streaming import decode, ingest

GOOD = {
    "event_id": "e1",
    "timestamp": "2026-04-12T12:00:00.123456+00:00",
    "panel_id": "Panel-001",
    "panel_type": "Mono",
    "panel_power_kw": 3.0,
    "production_kw": 2.184,
    "temperature_c": 21.4,
    "cloud_factor": 0.88,
    "temp_efficiency": 0.992,
    "status": "active",
    "city": "Turin",
}


def line(drop=(), **changes):
    return json.dumps({k: v for k, v in {**GOOD, **changes}.items() if k not in drop})


def decoded(spark, *lines):
    df = spark.createDataFrame([(i, text) for i, text in enumerate(lines)], "n INT, value STRING")
    return decode.decode_readings(df).orderBy("n").collect()


def test_good_event_keeps_its_values(spark):
    (row,) = decoded(spark, line())
    assert row.reject_reason is None
    assert (row.panel_id, float(row.production_kw)) == ("Panel-001", 2.184)
    assert row.timestamp == datetime(2026, 4, 12, 12, 0, 0, 123456)


def test_defaults_apply_to_absent_keys_only(spark):
    absent, null = decoded(spark, line(drop=("status", "city")), line(status=None, city=None))
    assert (absent.status, absent.city) == ("active", "Turin")
    assert (null.status, null.city) == (None, None)


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        (line(drop=("panel_id",)), "missing field: panel_id"),
        (line(drop=("event_id", "timestamp")), "missing field: event_id"),
        (line(panel_id=None), None),
        (line(production_kw=None), None),
        (line()[:-1], "not a JSON object"),
        ("[1, 2]", "not a JSON object"),
        ("", "not a JSON object"),
        (line(production_kw="much"), "wrong type"),
        (line(timestamp="yesterday"), "unreadable timestamp"),
        (line(production_kw=1e9), "number out of range"),
    ],
)
def test_rejects(spark, text, reason):
    (row,) = decoded(spark, text)
    assert row.reject_reason == reason


def drop_file(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def run(spark, base, dedup):
    stream = ingest.file_messages(spark, f"{base}/in", files_per_batch=1)
    ingest.start_ingest(stream, f"{base}/sink", f"{base}/cp", dedup=dedup).awaitTermination()
    return ingest.read_readings(spark, f"{base}/sink")


@pytest.mark.parametrize("dedup", ["sink", "state"])
def test_stream_across_batches_and_restart(spark, tmp_path, dedup):
    drop_file(
        tmp_path / "in",
        "1.json",
        [
            line(),
            line(),  # repeated in the same file
            line(event_id="e2", panel_id=None),
            line(event_id=None, production_kw=1.0),
            line(event_id=None, production_kw=1.0),
            line(drop=("panel_id",)),
            "{broken",
            "{broken",
        ],
    )
    first = run(spark, tmp_path, dedup)
    assert first.count() == 4
    # after a restart: a repeat, a late event, a third one without id
    drop_file(
        tmp_path / "in",
        "2.json",
        [
            line(),
            line(event_id="late", timestamp="2026-04-11T01:00:00+00:00"),
            line(event_id=None),
        ],
    )
    stored = run(spark, tmp_path, dedup)
    ids = sorted(str(r.event_id) for r in stored.collect())
    assert ids == ["None", "None", "None", "e1", "e2", "late"]
    rejects = ingest.read_rejects(spark, f"{tmp_path}/sink")
    assert {r.reject_reason: r["count"] for r in rejects.groupBy("reject_reason").count().collect()} == {
        "missing field: panel_id": 1,
        "not a JSON object": 2,
    }
    counters = ingest.ingest_counters(spark, f"{tmp_path}/sink").first()
    expected = 8 if dedup == "sink" else 6  # the state drops repeats before they are counted
    assert (counters.messages, counters.errors) == (expected, 3)
    assert counters.success_rate == pytest.approx((expected - 3) / expected * 100)


def test_a_batch_run_again_adds_nothing(spark, tmp_path):
    base = f"{tmp_path}/sink"
    run(spark, _with_one_file(tmp_path), "sink")
    writer = ingest.batch_writer(base, lambda: "retry")
    batch = decode.decode_readings(
        spark.createDataFrame([(line(event_id=f"n{i}"),) for i in range(5)], "value STRING")
    )
    for _ in range(2):
        writer(batch, 7)
    assert ingest.read_readings(spark, base).count() == 6


def test_same_day_dedup_reads_only_those_days(spark, tmp_path):
    run(spark, _with_one_file(tmp_path), "sink")
    sink = ingest.read_readings(spark, f"{tmp_path}/sink")
    rows = decode.decode_readings(
        spark.createDataFrame([(line(),), (line(event_id="new"),)], "value STRING")
    )
    left = ingest.unseen(rows, sink, same_day_only=True)
    assert [r.event_id for r in left.collect()] == ["new"]


def _with_one_file(tmp_path):
    drop_file(tmp_path / "in", "1.json", [line()])
    return tmp_path


def test_first_copy_by_order_wins(spark):
    df = spark.createDataFrame(
        [("a", 2, "late"), ("a", 1, "early"), (None, 5, "x"), (None, 5, "x")],
        "event_id STRING, offset INT, v STRING",
    )
    kept = sorted((str(r.event_id), r.v) for r in ingest.first_per_event(df, ["offset"]).collect())
    assert kept == [("None", "x"), ("None", "x"), ("a", "early")]


PAYLOAD = {
    "location": {"name": "Turin"},
    "current": {
        "temperature": 24,
        "humidity": 55,
        "wind_speed": 12,
        "wind_dir": "NW",
        "pressure": 1012,
        "precip": 0.0,
        "cloudcover": 30,
        "uv_index": 6,
        "weather_code": 113,
        "weather_descriptions": ["Sunny"],
        "is_day": "yes",
        "observation_time": "07:34 PM",
    },
}
FETCHED = datetime(2026, 4, 12, 20, 15)


def flattened(spark, payload):
    df = spark.createDataFrame([(json.dumps(payload),)], "value STRING")
    return decode.flatten_weather(df, FETCHED, city="Milan").collect()


def test_weather_payload_maps_expected_fields(spark):
    (row,) = flattened(spark, PAYLOAD)
    assert (row.city, row.temperature, row.weather_description) == ("Turin", 24, "Sunny")
    assert row.is_day is True
    assert row.observation_time == datetime(2026, 4, 12, 19, 34)
    assert row.timestamp == FETCHED


@pytest.mark.parametrize("payload", [{}, {"error": {"info": "x"}, **PAYLOAD}, {"current": None}])
def test_payload_without_data_gives_no_row(spark, payload):
    assert flattened(spark, payload) == []


def test_payload_fallbacks(spark):
    current = {**PAYLOAD["current"], "observation_time": "soon"}
    del current["weather_descriptions"], current["is_day"]
    (row,) = flattened(spark, {"current": current})
    assert (row.city, row.weather_description, row.is_day) == ("Milan", "", False)
    assert row.observation_time == FETCHED


def test_batch_and_stream_share_the_decoder(spark):
    assert "reject_reason" in decode.decode_readings(
        spark.createDataFrame([("x",)], "value STRING").select(F.col("value").cast("binary"))
    ).columns


def test_live_windows_slide(spark, tmp_path):
    from sunledger.streaming import rollup

    rows = [(datetime(2026, 4, 12, 12, m), "P1", 1.0 + m, True) for m in (0, 7, 31)]
    df = spark.createDataFrame(rows, "timestamp TIMESTAMP, panel_id STRING, production_kw DOUBLE, is_valid BOOLEAN")
    df.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    query = (
        rollup.live_windows(stream)
        .writeStream.format("memory")
        .queryName("live_windows")
        .outputMode("complete")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    windows = {r.window_start.strftime("%H:%M"): r for r in spark.table("live_windows").collect()}
    assert windows["11:35"].readings == 1
    assert windows["12:00"].readings == 2 and windows["12:00"].peak_production_kw == 8.0
    assert windows["12:05"].readings == 2
    assert windows["12:30"].active_panels == 1


def test_days_without_a_timestamp_are_checked_too(spark):
    rows = [("e1", None), ("e2", "2026-04-11 01:00:00")]
    new = spark.sql("SELECT * FROM VALUES ('e1', CAST(NULL AS TIMESTAMP)), ('e2', TIMESTAMP '2026-04-11 01:00:00') t(event_id, timestamp)")
    sink = new.selectExpr("event_id", "to_date(timestamp) AS event_date")
    assert ingest.unseen(new, sink, same_day_only=True).count() == 0
    assert ingest.unseen(new, sink.where("event_id = 'e2'"), same_day_only=True).count() == len(rows) - 1


def test_first_copy_of_a_batch_stays(spark):
    copies = spark.createDataFrame(
        [("e1", 1, 5, "b"), ("e1", 1, 3, "z"), ("e1", 2, 0, "a"), (None, 0, 0, "n"), (None, 0, 0, "n")],
        "event_id string, partition int, offset long, value string",
    )
    kept = ingest.first_per_event(copies, ["partition", "offset", "value"]).collect()
    assert sorted((r.event_id or "", r.value) for r in kept) == [("", "n"), ("", "n"), ("e1", "z")]


@pytest.mark.parametrize("dedup", ["sink", "state"])
def test_compaction_keeps_every_reading(spark, tmp_path, dedup):
    for i in range(3):
        drop_file(tmp_path / "in", f"{i}.json", [line(event_id=f"c{i}-{j}") for j in range(4)])
    before = run(spark, tmp_path, dedup)
    ids = sorted(r.event_id for r in before.collect())
    batches = [r[0] for r in before.select(ingest.BATCH_COLUMN).distinct().collect()]
    ingest.compact(spark, f"{tmp_path}/sink", batches, "merged")
    after = ingest.read_readings(spark, f"{tmp_path}/sink")
    assert sorted(r.event_id for r in after.collect()) == ids and len(ids) == 12
    assert {r[0] for r in after.select(ingest.BATCH_COLUMN).distinct().collect()} == {"merged"}
    assert after.where("ingestion_timestamp IS NULL").count() == 0


def test_the_columns_of_a_topic(spark):
    """What a Kafka source delivers: binary values with partition and offset."""
    rows = [
        (bytearray(line(event_id="k1", production_kw=2.0), "utf-8"), 1, 7),
        (bytearray(line(event_id="k1", production_kw=3.0), "utf-8"), 1, 5),
        (bytearray(b"{broken"), 0, 1),
        (None, 0, 2),
    ]
    topic = spark.createDataFrame(rows, "value BINARY, partition INT, offset LONG")
    readings = decode.decode_readings(topic)
    assert {"partition", "offset"} <= set(readings.columns)
    good = readings.where("reject_reason IS NULL")
    (kept,) = ingest.first_per_event(good, ["partition", "offset", "value"]).collect()
    assert (kept.event_id, kept.offset, float(kept.production_kw)) == ("k1", 5, 3.0)
    assert readings.where("reject_reason IS NOT NULL").count() == 2


@pytest.mark.parametrize("dedup", ["sink", "state"])
def test_the_first_of_differing_copies_is_stored(spark, tmp_path, dedup):
    """Within a batch the least copy, in whichever order they lie in the file; across batches the first."""
    copies = [line(event_id=f"d{i}", production_kw=1.0 + (i + k) % 3) for k in range(3) for i in range(30)]
    drop_file(tmp_path / "in", "1.json", copies)
    run(spark, tmp_path, dedup)
    drop_file(tmp_path / "in", "2.json", [line(event_id=f"d{i}", production_kw=0.5) for i in range(31)])
    stored = {r.event_id: float(r.production_kw) for r in run(spark, tmp_path, dedup).collect()}
    assert stored == {f"d{i}": 1.0 for i in range(30)} | {"d30": 0.5}


@pytest.mark.parametrize("dedup", ["sink", "state"])
def test_the_first_copy_of_a_topic_is_stored(spark, tmp_path, dedup):
    """With partition and offset these decide, not the value."""
    rows = [
        (line(event_id=f"t{i}", production_kw=kw), partition, offset)
        for i in range(20)
        for kw, partition, offset in ((1.0, 1, 5 + i % 4), (3.0, 1, 4), (2.0, 1, 9), (0.5, 2, 0))
    ]
    schema = "value STRING, partition INT, offset LONG"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    ingest.start_ingest(stream, f"{tmp_path}/sink", f"{tmp_path}/cp", dedup=dedup).awaitTermination()
    stored = {r.event_id: float(r.production_kw) for r in ingest.read_readings(spark, f"{tmp_path}/sink").collect()}
    assert stored == {f"t{i}": 3.0 for i in range(20)}
