"""Ingestion from records with all columns of a topic: copies, tombstones, retries."""

from __future__ import annotations

import json
from datetime import datetime

import pytest

from sunledger.streaming import decode, ingest
from tests.test_ingest import line

RECORDS = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset LONG, timestamp TIMESTAMP, timestampType INT"
)


def records(spark, rows):
    """(value, partition, offset) as records that arrived long before their events happened."""
    told = [
        (bytearray(b"k"), None if v is None else bytearray(v), "readings", p, o, datetime(2020, 1, 1), 0)
        for v, p, o in rows
    ]
    return spark.createDataFrame(told, RECORDS)


def told(**changes):
    return line(**changes).encode()


ROWS = [
    (told(event_id="a", production_kw=2.0), 1, 7),
    (told(event_id="a", production_kw=3.0), 1, 5),  # the first by offset, though not in the file
    (told(event_id="a", production_kw=1.0), 2, 0),
    (told(event_id="b", production_kw=1.5), 0, 9),
    (told(event_id=None), 0, 10),
    (told(event_id=None), 0, 11),
    (None, 0, 12),  # a tombstone
    (b"\xff\xfe\x00", 0, 13),  # not UTF-8
    (b"{broken", 0, 14),
]


@pytest.mark.parametrize("dedup", ["ids", "sink", "state"])
def test_a_topic_from_end_to_end(spark, tmp_path, dedup):
    base = str(tmp_path)
    for part, rows in enumerate([ROWS, [(told(event_id="a", production_kw=9.0), 0, 15), (told(event_id="c"), 0, 16)]]):
        records(spark, rows).coalesce(1).write.mode("append").parquet(f"{base}/in/{part}")
        source = spark.readStream.schema(RECORDS).parquet(f"{base}/in/*")
        query = ingest.start_ingest(ingest.of_topic(source), f"{base}/sink", f"{base}/cp", dedup=dedup)
        query.awaitTermination()
    stored = ingest.read_readings(spark, f"{base}/sink").collect()
    assert sorted((r.event_id or "", float(r.production_kw)) for r in stored) == [
        ("", 2.184), ("", 2.184), ("a", 3.0), ("b", 1.5), ("c", 2.184)
    ]
    # the time is the event's, not the record's
    assert {str(r.timestamp.date()) for r in stored} == {"2026-04-12"}
    rejects = ingest.read_rejects(spark, f"{base}/sink").collect()
    assert sorted((r.value or "", r.reject_reason) for r in rejects)[0] == ("", decode.NOT_AN_OBJECT)
    assert [r.reject_reason for r in rejects] == [decode.NOT_AN_OBJECT] * 3
    assert "{broken" in {r.value for r in rejects}
    counters = ingest.ingest_counters(spark, f"{base}/sink").first()
    assert (counters.messages, counters.errors) == ((5, 3) if dedup == "state" else (8, 3))


def test_counters_of_empty_and_repeated_batches(spark, tmp_path):
    base = str(tmp_path)
    for table in ("readings", "rejects", "counters"):
        (tmp_path / table).mkdir()
    write = ingest.batch_writer(base, lambda: "topic")
    nothing = decode.decode_readings(ingest.of_topic(records(spark, [])))
    write(nothing, 0)
    counters = ingest.ingest_counters(spark, base).first()
    assert (counters.messages, counters.errors, counters.success_rate) == (0, 0, None)
    batch = decode.decode_readings(ingest.of_topic(records(spark, ROWS)))
    for _ in range(2):  # as after a failure
        write(batch, 1)
    counters = ingest.ingest_counters(spark, base).first()
    assert (counters.messages, counters.errors) == (6, 3)


class Reader:
    """Records how a source is asked for, and delivers a table."""

    def __init__(self, table):
        self.table, self.asked = table, {}
        self.readStream = self

    def format(self, name):
        self.asked["format"] = name
        return self

    def option(self, name, value):
        self.asked[name] = value
        return self

    def load(self):
        return self.table


def test_how_the_topic_is_asked_for(spark):
    reader = Reader(records(spark, ROWS))
    got = ingest.kafka_messages(reader, "host:9092", "readings")
    assert reader.asked == {
        "format": "kafka",
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "readings",
        "startingOffsets": "earliest",
    }
    assert got.columns == ["value", "partition", "offset"]
    good = decode.decode_readings(got).where("reject_reason IS NULL")
    assert good.count() == 6 and json.loads(line())["panel_id"] == good.first().panel_id
