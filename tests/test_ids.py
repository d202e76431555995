"""The bucketed table of event ids: plan, writers in turn, restarts, compaction."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from sunledger.streaming import ingest
from sunledger.streaming.ids import IdTable, Locked
from tests.test_ingest import drop_file, line


def run(spark, base, writer="w"):
    stream = ingest.file_messages(spark, f"{base}/in-{writer}", files_per_batch=1)
    ingest.start_ingest(stream, f"{base}/sink", f"{base}/cp-{writer}", dedup="ids").awaitTermination()


def stored(spark, base):
    rows = ingest.read_readings(spark, f"{base}/sink").collect()
    return sorted((r.event_id or "", float(r.production_kw)) for r in rows)


def rows(spark, ids):
    return spark.createDataFrame([(i, k) for k, i in enumerate(ids)], "event_id string, k int")


def test_the_table_side_is_not_shuffled(spark, tmp_path):
    table = IdTable(spark, f"{tmp_path}/ids", 8)
    table.add(rows(spark, [f"e{i}" for i in range(500)]), "b1")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = table.unseen(rows(spark, ["e1", "x", None]), "b2")
        assert sorted(map(str, (r.event_id for r in new.collect()))) == ["None", "x"]
        plan = new._jdf.queryExecution().executedPlan().toString()
        final = plan.split("Initial Plan")[0]
        assert final.count("Exchange hashpartitioning") == 1  # the batch
        table_side = final[final.index("FileScan") - 400 : final.index("FileScan")]
        assert "Bucketed: true" in final and "Exchange" not in table_side
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_own_batch_is_no_conflict_and_adding_again_changes_nothing(spark, tmp_path):
    table = IdTable(spark, f"{tmp_path}/ids", 4)
    for _ in range(2):
        table.add(rows(spark, ["a", None, "b"]), "b1")
    assert table.unseen(rows(spark, ["a", "c"]), "b1").count() == 2
    assert [r.event_id for r in table.unseen(rows(spark, ["a", "c"]), "b2").collect()] == ["c"]
    table.compact()
    assert sorted(map(tuple, table.read().collect())) == [("a", "b1"), ("b", "b1")]
    assert [r.event_id for r in IdTable(spark, f"{tmp_path}/ids").unseen(rows(spark, ["a", "c"])).collect()] == ["c"]


def test_two_writers_and_restarts(spark, tmp_path):
    drop_file(tmp_path / "in-v", "1.json", [line(event_id=f"e{i}", production_kw=1.0) for i in range(6)])
    drop_file(tmp_path / "in-w", "1.json", [line(event_id=f"e{i}", production_kw=2.0) for i in range(3, 9)])
    run(spark, tmp_path, "v")
    run(spark, tmp_path, "w")
    first = [(f"e{i}", 1.0) for i in range(6)] + [(f"e{i}", 2.0) for i in range(6, 9)]
    assert stored(spark, tmp_path) == first
    drop_file(tmp_path / "in-v", "2.json", [line(event_id=f"e{i}", production_kw=3.0) for i in range(5, 11)])
    run(spark, tmp_path, "v")  # restarted from its checkpoint
    assert stored(spark, tmp_path) == sorted([*first, ("e9", 3.0), ("e10", 3.0)])


def test_writers_at_the_same_time(spark, tmp_path):
    for writer, kw in (("v", 1.0), ("w", 2.0)):
        for part in range(2):
            lines = [line(event_id=f"e{i}", production_kw=kw) for i in range(part * 10, part * 10 + 15)]
            drop_file(tmp_path / f"in-{writer}", f"{part}.json", lines)
    IdTable(spark, f"{tmp_path}/sink/event_ids")
    threads = [threading.Thread(target=run, args=(spark, tmp_path, w)) for w in "vw"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert [i for i, _ in stored(spark, tmp_path)] == sorted(f"e{i}" for i in range(25))


def test_a_failed_batch_keeps_its_turn(spark, tmp_path):
    table = IdTable(spark, f"{tmp_path}/ids", 4)
    with pytest.raises(ZeroDivisionError), table.turn("v"):
        raise ZeroDivisionError
    with pytest.raises(Locked), table.turn("w", wait=0.2, look=0.1):
        pass
    with table.turn("v"):
        table.add(rows(spark, ["a"]), "v-1")
    with table.turn("w", wait=0.2, look=0.1):
        assert table.unseen(rows(spark, ["a"])).count() == 0


def test_readings_without_ids_are_all_kept(spark, tmp_path):
    drop_file(tmp_path / "in-w", "1.json", [line(event_id=None, production_kw=1.0)] * 3)
    run(spark, tmp_path)
    assert stored(spark, tmp_path) == [("", 1.0)] * 3
    assert ingest.read_readings(spark, f"{tmp_path}/sink").where(F.col("event_id").isNotNull()).count() == 0
