"""The salted joins and exact quantiles against plain Spark, with one key holding a third."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from sunledger.functions.quantiles import exact_quantiles
from sunledger.functions.skew import hot_keys, pair_counts, pair_join, pair_tasks, skew_join


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(7)
    left = [(i, "hot" if i % 3 == 0 else f"k{rng.randrange(400)}") for i in range(6000)]
    left += [(i, None) for i in range(6000, 6050)]
    right = [("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(0, 400, 2)]
    return (
        spark.createDataFrame(left, "id INT, key STRING"),
        spark.createDataFrame(right, "key STRING, v INT"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_plain_join(sides, how):
    left, right = sides
    ours = skew_join(left, right, ["key"], how, salt_by=["id"], rows_per_task=100)
    plain = left.join(right, "key", how)
    assert sorted(map(str, ours.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_both_sides_hot(spark, how):
    left = [(i, "hot" if i % 3 else "l") for i in range(90)] + [(i, f"k{i}") for i in range(90, 900)]
    left += [(i, None) for i in range(900, 910)] + [(i, "r") for i in range(910, 913)]
    right = [(i, "hot") for i in range(40)] + [(i, "r") for i in range(40, 80)]
    right += [(i, f"k{i}") for i in range(100, 300)]
    left = spark.createDataFrame(left, "id INT, key STRING")
    right = spark.createDataFrame(right, "rid INT, key STRING")
    ours = skew_join(left, right, ["key"], how, salt_by=["id"], right_salt_by=["rid"], rows_per_task=7)
    plain = left.join(right, "key", how)
    assert sorted(map(str, ours.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_right_joins_are_refused(sides):
    left, right = sides
    with pytest.raises(ValueError, match="right"):
        skew_join(left, right, ["key"], "right", salt_by=["id"])


def test_salts_follow_the_rows_of_a_key(sides):
    found = {r.key: r.n for r in hot_keys(sides[0], ["key"], "n", rows_per_task=150).collect()}
    assert found == {"hot": 14}  # 2000 rows


@pytest.fixture
def unassisted(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def largest_task(joined):
    return joined.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]


def test_a_key_with_a_third_of_the_rows_is_spread(unassisted, sides):
    left, right = sides
    joined = skew_join(left, right, ["key"], salt_by=["id"], rows_per_task=100)
    assert joined.where("key = 'hot'").count() == 4000
    assert largest_task(joined) < 1000


def test_uniform_busy_hours_are_split(unassisted, spark):
    left = spark.range(7200).selectExpr("id", "id % 72 AS hour")
    right = spark.range(2880).selectExpr("id AS rid", "id % 72 AS hour")
    joined = skew_join(left, right, ["hour"], "left", salt_by=["id"], right_salt_by=["rid"], rows_per_task=20)
    assert joined.count() == 7200 * 40
    assert largest_task(joined) < 3 * 7200 * 40 / 32


@pytest.mark.parametrize("probs", [[0.5], [0, 0.1, 0.25, 0.5, 0.75, 0.9, 1]])
def test_exact_quantiles_equal_percentile(spark, probs):
    rng = random.Random(3)
    rows = [("a", rng.choice([0.0, -1.5, rng.gauss(0, 1e3), rng.random() * 1e-6])) for _ in range(2001)]
    rows += [("b", 4.25), ("c", None), ("d", 1.0), ("d", 2.0)]
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE")
    ours = {r.g: r.quantiles for r in exact_quantiles(df, ["g"], F.col("v"), probs).collect()}
    listed = ", ".join(str(p) for p in probs)
    plain = df.where("v IS NOT NULL").groupBy("g").agg(F.expr(f"percentile(v, array({listed}))").alias("q"))
    for row in plain.collect():
        assert ours[row.g] == pytest.approx(row.q, rel=1e-12)
    assert "c" not in ours


def test_null_is_a_group_of_the_quantiles(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0), ("a", None)], "g STRING, v DOUBLE")
    found = {r.g: (r.n, r.quantiles) for r in exact_quantiles(df, ["g"], F.col("v"), [0.5, 1]).collect()}
    assert found == {None: (2, [2.0, 3.0]), "a": (1, [2.0, 2.0])}


def test_stable_sum_does_not_cut(spark):
    from sunledger.functions.semantics import stable_mean, stable_sum

    df = spark.createDataFrame([(1e-9,), (2e-9,), (3e13,)], "v DOUBLE")
    total, mean = df.where("v < 1").agg(stable_sum(F.col("v")), stable_mean(F.col("v"))).first()
    assert total == pytest.approx(3e-9) and mean == pytest.approx(1.5e-9)
    assert df.agg(stable_sum(F.col("v"))).first()[0] == pytest.approx(3e13)


def test_fixed_point_sum_of_any_order_and_value(spark):
    from sunledger.functions.semantics import fixed_point_sum

    rows = [((i * 7919 % 10007) / 997 - 5, i) for i in range(5000)] + [(1e-13, -1), (None, -2), (-3e9, -3)]
    df = spark.createDataFrame(rows, "v double, i int")
    sums = {df.orderBy(F.rand(s)).repartition(n).agg(fixed_point_sum(F.col("v"))).first()[0] for s, n in ((1, 1), (2, 7), (3, 13))}
    assert len(sums) == 1 and sums.pop() == pytest.approx(math.fsum(v for v, _ in rows if v is not None), rel=1e-14)
    special = spark.createDataFrame(
        [("a", math.nan), ("a", 1.0), ("b", math.inf), ("b", 2.0), ("c", 1e300), ("c", 1e17), ("d", None)], "k string, v double"
    )
    got = {r.k: r.s for r in special.groupBy("k").agg(fixed_point_sum(F.col("v")).alias("s")).collect()}
    assert math.isnan(got["a"]) and got["b"] == math.inf and got["c"] == 1e300 and got["d"] is None


@pytest.mark.parametrize("tasks", [None, 7])
def test_pair_join_equals_plain_left_join(spark, tasks):
    """Busy keys on either side or both, keys of one side, keys without, rows that come twice, ids that are NULL."""
    left = [(i, "both" if i % 3 else "l") for i in range(90)] + [(i, f"k{i}") for i in range(90, 120)]
    left += [(i, None) for i in range(120, 130)] + [(1, "r"), (1, "r"), (None, "r"), (None, "both")]
    right = [(i, "both", i % 4 or None) for i in range(40)] + [(i, "r", 1) for i in range(40, 80)]
    right += [(5, "both", 1)] * 3 + [(None, "r", None)] * 2 + [(i, f"k{i}", i) for i in range(100, 140)]
    right += [(i, None, i) for i in range(5)]
    left = spark.createDataFrame(left, "id INT, key STRING")
    right = spark.createDataFrame(right, "rid INT, key STRING, v INT")
    counts = pair_counts(left, right, ["key"])
    ours = pair_join(left, right, ["key"], ["rid", "v"], counts, tasks, block_rows=6, pairs_per_task=60)
    plain = left.join(right, "key", "left").select("id", "key", "rid", "v")
    assert sorted(map(str, ours.collect())) == sorted(map(str, plain.collect()))


def test_pair_join_of_empty_sides(spark):
    left, right = spark.createDataFrame([(1, "a"), (2, None)], "id INT, key STRING"), spark.createDataFrame([("a", 1)], "key STRING, v INT")
    for a, b in ((left, right.limit(0)), (left.limit(0), right)):
        ours = pair_join(a, b, ["key"], ["v"], pair_counts(a, b, ["key"]))
        assert sorted(map(str, ours.collect())) == sorted(map(str, a.join(b, "key", "left").select("id", "key", "v").collect()))


def test_tasks_follow_the_pairs(spark):
    left = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(60)], "id INT, key STRING")
    counts = pair_counts(left, left, ["key"])
    assert pair_tasks(counts, pairs_per_task=100) == 18  # 1800 pairs
    assert pair_tasks(counts) == pair_tasks(counts.limit(0)) == spark.sparkContext.defaultParallelism


def test_pairs_of_busy_keys_are_spread(spark):
    left = spark.range(900).selectExpr("id", "IF(id % 3 = 0, 'hot', IF(id % 3 = 1, 'none', NULL)) AS key")
    right = spark.range(300).selectExpr("id AS rid", "'hot' AS key")
    counts = pair_counts(left, right, ["key"])
    joined = pair_join(left, right, ["key"], ["rid"], counts, 40, block_rows=20, pairs_per_task=1000)
    assert joined.count() == 300 * 300 + 600
    assert joined.select("id", "rid").distinct().count() == 300 * 300 + 600
    assert largest_task(joined) < 12_000
    lonely = joined.where("rid IS NULL AND key IS NULL")
    assert lonely.count() == 300 and largest_task(lonely) < 60
