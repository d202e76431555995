"""Toxicity: held-out accuracy, edge cases, and the corrected risk."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sunledger.llm import toxicity
from tests.llm.fixtures import bag, clashing, documents, empty, labels, odd


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    got = toxicity.query(spark, folder)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    truth = spark.read.parquet(f"{folder}/labels.parquet")
    both = got.join(truth, "doc_id").where("held_out").select("toxic", "predicted", "score").collect()
    positive = [r for r in both if r["toxic"] == 1]
    negative = [r for r in both if r["toxic"] == 0]
    assert np.mean([r["predicted"] for r in negative]) <= 0.01
    assert np.mean([r["predicted"] for r in positive]) >= 0.9
    rank = np.mean([np.mean(p["score"] > np.array([n["score"] for n in negative])) for p in positive])
    assert rank >= 0.95


@pytest.mark.parametrize("make", [odd, clashing, empty])
def test_odd_tables(spark, make):
    docs = make(spark)
    rows = toxicity.score_toxicity(docs, labels(spark).unionByName(spark.createDataFrame([(None, 1, None), (1, 1, 1), (2, 0, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")))
    assert rows.count() == docs.count()
    assert rows.where("toxicity < 0 OR toxicity > 1 OR toxicity IS NULL").count() == 0
    kept = toxicity.keep_clean(docs, labels(spark))
    assert kept.columns == docs.columns
    assert bag(kept) == bag(docs)  # nothing to learn from: all stay


def test_no_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score_toxicity(documents(spark), none).where("toxicity <> 0").count() == 0


def test_score_depends_on_the_text_only(spark):
    docs = documents(spark).limit(40)
    other = docs.select((F.col("doc_id") + 0).alias("doc_id"), "text", F.lit("x").alias("lang"), F.lit("y").alias("source"))
    a = toxicity.score_toxicity(documents(spark), labels(spark))
    texts = {r["text"]: r["toxicity"] for r in a.collect()}
    again = toxicity.score_toxicity(documents(spark).withColumn("lang", F.lit("x")).withColumn("source", F.lit(None).cast("string")), labels(spark))
    assert {r["text"]: r["toxicity"] for r in again.collect()} == texts
    assert other.count() == 40


def test_nnpu_learns_without_negative_labels():
    rng = np.random.default_rng(0)
    positive = [np.array(sorted({0, *rng.integers(2, 50, 5).tolist()})) for _ in range(200)]
    hidden = [np.array(sorted({0, *rng.integers(2, 50, 5).tolist()})) for _ in range(100)]
    clean = [np.array(sorted(set(rng.integers(2, 50, 5).tolist()))) for _ in range(900)]
    w = toxicity.fit_nnpu(positive, hidden + clean, 50, 0.1, 1)
    score = lambda rows: np.array([w[r].sum() + w[-1] for r in rows])
    assert (score(hidden) > 0).mean() > 0.95
    assert (score(clean) > 0).mean() < 0.05


def test_features_are_distinct_per_text():
    rows, features = toxicity.document_features(pa.array(["same same Same,", None, "", "other"]))
    pairs = list(zip(rows.tolist(), features.tolist(), strict=True))
    assert len(pairs) == len(set(pairs)) and set(rows.tolist()) == {0, 3}


def test_every_part_of_a_text_counts():
    inner = lambda text: {f for word in text.split() for f in toxicity.word_features(word)}
    # an insult inside text without spaces, or between dashes and slashes, has features of its own
    assert inner("今天天气很好混蛋我们去公园散步吧") & inner("混蛋")
    assert inner("well-you-scoundrel/then") >= inner("scoundrel")
    assert inner("(no)") == inner("no") != set()
    assert inner("... -- !") == set()
    assert len(inner("的" * 10_000)) <= 6  # repeats add nothing


def test_insult_inside_unspaced_text_raises_the_score(spark):
    rng = np.random.default_rng(5)
    signs = [chr(0x4E00 + i) for i in range(300)]
    text = lambda insult: "".join(rng.choice(signs, 20)) + insult + "".join(rng.choice(signs, 20))
    rows = [(i, text("混蛋") if i % 4 == 0 else text(""), int(i % 4 == 0)) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    truth = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    scores = toxicity.score_toxicity(docs, truth, F.col("doc_id") < 300).where("doc_id >= 300").collect()
    toxic = [r["toxicity"] for r in scores if r["doc_id"] % 4 == 0]
    clean = [r["toxicity"] for r in scores if r["doc_id"] % 4]
    assert min(toxic) > max(clean)


def test_repeated_ids_are_drawn_once(spark):
    rows = [(i % 3, "", False) for i in range(300)] + [(i % 2, "some words here", True) for i in range(50)]
    sample = spark.createDataFrame(rows, "id long, text string, positive boolean").select("id", "positive", "text")
    assert toxicity.training_table(sample).count() == 3 + 1
