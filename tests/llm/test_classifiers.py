"""Quality, language and secrets: held-out accuracy, edge cases, invariances."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sunledger.llm import language_id, quality, secrets
from tests.llm.fixtures import ODD_ROWS, bag, clashing, documents, empty, labels, odd

MEDIUM = "/root/testdata/sf0.01"


def test_quality_of_held_out_documents(spark):
    got = quality.query(spark, MEDIUM)
    truth = spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", "quality")
    rows = got.join(truth, "doc_id").where("held_out").collect()
    good, bad = [r for r in rows if r["quality"] == 1], [r for r in rows if r["quality"] == 0]
    assert np.mean([r["predicted"] for r in good]) >= 0.95
    assert np.mean([r["predicted"] == 0 for r in bad]) >= 0.7
    assert got.count() == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()


@pytest.mark.parametrize("make", [odd, clashing, empty])
def test_quality_on_odd_tables(spark, make):
    docs = make(spark)
    more = spark.createDataFrame([(None, 1, None), (1, 1, 1), (2, 0, 0), (1, 0, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    got = quality.score_quality(docs, labels(spark).unionByName(more))
    assert got.count() == docs.count()
    assert got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert quality.score_quality(docs.drop("source", "lang"), more.limit(0)).where("score <> 0.5").count() == 0


def test_views_teach_each_other():
    """With labels of a few rows only, pseudo-labels of the strong view raise the weak one."""
    import pandas as pd

    rng = np.random.default_rng(4)
    n = 600
    truth = rng.random(n) < 0.5
    words = [np.array([1 if t else 2, 3 + int(rng.integers(50))]) for t in truth]
    numbers = [list(np.r_[np.where(t, 1.0, -1.0) + rng.normal(0, 1.0), rng.normal(0, 1, quality.META_NUMBERS - 1)]) for t in truth]
    label = [int(t) if i < 40 else None for i, t in enumerate(truth)]
    rows = pd.DataFrame({"id": range(n), "label": label, "words": words, "numbers": numbers, "buckets": [np.array([0, 1])] * n})
    models, prior = quality.co_train(rows)
    margin = models[0].calibrated([w for w in words], np.zeros((n, 0))) + models[1].calibrated([np.array([0, 1])] * n, np.array(numbers)) - prior
    assert np.mean((margin > 0) == truth) > 0.95


def test_pseudo_labels_come_from_all_rows(spark):
    """The surest rows of the whole table, against brute force; copies count once, taken ones not again."""
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text", "source", "lang")
    docs = docs.unionByName(docs.limit(50)).selectExpr("doc_id AS id", "CAST(NULL AS int) AS label", "text", "source", "lang").repartition(7)
    schema = f"id long, label int, words {quality.SPARSE}, numbers array<double>, buckets {quality.SPARSE}"
    features = docs.mapInArrow(quality.view_rows, schema).withColumn("key", F.xxhash64(*quality.FEATURES))
    rng = np.random.default_rng(1)
    models = [quality.Logistic(1 << quality.WORD_BITS, 0), quality.Logistic(quality.META_BUCKETS, quality.META_NUMBERS)]
    for model in models:
        model.sparse, model.dense = rng.normal(size=len(model.sparse)), rng.normal(size=len(model.dense))
    rows = features.toPandas().drop_duplicates("key").sort_values("key")
    examples = quality.Examples()
    examples.add(rows)
    keys = rows.key.to_numpy()
    taken = [set(int(k) for k in keys[:200]), set()]
    want = set()
    for view, model in enumerate(models):
        margin = model.margin(*examples.view(view, np.arange(len(keys))))
        order = [i for i in np.lexsort((keys, margin)) if int(keys[i]) not in taken[view]]
        want |= {(view, int(keys[i]), 0) for i in order[:40]} | {(view, int(keys[i]), 1) for i in order[-25:]}
    got = quality.most_confident(features, models, 25, 40, taken)
    assert {(r["view"], r["key"], r["label"]) for r in got.collect()} == want and got.count() == len(want)
    fetched = quality.with_features(features, got).toPandas()
    assert len(fetched) == len(want) and fetched.numbers.map(len).eq(quality.META_NUMBERS).all()


def test_what_co_training_adds(spark, monkeypatch):
    """From a few labels: held-out accuracy with the exchange is not below that without it."""
    monkeypatch.setattr(quality, "MAX_LABELLED", 60)
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    truth = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    right = []
    for rounds in (0, quality.ROUNDS):
        rows = quality.score_quality(docs, truth, F.crc32(F.col("doc_id").cast("string")) % 3 != 1, rounds=rounds)
        rows = rows.join(truth.select("doc_id", "quality"), "doc_id").where("quality IS NOT NULL").collect()
        pairs = [(r["score"], r["quality"]) for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
        good, bad = np.array([s for s, q in pairs if q == 1]), np.array([s for s, q in pairs if q == 0])
        right.append(float((good[:, None] > bad[None, :]).mean()))
    print("order of good above bad, without and with co-training", right)
    assert right[1] >= right[0] - 0.01 and right[1] > 0.8


def test_features_ignore_the_batch():
    texts = ["Alpha beta, BETA 12", "", "ünï | x"]
    together = quality.content_features(pa.array(texts))
    alone = [quality.content_features(pa.array([t]))[0] for t in texts]
    assert [x.tolist() for x in together] == [x.tolist() for x in alone]


def test_language_of_held_out_documents(spark):
    got = language_id.query(spark, MEDIUM)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    truth = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize("make", [odd, clashing, empty])
def test_language_on_odd_tables(spark, make):
    docs = make(spark)
    rows = language_id.identify(docs).collect()
    assert len(rows) == docs.count()
    langs = {r[2] for r in ODD_ROWS if r[2]}
    by_id = {r[0]: r[1] for r in ODD_ROWS}
    for r in rows:
        text = by_id[r["doc_id"]]
        und = text is None or not any(c.isalpha() for c in text)
        assert (r["lang_pred"] == "und") == und
        assert und or r["lang_pred"] in langs
    assert {r["lang_pred"] for r in language_id.identify(docs, F.lit(False)).collect()} <= {"und"}


def test_language_depends_on_the_text_only(spark):
    docs = documents(spark)
    learn = F.col("doc_id") % 2 == 0
    plain = language_id.identify(docs, learn)
    changed = docs.withColumn("lang", F.when(learn, F.col("lang")).otherwise("xx")).withColumn("source", F.lit("s"))
    again = language_id.identify(changed, learn)
    assert bag(again) == bag(plain)


def test_narrow_margins_are_rejected(spark):
    docs = spark.createDataFrame([(i, "aaaa bbbb cccc dddd " * 50, "x" if i % 2 else "y", "s", 1) for i in range(8)], "doc_id long, text string, lang string, source string, n_chars int")
    rows = language_id.identify(docs).collect()
    assert {(r["lang_pred"], r["rejected"], r["score"]) for r in rows} == {("x", True, 0.0)}


SECRET = "AKIA" + "Q7ZK2M4N8P1R5T9W"


def test_candidates_are_found_in_whole_texts(spark):
    text = "word " * 20_000 + f"key {SECRET} and token = \"0123456789abcdef0123456789abcdef\" end"
    docs = spark.createDataFrame([(1, text, "s"), (2, None, "s"), (3, "", None), (4, "short only", "s"), (None, SECRET, "s")], "doc_id long, text string, source string")
    rows = secrets.candidates(docs).collect()
    want = [(d, m.start(), m[0]) for d, t in ((1, text), (None, SECRET)) for m in secrets.CANDIDATE.finditer(t)]
    assert sorted(map(repr, ((r["doc_id"], r["start"], r["candidate"]) for r in rows))) == sorted(map(repr, want))
    assert len({len(r["features"]) for r in rows}) == 1


def test_forest_on_held_out_findings(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    learn = F.col("doc_id") % 2 == 0
    found = secrets.scan(docs, learn=learn).where(~learn).collect()
    text = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    right = []
    for r in found:
        before = text[r["doc_id"]][max(0, r["start"] - 48) : r["start"]]
        known = bool(re.match(r"AKIA[0-9A-Z]{16}$", r["candidate"])) or bool(re.search(r"(password|token)\s*=\s*\"?$", before))
        if known or r["candidate"].isalpha():
            right.append(r["finding"] == known)
    assert len(right) > 50 and np.mean(right) >= 0.98


@pytest.mark.parametrize("make", [odd, clashing, empty])
def test_secrets_on_odd_tables(spark, make):
    rows = secrets.scan(make(spark))
    assert rows.where("score IS NULL").count() == 0
    assert rows.columns == ["doc_id", "path", "start", "length", "candidate", "score", "finding"]


def test_gram_codes_count_runs_of_letters():
    flags = lambda t: len(secrets.gram_codes(np.frombuffer(t.encode(), dtype=np.uint8)))
    assert [flags(t) for t in ("", "abc", "abcd", "ab1cde", "abcde", "AbCdE xyzw")] == [0, 0, 1, 0, 2, 3]


PLANTED = [  # text before, secret, text after
    ("é", SECRET, " x"),
    ("clé ", SECRET, "的密钥"),
    ("密钥是", SECRET, "。"),
    ('password = "', "p@ss!W0rd#2024xyz", '"'),
    ('password="', "hunter2hunter2", '" and more'),
    ("PASSWD: ", "k0rt!", " end"),
    ("{'api_key': '", "a b\\'c 9", "'}"),
    ('{\\"token\\": \\"', "q-1", '\\"}'),
    ("secret=", "ünï©ode7", "\n"),
    ("login?token=1&password=", "hunter2", " x"),
    ("password = '", "never closed", "\n".join(["", "line"])),
    ("token := `", "raw 1", "`"),
    ('secret = b"', "by tes", '"'),
    ('password = "', "one\ntwo", '"'),
]


def test_planted_secrets_are_candidates(spark):
    """The list is independent of the patterns."""
    texts = [before + secret + after for before, secret, after in PLANTED]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    rows = secrets.scan(docs).collect()
    found = {(r["doc_id"], r["start"], r["candidate"]) for r in rows}
    want = {(i, len(before), secret) for i, (before, secret, _) in enumerate(PLANTED) if secret != "never closed"}
    assert want <= found and (10, len(PLANTED[10][0]), "never") in found
    assert all(texts[r["doc_id"]][r["start"] :][: r["length"]] == r["candidate"] for r in rows)
    assert len(found) == len(rows)


def test_assigned_spans_stay_linear():
    for text in ("password=" * 5000, "password='" * 5001, "token=\"x\\" * 3000):
        assert sum(e - s for s, e in secrets.assigned_spans(text)) <= 4 * len(text)


def made_languages(spark, n, texts=6):
    """Languages of their own syllables."""
    import random

    rows = []
    for lang in range(n):
        draw = random.Random(lang)
        words = ["".join(draw.choice("bcdfghklmnprstvz") + draw.choice("aeiouy") for _ in range(3)) for _ in range(40)]
        for t in range(texts):
            rows.append((lang * texts + t, " ".join(draw.choice(words) for _ in range(60)), f"l{lang:03}"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_every_language_is_learnt(spark):
    """300 languages, more than a task holds at once."""
    docs = made_languages(spark, 300)
    got = language_id.identify(docs, F.col("doc_id") % 6 != 0, group=100)
    right = got.join(docs.select("doc_id", "lang"), "doc_id").where("NOT learnable")
    assert right.count() == 300 and right.where("lang_pred = lang").count() >= 297
    assert right.select("lang_pred").distinct().count() >= 297


def test_groups_change_no_prediction(spark):
    docs = made_languages(spark, 7)
    whole = language_id.identify(docs, F.col("doc_id") % 6 != 0)
    parts = language_id.identify(docs, F.col("doc_id") % 6 != 0, group=2)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.select(whole.columns).collect()))
    one = language_id.identify(docs.where("lang = 'l001'"), group=2)
    assert {r["lang_pred"] for r in one.collect()} == {"l001"}


def test_language_is_the_least_compressed_size(spark):
    """Scores are recomputed with plain one-shot compression per chunk, text by text."""
    import math

    docs = made_languages(spark, 4)
    table = language_id.dictionaries(docs, F.lit(True), "text", "lang")
    raw = {r["lang"]: bytes(r["data"]) for r in table.orderBy("lang").collect()}
    made = dict(zip(raw, language_id.compressors(raw), strict=True))
    got = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    for r in docs.collect():
        size = {k: len(c.compress(r["text"].lower().encode())) for k, c in made.items()}
        order = sorted(size, key=lambda k: (size[k], k))
        margin = (size[order[1]] - size[order[0]]) / size[order[1]]
        assert got[r["doc_id"]]["lang_pred"] == order[0]
        assert got[r["doc_id"]]["score"] == pytest.approx(1 - math.exp(-margin / 0.02))
