"""Exact top-k search and the URL filter against brute force."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sunledger.llm import knn, url_filter

FOLDER = "/root/testdata/sf0.001"
RULES = dict(url_filter.RULES)


def brute_top(rows, k, is_query):
    rows = sorted({(i, tuple(v)) for i, v in rows})
    out = []
    for qi, qv in rows:
        if not is_query(qi):
            continue
        scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in rows if i != qi)[:k]
        out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def quantise(vector):
    return tuple(int(np.floor(256 * float(x))) for x in vector)


def results(df):
    return sorted(tuple(r) for r in df.collect())


def test_top_k_on_the_table(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = [(r["vec_id"], quantise(r["embedding"])) for r in table.collect()]
    got = knn.query(spark, FOLDER)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert results(got) == brute_top(rows, 5, lambda i: i % 50 == 0)


@pytest.mark.parametrize(("data_block", "query_block", "pivots"), [(4096, 1024, 256), (7, 3, 5)])
def test_top_k_with_copies_clusters_and_odd_rows(spark, monkeypatch, data_block, query_block, pivots):
    monkeypatch.setattr(knn, "DATA_BLOCK", data_block)
    monkeypatch.setattr(knn, "QUERY_BLOCK", query_block)
    monkeypatch.setattr(knn, "MAX_PIVOTS", pivots)
    rng = np.random.default_rng(2)
    rows = []
    for i in range(300):
        centre = np.array([[40.0, 0, 0], [0, 40.0, 0], [0, 0, 0.5]][i % 3])
        rows.append((i - 20, [float(x) for x in centre + rng.normal(0, 0.3, 3)]))
    rows += [(1000 + i, [1.0, 1.0, 1.0]) for i in range(60)]  # a third are copies
    rows += [(1000, [1.0, 1.0, 1.0]), (50, [0.25, 0.0, 0.0])]  # a repeated row, a second vector of an id
    odd = [(2000, None), (2001, [1.0, None, 2.0]), (2050, [float("nan"), 1.0, 1.0]), (2052, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("g", F.lit("x"))
    got = knn.top_k(df, F.col("vec_id") % 10 == 0)
    want = brute_top([(i, quantise(v)) for i, v in rows], 5, lambda i: i % 10 == 0)
    assert results(got) == want


def test_few_candidates_and_empty_tables(spark):
    two = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0])], "vec_id long, embedding array<double>")
    assert results(knn.top_k(two, F.col("vec_id") % 50 == 0)) == [(0, 1, 1, 256 * 768)]
    for rows in ([], [(1, [1.0])], [(0, [1.0])]):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        assert knn.top_k(df, F.col("vec_id") % 50 == 0).collect() == []


def test_large_components_stay_exact():
    q = np.array([[2**40, 3]], dtype=np.int64)
    x = np.array([[2**10, 1], [2**10, 2], [-5, 7]], dtype=np.int64)
    rows, columns, scores = knn.best_of(np.array([9]), q, np.array([1, 2, 3]), x, 2)
    assert columns.tolist() == [1, 0] and scores.tolist() == [2**50 + 6, 2**50 + 3]
    # sums pass 64 bits on the way, the results do not
    q = np.array([[2**40, 2**40, 1]], dtype=np.int64)
    x = np.array([[2**23, -(2**23), 5], [2**24, -(2**24), 9], [-(2**30), 1, 0], [2**22, 1, 0]], dtype=np.int64)
    rows, columns, scores = knn.best_of(np.array([9]), q, np.arange(4), x, 3)
    assert columns.tolist() == [3, 1, 0] and scores.tolist() == [2**62 + 2**40, 9, 5]
    with pytest.raises(OverflowError):
        knn.best_of(np.array([9]), q, np.arange(1), np.array([[2**40, 0, 0]]), 1)


def brute_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def brute_rule(host, path):
    fits = []
    for rule in RULES:
        domain, _, start = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start):
            fits.append(rule)
    return max(fits, key=len, default=None)


URLS = [
    None, "", "no scheme", "http://", "http://NET/", "http://a.net", "http://a.net/", "http://a.Example.NET/en/x?y#z",
    "http://xexample.net/en/", "http://example.net/EN/", "https://example.com/de", "https://example.com/de/", "ftp://m.example.com?de/",
    "http://example.org/fr/1", "http://org/fr/", "a://b://c/d", "http://ÄB.example.org/fr/", "http://x.net\n/en", "http://h/" + "p/" * 3000,
]


def check_rules(rows):
    for r in rows:
        assert (r["host"], r["path"]) == brute_split(r["url"])
        assert r["rule"] == brute_rule(r["host"], r["path"])
        assert r["verdict"] in ("allow", "block")
        if r["rule"]:
            assert r["verdict"] == RULES[r["rule"]]


def test_rules_on_odd_urls(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS + URLS[:5])], "page_id long, url string")
    pages = pages.withColumn("verdict", F.lit("mine")).withColumn("suffix", F.lit(None).cast("string"))
    rows = url_filter.judge(pages).collect()
    assert len(rows) == len(URLS) + 5
    check_rules(rows)


@pytest.mark.parametrize("urls", [[], ["http://b.org/x", None], ["http://a.net/", "http://b.org/x"], ["http://a.org/fr/", "http://b.org/x"]])
def test_without_two_verdicts_to_learn_from(spark, urls):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    rows = url_filter.judge(pages).collect()
    check_rules(rows)
    only = "block" if "http://a.net/" in urls else "allow"
    assert all(r["verdict"] == only for r in rows if not r["rule"])


def test_trees_agree_with_held_out_rules(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    learn = F.pmod(F.xxhash64("url"), F.lit(4)) != 0
    rows = url_filter.judge(pages, learn=learn).where(~learn & F.col("rule").isNotNull()).collect()
    check_rules(rows)
    right = [(r["blocked"] >= 0.5) == (RULES[r["rule"]] == "block") for r in rows]
    assert len(right) > 100 and np.mean(right) >= 0.95


def test_trees_on_hosts_they_never_saw(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    learn = F.pmod(F.xxhash64("host"), F.lit(4)) != 0
    rows = url_filter.judge(pages, learn=learn).where(~learn & F.col("rule").isNotNull()).collect()
    right = [(r["blocked"] >= 0.5) == (RULES[r["rule"]] == "block") for r in rows]
    print("unseen hosts", len(right), np.mean(right))
    assert len(right) > 100 and np.mean(right) >= 0.8


def test_no_label_is_among_its_own_features(spark):
    rows = [(f"http://h{i}.x{i}.zz{i}/s{i}", "block" if i % 2 else "allow") for i in range(20)] + [("http://h0.x0.zz0/s0/more", None)]
    urls = spark.createDataFrame(rows, "url string, verdict string")
    host, path = url_filter.split_url(F.col("url"))
    urls = url_filter.lexical(urls.withColumn("host", host).withColumn("path", path))
    statistics = {key: url_filter.suffix_statistics(urls, key) for key in ("suffix", "domain", "section")}
    for r in url_filter.with_shares(urls, statistics).collect():
        # alone under its keys, a labelled URL knows nothing; the unlabelled one sees the label of the other
        want = 0.5 if r["verdict"] else 1 / 3
        assert [r[f"f_{key}_blocked"] for key in statistics] == [want] * 3


def test_native(spark):
    got = url_filter.query(spark, FOLDER)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    rows = got.join(spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url"), "page_id").collect()
    check_rules(rows)


def test_entropy(spark):
    df = spark.createDataFrame([("aabb",), ("aaaa",), ("abcd",)], "t string")
    assert [round(r[0], 9) + 0.0 for r in df.select(url_filter.entropy(F.col("t"))).collect()] == [1.0, 0.0, 2.0]
