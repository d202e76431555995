"""Exact and SimHash deduplication against brute force."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from sunledger.llm import exact_dedup, simhash
from tests.llm.fixtures import bag, clashing, documents, empty, odd

def brute_exact(rows):
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        text = text or ""
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        groups.setdefault(body, []).append((-len(text), doc_id is None, doc_id or 0, i, doc_id))
    out = []
    for body, members in groups.items():
        keep = min(members)
        for m in members:
            out.append((m[4], keep[4], len(members), hashlib.sha256(body.encode()).hexdigest()))
    return sorted(map(repr, out)), len(groups)


@pytest.mark.parametrize(
    ("make", "capacity", "key_bits"),
    [(documents, 4096, 64), (documents, 2, 3), (odd, 2, 64), (odd, 2, 3), (clashing, 4096, 64), (empty, 4096, 64)],
)
def test_exact_duplicates(spark, make, capacity, key_bits):
    docs = make(spark)
    want, groups = brute_exact([tuple(r) for r in docs.select("doc_id", "text").collect()])
    got = exact_dedup.exact_duplicates(docs, capacity=capacity, key_bits=key_bits)
    assert bag(got.select("doc_id", "keep_id", "group_size", "text_sha256")) == want
    assert got.where("kept").count() == groups
    if key_bits == 3 and groups > 8:
        assert got.where("chain > 0").count()  # different texts share a key


@pytest.mark.parametrize("make", [odd, clashing, empty])
def test_exact_deduplicate_keeps_columns(spark, make):
    docs = make(spark)
    got = exact_dedup.deduplicate(docs)
    assert got.columns == docs.columns
    assert got.count() == brute_exact([tuple(r) for r in docs.select("doc_id", "text").collect()])[1]


def test_hot_texts_and_crowded_cells(spark):
    """Copies merged in shares, and cells that are doubled beyond the shared directory."""
    rows = [(i, "hot text " * (1 + i % 3)) for i in range(300)] + [(1000 + i, f"text {i % 150}") for i in range(400)] + [(None, None)] * 90
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, groups = brute_exact(rows)
    got = exact_dedup.exact_duplicates(docs, capacity=3, max_depth=2, hot_copies=20)
    assert bag(got.select("doc_id", "keep_id", "group_size", "text_sha256")) == want
    assert got.where("kept").count() == groups


def test_the_result_comes_from_the_index(spark, monkeypatch):
    """Texts that a wrong directory sends to different owners are not found equal."""
    rows = [(i, f"text {i % 10}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    right = exact_dedup.routed

    def wrong(texts, cells, max_depth):
        lost = F.pmod(F.col("best.h1"), F.lit(2)).cast("int")
        return right(texts, cells, max_depth).withColumn("bucket", F.col("bucket") * 2 + lost).repartition("bucket", "own")

    monkeypatch.setattr(exact_dedup, "routed", wrong)
    with pytest.raises(AssertionError):
        assert bag(exact_dedup.exact_duplicates(docs).select("doc_id", "keep_id", "group_size", "text_sha256")) == brute_exact(rows)[0]


def test_owners_need_no_further_shuffle(spark):
    texts = spark.createDataFrame([(1, "a", 1, (1, 2, 3, 4))], "key long, body string, copies long, best struct<points:int,id:long,h1:long,h2:long>")
    cells = spark.createDataFrame([(0, 0, 0, 0)], exact_dedup.CELLS)
    owned = exact_dedup.routed(texts, cells, 16).groupBy("bucket", "own", "key", "body").agg(F.sum("copies"))
    plan = owned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_directory_doubles_until_no_bucket_is_overfull():
    counts = {c: 1 + (c % 5 == 0) * 10 for c in range(256)}
    cells = exact_dedup.double_directory(counts, 40, 8)
    assert sorted(c for c, _, _ in cells) == list(range(256))
    total = {}
    for cell, bucket, depth in cells:
        total.setdefault(bucket, []).append((cell, depth))
    for members in total.values():
        ids = [c for c, _ in members]
        assert ids == list(range(ids[0], ids[0] + len(ids)))  # a key range
        depth = members[0][1]
        assert depth == 8 or sum(counts[c] for c in ids) <= 40
        if depth:  # the parent was overfull
            parent = [c for c in counts if c >> (9 - depth) == ids[0] >> (9 - depth)]
            assert sum(counts[c] for c in parent) > 40
    assert exact_dedup.double_directory({}, 4, 8) == []
    assert exact_dedup.double_directory({7: 1000}, 4, 8) == [(7, 0, 8)]


def test_native(spark):
    plan = exact_dedup.query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def brute_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_components(rows, radius=3):
    fps = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        r = find(i)
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    return sorted(repr((d, f"{fps[i]:016x}", least.get(find(i)))) for i, (d, _) in enumerate(rows)), len({find(i) for i in range(len(rows))})


@pytest.mark.parametrize(("make", "limit"), [(documents, 4096), (odd, 2), (clashing, 4096), (empty, 4096)])
def test_near_duplicates(spark, make, limit):
    docs = make(spark)
    want, groups = brute_components([tuple(r) for r in docs.select("doc_id", "text").collect()])
    got = simhash.near_duplicates(docs, limit=limit)
    assert bag(got.select("doc_id", "fingerprint", "component_id")) == want
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert kept.count() == groups


def test_long_texts_cross_the_bit_count_steps():
    texts = ["x y z", None, " ".join(f"w{i}" for i in range(50_000)), "", "a b c d " * 9000]
    got = simhash.fingerprints(pa.array(texts)).view(np.uint64)
    assert [int(g) for g in got] == [brute_fingerprint(t) for t in texts]


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_every_pair_within_the_radius_shares_a_table(radius):
    rng = np.random.default_rng(1)
    masks = simhash.covering_masks(list(range(64)), radius, 7)
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(2000):
        flip = sum(1 << int(b) for b in rng.choice(64, size=radius, replace=False))
        assert any(not flip & m for m in masks)


def test_second_level_leaves_few_free_bits():
    for i, mask in enumerate(simhash.covering_masks(list(range(64)), 3, simhash.MASK_SEED)):
        free = [p for p in range(64) if not mask >> p & 1]
        for m in simhash.covering_masks(free, 3, simhash.MASK_SEED + 1 + i):
            assert 64 - (mask | m).bit_count() <= 17  # SUBBUCKET_LIMIT


@pytest.mark.parametrize("limit", [3, 4096])
def test_links_on_crowded_fingerprints(spark, limit):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 62, size=4)
    fps = set()
    for c in centres:
        for _ in range(150):
            x = int(c)
            for b in rng.choice(64, size=int(rng.integers(0, 7)), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(np.array(sorted(fps), dtype=np.uint64).view(np.int64).tolist())
    links = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), limit=limit)
    roots = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 3:
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    assert {f: roots.get(f, f) for f in fps} == {f: find(f) for f in fps}
