"""Mixing and packing against brute force and exact round trips."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from sunledger.llm import mixing, packing
from tests.llm.fixtures import bag, clashing, documents, empty, odd

INPUTS = [documents, odd, clashing, empty]


def brute_targets(size_of):
    names = sorted(size_of, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    rest, open_, target = Fraction(sum(size_of.values())), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if rest * weight[s] / total > 3 * size_of[s]]
        if not over:
            target |= {s: rest * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = Fraction(3 * size_of[s])
            open_.remove(s)
        rest -= sum(target[s] for s in over)
    return target


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("make", INPUTS)
def test_mix(spark, make):
    docs = make(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "source", "text").collect()]
    size_of = defaultdict(int)
    for _, source, text in rows:
        size_of[source] += len(words(text))
    target = brute_targets(size_of)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == size_of[r["source"]]
        assert r["target"] == pytest.approx(float(target[r["source"]]), rel=1e-9, abs=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert sorted(repr((r["doc_id"], r["size"])) for r in got) == sorted(repr((d, len(words(t)))) for d, _, t in rows)
    for source, want in target.items():
        assert abs(taken[source] - want) <= 0.01 * want + 2 * mixing.BLOCK_WORDS
    again = mixing.mix(docs.repartition(7)).select("doc_id", "size", "taken")
    assert bag(again) == sorted(repr((r["doc_id"], r["size"], r["taken"])) for r in got)


@pytest.mark.parametrize("make", [documents, clashing])
def test_mixed_documents_hold_the_words_taken(spark, make):
    docs = make(spark)
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    want = mixing.mix(docs).agg(F.sum("taken")).first()[0] or 0
    assert sum(len(words(r["text"])) for r in got.select("text").collect()) == want
    whole = {tuple(words(r["text"])) for r in docs.select("text").collect()}
    parts = [tuple(words(r["text"])) for r in got.select("text").collect()]
    assert not parts or sum(p in whole for p in parts) > len(parts) / 4  # most documents stay whole


@pytest.mark.parametrize("fanout", [3])
def test_shards_in_a_deep_tree(spark, fanout, monkeypatch):
    monkeypatch.setattr(mixing, "FANOUT", fanout)
    docs = documents(spark)
    rows = mixing.mix(docs, shard_rows=9, block_words=8).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target")
    )
    for r in rows.collect():
        assert abs(r["taken"] - r["target"]) <= 0.01 * r["target"] + 16


def test_apportionment_is_sainte_lague(spark):
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for g in range(30):
        weights = rng.integers(0, 400, size=int(rng.integers(1, 12))).tolist()
        if g == 0:
            weights = [5, 5, 5, 5]
        seats = int(rng.integers(0, 60))
        won = [0] * len(weights)
        for _ in range(seats if sum(weights) else 0):
            i = max(range(len(weights)), key=lambda i: (Fraction(weights[i], 2 * won[i] + 1), -i))
            won[i] += 1
        for i, w in enumerate(weights):
            rows.append((g, i, seats, float(w)))
            want[g, i] = won[i]
    df = spark.createDataFrame(rows, "g int, i int, seats int, w double")
    got = {(r["g"], r["i"]): r["quota"] for r in mixing.apportion(df, ["g"], ["i"], "seats", "w").collect()}
    assert got == want


def whole_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.vocabulary_path())
    t.encode_special_tokens = True
    return [*t.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


@pytest.mark.parametrize("make", INPUTS)
def test_packing_round_trip(spark, make):
    docs = make(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = packing.pack(docs).collect()
    assert len({r["sequence_id"] for r in got}) == len(got)
    back = defaultdict(list)
    for r in sorted(got, key=lambda r: r["sequence_id"]):
        assert r["length"] == len(r["ids"]) == 1 << r["bucket"] <= 2048 and r["offset"] == 0
        back[r["doc_id"]].append(r)
    want = defaultdict(list)
    for doc_id, text in rows:
        want[doc_id].append(whole_ids(text))
    for doc_id, texts in want.items():
        pieces = back[doc_id]
        assert [x for p in pieces for x in p["ids"]] == [x for t in texts for x in t]
        at = 0
        for p in pieces:
            at = 0 if p["start"] == 0 else at
            assert p["start"] == at
            at += p["length"]
            assert p["doc_tokens"] in {len(t) for t in texts}
    digests = packing.pack(docs, digest=True).collect()
    crc = lambda ids: zlib.crc32(np.array(ids, dtype="<u4").tobytes())
    assert sorted(repr((r["doc_id"], r["start"], r["ids_crc32"])) for r in digests) == sorted(
        repr((r["doc_id"], r["start"], crc(r["ids"]))) for r in got
    )


def test_decomposition():
    for n in (1, 2, 3, 2047, 2048, 2049, 10_000):
        lengths = packing.piece_lengths(n, 2048)
        assert sum(lengths) == n and lengths == sorted(lengths, reverse=True)
        rest = [x for x in lengths if x < 2048]
        assert len(rest) == len(set(rest)) and all(x & (x - 1) == 0 for x in lengths)


def test_buckets_on_disk(spark, tmp_path):
    pieces = packing.pack(documents(spark))
    packing.write_buckets(pieces, str(tmp_path / "packed"))
    back = spark.read.parquet(str(tmp_path / "packed"))
    assert back.where("size(ids) <> shiftleft(1, bucket)").count() == 0
    assert back.count() == pieces.count()
    with pytest.raises(ValueError):
        packing.pack(documents(spark), longest=1000)


SPECIAL_TEXTS = [
    "a <|endoftext|> b",
    "<|endoftext|>",
    "<|startoftext|><|endoftext|><|endoftext|>x<|startoftext|>",
    "Don't<|endoftext|>'s 12<|endoftext|>34",
    "<|ENDOFTEXT|> <|EndOfText|> <| endoftext|> <|endoftext<|endoftext|>|>",
    "e<|endoftext|>\u0301 <|endoftext|>\u0338",
    "word " * 3000 + "<|endoftext|>" + " word" * 3000,
    "plain text",
    "",
    None,
]


def plain_ids(text):
    """The tokenizer's own call, without any setting."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.vocabulary_path())
    return [*t.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def test_added_tokens_have_their_own_ids(spark, tmp_path):
    import corpus_pipeline

    docs = spark.createDataFrame(list(enumerate(SPECIAL_TEXTS)), "doc_id long, text string")
    back = defaultdict(list)
    for r in sorted(packing.pack(docs, added_tokens=True).collect(), key=lambda r: r["sequence_id"]):
        back[r["doc_id"]] += r["ids"]
    assert back == {i: plain_ids(t) for i, t in enumerate(SPECIAL_TEXTS)}
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = set()
    for i, text in enumerate(SPECIAL_TEXTS):
        ids, at = plain_ids(text), 0
        for n in packing.piece_lengths(len(ids), 2048):
            want.add((i, at, n, zlib.crc32(np.array(ids[at : at + n], dtype="<u4").tobytes()), len(ids)))
            at += n
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    for got in (packing.query(spark, str(tmp_path)), corpus_pipeline.pack_stage(spark, docs, str(tmp_path))):
        assert {tuple(r) for r in got.select(columns).collect()} == want
