"""Collocations, token counts and lexical search against brute force and the tokenizer itself."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from functools import cache

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sunledger.llm import collocations, lexical, token_counts
from sunledger.llm.common import read_table
from tests.llm.fixtures import bag, clashing, documents, empty, odd

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ------------------------------------------------------------------ token counts


@cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_counts.vocabulary_path())


def prefix_tokens(text):
    return [len(tokenizer().encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]


@cache
def counter():
    return token_counts.Counter(token_counts.vocabulary_path())


ALPHABET = "aAbBeErRvVlLsStTmMdDoOiIhHnNcC''''!.,-<|>=&0129  \t\nİ̸̇́̌JjéÉüßǅ漢字한한क़काक़ 　 \x85\x1c​🙂ﬁΣσς²½\x00"


def test_every_prefix_of_random_texts():
    draw = random.Random(5)
    texts = []
    for _ in range(1200):
        text = "".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 14)))
        if draw.random() < 0.15:
            text += draw.choice(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>"]) + "".join(draw.choice(ALPHABET) for _ in range(3))
        texts.append(text)
    got = counter().slice(pa.array(texts, pa.string())).to_pylist()
    assert got == [prefix_tokens(t) for t in texts]


@pytest.mark.parametrize(
    "text",
    ["don't we're I'LL they've 'red ''s !'s 'r 've", "x" * 300, "ab" * 70 + "'re" * 40, "é" * 90 + "é" * 30, "TAKSİ. BELEDİYESİ, Türkiye J̌."],
)
def test_every_prefix_of_hard_words(text):
    assert counter().slice(pa.array([text])).to_pylist() == [prefix_tokens(text)]


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED_POINTS", 50)
    monkeypatch.setattr(token_counts, "CACHED_PAIRS", 40)
    small = token_counts.Counter(token_counts.vocabulary_path())
    for text in ("one two three four five", "six seven, eight! nine?", "one two ten eleven"):
        assert small.slice(pa.array([text, "", text[::-1]])).to_pylist() == [prefix_tokens(t) for t in (text, "", text[::-1])]


@pytest.mark.parametrize("make", [odd, clashing, empty])
def test_prefix_counts_on_odd_tables(spark, make):
    docs = make(spark)
    got = token_counts.prefix_counts(docs)
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    want = [(d, len(t.encode()), len(tokenizer().encode(t, add_special_tokens=False).ids), len(t) + 1) for d, t in rows]
    total = token_counts.total(F.col("counts"))
    assert bag(got.select("doc_id", "n_bytes", total, F.size("counts"))) == sorted(map(repr, want))


def test_query_counts_whole_documents(spark):
    got = {r["doc_id"]: tuple(r) for r in token_counts.query(spark, FOLDER).collect()}
    for r in documents(spark).collect():
        n = len(tokenizer().encode(r["text"] or "", add_special_tokens=False).ids)
        assert got[r["doc_id"]] == (r["doc_id"], len((r["text"] or "").encode()), n, n > 2048)


def test_budgets_without_encoding(spark):
    docs = documents(spark).where("doc_id % 7 = 0")
    stored = token_counts.prefix_counts(docs)
    cut = {r["doc_id"]: r["text"] for r in token_counts.truncated(docs, stored, 50).collect()}
    for r in docs.collect():
        text, kept = r["text"] or "", cut[r["doc_id"]] or ""
        n = lambda t: len(tokenizer().encode(t, add_special_tokens=False).ids)
        assert text.startswith(kept) and n(kept) <= 50
        assert kept == text or all(n(text[: len(kept) + k]) > 50 for k in (1, 2, 3))
    half = stored.select(token_counts.tokens_upto(F.col("counts"), F.lit(5)).alias("n"), F.col("doc_id")).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert all(r["n"] == prefix_tokens(texts[r["doc_id"]][:5])[-1] for r in half)


# ------------------------------------------------------------------ lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(docs, items, k=10):
    tf = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    tf = [(d, c) for d, c in tf if c]
    total, words = len(tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    out = []
    for item, text in items:
        terms = set(TERM.findall((text or "").translate(LOWER)))
        scores = []
        for d, c in tf:
            n = sum(c.values())
            m = 10 + 90 * n * total // words
            s = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms & c.keys()
            )
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(map(repr, out))


@pytest.mark.parametrize("shares", [(1,), (1 / 32, 1 / 4, 1)])
def test_search_is_brute_force(spark, monkeypatch, shares):
    monkeypatch.setattr(lexical, "CELL_COORDINATES", 300)  # many cells and parts
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 200)  # several blocks of queries
    docs, items = documents(spark), read_table(spark, FOLDER, "benchmark")
    want = brute_search([(r["doc_id"], r["text"]) for r in docs.collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert bag(lexical.search(docs, items, shares=shares)) == want


@pytest.mark.parametrize("make", [odd, clashing, empty])
def test_search_on_odd_tables(spark, make):
    docs = make(spark)
    asked = [(1, "A b word1 WORD1"), (1, "no id here at all"), (None, "漢字 ünïcode äö"), (2, ""), (3, None), (4, "unheard of")]
    items = spark.createDataFrame([(*a, "x") for a in asked], "item_id long, text string, score string")
    got = lexical.search(docs, items)
    assert bag(got) == brute_search([(r["doc_id"], r["text"]) for r in docs.collect()], asked)
    assert lexical.search(docs, items.where("false")).count() == 0


def test_bounds_keep_the_best():
    """A cell never loses one of the best vectors, whatever the score to beat."""
    draw = random.Random(3)
    vectors = [{t: draw.randint(1, 1000) for t in draw.sample(range(30), draw.randint(1, 12))} for _ in range(300)]
    table = pa.table(
        {
            "doc_id": pa.array([None if i % 50 == 0 else i % 90 for i in range(300)], pa.int64()),
            "row": pa.array(range(300)),
            "length": pa.array([math.sqrt(sum(x * x for x in v.values())) for v in vectors]),
            "terms": pa.array([list(v) for v in vectors], pa.list_(pa.int64())),
            "impacts": pa.array([list(v.values()) for v in vectors], pa.list_(pa.int64())),
        }
    )
    import numpy as np

    postings = lexical.Postings(table)
    for _ in range(60):
        terms = sorted(draw.sample(range(35), draw.randint(1, 8)))
        scores = [sum(v.get(t, 0) for t in terms) for v in vectors]
        for beat in (0, sorted(scores)[-10], sorted(scores)[-1], 10**6):
            order = sorted((i for i in range(300) if scores[i] >= max(beat, 1)), key=lambda i: (-scores[i], i % 50 == 0, 0 if i % 50 == 0 else i % 90, i))
            found, got = postings.best(np.array(terms), beat, 10)
            assert found.tolist() == order[:10] and got.tolist() == [scores[i] for i in order[:10]]


# ------------------------------------------------------------------ collocations


def brute_collocations(docs, least, top):
    counts, total = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 6):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = set()
        for p, a in candidates.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    q = p[i:j]
                    if len(q) < len(p) and 100 * a >= 100 * f[q]:
                        inside.add(q)
        scored = []
        for p, a in candidates.items():
            if p not in inside:
                s, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                phrase = " ".join(p)
                scored.append((-s, -a, phrase.encode(), (phrase, a, f[p[:k]], f[p[k:]], total[lang], s)))
        out += [(lang, r, *x[3]) for r, x in enumerate(sorted(scored)[:top], 1)]
    return sorted(map(repr, out))


@pytest.mark.parametrize(("least", "top", "shares"), [(4, 40, (1 / 8, 1)), (4, 7, (1 / 64, 1 / 16, 1 / 4, 1)), (9, 2000, (1,))])
def test_collocations_are_brute_force(spark, least, top, shares):
    docs = documents(spark)
    got = collocations.collocations(docs, least=least, top=top, shares=shares)
    assert bag(got) == brute_collocations([(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()], least, top)


@pytest.mark.parametrize("make", [odd, clashing, empty])
def test_collocations_on_odd_tables(spark, make):
    docs = make(spark)
    got = collocations.collocations(docs, least=2, top=50)
    assert bag(got) == brute_collocations([(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()], 2, 50)


def test_bounds_spare_frequent_words(spark):
    """Once a language is settled, words whose bound is below its last score are not expanded."""
    rows = [("en", "rare%d pair%d" % (i, i)) for i in range(12) for _ in range(3)] + [("en", "the cat of the dog of the house")] * 40
    docs = spark.createDataFrame(rows, "lang string, text string")
    seen = []
    got = collocations.collocations(docs, least=3, top=5, shares=(1 / 8, 1), report=lambda *x: seen.append(x))
    assert bag(got) == brute_collocations(rows, 3, 5)
    assert [n for stage, n, turn in seen if stage == "phrases of 2" and turn == 1] == [0]


def test_ties_with_the_last_place_are_expanded(spark):
    rows = [("en", f"a{i} b{i}") for i in range(30) for _ in range(5)] + [("en", f"c{i} d{i}") for i in range(5) for _ in range(10)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    for shares in ((1 / 100, 1), (1 / 2, 1)):
        assert bag(collocations.collocations(docs, least=5, top=10, shares=shares)) == brute_collocations(rows, 5, 10)


def test_one_code_for_two_words_is_noticed(spark, monkeypatch):
    docs = spark.createDataFrame([("en", "x y x y x y")], "lang string, text string")
    whole = collocations.codes_of

    def colliding(words, seed):
        made = whole(words, seed)
        return made * 0 + 7 if seed < 2 else made

    monkeypatch.setattr(collocations, "codes_of", colliding)
    assert bag(collocations.collocations(docs, least=2)) == brute_collocations([("en", "x y x y x y")], 2, 2000)
