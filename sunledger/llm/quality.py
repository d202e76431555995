"""Quality classifier by co-training of a text view and a page-metadata view.

Both views start from the labelled sample.  In each round both score every document outside that sample, and
a view's most confident predictions among all of them become pseudo-labels for the other view.  The final
views are calibrated on labelled documents that neither was trained on, and their evidence is added to
score all documents.  Features are computed once, into a table that the rounds and the final scores read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sunledger.llm.common import id_remainder, read_table, slices, stored, text_or_empty, word_codes

MAX_LABELLED = 6000  # bound of the labelled training sample
WORD_BITS = 16
META_BUCKETS = 64
ROUNDS = 4
EXCHANGED = 300  # documents that a view hands the other in a round, in the proportion of the classes
STEPS, MORE_STEPS = 200, 100  # of the first fit, and of the fits that go on from it
RATE = 0.1
PLATT_STEPS = 2000
L2 = 1e-4
SEED = 17
THRESHOLD = 0.5
META_NUMBERS = 8

SPARSE = "array<int>"
FEATURES = ["words", "numbers", "buckets"]
ASCII_KINDS = {
    code: kind for kind, first, last in (("A", "A", "Z"), ("a", "a", "z"), ("0", "0", "9")) for code in range(ord(first), ord(last) + 1)
}


def content_features(texts: pa.Array) -> list[np.ndarray]:
    """Text view: hashed word forms and word shapes, each once per text."""
    rows, codes, words = word_codes(texts)
    hashed = np.array([_word_feature(w) for w in words] or [(0, 0)], dtype=np.int64)
    pairs = np.concatenate([rows.astype(np.int64) << 32 | hashed[codes, i] for i in (0, 1)]) if len(rows) else np.empty(0, dtype=np.int64)
    pairs = np.unique(pairs)
    return np.split(pairs & 0xFFFFFFFF, np.searchsorted(pairs >> 32, np.arange(1, len(texts))))


def _word_feature(word: str) -> tuple[int, int]:
    """Hashes of a word's form and of the kinds of its first and last characters."""
    shape = word[:1] + "~" + word[-3:]
    if not shape.isascii():
        shape = "".join("A" if c.isupper() else "a" if c.isalpha() else c for c in shape)
    data = shape.translate(ASCII_KINDS).encode("utf-8", "replace")
    form = word.lower().encode("utf-8", "replace")
    return zlib.crc32(form) >> (32 - WORD_BITS), zlib.crc32(data) >> (32 - WORD_BITS)


def metadata_features(texts: pa.Array, source: pa.Array, lang: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Page view: layout numbers and hashed buckets of source and language."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    chars = pc.utf8_length(texts).to_numpy().astype(float)
    share = lambda pattern: pc.count_substring_regex(texts, pattern).to_numpy() / np.maximum(chars, 1)
    lines = pc.count_substring(texts, "\n").to_numpy() + 1.0
    numbers = np.stack(
        [
            np.log1p(chars) / 10,
            np.log1p(lines) / 5,
            np.log1p(chars / lines) / 8,
            share(r"\p{Lu}") * 5,
            share(r"[0-9]") * 10,
            share(r"[^\p{L}\p{N}\s]") * 5,
            share(r"[ \t]{2,}") * 10,
            share(r"https?://") * 100,
        ],
        axis=1,
    )
    buckets = np.stack(
        [[zlib.crc32(f"{kind}={x.as_py()}".encode()) % META_BUCKETS for x in column] for kind, column in (("s", source), ("l", lang))],
        axis=1,
    ) if len(texts) else np.empty((0, 2), dtype=np.int64)
    return numbers, buckets


def view_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            numbers, buckets = metadata_features(part.column("text"), part.column("source"), part.column("lang"))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    part.column("label"),
                    pa.array(content_features(part.column("text")), pa.list_(pa.int32())),
                    pa.array(list(numbers), pa.list_(pa.float64())),
                    pa.array(list(buckets), pa.list_(pa.int32())),
                ],
                names=["id", "label", "words", "numbers", "buckets"],
            )


class Logistic:
    """Logistic regression on sparse indicator columns and dense numbers."""

    def __init__(self, width: int, dense: int):
        self.sparse, self.dense, self.bias = np.zeros(width), np.zeros(dense), 0.0
        self.scale, self.shift = 1.0, 0.0  # calibration

    def margin(self, columns: list[np.ndarray], numbers: np.ndarray) -> np.ndarray:
        row = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
        flat = np.concatenate([*columns, np.empty(0, dtype=np.int64)]).astype(np.int64)
        norm = np.sqrt(np.maximum(1, np.bincount(row, minlength=len(columns))))
        return np.bincount(row, weights=self.sparse[flat], minlength=len(columns)) / norm + numbers @ self.dense + self.bias

    def calibrated(self, columns: list[np.ndarray], numbers: np.ndarray) -> np.ndarray:
        """Calibrated log-odds."""
        return self.scale * self.margin(columns, numbers) + self.shift

    def fit(self, columns: list[np.ndarray], numbers: np.ndarray, label: np.ndarray, steps: int) -> None:
        """Gradient steps on the balanced logistic loss, from the present weights."""
        row = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
        flat = np.concatenate([*columns, np.empty(0, dtype=np.int64)]).astype(np.int64)
        norm = np.sqrt(np.maximum(1, np.bincount(row, minlength=len(columns))))
        balance = np.where(label > 0, 0.5 / max(1e-9, label.mean()), 0.5 / max(1e-9, 1 - label.mean())) / len(label)
        w = np.concatenate([self.sparse, self.dense, [self.bias]])
        mean, square = np.zeros_like(w), np.zeros_like(w)
        s, d = len(self.sparse), len(self.dense)
        for step in range(1, steps + 1):
            z = np.bincount(row, weights=w[flat], minlength=len(columns)) / norm + numbers @ w[s : s + d] + w[-1]
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) * balance
            grad = np.concatenate([np.bincount(flat, weights=(g / norm)[row], minlength=s), numbers.T @ g, [g.sum()]]) + L2 * w
            mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad * grad
            w -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
        self.sparse, self.dense, self.bias = w[:s], w[s : s + d], float(w[-1])

    def calibrate(self, columns: list[np.ndarray], numbers: np.ndarray, label: np.ndarray) -> None:
        """Platt scaling: gradient descent on standardised margins."""
        z = self.margin(columns, numbers)
        middle, spread = z.mean(), z.std() + 1e-9
        x, a, b = (z - middle) / spread, 1.0, 0.0
        target = np.where(label > 0, (label.sum() + 1) / (label.sum() + 2), 1 / ((1 - label).sum() + 2))
        for _ in range(PLATT_STEPS):
            g = 1 / (1 + np.exp(-(a * x + b))) - target
            a, b = max(a - 2 * (g * x).mean(), 0.0), b - 2 * g.mean()
        self.scale, self.shift = a / spread, b - a * middle / spread


class Examples:
    """Features of training rows, by position."""

    def __init__(self):
        self.words, self.buckets, self.numbers = [], [], []

    def add(self, rows) -> range:
        first = len(self.words)
        self.words += [np.asarray(w, dtype=np.int64) for w in rows.words]
        self.buckets += [np.asarray(b, dtype=np.int64) for b in rows.buckets]
        self.numbers += [np.asarray(x, dtype=float) for x in rows.numbers]
        return range(first, len(self.words))

    def view(self, i: int, at: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        if i == 0:
            return [self.words[j] for j in at], np.zeros((len(at), 0))
        return [self.buckets[j] for j in at], np.array([self.numbers[j] for j in at]).reshape(len(at), META_NUMBERS)


def co_train(
    rows, confident: Callable | None = None, rounds: int = ROUNDS, exchanged: int | None = None
) -> tuple[list[Logistic], float] | None:
    """([text view, page view], log-odds of the labels) from a table with label (null: pool), words, numbers, buckets.

    ``confident(models, positive, negative, taken)`` gives, with columns view, label, key and the features, the
    rows that either view is surest of; ``taken`` are the keys that each has handed over.  Without it, the
    rows without a label are the pool, and a round exchanges a twentieth of them.
    """
    rows = rows.sort_values("id", kind="stable")
    examples = Examples()
    examples.add(rows)
    label = rows.label.to_numpy(dtype=float)
    known, pool = np.flatnonzero(~np.isnan(label)), np.flatnonzero(np.isnan(label))
    draw = np.random.default_rng(SEED).random(len(rows))
    train, check = known[draw[known] < 0.75], known[draw[known] >= 0.75]
    if len(set(label[train])) < 2 or len(set(label[check])) < 2:
        return None
    given = [{int(i): label[i] for i in train} for _ in range(2)]
    taken: list[set[int]] = [set(), set()]
    share = label[train].mean()
    models = [Logistic(1 << WORD_BITS, 0), Logistic(META_BUCKETS, META_NUMBERS)]
    n = exchanged or max(1, len(pool) // 20)
    positive, negative = int(round(n * share)), int(round(n * (1 - share)))
    for turn in range(rounds + 1):
        for i, (model, labels) in enumerate(zip(models, given, strict=True)):
            at = np.array(sorted(labels), dtype=np.int64)
            model.fit(*examples.view(i, at), np.array([labels[int(j)] for j in at]), MORE_STEPS if turn else STEPS)
        if turn == rounds:
            break
        if confident:
            got = confident(models, positive, negative, taken)
            for j, view, key, y in zip(examples.add(got), got["view"], got["key"], got["label"], strict=True):
                given[1 - view][j] = float(y)
                taken[view].add(int(key))
            continue
        for i, model in enumerate(models):
            other = given[1 - i]
            free = np.array([p for p in pool if int(p) not in other], dtype=np.int64)
            if not len(free):
                continue
            order = free[np.argsort(model.margin(*examples.view(i, free)), kind="stable")]
            for j in order[len(order) - positive :]:
                other[int(j)] = 1.0
            for j in order[:negative]:
                other.setdefault(int(j), 0.0)
    for i, model in enumerate(models):
        model.calibrate(*examples.view(i, check), label[check])
    return models, float(np.log(share / (1 - share)))


def lists(column: pa.Array) -> list[np.ndarray]:
    """The lists of an array column."""
    if not len(column):
        return []
    return np.split(column.flatten().to_numpy(), np.cumsum(pc.list_value_length(column).to_numpy())[:-1])


def views_of(batch: pa.RecordBatch) -> list[tuple[list[np.ndarray], np.ndarray]]:
    """(sparse columns, numbers) of either view."""
    numbers = batch.column("numbers").flatten().to_numpy().reshape(batch.num_rows, META_NUMBERS)
    return [(lists(batch.column("words")), np.zeros((batch.num_rows, 0))), (lists(batch.column("buckets")), numbers)]


def most_confident(features: DataFrame, models: list[Logistic], positive: int, negative: int, taken: list[set[int]]) -> DataFrame:
    """view, label, key: the ``positive`` highest and ``negative`` lowest margins of either view among all rows without a label.

    Rows alike in all features (one ``key``) count once; equal margins go by key.  A row among the highest is
    not among the lowest too.  Every task keeps its own best only, so little is shuffled.
    """
    known = [np.array(sorted(t), dtype=np.int64) for t in taken]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = {(view, label): (np.empty(0, np.int64), np.empty(0)) for view in (0, 1) for label in (0, 1)}
        for batch in batches:
            keys, first = np.unique(batch.column("key").to_numpy(), return_index=True)
            for view, part in enumerate(views_of(batch.take(pa.array(first)))):
                margin = models[view].margin(*part)
                free = ~np.isin(keys, known[view])
                for label, most in ((1, positive), (0, negative)):
                    held_keys, held = kept[view, label]
                    all_keys, at = np.unique(np.concatenate([held_keys, keys[free]]), return_index=True)
                    all_margins = np.concatenate([held, margin[free]])[at]
                    best = np.lexsort((all_keys, -all_margins if label else all_margins))[:most]
                    kept[view, label] = all_keys[best], all_margins[best]
        for (view, label), (keys, margin) in kept.items():
            columns = [np.full(len(keys), view, np.int32), np.full(len(keys), label, np.int32), keys, margin]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["view", "label", "key", "margin"])

    found = features.where("label IS NULL").select("key", *FEATURES).mapInArrow(run, "view int, label int, key long, margin double")
    surest = F.when(F.col("label") == 1, -F.col("margin")).otherwise(F.col("margin"))
    # alike rows have one margin but for the last bits, which may depend on the batch
    found = found.groupBy("view", "label", "key").agg(F.min("margin").alias("margin"))
    order = Window.partitionBy("view", "label").orderBy(surest, "key")
    most = F.when(F.col("label") == 1, positive).otherwise(negative)
    found = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= max(positive, negative))
    return found.where(F.col("place") <= most).groupBy("view", "key").agg(F.max("label").alias("label"))


def with_features(features: DataFrame, chosen: DataFrame) -> DataFrame:
    """``chosen`` (a bounded number of keys) with the features of one row of each key."""

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.empty(0, dtype=np.int64)
        for batch in batches:
            keys, first = np.unique(batch.column("key").to_numpy(), return_index=True)
            fresh = ~np.isin(keys, seen)
            seen = np.concatenate([seen, keys[fresh]])
            yield batch.take(pa.array(first[fresh]))

    keys = F.broadcast(chosen.select("key").distinct())
    rows = features.where("label IS NULL").select("key", *FEATURES).join(keys, "key")
    rows = rows.mapInArrow(once, rows.schema).dropDuplicates(["key"])
    return chosen.join(rows, "key").orderBy("view", "label", "key")


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per input row: doc_id, score (0 to 1, higher: better), content_score, metadata_score.

    ``learn``: condition on ids to learn labels from; at most ``MAX_LABELLED`` of them are drawn, and all other
    rows are the pool of every round.  A null text counts as empty, as does an empty one; very long texts are
    read whole; a null source or language is a value of its own.  With fewer than two classes of labels every
    score is 0.5.  Repeated rows score alike and count once in a round; of several rows with one labelled
    id, one is learnt from.  An empty table gives an empty result, other columns are ignored.
    """
    learn = F.lit(True) if learn is None else learn
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        text_or_empty(f"`{text_col}`").alias("text"),
        *[(F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string")).alias(c) for c in ("source", "lang")],
    )
    draw = F.xxhash64(F.lit(SEED), "id")
    marked = (
        labels.where(learn).where(F.col(f"`{label_col}`").isNotNull())
        .groupBy(F.col(f"`{id_col}`").cast("long").alias("id")).agg(F.min(f"`{label_col}`").cast("int").alias("label"))
    )
    sample = stored(marked.where("id IS NOT NULL").orderBy(draw, "id").limit(MAX_LABELLED), "quality-sample")
    given = rows.join(F.broadcast(sample), "id", "left")  # bounded by the parameter
    features = given.select("id", "label", "text", "source", "lang").mapInArrow(
        view_rows, f"id long, label int, words {SPARSE}, numbers array<double>, buckets {SPARSE}"
    )
    features = stored(features.withColumn("key", F.xxhash64(*FEATURES)), "quality-features")
    labelled = features.where("label IS NOT NULL").groupBy("id").agg(F.min_by(F.struct("label", *FEATURES), "key").alias("r"))

    def confident(models: list[Logistic], positive: int, negative: int, taken: list[set[int]]):
        return with_features(features, most_confident(features, models, positive, negative, taken)).toPandas()  # at most 4 x EXCHANGED rows

    trained = co_train(labelled.select("id", "r.*").toPandas(), confident, rounds, EXCHANGED)
    models, prior = trained or (None, 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odds = [np.zeros(batch.num_rows), np.zeros(batch.num_rows)]
            if models and batch.num_rows:
                odds = [model.calibrated(*view) for model, view in zip(models, views_of(batch), strict=True)]
            p = lambda z: pa.array(1 / (1 + np.exp(-np.clip(z, -50, 50))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), p(odds[0] + odds[1] - prior), p(odds[0]), p(odds[1])],
                names=["doc_id", "score", "content_score", "metadata_score"],
            )

    return features.select("id", *FEATURES).mapInArrow(run, "doc_id long, score double, content_score double, metadata_score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = F.coalesce(id_remainder("doc_id", 3) != 1, F.lit(True))
    got = score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), learn)
    return got.select(
        "doc_id",
        (~learn).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "content_score",
        "metadata_score",
    )
