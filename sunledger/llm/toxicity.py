"""Toxicity by non-negative positive-unlabelled learning.

Training sees confirmed toxic documents and unlabelled ones; negative labels are never used as such.
The risk of a linear classifier is corrected by the class prior: prior * R+(positives) +
max(0, R-(unlabelled) - prior * R-(positives)).  Several classifiers are trained on bootstrap
samples and averaged.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm.common import id_remainder, read_table, slices, stored, text_or_empty, word_codes

HASH_BITS = 22
MAX_POSITIVES = 4000  # bounds of the training sample
MAX_UNLABELLED = 12000
FEATURES = 2048
MIN_POSITIVES = 3  # positives that hold a feature
MIN_STRENGTH = 3.0  # standard deviations by which a feature is more frequent in positives
CLASSIFIERS = 3
STEPS = 300
LEARNING_RATE = 0.1
L2 = 1e-5
SEED = 11
MINIMUM_FACTORS = (2654435761, 2246822519, 3266489917, 668265263)
THRESHOLD = 0.7
TRIM = ".,;:!?\"'()[]{}<>*&%$#@|/\\-_=+~`"


LETTERS = re.compile(r"[^\W\d_]+")
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]+")


def word_features(word: str) -> list[int]:
    """Hashed features of what stands between white space: the words in it, their beginnings and ends, and
    for scripts that set no spaces every two and three neighbouring characters."""
    word = word.lower().strip(TRIM)
    if not word:
        return []
    parts = set(_forms(word))
    if not word.isalpha():
        parts.update(form for piece in LETTERS.findall(word) for form in _forms(piece))
    if not word.isascii():
        for run in UNSPACED.findall(word):
            parts.update(f"~{run[i : i + k]}" for k in (2, 3) for i in range(len(run) - k + 1))
    return [zlib.crc32(p.encode("utf-8", "replace")) >> (32 - HASH_BITS) for p in parts]


def _forms(word: str) -> tuple[str, ...]:
    return (f"={word}", f"<{word[:4]}", f"<{word[:5]}", f"{word[-4:]}>") if len(word) > 2 else (f"={word}",)


def document_features(texts: pa.Array, wanted: dict[int, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) pairs, each once; with ``wanted`` only its features, by their column."""
    rows, codes, words = word_codes(texts)
    owner, feature = [], []
    for i, word in enumerate(words):
        for f in word_features(word):
            column = f if wanted is None else wanted.get(f)
            if column is not None:
                owner.append(i)
                feature.append(column)
    if not owner:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    owner_of, features = np.array(owner, dtype=np.int64), np.array(feature, dtype=np.int64)
    sizes = np.bincount(owner_of, minlength=len(words))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    lengths = sizes[codes]
    shift = np.repeat(starts[codes] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    pairs = np.unique(np.repeat(rows, lengths).astype(np.int64) << 32 | features[shift + np.arange(len(shift))])
    return pairs >> 32, pairs & 0xFFFFFFFF


def training_rows(docs: DataFrame, labels: DataFrame, learn, id_col: str, label_col: str) -> tuple[DataFrame, float]:
    """A bounded seeded sample (positive, text) of the labelled rows where ``learn`` holds, and the prior.

    Several labels of one id count as toxic if one is; null labels are unlabelled.
    """
    marked = (
        labels.where(learn)
        .groupBy(F.col(id_col).cast("long").alias("id"))
        .agg(F.max(label_col).alias("label"))
        .withColumn("draw", F.xxhash64(F.lit(SEED), "id"))
    )
    share = marked.agg(F.avg(F.col("label").cast("double"))).first()[0]
    positives = marked.where("label = 1").orderBy("draw", "id").limit(MAX_POSITIVES).select("id", F.lit(True).alias("positive"))
    unlabelled = marked.orderBy("draw", "id").limit(MAX_UNLABELLED).select("id", F.lit(False).alias("positive"))
    sample = positives.unionByName(unlabelled)  # bounded, so it may be broadcast
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty("text").alias("text"))
    return rows.join(F.broadcast(sample), "id").select("id", "positive", "text"), share or 0.0


def sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its distinct features and four minima of seeded hashes over them."""
    for batch in batches:
        for part in slices(batch, "text"):
            rows, features = document_features(part.column("text"))
            counts = np.bincount(rows, minlength=part.num_rows) if len(rows) else np.zeros(part.num_rows, dtype=np.int64)
            offsets = np.concatenate([[0], np.cumsum(counts)])
            minima = [_minima(features[s:e]) for s, e in zip(offsets, offsets[1:], strict=False)]
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(features.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("positive"), pa.array(minima, pa.string()), lists],
                names=["id", "positive", "minima", "features"],
            )


def _minima(features: np.ndarray) -> str | None:
    if not len(features):
        return None
    x = features.astype(np.uint64)
    return " ".join(str(int(((x * np.uint64(m)) & np.uint64(0xFFFFFFFF)).min())) for m in MINIMUM_FACTORS)


def fit_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], width: int, prior: float, seed: int) -> np.ndarray:
    """Weights and bias (last) that minimise the non-negative risk; rows are lists of columns."""
    rng = np.random.default_rng(seed)
    p = [positive[i] for i in rng.integers(len(positive), size=len(positive))]
    u = [unlabelled[i] for i in rng.integers(len(unlabelled), size=len(unlabelled))]

    def flat(rows):
        lengths = [len(r) for r in rows]
        return np.repeat(np.arange(len(rows)), lengths), np.concatenate([*rows, []]).astype(np.int64)

    (p_row, p_col), (u_row, u_col) = flat(p), flat(u)
    w = np.zeros(width + 1)
    w[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        zp = np.bincount(p_row, weights=w[p_col], minlength=len(p)) + w[-1]
        zu = np.bincount(u_row, weights=w[u_col], minlength=len(u)) + w[-1]
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        negative_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gp = prior * (sp - 1) / len(p)
        correction, gu = -prior * sp / len(p), su / len(u)
        if negative_risk < 0:  # the corrected risk must not go below zero: step back
            gp, correction, gu = np.zeros_like(gp), -correction, -gu
        gp = gp + correction
        grad = np.bincount(p_col, weights=gp[p_row], minlength=width + 1)
        grad += np.bincount(u_col, weights=gu[u_row], minlength=width + 1)
        grad[-1] = gp.sum() + gu.sum()
        grad[:-1] += L2 * w[:-1]
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad * grad
        w -= LEARNING_RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return w


def training_table(sample: DataFrame) -> DataFrame:
    """id, positive, features of the sample; (near) copies, which agree in all four minima, come once."""
    rows = stored(
        sample.mapInArrow(sample_features, "id long, positive boolean, minima string, features array<int>"),
        "toxicity-sample",
    )
    first = rows.where("minima IS NOT NULL").groupBy("positive", "minima").agg(F.min("id").alias("id"))
    once = rows.join(F.broadcast(first), ["positive", "minima", "id"], "left_semi").dropDuplicates(["positive", "id"])
    bare = rows.where("minima IS NULL").dropDuplicates(["positive", "id"])
    return once.unionByName(bare).select("id", "positive", "features")


def telling_features(rows: DataFrame, positives: int, unlabelled: int) -> list[int]:
    """The ``FEATURES`` features that are most over-represented in positives."""
    rate = (F.col("u") + 1) / (unlabelled + 1)
    strength = (F.col("p") / positives - rate) / F.sqrt(rate / positives)
    counts = (
        rows.select("positive", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u"))
    )
    best = (
        counts.where(F.col("p") >= MIN_POSITIVES)
        .withColumn("strength", strength)
        .where(F.col("strength") > MIN_STRENGTH)
        .orderBy(F.col("strength").desc(), "feature")
        .limit(FEATURES)
    )
    return sorted(r["feature"] for r in best.select("feature").collect())


def train(sample: DataFrame, prior: float) -> tuple[dict[int, int], np.ndarray]:
    """(column of each chosen feature, weights of each classifier).  The sample is bounded; only its
    chosen features come to the driver."""
    rows = training_table(sample)
    count = {r["positive"]: r["n"] for r in rows.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    if len(count) < 2:
        return {}, np.empty((0, 1))
    best = telling_features(rows, count[True], count[False])
    if not best:
        return {}, np.empty((0, 1))
    wanted = np.array(best, dtype=np.int32)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("features")
            flat, at = lists.values.to_numpy(), lists.offsets.to_numpy()
            found = np.searchsorted(wanted, flat).clip(max=len(wanted) - 1)
            hit = wanted[found] == flat
            before = np.concatenate([[0], np.cumsum(hit)])
            columns = pa.ListArray.from_arrays(
                pa.array((before[at] - before[at[0]]).astype(np.int32)),
                pa.array(found[at[0] : at[-1]][hit[at[0] : at[-1]]].astype(np.int32)),
            )
            kept = batch.select(["id", "positive"])
            yield pa.RecordBatch.from_arrays([*kept.columns, columns], names=["id", "positive", "columns"])

    got = rows.mapInArrow(narrow, "id long, positive boolean, columns array<int>").toPandas()
    got = got.sort_values(["positive", "id"])
    p, u = (list(got["columns"][x]) for x in (got.positive, ~got.positive))
    prior = min(max(prior, 0.001), 0.9)
    weights = np.stack([fit_nnpu(p, u, len(best), prior, SEED + i) for i in range(CLASSIFIERS)])
    return {f: i for i, f in enumerate(best)}, weights


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    score_col: str = "toxicity",
) -> DataFrame:
    """``docs`` with ``score_col`` (0 to 1), which depends on the text only.

    ``learn``: condition on ``labels`` rows to learn from.  A null text counts as empty and is scored
    like it; long texts are scored whole.  Without a positive, or a feature that tells positives apart, every
    score is 0; an empty table gives an empty one.  Repeated rows and equal texts score alike, ids that
    repeat are drawn once, ties in the draw go by id; an existing column ``score_col`` is replaced.
    """
    learn = F.lit(True) if learn is None else learn
    plain = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("text"))
    sample, prior = training_rows(plain, labels, learn, id_col, label_col)
    wanted, weights = train(sample, prior)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                total = np.zeros(part.num_rows)
                if len(weights):
                    rows, columns = document_features(part.column(text_col), wanted)
                    for w in weights:
                        z = np.bincount(rows, weights=w[columns], minlength=part.num_rows) + w[-1]
                        total += 1 / (1 + np.exp(-z)) / len(weights)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(total)], names=[*part.schema.names, score_col]
                )

    rest = docs.drop(score_col).withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    return rest.mapInArrow(run, rest.withColumn(score_col, F.lit(0.0)).schema)


def not_held_out() -> Column:
    return F.coalesce(id_remainder("doc_id", 3) != 1, F.lit(True))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, read_table(spark, sf_dir, "labels"), not_held_out())
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (~not_held_out()).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those predicted toxic; columns unchanged."""
    name = "toxicity"
    while name in docs.columns:
        name += "_"
    return score_toxicity(docs, labels, not_held_out(), score_col=name).where(F.col(name) < THRESHOLD).drop(name)
