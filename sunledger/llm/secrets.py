"""Secret scan: candidates by two patterns (long runs of key letters, assigned values), false positives removed by a random forest.

The forest sees the candidate's length, its transitions between character classes, how much of it is
made of letter sequences that are common in the corpus, its path and the neighbouring words.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm.common import id_remainder, read_table, slices, stored, text_or_empty

# Borders are ASCII: a key may touch a letter of another script.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9_])[A-Za-z0-9_+/\-]{16,}={0,2}(?![A-Za-z0-9_])")
CONTEXT = 48  # characters of either side
GRAM_BITS = 16
COMMON_GRAM = 2e-5  # share of all letter sequences from which one counts as common
WORD_BUCKETS = 16
PATH_BUCKETS = 8
MAX_FINDINGS = 20_000  # expected training findings per class
TREES = 30
DEPTH = 8
SEED = 23

# Documented key formats and the names that secrets are assigned to.
KNOWN_FORMAT = r"^(AKIA[0-9A-Z]{16}|ghp_[A-Za-z0-9]{36}|xox[abp]-[0-9A-Za-z-]{20,})$"
NAMES = r"password|passwd|secret|token|api[_-]?key"
ASSIGNED = rf"(?i)({NAMES})['\"]?\s*[:=]\s*['\"]?$"
ASSIGNMENT = re.compile(rf"(?i)(?:{NAMES})\\*['\"`]?\s*(?::=|=>|={{2,3}}(?=[\s'\"`])|[:=])\s*(?:[bfru]{{1,2}}(?=['\"]))?")
QUOTE = re.compile(r"(\\*)(['\"`])")
RUN = re.compile(r"\S+")
MIN_KNOWN = 8  # characters from which an assigned value with a digit is taken as verified
PLAIN = r"^[A-Za-z]+$"

CANDIDATES = (
    "doc_id long, path string, start int, candidate string, before string, after string, features array<double>"
)


def gram_codes(data: np.ndarray) -> np.ndarray:
    """Hashed codes of all runs of four ASCII letters in bytes, case folded."""
    low = data | 0x20
    letter = (low >= 97) & (low <= 122)
    if len(data) < 4:
        return np.empty(0, dtype=np.uint32)
    x = (low - 97).astype(np.uint32)
    four = letter[:-3] & letter[1:-2] & letter[2:-1] & letter[3:]
    code = ((x[:-3] * 26 + x[1:-2]) * 26 + x[2:-1]) * 26 + x[3:]
    return (code[four] * np.uint32(2654435761)) >> np.uint32(32 - GRAM_BITS)


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << GRAM_BITS, dtype=np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            joined = "\n".join(part.column("text").to_pylist()).encode("utf-8", "replace")
            total += np.bincount(gram_codes(np.frombuffer(joined, dtype=np.uint8)), minlength=len(total))
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["gram", "n"])


def common_grams(rows: DataFrame) -> np.ndarray:
    """Flags of the common letter sequences, counted over all texts; the table has 2**GRAM_BITS cells."""
    counts = rows.select("text").mapInArrow(count_grams, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    flags = np.zeros(1 << GRAM_BITS, dtype=bool)
    got = counts.toPandas()
    if len(got):
        flags[got.gram.to_numpy()] = got.n.to_numpy() >= COMMON_GRAM * got.n.sum()
    return flags


def _bucket(text: str, buckets: int) -> np.ndarray:
    out = np.zeros(buckets)
    out[zlib.crc32(text.encode("utf-8", "replace")) % buckets] = 1
    return out


def candidate_features(candidate: str, before: str, after: str, path: str, common: np.ndarray) -> np.ndarray:
    data = np.frombuffer(candidate.encode("utf-8", "replace"), dtype=np.uint8)
    kind = np.select([(data >= 97) & (data <= 122), (data >= 65) & (data <= 90), (data >= 48) & (data <= 57)], [0, 1, 2], 3)
    steps = np.bincount(kind[:-1] * 4 + kind[1:], minlength=16) / max(1, len(data) - 1)
    _, per_letter = np.unique(data, return_counts=True)
    share = per_letter / len(data)
    grams = gram_codes(data)
    left, right = re.findall(r"\w+", before), re.findall(r"\w+", after)
    mark = before.rstrip()[-1:]
    return np.concatenate(
        [
            [
                len(data),
                len(per_letter) / len(data),
                -(share * np.log2(share)).sum(),
                common[grams].sum() / len(data),
                float(mark in {"=", ":"}),
                float(mark in {"'", '"'}),
                float("=" in before[-6:] or ":" in before[-6:]),
            ],
            np.bincount(kind, minlength=4) / len(data),
            steps,
            _bucket(left[-1].lower() if left else "", WORD_BUCKETS),
            _bucket(right[0].lower() if right else "", WORD_BUCKETS),
            _bucket(path, PATH_BUCKETS),
        ]
    )


def assigned_spans(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of every value after an assigned name, of any length and characters.

    A quoted value ends at its closing quote.  Any other reaches to white space; names inside it are
    assigned what follows up to the next name, so that the spans of a text stay within a few times
    its length.
    """
    run_end = 0  # of the run of the last value without quotes
    found = ASSIGNMENT.search(text)
    while found:
        start, following = found.end(), ASSIGNMENT.search(text, found.end())
        quote = QUOTE.match(text, start)
        close = _closing(text, quote) if quote else -1
        if close >= 0:
            if close > quote.end():
                yield quote.end(), close
        if close < 0 or "\n" in text[quote.end() : close]:  # perhaps a quote that nobody closed
            start = quote.end() if quote else start
            run = RUN.match(text, start)
            if run and start < run_end and following:
                yield start, max(start + 1, min(run.end(), following.start()))
            elif run:
                yield run.span()
            run_end = max(run_end, run.end() if run else 0)
        found = following


def _closing(text: str, quote: re.Match) -> int:
    """Place of the same quote, escaped as often, after an opening one; -1 if there is none."""
    at = text.find(quote[0], quote.end())
    while at >= 0 and not quote[1] and _escaped(text, at, quote.end()):
        at = text.find(quote[0], at + 1)
    return at


def _escaped(text: str, at: int, begin: int) -> bool:
    slashes = at
    while slashes > begin and text[slashes - 1] == "\\":
        slashes -= 1
    return (at - slashes) % 2 == 1


def spans(text: str) -> list[tuple[int, int]]:
    """Start and end of all candidates of a text, each once."""
    return sorted({m.span() for m in CANDIDATE.finditer(text)} | set(assigned_spans(text)))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """All candidates (``CANDIDATES``) of whole texts with their features.

    A candidate is a run of 16 or more key letters or the value after an assigned name; where the two
    differ, both are candidates.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"),
        text_or_empty(text_col).alias("text"),
    )
    common = common_grams(rows)
    names = ["doc_id", "path", "start", "candidate", "before", "after", "features"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hit = pc.match_substring_regex(part.column("text"), rf"[A-Za-z0-9_+/\-]{{16,}}|(?i:{NAMES})")
                columns: list[list] = [[] for _ in names]
                some = part.filter(hit)
                for doc_id, path, text in zip(*(some.column(c).to_pylist() for c in ("doc_id", "path", "text")), strict=True):
                    for start, end in spans(text):
                        found, before, after = text[start:end], text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
                        features = candidate_features(found, before, after, path, common)
                        for column, value in zip(columns, (doc_id, path, start, found, before, after, features), strict=True):
                            column.append(value)
                kinds = [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.list_(pa.float64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return rows.mapInArrow(run, CANDIDATES)


def verified_findings() -> Column:
    """Label of a candidate: true for a documented format or an assigned value with a digit, false for
    plain words, null where nothing is known."""
    value = F.col("candidate")
    assigned = F.col("before").rlike(ASSIGNED) & value.rlike("[0-9]") & (F.length(value) >= MIN_KNOWN)
    secret = value.rlike(KNOWN_FORMAT) | assigned
    return F.when(secret, True).when(value.rlike(PLAIN), False)


def scan(docs: DataFrame, label: Column | None = None, learn: Column | None = None, **columns: str) -> DataFrame:
    """One row per candidate: doc_id, path, start (characters), length, candidate, score (0 to 1), finding.

    ``label`` says whether a candidate of the training rows is a secret (null: unknown) and ``learn``
    which documents to learn from.  Null and empty texts have no candidate.  Without labels of both
    kinds the score is 1 and every candidate stays a finding.  Repeated rows give repeated findings;
    other columns are ignored.
    """
    label = verified_findings() if label is None else label
    learn = F.lit(True) if learn is None else learn
    found = stored(candidates(docs, **columns), "secret-candidates")
    known = found.where(learn).select(label.cast("double").alias("label"), "features", "doc_id", "start").where("label IS NOT NULL")
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) == 2:
        share = F.when(F.col("label") == 1, MAX_FINDINGS / counts[1.0]).otherwise(MAX_FINDINGS / counts[0.0])
        drawn = known.where(F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "start"), F.lit(1_000_003)) < share * 1_000_003)
        forest = RandomForestClassifier(
            featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, probabilityCol="p"
        ).fit(drawn.select("label", array_to_vector("features").alias("vector")))
        scored = forest.transform(found.withColumn("vector", array_to_vector("features")))
        scored = scored.withColumn("score", F.get(vector_to_array("p"), F.lit(1)))
    else:
        scored = found.withColumn("score", F.lit(1.0))
    return scored.select(
        "doc_id",
        "path",
        "start",
        F.length("candidate").alias("length"),
        "candidate",
        "score",
        (F.col("score") >= 0.5).alias("finding"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = F.coalesce(id_remainder("doc_id", 3) != 1, F.lit(True))
    found = scan(read_table(spark, sf_dir, "documents"), learn=learn)
    return found.select(
        "doc_id", "start", "length", F.sha2("candidate", 256).alias("candidate_sha256"), "score", "finding"
    )
