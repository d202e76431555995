"""SimHash near-duplicates found by covering locality-sensitive hashing.

Each fingerprint bit gets a vector of radius + 1 bits.  Table v (every vector but zero) keeps the
bits whose vector has an odd product with v.  At most ``radius`` differing bits leave some v
orthogonal to all of them, so every pair within the radius agrees in that table: no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm.common import identity, joined_contents, read_table, slices, stored, text_or_empty

BITS = 64
RADIUS = 3
SHINGLE_WORDS = 3
HASH_SEED = 42
MASK_SEED = 7
BUCKET_LIMIT = 4096  # fingerprints compared directly; larger buckets are covered once more
SUBBUCKET_LIMIT = 1 << 17


def covering_masks(positions: list[int], radius: int, seed: int) -> list[int]:
    """2**(radius + 1) - 1 masks over the bit ``positions``, about half of them in each."""
    order = np.random.default_rng(seed).permutation(len(positions))
    vectors = (1 << (radius + 1)) - 1
    vector_of = {positions[p]: 1 + i % vectors for i, p in enumerate(order)}
    return [sum(1 << p for p in positions if (vector_of[p] & v).bit_count() % 2) for v in range(1, vectors + 1)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def shingle_hashes(text: bytes, words: int) -> list[int]:
    """XXH64 of each run of ``words`` words (the whole text when it has fewer)."""
    tokens = text.split()
    if not tokens:
        return []
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    if len(tokens) < words:
        return [digest(joined, HASH_SEED)]
    return [digest(joined[s:e], HASH_SEED) for s, e in zip(starts, ends[words - 1 :].tolist(), strict=False)]


def fingerprints(texts: pa.Array, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Fingerprints (int64) of texts; zero without a word."""
    lower = pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.large_binary())
    hashes: list[int] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(lower):
        own = shingle_hashes(text.as_py(), words)
        counts[i] = len(own)
        hashes += own
    out = np.zeros(len(texts), dtype=">u8")
    some = np.flatnonzero(counts)
    if len(some):
        starts = np.concatenate([[0], np.cumsum(counts[some])])
        all_hashes = np.array(hashes, dtype=np.uint64).astype(">u8")
        step = 1 << 14
        ones = np.zeros((len(some), BITS), dtype=np.int64)
        for begin in range(0, len(all_hashes), step):
            part = all_hashes[begin : begin + step]
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1)
            first = np.searchsorted(starts, begin, side="right") - 1
            last = np.searchsorted(starts, begin + len(part), side="left")
            at = np.maximum(starts[first:last] - begin, 0)
            ones[first:last] += np.add.reduceat(bits, at, axis=0, dtype=np.int64)
        out[some] = np.packbits(2 * ones > counts[some][:, None], axis=1).view(">u8").ravel()
    return out.astype(np.uint64).view(np.int64)


def fingerprint_column(docs: DataFrame, text_col: str, words: int) -> DataFrame:
    """``docs`` with the column ``fp``; ``text_col`` is the name of a non-null text column."""
    schema = docs.withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                fp = pa.array(fingerprints(part.column(text_col), words))
                yield pa.RecordBatch.from_arrays([*part.columns, fp], names=[*part.schema.names, "fp"])

    return docs.mapInArrow(run, schema)


def stars(members: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """(member, smallest member of its component) of distinct fingerprints linked within ``radius``.

    Breadth first over the members not reached yet: a group of close fingerprints costs one pass, and
    its pairs are never listed.
    """
    left = np.sort(members)
    ends, roots = [], []
    while len(left) > 1:
        root, frontier, left = left[0], [left[0]], left[1:]
        while frontier and len(left):
            near = np.bitwise_count((left ^ frontier.pop()).view(np.uint64)) <= radius
            reached = left[near]
            ends += reached.tolist()
            roots += [int(root)] * len(reached)
            frontier += list(reached)
            left = left[~near]
    return ends, roots


def bucket_links(radius: int, limit: int):
    """Task over rows (t, masked, fp) sorted by (t, masked): star links of each bucket.

    Holds one bucket of at most ``limit`` fingerprints; the members of a larger one go on as rows
    (t, fp, null).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_t, held_m, held_fp = (np.empty(0, dtype=np.int64) for _ in range(3))
        over: tuple[int, int] | None = None  # the bucket that is being passed on

        def out(t, a, b):
            return pa.RecordBatch.from_arrays(
                [pa.array(t, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["t", "a", "b"]
            )

        def close(t, masked, fp):
            starts = np.concatenate([[0], np.flatnonzero((np.diff(t) != 0) | (np.diff(masked) != 0)) + 1, [len(t)]])
            tables, ends, roots = [], [], []
            for g in np.flatnonzero(np.diff(starts) > 1):
                own = fp[starts[g] : starts[g + 1]]
                if len(own) > limit:
                    tables += t[starts[g] : starts[g + 1]].tolist()
                    ends += own.tolist()
                    roots += [None] * len(own)
                else:
                    a, b = stars(own, radius)
                    tables += [int(t[starts[g]])] * len(a)
                    ends += a
                    roots += b
            return out(tables, ends, roots)

        for batch in batches:
            t, masked, fp = (batch.column(i).to_numpy() for i in range(3))
            if over is not None:
                same = (t == over[0]) & (masked == over[1])
                yield out(t[same], fp[same], [None] * int(same.sum()))
                if not same.all():
                    over = None
                t, masked, fp = t[~same], masked[~same], fp[~same]
            t, masked, fp = (np.concatenate(x) for x in ((held_t, t), (held_m, masked), (held_fp, fp)))
            if not len(t):
                continue
            whole = int(np.flatnonzero((t != t[-1]) | (masked != masked[-1]))[-1] + 1) if (
                (t[0] != t[-1]) or (masked[0] != masked[-1])
            ) else 0
            if whole:
                yield close(t[:whole], masked[:whole], fp[:whole])
            held_t, held_m, held_fp = t[whole:], masked[whole:], fp[whole:]
            if len(held_t) > limit:
                over = (int(held_t[0]), int(held_m[0]))
                yield out(held_t, held_fp, [None] * len(held_t))
                held_t, held_m, held_fp = (np.empty(0, dtype=np.int64) for _ in range(3))
        if len(held_t):
            yield close(held_t, held_m, held_fp)

    return run


def links(distinct: DataFrame, radius: int = RADIUS, limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of ``fp`` within ``radius`` bits.

    A bucket with more than ``limit`` fingerprints is covered a second time on its free bits.  A
    second-level bucket leaves about 15 bits free, so it has a bounded number of fingerprints.
    """
    first = covering_masks(list(range(BITS)), radius, MASK_SEED)
    table = F.array(*[F.lit(signed(m)) for m in first])
    rows = distinct.select("fp", F.posexplode(table).alias("t", "mask")).select(
        F.col("t").cast("long").alias("t"), F.col("fp").bitwiseAND(F.col("mask")).alias("masked"), "fp"
    )
    found = stored(
        rows.repartition("t", "masked")
        .sortWithinPartitions("t", "masked")
        .mapInArrow(bucket_links(radius, limit), "t long, a long, b long"),
        "simhash-links",
    )
    second = []
    for i, mask in enumerate(first):
        free = [p for p in range(BITS) if not mask >> p & 1]
        second.append(F.array(*[F.lit(signed(mask | m)) for m in covering_masks(free, radius, MASK_SEED + 1 + i)]))
    again = found.where("b IS NULL").select(
        "t", F.col("a").alias("fp"), F.posexplode(F.element_at(F.array(*second), F.col("t").cast("int") + 1)).alias("u", "mask")
    )
    again = (
        again.select(
            (F.col("t") * 1000 + F.col("u")).alias("t"), F.col("fp").bitwiseAND(F.col("mask")).alias("masked"), "fp"
        )
        .repartition("t", "masked")
        .sortWithinPartitions("t", "masked")
        .mapInArrow(bucket_links(radius, SUBBUCKET_LIMIT), "t long, a long, b long")
    )
    return found.where("b IS NOT NULL").select("a", "b").unionByName(again.select("a", "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of an edge (a, b).

    Large-star and small-star steps in turn, each as an aggregate and a join; no neighbourhood is
    gathered.  Every round is written to the shared folder.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
            .select("e.a", F.col("e.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        edges = stored(small, "links")
        state = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.expr("hash(a, b)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    limit: int = BUCKET_LIMIT,
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id, kept, h1, h2.

    Fingerprints link at ``radius`` or fewer differing bits.  component_id is the smallest id
    reachable (null when the component has none); ``kept`` marks one row of each component, that with
    the smallest id (null last), the first one of repeated rows.  A null text counts as empty; empty
    texts have fingerprint zero and link like any other.  Other columns are ignored (h1 and h2
    identify the whole row).  An empty table gives an empty result.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), *identity(docs), text_or_empty(f"`{text_col}`").alias("text")
    )
    marked = stored(
        fingerprint_column(rows, "text", words).drop("text").withColumn("row", F.monotonically_increasing_id()),
        "simhash-fingerprints",
    )
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("best")
    distinct = stored(marked.groupBy("fp").agg(best), "simhash-distinct")
    roots = components(links(distinct, radius, limit))
    joined = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "best", F.coalesce("root", "fp").alias("root")
    )
    least = joined.groupBy("root").agg(F.min("best").alias("first"))
    of_fp = joined.join(least, "root").select("fp", "first")
    return marked.join(of_fp, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
        (F.col("row") == F.col("first.row")).alias("kept"),
        "h1",
        "h2",
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, all columns unchanged."""
    kept = near_duplicates(docs, id_col, text_col).where("kept").select("h1", "h2")
    return joined_contents(docs, kept).select("doc.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
