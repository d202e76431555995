"""Exact deduplication over an extendible-hash index on shared files (DataFrame functions only).

The pseudo-key of a text is the 64-bit hash of its normalised form.  A directory on the leading key
bits starts with one bucket and doubles while a bucket is overfull, so each bucket is a contiguous
key range.  Every text is routed through the directory to the owner task of its bucket.  The owner
compares the bytes of the texts of a key, makes an entry of each different text, with the number of its
copies and the row that stays, and chains the entries of a key.  The result is read from the index.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sunledger.llm.common import identity, joined_contents, read_table, stored, text_or_empty

WHITE_SPACE = r"[\x20\x09-\x0D]+"
BUCKET_CAPACITY = 4096  # entries (different texts) before a bucket splits
MAX_DEPTH = 16  # the shared directory has at most 2**16 cells; fuller cells are doubled on by their own bits
BROADCAST_ROWS = 1 << 20  # hot keys that are broadcast (16 bytes each); more of them are joined by a shuffle
HOT_COPIES = 1000  # texts of a key beyond which copies are merged before they are routed

CELLS = "cell int, bucket int, depth int, own_bits int"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, WHITE_SPACE, "")


def double_directory(counts: dict[int, int], capacity: int, max_depth: int) -> list[tuple[int, int, int]]:
    """Directory as (cell, bucket, local depth) for each occupied cell of ``max_depth`` bits.

    ``counts``: entries per cell.  Starts with one bucket of depth 0; an overfull bucket is split by
    its next key bit, and the directory doubles whenever a split needs more bits than it has.
    """
    buckets = {(0, 0): counts} if counts else {}
    for depth in range(max_depth):
        overfull = [b for b in buckets if b[1] == depth and sum(buckets[b].values()) > capacity]
        for prefix, _ in overfull:
            members = buckets.pop((prefix, depth))
            for bit in (0, 1):
                child = 2 * prefix + bit
                half = {c: n for c, n in members.items() if c >> (max_depth - depth - 1) == child}
                if half:
                    buckets[child, depth + 1] = half
    order = sorted(buckets, key=lambda b: b[0] << (max_depth - b[1]))
    return [(cell, i, b[1]) for i, b in enumerate(order) for cell in sorted(buckets[b])]


def directory(keys: DataFrame, capacity: int, max_depth: int) -> DataFrame:
    """The directory for different ``keys``; its counts per cell (at most 2**max_depth) pass the driver.

    A cell that is overfull at ``max_depth`` is doubled further inside: ``own_bits`` more key bits tell its
    buckets apart, so the number of buckets grows with the keys and the shared directory does not.
    """
    cell = F.shiftrightunsigned("key", 64 - max_depth).cast("int")
    counts = {r["cell"]: r["n"] for r in keys.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")).collect()}
    own = {c: max(0, ceil(log2(n / capacity))) for c, n in counts.items()}
    rows = [(c, b, d, own[c] if d == max_depth else 0) for c, b, d in double_directory(counts, capacity, max_depth)]
    return keys.sparkSession.createDataFrame(rows, CELLS)


def routed(texts: DataFrame, cells: DataFrame, max_depth: int) -> DataFrame:
    """``texts`` (with a key) in the tasks of their owners, with the bucket and its part ``own``."""
    cell = F.shiftrightunsigned("key", 64 - max_depth).cast("int")
    own = F.expr(f"if(own_bits = 0, 0L, shiftrightunsigned(shiftleft(key, {max_depth}), 64 - own_bits))")
    return (
        texts.withColumn("cell", cell)
        .join(F.broadcast(cells), "cell")
        .withColumn("own", own)
        .drop("cell", "depth", "own_bits")
        .repartition("bucket", "own")
    )


def build_index(texts: DataFrame, cells: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """Index as files sorted by bucket and key, one row per different text.

    ``texts``: key, body, copies and best, with copies of one text merged or not.  Routing by bucket is
    all that brings equal texts together: the owner's aggregate and chains need no further shuffle.
    """
    chain = Window.partitionBy("bucket", "own", "key").orderBy("text_sha256")
    same = Window.partitionBy("bucket", "own", "key", "text_sha256")
    owned = (
        routed(texts, cells, max_depth)
        .groupBy("bucket", "own", "key", "body")
        .agg(F.sum("copies").alias("group_size"), F.max("best").alias("best"))
        .withColumn("text_sha256", F.sha2(F.encode("body", "UTF-8"), 256))
        .drop("body")
        .withColumn("chain", F.row_number().over(chain) - 1)
        .withColumn("equal_digests", F.count("*").over(same))
        .withColumn(
            "chain",
            F.when(
                F.col("equal_digests") > 1, F.raise_error(F.lit("different texts with one SHA-256")).cast("int")
            ).otherwise(F.col("chain")),
        )
        .drop("equal_digests")
    )
    return stored(owned.sortWithinPartitions("bucket", "own", "key", "chain"), "dedup-index")


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = BUCKET_CAPACITY,
    max_depth: int = MAX_DEPTH,
    key_bits: int = 64,
    hot_copies: int = HOT_COPIES,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, bucket, chain, h1, h2.

    Texts are equal when identical without ASCII white space; a null text counts as empty.  Of equal
    texts the row with the most code points stays, then the smallest id (null last), then one of
    fully repeated rows.  Other columns are ignored (h1 and h2 identify the whole row).  An empty table
    gives an empty result.  ``key_bits`` shortens the hash (for tests of chains).

    Texts are shuffled once, to their owners.  Copies of a key with more than ``hot_copies`` texts are
    merged by their bytes before, in shares, so a text that fills a third of the table sends its owner a
    row per ``hot_copies`` copies.  Everything else handles digests.
    """
    texts = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(f"`{text_col}`").alias("text"), *identity(docs)
    )
    texts = texts.withColumn("body", normalised(F.col("text")))
    key = F.xxhash64("body") if key_bits == 64 else F.shiftleft(F.xxhash64("body"), 64 - key_bits)
    points = F.char_length("text")
    entries = stored(
        texts.select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            key.alias("key"),
            F.sha2(F.encode("body", "UTF-8"), 256).alias("text_sha256"),
            "h1",
            "h2",
        ),
        "dedup-entries",
    )
    keys = stored(entries.groupBy("key").agg(F.count("*").alias("texts")), "dedup-keys")
    cells = directory(keys, capacity, max_depth)
    best = F.struct(points.alias("points"), F.bitwise_not("doc_id").alias("id"), "h1", "h2").alias("best")
    hot = stored(keys.where(F.col("texts") > hot_copies).select(F.col("key").alias("hot_key"), "texts"), "dedup-hot")
    hot = F.broadcast(hot) if hot.count() <= BROADCAST_ROWS else hot
    carried = texts.select(key.alias("key"), "body", best).join(hot, F.col("key") == F.col("hot_key"), "left")
    share = F.pmod(F.col("best.h1"), F.ceil(F.col("texts") / hot_copies))
    merged = (
        carried.where("hot_key IS NOT NULL")
        .groupBy("key", "body", share.alias("share"))
        .agg(F.count("*").alias("copies"), F.max("best").alias("best"))
        .select("key", "body", "copies", "best")
    )
    single = carried.where("hot_key IS NULL").select("key", "body", F.lit(1).cast("long").alias("copies"), "best")
    index = build_index(single.unionByName(merged), cells, max_depth)
    kept = index.select("key", "text_sha256", F.col("best.h1").alias("h1"), F.col("best.h2").alias("h2"))
    picked = (
        entries.join(kept, ["key", "text_sha256", "h1", "h2"]).groupBy("key", "text_sha256").agg(F.min("row").alias("keep_row"))
    )
    found = index.select("key", "text_sha256", F.bitwise_not("best.id").alias("keep_id"), "group_size", "bucket", "chain")
    found = found.join(picked, ["key", "text_sha256"])
    return entries.join(found, ["key", "text_sha256"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        "text_sha256",
        "bucket",
        "chain",
        "h1",
        "h2",
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns unchanged."""
    kept = exact_duplicates(docs, id_col, text_col).where("kept").select("h1", "h2")
    return joined_contents(docs, kept).select("doc.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(body) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY body ORDER BY points DESC, doc_id)
"""
