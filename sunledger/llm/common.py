"""Helpers of the training-data operators: shared tables, bounded slices, words as codes."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.session import work_folder

SLICE_BYTES = 4 << 20  # text that a task looks at together


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder of ``spark.checkpoint.dir``.

    Cuts the lineage: the table outlives the executors that wrote it.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def identity(docs: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a whole row, ``h1`` and ``h2``: rows that agree in both are equal."""
    parts: list[Column] = []
    for i, field in enumerate(docs.schema.fields):
        column = F.col(f"`{field.name}`")
        hashable = "map<" not in field.dataType.simpleString()
        parts += [F.lit(i), column if hashable else F.to_json(F.struct(column))]
    return [F.xxhash64(F.lit(seed), *parts).alias(f"h{seed}") for seed in (1, 2)]


def joined_contents(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """``decisions`` (with h1, h2 of :func:`identity`) with the row they speak of as the struct ``doc``.

    Equal rows of ``docs`` collapse before the shuffle, so each decision meets one row.
    """
    contents = docs.select(*identity(docs), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    contents = contents.dropDuplicates(["h1", "h2"])
    keys = [F.col(h).alias(f"of_{h}") for h in ("h1", "h2")]
    chosen = decisions.select("*", *keys).drop("h1", "h2")
    same = (F.col("h1") == F.col("of_h1")) & (F.col("h2") == F.col("of_h2"))
    return contents.join(chosen, same).drop("h1", "h2", "of_h1", "of_h2")


def id_remainder(column: str, modulus: int) -> Column:
    """``crc32(id as text) mod modulus``; null for a null id."""
    return F.crc32(F.col(column).cast("string")) % modulus


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with at most ``limit`` bytes of text each (or one row)."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(sizes, dtype=np.int64) - 1) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        yield batch.slice(int(start), int(end - start))
    give_back()


def give_back() -> None:
    """Return freed memory to the system: workers are reused and should not keep a peak."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def letter_kinds(pre_tokenizer, points: str) -> np.ndarray:
    """How a tokenizer that parts letters, numbers and marks sees each code point: L joins letters, N stands alone, O joins marks."""
    pieces = pre_tokenizer.pre_tokenize_str(" ".join("a" + c + c for c in points))
    per_point = np.bincount([start // 4 for _, (start, _) in pieces], minlength=len(points))
    return np.array([ord("X"), ord("L"), ord("O"), ord("N")], dtype=np.uint8)[per_point]


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words between ASCII white space as (row of each word, code of each word, distinct words)."""
    words = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    offsets = words.offsets.to_numpy()
    flat = words.flatten()
    rows = np.repeat(np.arange(len(texts)), np.diff(offsets))
    some = pc.greater(pc.binary_length(flat), 0)
    encoded = flat.filter(some).dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False)
    return rows[some.to_numpy(zero_copy_only=False)], codes, encoded.dictionary.to_pylist()
