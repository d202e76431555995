"""Language identification by compression.

Each language has a zstandard raw-content dictionary of sample text.  A text is compressed with every
dictionary; the smallest result names the language, and a narrow margin rejects it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm.common import id_remainder, read_table, slices, stored

SAMPLE_TEXTS = 400  # texts per language that its dictionary may draw on
DICTIONARY_BYTES = 1 << 17
GROUP_LANGUAGES = 64  # languages that a task scores together; there may be any number of groups
# match finder: of the lazy kind, wide enough for a dictionary and one chunk
SEARCH_LOG, MIN_MATCH, WINDOW_LOG = 4, 4, 18
CHUNK_BYTES = 4096
NARROW = 0.005  # margins below are rejected
UNKNOWN = "und"


def dictionaries(docs: DataFrame, learn: Column, text_col: str, lang_col: str) -> DataFrame:
    """lang, data: a raw dictionary for every language, from a bounded sample of the rows where ``learn`` holds.

    Texts are drawn by their hash: what a language's threshold leaves is about twice what its dictionary may
    use, so no task gets the texts of a whole language.  Copies of a text are drawn once.
    """
    rows = docs.where(learn).select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    rows = rows.where("lang IS NOT NULL AND length(text) > 0").withColumn("draw", F.xxhash64(F.lit(3), "text"))
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("draw").alias("texts"))
    place = F.col("draw").cast("double") / 2.0**64 + 0.5
    drawn = (
        rows.join(stored(sizes, "language-sizes"), "lang")
        .where(place < 2.0 * SAMPLE_TEXTS / F.col("texts"))
        .groupBy("lang", "draw")
        .agg(F.first("text").alias("text"))
        .select("lang", "draw", F.octet_length("text").cast("long").alias("bytes"), F.substring("text", 1, DICTIONARY_BYTES).alias("text"))
    )

    def build(table: pa.Table) -> pa.Table:
        # texts that leave room for others come first
        got = table.append_column("long", pc.greater(table["bytes"], DICTIONARY_BYTES // 4))
        got = got.sort_by([("long", "ascending"), ("draw", "ascending")]).slice(0, SAMPLE_TEXTS)
        size, kept = 0, []
        for text in dict.fromkeys(letters_only(got["text"]).to_pylist()):
            data = text.encode("utf-8", "replace")
            if size + len(data) <= DICTIONARY_BYTES or not kept:
                kept.append(data)
                size += len(data)
        data = b"".join(reversed(kept))[-DICTIONARY_BYTES:]
        return pa.table({"lang": pa.array([table["lang"][0].as_py()]), "data": pa.array([data], pa.binary())})

    return stored(drawn.groupBy("lang").applyInArrow(build, "lang string, data binary"), "language-dictionaries")


def letters_only(texts: pa.Array) -> pa.Array:
    """Lower-case words between single spaces: case, digits and marks say little about a language."""
    return pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}\p{M}]+", " ")


def compressors(raw: dict[str, bytes]) -> list:
    import zstandard

    parameters = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_LAZY2,
        search_log=SEARCH_LOG,
        min_match=MIN_MATCH,
        window_log=WINDOW_LOG,
        hash_log=WINDOW_LOG - 1,
        chain_log=WINDOW_LOG - 1,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )
    made = []
    for data in raw.values():
        dictionary = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=parameters)
        made.append(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters))
    return made


def sizes(text: bytes, made: list) -> np.ndarray:
    """Compressed bytes of the whole text per language, in chunks that only share the dictionary."""
    chunks = [text[i : i + CHUNK_BYTES] for i in range(0, len(text), CHUNK_BYTES)]
    return np.array([sum(len(c.compress(x)) for x in chunks) for c in made], dtype=np.int64)


def measured(rows: DataFrame, raw: dict[str, bytes]) -> DataFrame:
    """``rows`` with the language of the least size among ``raw``, that size and the next one (null: there is none)."""
    names = list(raw)
    kept = [c for c in rows.columns if c != "text"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = compressors(raw)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = pc.fill_null(part.column("text"), "")
                lettered = pc.match_substring_regex(texts, r"\p{L}").to_pylist()
                langs, least, after = [], [], []
                for text, letter in zip(letters_only(texts), lettered, strict=True):
                    if not letter or not names:
                        langs.append(None)
                        least.append(None)
                        after.append(None)
                        continue
                    got = sizes(text.as_py().encode("utf-8", "replace"), made)
                    best = int(got.argmin())
                    langs.append(names[best])
                    least.append(int(got[best]))
                    after.append(int(np.delete(got, best).min()) if len(got) > 1 else None)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), pa.array(langs, pa.string()), pa.array(least, pa.int64()), pa.array(after, pa.int64())],
                    names=[*kept, "lang_pred", "least", "after"],
                )

    return rows.mapInArrow(run, f"{kinds}, lang_pred string, least long, after long")


def identify(
    docs: DataFrame,
    learn: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    group: int = GROUP_LANGUAGES,
) -> DataFrame:
    """One row per input row: doc_id, lang_pred, score (0 to 1), rejected, learnable.

    Only the text enters a prediction; every language that occurs among the rows to learn from can be
    predicted.  Null texts and texts without a letter are ``und`` with score 0, as is everything when there
    is nothing to learn from.  Ties go to the first language by name and are rejected like other narrow
    margins.  Repeated rows are predicted alike; long texts are compressed whole, in chunks; other columns
    are ignored; an empty table gives an empty result.

    Languages are scored ``group`` at a time, which bounds the memory of a task; with more languages every
    text is measured once per group and the least size found by an aggregate.
    """
    known = F.coalesce(F.lit(True) if learn is None else learn, F.lit(True))
    table = dictionaries(docs, known, text_col, lang_col)
    names = sorted(r["lang"] for r in table.select("lang").collect())
    groups = [names[i : i + group] for i in range(0, len(names), group)] or [[]]

    def loaded(langs: list[str]) -> dict[str, bytes]:
        got = {r["lang"]: bytes(r["data"]) for r in table.where(F.col("lang").isin(langs)).collect()} if langs else {}
        return {lang: got[lang] for lang in langs}

    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), known.alias("learnable")
    )
    if len(groups) == 1:
        found = measured(rows, loaded(groups[0]))
    else:
        rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "language-texts")
        parts = [stored(measured(rows, loaded(g)), "language-group") for g in groups]
        found = (
            reduce(DataFrame.unionByName, parts)
            .groupBy("row")
            .agg(
                F.first("doc_id").alias("doc_id"),
                F.first("learnable").alias("learnable"),
                F.min(F.when(F.col("least").isNotNull(), F.struct("least", "lang_pred"))).alias("best"),
                F.array_sort(F.flatten(F.collect_list(F.array("least", "after")))).alias("sizes"),
            )
            .select("doc_id", "learnable", "best.lang_pred", "best.least", F.get("sizes", F.lit(1)).alias("after"))
        )
    second = F.coalesce("after", 2 * F.col("least"))
    margin = (second - F.col("least")) / second
    return found.select(
        "doc_id",
        F.coalesce("lang_pred", F.lit(UNKNOWN)).alias("lang_pred"),
        F.coalesce(1 - F.exp(-margin / 0.02), F.lit(0.0)).alias("score"),
        F.coalesce(margin < NARROW, F.lit(True)).alias("rejected"),
        "learnable",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    got = identify(docs, id_remainder("doc_id", 4) != 2)
    return got.select("doc_id", (~F.col("learnable")).alias("held_out"), "lang_pred", "score", "rejected")
