"""Small inputs with nulls, empty and long texts, ties, repeated rows and clashing column names."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
LONG = " ".join(f"word{i % 997}" for i in range(30_000))

ODD_ROWS = [
    (1, "a b c d e f", "en", "s1", 11),
    (2, "a  b c\td e f", "en", "s1", 12),
    (3, "abcdef ", "en", "s2", 7),
    (4, None, None, None, None),
    (5, "", "de", "s2", 0),
    (6, " \t\n", "de", None, 3),
    (7, LONG, "en", "s3", len(LONG)),
    (8, LONG + " ", "en", "s3", len(LONG) + 1),
    (9, "Ünïcode ÄÖ 漢字 <|endoftext|> 🙂 é", "de", "s4", 20),
    (9, "Ünïcode ÄÖ 漢字 <|endoftext|> 🙂 é", "de", "s4", 20),
    (None, "no id here at all", "en", "s5", 17),
    (None, "no id here at all", "en", "s5", 17),
    (10, "one", "fr", "s5", 3),
    (11, "one two", "fr", "s5", 7),
    (12, "no id here at all", "en", "s6", 17),
]

CLASHES = ["row", "key", "body", "best", "fp", "kept", "shard", "size", "words", "doc", "toxicity", "_text", "score", "group_size"]


def odd(spark):
    return spark.createDataFrame(ODD_ROWS, SCHEMA)


def clashing(spark):
    from pyspark.sql import functions as F

    return odd(spark).select("*", *[F.lit(f"mine-{c}").alias(c) for c in CLASHES])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")


def bag(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))
