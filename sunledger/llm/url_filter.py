"""URL filter: host rules first, gradient-boosted trees on lexical features for the rest.

DataFrame functions and Spark ML only.  The trees learn from the URLs that a rule decides.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm.common import read_table, stored

# The rules, as (host/path, verdict).
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
MAX_TRAINING_URLS = 200_000  # expected size of the seeded training sample of distinct labelled URLs
FOLDS = 5  # a labelled URL sees label shares of the other folds only
TREES = 15
DEPTH = 3
SEED = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = [
    "f_length",
    "f_host_length",
    "f_host_labels",
    "f_depth",
    "f_digits",
    "f_entropy",
    "f_parameters",
    "f_fragment",
    "f_longest_part",
    "f_suffix_pages",
    "f_suffix_blocked",
    "f_domain_pages",
    "f_domain_blocked",
    "f_section_pages",
    "f_section_blocked",
]


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def matching_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """(rule, its verdict): the longest rule whose host is the host or a parent domain of it and whose
    path begins the path; nulls without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, decision in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, _, start = name.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{start}")
        rule = F.when(fits, F.lit(name)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Bits per character."""
    letters = F.filter(F.split(text, ""), lambda c: c != "")
    share = lambda c: (F.length(text) - F.length(F.replace(text, c))) / F.length(text)
    bits = F.transform(F.array_distinct(letters), lambda c: -share(c) * F.log2(share(c)))
    return F.aggregate(bits, F.lit(0.0), lambda total, x: total + x)


def lexical(pages: DataFrame) -> DataFrame:
    """``pages`` (url, host, path, verdict) with the lexical features and the keys of the suffix statistics."""
    url = F.coalesce("url", F.lit(""))
    count = lambda c, pattern: F.regexp_count(c, F.lit(pattern)).cast("double")
    return (
        pages.withColumn("f_length", F.length(url).cast("double"))
        .withColumn("f_host_length", F.length("host").cast("double"))
        .withColumn("f_host_labels", count(F.col("host"), r"[^.]+"))
        .withColumn("f_depth", count(F.col("path"), r"/+[^/]"))
        .withColumn("f_digits", count(url, "[0-9]") / F.greatest(F.length(url), F.lit(1)))
        .withColumn("f_entropy", F.when(F.length(url) > 0, entropy(url)).otherwise(0.0))
        .withColumn("f_parameters", count(F.regexp_extract(url, r"\?([^#]*)", 1), r"[^&]+"))
        .withColumn("f_fragment", F.contains(url, F.lit("#")).cast("double"))
        .withColumn("f_longest_part", F.array_max(F.transform(F.split(url, "[/.?&=#-]"), F.length)).cast("double"))
        .withColumn("suffix", F.substring_index("host", ".", -1))
        .withColumn("domain", F.substring_index("host", ".", -2))
        .withColumn("section", F.regexp_extract("path", r"^/([^/]*)", 1))
    )


def fold_of_url() -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), F.lit("fold"), "url"), F.lit(FOLDS)).cast("int")


def suffix_statistics(pages: DataFrame, key: str) -> DataFrame:
    """Per ``key``: the logarithm of its number of URLs, and its labelled and blocked URLs by fold."""
    by_fold = lambda condition: F.array(*[F.count_if(condition & (fold_of_url() == i)) for i in range(FOLDS)])
    return pages.groupBy(key).agg(
        F.log(F.count("*")).alias(f"f_{key}_pages"),
        by_fold(F.col("verdict").isNotNull()).alias(f"{key}_labelled"),
        by_fold(F.coalesce(F.col("verdict") == "block", F.lit(False))).alias(f"{key}_blocked"),
    )


def with_shares(urls: DataFrame, statistics: dict[str, DataFrame]) -> DataFrame:
    """``urls`` with the statistics of their keys.

    The smoothed share of blocked URLs leaves out the fold of a labelled URL, so that no URL's own label is
    among its features.
    """
    for key, table in statistics.items():
        labelled, blocked = (
            F.aggregate(f"{key}_{n}", F.lit(0).cast("long"), lambda total, x: total + x)
            - F.when(F.col("verdict").isNotNull(), F.get(f"{key}_{n}", fold_of_url())).otherwise(0)
            for n in ("labelled", "blocked")
        )
        urls = (
            urls.join(table, key, "left")
            .withColumn(f"f_{key}_blocked", (blocked + 1) / (labelled + 2))
            .drop(f"{key}_labelled", f"{key}_blocked")
        )
    return urls


def judge(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: tuple[tuple[str, str], ...] = RULES,
    learn: Column | None = None,
) -> DataFrame:
    """One row per input row: page_id, url, host, path, rule, verdict (allow or block), blocked (probability).

    A rule decides where one fits; else the trees do, block from 0.5.  ``learn``: condition on
    (page_id, url, host, path) of the URLs to learn from.  A null URL has empty host and path and is judged like an
    empty one.  Where the labelled URLs have no two verdicts, the rest gets the only one, or allow.
    Repeated rows are judged alike; an empty table gives an empty result; other columns are ignored.
    """
    host, path = split_url(F.col("url"))
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    rows = rows.withColumn("host", host).withColumn("path", path)
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    known = F.lit(True) if learn is None else learn
    marked = lexical(rows.withColumn("rule", rule).withColumn("given", verdict)).withColumn(
        "verdict", F.when(known, F.col("given"))
    )
    urls = stored(marked, "url-features")
    distinct = urls.dropDuplicates(["url"])
    statistics = {key: stored(suffix_statistics(distinct, key), f"url-{key}") for key in ("suffix", "domain", "section")}
    counts = {r["verdict"]: r["n"] for r in distinct.groupBy("verdict").agg(F.count("*").alias("n")).collect()}
    labelled = counts.get("block", 0) + counts.get("allow", 0)
    if counts.get("block") and counts.get("allow"):
        share = MAX_TRAINING_URLS / labelled
        drawn = F.pmod(F.xxhash64(F.lit(SEED), "url"), F.lit(1_000_003)) < F.lit(share * 1_000_003)
        vector = VectorAssembler(inputCols=FEATURES, outputCol="f_all")
        train = vector.transform(with_shares(distinct.where(F.col("verdict").isNotNull() & drawn), statistics)).select(
            "f_all", (F.col("verdict") == "block").cast("double").alias("label")
        )
        trees = GBTClassifier(featuresCol="f_all", maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(train)
        scored = trees.transform(vector.transform(with_shares(urls, statistics)))
        scored = scored.withColumn("blocked", F.get(vector_to_array("probability"), F.lit(1)))
    else:
        scored = urls.withColumn("blocked", F.lit(1.0 if counts.get("block") else 0.0))
    own = F.when(F.col("blocked") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "url", "host", "path", "rule", F.coalesce("given", own).alias("verdict"), "blocked")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
