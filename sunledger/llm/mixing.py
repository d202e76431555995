"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Every source is dealt into shards by a seeded hash.  The words of a shard, in seeded order, form one
stream that is cut into equal blocks.  Blocks are apportioned by highest quotients: first to sources
by their targets, then down a tree of shards (at most ``FANOUT`` children a node, so no group grows
with the data) to an integer quota per shard.  A shard takes whole rounds of its blocks and, for the
rest, a run of blocks from a seeded start; its documents follow from arithmetic on word positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sunledger.llm.common import identity, joined_contents, read_table, stored, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
BLOCK_WORDS = 32
SHARD_ROWS = 4096
FANOUT = 1024
MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
SEED = 20240229


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """Per source: source_size, weight, target.  ``sizes``: source, words (any number of rows).

    Targets share all words by weight; none exceeds ``repeats`` times its source, and what is cut off
    is shared again.  Sorted by the ratio at which a source is full, the full ones are a prefix.
    The windows run over one row per source.
    """
    sources = sizes.groupBy("source").agg(F.sum("words").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    before = Window.orderBy("full_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    cycle = F.array(*[F.lit(w) for w in weights])
    level = (F.col("total") - F.coalesce(F.col("cut"), F.lit(0))) / F.nullif(
        F.col("all_weight") - F.coalesce(F.col("cut_weight"), F.lit(0)), F.lit(0)
    )
    return (
        sources.withColumn("weight", F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights)))
        .withColumn("most", repeats * F.col("source_size"))
        .withColumn("full_at", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("cut", F.sum("most").over(before))
        .withColumn("cut_weight", F.sum("weight").over(before))
        .withColumn("full", F.col("full_at") <= level)
        .withColumn("cut", F.sum(F.when(F.col("full"), F.col("most"))).over(everything))
        .withColumn("cut_weight", F.sum(F.when(F.col("full"), F.col("weight"))).over(everything))
        .withColumn(
            "target",
            F.when(F.col("full"), F.col("most").cast("double")).otherwise(F.col("weight") * level),
        )
        .select("source", "source_size", "weight", "target")
    )


def apportion(rows: DataFrame, group: list[str], child: list[str], seats: str, weight: str) -> DataFrame:
    """``rows`` with ``quota``: its seats of the group's ``seats`` by the highest quotients w / (2k + 1).

    Seats that every row surely gets follow from bounds on the divisor; only the few quotients between
    the bounds (about three per row) are ranked.  Ties go to the smaller ``child``.
    """
    whole = Window.partitionBy(*[F.col(c) for c in group])
    ranked = Window.partitionBy(*[F.col(c) for c in group]).orderBy(
        F.col("_quotient").desc(), *[F.col(c).asc_nulls_last() for c in child], "_k"
    )
    share = F.col(weight) / F.nullif(F.col("_sum"), F.lit(0.0))
    bounded = (
        rows.withColumn("_sum", F.sum(weight).over(whole))
        .withColumn("_n", F.count("*").over(whole))
        .withColumn("_low", F.ceil(share * (F.col(seats) - F.col("_n") / 2) - 0.5) - 1)
        .withColumn("_low", F.coalesce(F.greatest(F.col("_low"), F.lit(0)), F.lit(0)).cast("long"))
        .withColumn("_high", F.floor(share * (F.col(seats) + F.col("_n") / 2) + 0.5) + 1)
        .withColumn("_high", F.greatest(F.coalesce(F.col("_high").cast("long"), F.lit(0)), F.col("_low")))
        .withColumn("_open", F.col(seats) - F.sum("_low").over(whole))
    )
    candidates = (
        bounded.where("_high > _low AND _open > 0")
        .withColumn("_k", F.explode(F.sequence("_low", F.col("_high") - 1)))
        .withColumn("_quotient", F.col(weight) / (2 * F.col("_k") + 1))
        .withColumn("_rank", F.row_number().over(ranked))
        .where("_rank <= _open")
    )
    keys = [*group, *child]
    won = candidates.groupBy(*keys).agg(F.count("*").alias("_won")).select(*[F.col(c).alias(f"_{c}") for c in keys], "_won")
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return (
        bounded.join(won, same, "left")
        .withColumn("quota", F.col("_low") + F.coalesce(F.col("_won"), F.lit(0)))
        .select(*rows.columns, "quota")
    )


def shard_quotas(shards: DataFrame, targets: DataFrame, largest: int, repeats: int = MAX_REPEATS) -> DataFrame:
    """Integer quota per (source, shard).  ``shards``: source, shard, words, blocks; shard < ``largest``."""
    per_source = shards.groupBy("source").agg(F.sum("blocks").alias("blocks"))
    name = per_source.select(F.col("source").alias("s"), "blocks")
    wanted = targets.join(name, targets["source"].eqNullSafe(name["s"])).select(
        "source",
        F.coalesce(F.col("target") / F.nullif("source_size", F.lit(0)) * F.col("blocks"), F.lit(0.0)).alias("wanted"),
    )
    wanted = wanted.withColumn("all_blocks", F.round(F.sum("wanted").over(Window.partitionBy(F.lit(1)))).cast("long"))
    wanted = wanted.withColumn("top", F.lit(0))
    parents = apportion(wanted, ["top"], ["source"], "all_blocks", "wanted").select(
        "source", F.lit(0).cast("long").alias("node"), F.col("quota").alias("seats")
    )
    levels = 1
    while FANOUT**levels < largest:
        levels += 1
    for level in range(levels - 1, -1, -1):
        width = FANOUT**level
        nodes = (
            shards.withColumn("child", F.expr(f"shard div {width}"))
            .groupBy("source", "child")
            .agg(F.sum("blocks").cast("double").alias("weight"))
            .withColumn("node", F.expr(f"child div {FANOUT}"))
        )
        up = parents.select(F.col("source").alias("s"), F.col("node").alias("n"), "seats")
        nodes = nodes.join(up, nodes["source"].eqNullSafe(up["s"]) & (nodes["node"] == up["n"])).drop("s", "n")
        parents = apportion(nodes, ["source", "node"], ["child"], "seats", "weight").select(
            "source", F.col("child").alias("node"), F.col("quota").alias("seats")
        )
    final = parents.select(F.col("source").alias("s"), F.col("node").alias("n"), "seats")
    return shards.join(final, shards["source"].eqNullSafe(final["s"]) & (shards["shard"] == final["n"])).select(
        "source", "shard", "words", "blocks", F.least("seats", repeats * F.col("blocks")).alias("quota")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    block_words: int = BLOCK_WORDS,
    shard_rows: int = SHARD_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, and the spans taken.

    ``rounds`` says how often the whole document is taken; besides, its words [0, head_end) and
    [tail_start, tail_end) are taken once more.  size counts words (null text: 0); a null source is a
    source of its own and comes last.  Nothing depends on partitioning, so reruns agree; rows with the
    same id and size are interchangeable.  Empty tables give an empty result; other columns are
    ignored (h1 and h2 identify the whole row).
    """
    sized = stored(
        docs.select(
            F.col(f"`{id_col}`").cast("long").alias("doc_id"),
            F.col(f"`{source_col}`").cast("string").alias("source"),
            F.regexp_count(text_or_empty(f"`{text_col}`"), F.lit(WORD)).cast("long").alias("size"),
            *identity(docs),
        ),
        "mix-sizes",
    )
    shards_wanted = -(-max(1, sized.count()) // shard_rows)
    draw = F.xxhash64(F.lit(seed), "doc_id", "size")
    sized = sized.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "size"), F.lit(shards_wanted)).cast("long"))
    shards = stored(
        sized.groupBy("source", "shard")
        .agg(F.sum("size").alias("words"))
        .withColumn("blocks", F.ceil(F.col("words") / block_words).cast("long")),
        "mix-shards",
    )
    targets = stored(source_targets(shards, weights), "mix-targets")
    quotas = shard_quotas(shards, targets, shards_wanted)
    start = F.pmod(F.xxhash64(F.lit(seed), "source", "shard"), F.nullif(F.col("blocks"), F.lit(0)))
    runs = (
        quotas.withColumn("first", F.coalesce(start, F.lit(0)))
        .selectExpr(
            "source AS q_source",
            "shard AS q_shard",
            "CASE WHEN blocks = 0 THEN 0 ELSE quota div blocks END AS rounds",
            "CASE WHEN blocks = 0 THEN 0 ELSE first * words div blocks END AS run_start",
            "CASE WHEN blocks = 0 THEN 0 ELSE least(first + quota % blocks, blocks) * words div blocks END AS run_end",
            "CASE WHEN blocks = 0 THEN 0 ELSE greatest(first + quota % blocks - blocks, 0) * words div blocks END AS wrap_end",
        )
    )
    sources = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    runs = runs.join(sources, runs["q_source"].eqNullSafe(sources["t_source"])).drop("t_source")
    order = Window.partitionBy("source", "shard").orderBy(draw, F.col("doc_id").asc_nulls_last(), "size")
    placed = sized.withColumn(
        "at", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    )
    within = lambda c: F.least(F.greatest(c - F.col("at"), F.lit(0)), F.col("size"))
    return (
        placed.join(runs, placed["source"].eqNullSafe(runs["q_source"]) & (placed["shard"] == runs["q_shard"]))
        .withColumn("head_end", within(F.col("wrap_end")))
        .withColumn("tail_start", within(F.col("run_start")))
        .withColumn("tail_end", F.greatest(within(F.col("run_end")), F.col("tail_start")))
        .withColumn(
            "taken", F.col("rounds") * F.col("size") + F.col("head_end") + F.col("tail_end") - F.col("tail_start")
        )
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            "taken",
            "rounds",
            "head_end",
            "tail_start",
            "tail_end",
            "h1",
            "h2",
        )
    )


def taken_texts(text: Column) -> Column:
    """The texts that a row of :func:`mix` stands for: whole rounds, then the words taken once more.

    A part of a document has its words joined by single spaces.
    """
    words = F.filter(F.split(text, GAP), lambda w: w != "")
    extra = F.col("head_end") + F.col("tail_end") - F.col("tail_start")
    part = F.array_join(
        F.concat(
            F.slice(words, F.lit(1), F.col("head_end").cast("int")),
            F.slice(words, (F.col("tail_start") + 1).cast("int"), (F.col("tail_end") - F.col("tail_start")).cast("int")),
        ),
        " ",
    )
    once = F.when(extra == F.col("size"), text).otherwise(part)
    return F.concat(
        F.array_repeat(text, F.col("rounds").cast("int")),
        F.when((extra > 0) & (F.col("size") > 0), F.array(once)).otherwise(F.array().cast("array<string>")),
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix as documents: a row per copy taken, all columns kept, ``text`` cut where only a part is taken.

    Texts without a word have nothing to take and don't appear.
    """
    taken = mix(docs, id_col, text_col, source_col).where("taken > 0")
    rows = joined_contents(docs, taken.select("h1", "h2", "size", "rounds", "head_end", "tail_start", "tail_end"))
    rows = rows.withColumn("_text", F.explode(taken_texts(F.col(f"doc.`{text_col}`").cast("string"))))
    return rows.select(
        *[F.col("_text").alias(c) if c == text_col else F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
