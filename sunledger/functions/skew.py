"""Equi-joins that survive a key holding a large part of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 2_000_000
PAIRS_PER_TASK = 10_000_000
BLOCK_ROWS = 1_000
MOST_TASKS = 10_000

_SALT, _FOUND, _SPLIT, _BLOCK = "__salt", "__found", "__split", "__block"
_LEFT, _RIGHT = "__left_rows", "__right_rows"


def hot_keys(
    df: DataFrame, keys: Sequence[str], salts: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Keys with more rows than a task should get, with the number of tasks they need as ``salts``.

    At most one key per ``rows_per_task`` rows.  Not hinted as a broadcast: Spark
    checks its size.
    """
    counted = df.where(_all_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > rows_per_task).select(
        *keys, F.ceil(F.col("n") / rows_per_task).cast("int").alias(salts)
    )


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    *,
    salt_by: Sequence[str],
    right_salt_by: Sequence[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Many-to-many join on ``keys`` with the busy keys of either side spread over tasks.

    A key gets one salt per ``rows_per_task`` of its rows: its rows on that side
    are split by the salt, and its rows on the other side are copied once per
    salt; all other keys join as usual.  Rows of ``left`` with a NULL key match
    nothing and keep salt 0; Spark splits their partition by size.  The salts are
    hashes of ``salt_by`` and ``right_salt_by`` (ids of the rows), hence the same
    when a lost task is run again.  Without ``right_salt_by`` only the left side
    is split.

    ``how`` is one of inner, left, left_semi, left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"the left side of a {how!r} join cannot be split")
    keys = list(keys)
    filtering = how in ("left_semi", "left_anti")
    if filtering:
        # only the presence of a key matters: one row per key cannot be hot
        right = right.select(*keys).distinct()
    split_right = right_salt_by is not None and not filtering
    a, b = f"{_SALT}_a", f"{_SALT}_b"

    hot = hot_keys(left, keys, a, rows_per_task)
    left, right = (side.join(hot, keys, "left") for side in (left, right))
    if split_right:
        hot = hot_keys(right.drop(a), keys, b, rows_per_task)
        left, right = (side.join(hot, keys, "left") for side in (left, right))
        left = left.withColumn(_SPLIT, F.col(b).isNotNull()).withColumn(b, F.explode(_copies(b)))
        right = right.withColumn(b, _salt(right_salt_by, b))
    left = left.withColumn(a, _salt(salt_by, a))
    right = right.withColumn(a, F.explode(_copies(a)))
    if not split_right:
        return left.join(right, [*keys, a], how).drop(a)
    joined = left.join(right.withColumn(_FOUND, F.lit(True)), [*keys, a, b], how)
    # a key that is split on the right has matches: its copies without one are not results
    return joined.where(F.col(_FOUND).isNotNull() | ~F.col(_SPLIT)).drop(a, b, _FOUND, _SPLIT)


def pair_counts(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of either side per key, for :func:`pair_join`; rows with a NULL key are not counted."""
    sides = [
        side.where(_all_present(keys)).select(*keys, F.lit(a).alias(_LEFT), F.lit(b).alias(_RIGHT))
        for side, a, b in ((left, 1, 0), (right, 0, 1))
    ]
    return sides[0].unionByName(sides[1]).groupBy(*keys).agg(F.sum(_LEFT).alias(_LEFT), F.sum(_RIGHT).alias(_RIGHT))


def pair_tasks(counts: DataFrame, pairs_per_task: int = PAIRS_PER_TASK) -> int:
    """Tasks that the pairs of ``counts`` are worth, at least one a core; runs a job over ``counts``."""
    pairs = counts.agg(F.sum(F.col(_LEFT).cast("double") * F.col(_RIGHT))).first()[0] or 0
    cores = counts.sparkSession.sparkContext.defaultParallelism
    return min(max(cores, math.ceil(pairs / pairs_per_task)), MOST_TASKS)


def pair_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    counts: DataFrame,
    tasks: int | None = None,
    *,
    block_rows: int = BLOCK_ROWS,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """Left join of many with many rows, made for results far larger than both sides.

    Returns the columns of ``left`` and the ``values`` of ``right``, a row for each pair; a row of
    ``left`` without counterparts comes once.  The rows of a key on the right are dealt to blocks of
    about ``block_rows`` by a hash of all their columns.  A row of ``left`` meets whole blocks and is
    multiplied after the join, so that the shuffle, the sort and the join see a thousandth of the pairs
    and no row of ``left`` needs all its pairs in memory.  Rows of a busy key on the left are dealt in
    the same way, to ``pairs_per_task`` pairs with one block, and its blocks are copied.

    ``counts`` are the :func:`pair_counts` of both sides.  With ``tasks`` the pairs are spread evenly
    over so many: the sizes that Spark goes by are those of the input, not those of the result.
    """
    keys, kept = list(keys), left.columns
    a, b = f"{_SALT}_a", f"{_SALT}_b"
    counts = counts.select(
        *keys,
        F.ceil(
            F.greatest(
                F.lit(1.0),
                F.col(_LEFT) * F.least(F.col(_RIGHT), F.lit(block_rows)) / pairs_per_task,
                F.col(_LEFT) / ROWS_PER_TASK,
            )
        ).cast("int").alias(a),
        F.ceil(F.greatest(F.lit(1.0), F.col(_RIGHT) / block_rows)).cast("int").alias(b),
    )
    # a row with a NULL key meets nothing, so any salt will do
    salts = F.when(_all_present(keys), F.col(a)).otherwise(F.lit(tasks))
    left = left.join(counts, keys, "left").withColumn(_SPLIT, F.coalesce(F.col(b) > 1, F.lit(False)))
    left = left.withColumn(a, salts).withColumn(a, _salt(kept, a)).withColumn(b, F.explode(_copies(b)))
    blocks = right.where(_all_present(keys)).join(counts, keys, "left")
    blocks = (
        blocks.withColumn(b, _salt(right.columns, b))
        .groupBy(*keys, a, b)
        .agg(F.collect_list(F.struct(*values)).alias(_BLOCK))
        .withColumn(a, F.explode(_copies(a)))
    )
    if tasks:
        left, blocks = (side.repartition(tasks, *keys, a, b) for side in (left, blocks))
    met = left.join(blocks, [*keys, a, b], "left")
    # a key with several blocks has matches: a copy that met an empty one is not a result
    met = met.where(F.col(_BLOCK).isNotNull() | ~F.col(_SPLIT))
    return met.select(*kept, F.inline_outer(_BLOCK).alias(*values))


def _salt(columns: Sequence[str], salts: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.coalesce(salts, F.lit(1))).cast("int")


def _copies(salts: str) -> Column:
    return F.sequence(F.lit(0), F.coalesce(salts, F.lit(1)) - 1)


def _all_present(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return condition
