"""Exact top-k search as a Voronoi kNN join on inner products.

Vectors are grouped by their nearest pivot; a group is summarised by its size and radius.  A query q
scores at most q.p + |q| * radius in the group of pivot p.  A first join with the groups of the best
bounds gives every query a score to beat; the second join sends a group only to the blocks of queries
that it can still improve.  Joins run on bounded blocks of data and of queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sunledger.llm.common import read_table, stored

K = 5
MAX_PIVOTS = 256
DATA_BLOCK = 4096  # vectors, and queries, that a task multiplies at once
QUERY_BLOCK = 1024
FIRST_GROUPS = 3  # groups of the first join
EXACT_FLOAT = 2**52
EXACT_LONG = 2.0**62  # below this, sums of products fit in 64 bits

FOUND = "query_id long, query_key long, vec_id long, score long"


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, v): distinct rows with floor(scale * x) per component.

    Null ids and vectors that are null or hold a null or non-finite component take no part.
    """
    vector = F.col(f"`{vector_col}`").cast("array<double>").alias("v")
    return (
        vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vector)
        .where("vec_id IS NOT NULL AND v IS NOT NULL")
        .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
        .select("vec_id", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))
        .distinct()
    )


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows; shorter ones are filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def nearest_pivot(pivots: np.ndarray):
    """Task that adds the nearest pivot and the distance to it."""
    square = (pivots.astype(float) ** 2).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("v"), pivots.shape[1]).astype(float)
            group = (square - 2 * x @ pivots.T.astype(float)).argmin(axis=1)
            far = np.sqrt(((x - pivots[group]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(group.astype(np.int32)), pa.array(far)], names=[*batch.schema.names, "g", "far"]
            )

    return run


def _as_long(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object and any(abs(int(x)) >= 2**63 for x in scores):
        raise OverflowError("a score among the best does not fit in 64 bits")
    return scores.astype(np.int64)


def best_of(q_ids: np.ndarray, q: np.ndarray, x_ids: np.ndarray, x: np.ndarray, k: int):
    """(query row, data row, score) of the ``k`` best per query, ties to the smaller id, none to itself."""
    order = np.argsort(x_ids, kind="stable")
    x_ids, x = x_ids[order], x[order]
    biggest = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, x.shape[1])
    exact = biggest * len(x_ids) < EXACT_FLOAT
    rows, columns, scores = [], [], []
    for begin in range(0, len(q), 256):
        part, ids = q[begin : begin + 256], q_ids[begin : begin + 256]
        if exact:
            s = (part.astype(float) @ x.T.astype(float)).astype(np.int64)
        elif biggest < EXACT_LONG:
            s = part @ x.T
        else:  # sums may pass 64 bits
            s = part.astype(object) @ x.T.astype(object)
        own = ids[:, None] == x_ids[None, :]
        if exact:
            rank = s * len(x_ids) - np.arange(len(x_ids))
            rank[own] = -(2**62)  # below every exact score, and it can be negated
            n = min(k, len(x_ids))
            top = np.argpartition(-rank, n - 1, axis=1)[:, :n] if n < len(x_ids) else np.tile(np.arange(n), (len(part), 1))
        else:
            order_of = np.where(own, 1, -s.astype(object))
            order_of[own] = max(1, order_of.max()) + 1  # behind all others
            top = np.argsort(order_of, axis=1, kind="stable")[:, :k].astype(np.int64)
        keep = ~np.take_along_axis(own, top, axis=1)
        r, c = np.nonzero(keep)
        rows.append(begin + r)
        columns.append(order[top[r, c]])
        scores.append(_as_long(s[r, top[r, c]]))
    return np.concatenate(rows), np.concatenate(columns), np.concatenate(scores)


def solve(queries: DataFrame, data: DataFrame, blocks: dict[int, int], width: int, k: int) -> DataFrame:
    """Best candidates (``FOUND``) of each query in the groups ``wanted``.

    ``queries``: query_id, query_key, v, block, wanted.  A block of data meets a block of queries in
    one task; data goes only where a query of the block wants its group.
    """
    block_count = F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair])
    asked = queries.select("query_id", "query_key", "v", "block", F.explode("wanted").alias("g"))
    routes = asked.select(F.col("g").alias("to_g"), F.col("block").alias("to_block")).distinct()
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.element_at(block_count, F.col("g")) - 1)))
    sent = data.select(
        "vec_id", "v", "g", F.pmod(F.xxhash64("vec_id"), F.element_at(block_count, F.col("g"))).cast("int").alias("part")
    )
    sent = sent.join(routes, F.col("g") == F.col("to_g")).select(
        "vec_id", F.col("v").alias("x"), "to_g", F.col("part").alias("to_part"), "to_block"
    )

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.schema([(c, pa.int64()) for c in ("query_id", "query_key", "vec_id", "score")]).empty_table()
        if not left.num_rows or not right.num_rows:
            return empty
        q_ids, x_ids = left.column("query_id").to_numpy(), right.column("vec_id").to_numpy()
        q, x = matrix(left.column("v"), width), matrix(right.column("x"), width)
        r, c, s = best_of(q_ids, q, x_ids, x, k)
        return pa.table(
            {"query_id": q_ids[r], "query_key": left.column("query_key").to_numpy()[r], "vec_id": x_ids[c], "score": s},
            schema=empty.schema,
        )

    data_side = sent.groupBy("to_g", "to_part", "to_block")
    return asked.groupBy("g", "part", "block").cogroup(data_side).applyInArrow(join, FOUND)


def top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best inner products of each query with all other rows.

    ``is_query`` is a condition on vec_id.  Ties go to the smaller vec_id; fewer candidates give fewer
    rows.  Rows equal in id and vector count once; vectors of different lengths are filled up with
    zeros; an empty table gives an empty result; other columns are ignored.  Of equal vectors only
    the k + 1 smallest ids can be among the best, so only those are searched.
    """
    spark = vectors.sparkSession
    rows = stored(quantised(vectors, id_col, vector_col, scale), "knn-vectors")
    n, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    copies = Window.partitionBy("v").orderBy("vec_id")
    searched = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy")
    wanted = min(MAX_PIVOTS, max(1, int(n**0.5 / 2)))
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).toArrow()
    pivots = np.unique(matrix(picked.column("v"), width), axis=0)
    schema = "vec_id long, v array<long>, g int, far double"
    data = stored(searched.mapInArrow(nearest_pivot(pivots), schema), "knn-groups")
    summary = {r["g"]: r for r in data.groupBy("g").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()}
    groups = np.array(sorted(summary))
    radius = np.array([summary[g]["radius"] for g in groups])
    blocks = {int(g): -(-summary[g]["n"] // DATA_BLOCK) for g in groups}

    asking = rows.where(is_query)
    homes = stored(asking.mapInArrow(nearest_pivot(pivots), schema), "knn-queries")
    per_home = {r["g"]: r["n"] for r in homes.groupBy("g").agg(F.count("*").alias("n")).collect()}
    first_block, parts, at, room = {}, {}, 0, 0  # neighbouring cells share a block, a large cell has several
    for g in sorted(per_home):
        parts[g] = -(-per_home[g] // QUERY_BLOCK)
        if per_home[g] > room:
            at, room = at + 1, QUERY_BLOCK
        first_block[g] = at
        room -= per_home[g]
        if parts[g] > 1:
            at, room = at + parts[g] - 1, 0
    literal = lambda d: F.create_map(*[F.lit(int(x)) for pair in d.items() for x in pair])
    if not per_home:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    queries = homes.select(
        F.col("vec_id").alias("query_id"),
        F.xxhash64("v").alias("query_key"),
        "v",
        (
            F.element_at(literal(first_block), F.col("g"))
            + F.pmod(F.xxhash64("vec_id"), F.element_at(literal(parts), F.col("g"))).cast("int")
        ).alias("block"),
    )

    def bounds(batch: pa.RecordBatch) -> np.ndarray:
        q = matrix(batch.column("v"), width).astype(float)
        reach = np.sqrt((q**2).sum(axis=1))[:, None] * radius
        return q @ pivots[groups].T.astype(float) + reach + 1e-9 * (1 + np.abs(reach))

    def lists(batch: pa.RecordBatch, chosen: list[np.ndarray]) -> pa.RecordBatch:
        offsets = np.concatenate([[0], np.cumsum([len(c) for c in chosen])]).astype(np.int32)
        flat = groups[np.concatenate([*chosen, np.empty(0, dtype=np.int64)]).astype(np.int64)].astype(np.int32)
        kept = batch.select(["query_id", "query_key", "v", "block"])
        return pa.RecordBatch.from_arrays(
            [*kept.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[*kept.schema.names, "wanted"]
        )

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = np.argsort(-bounds(batch), axis=1, kind="stable")[:, :FIRST_GROUPS]
            yield lists(batch, list(order))

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = bounds(batch)
            done = np.argsort(-most, axis=1, kind="stable")[:, :FIRST_GROUPS]
            np.put_along_axis(most, done, -np.inf, axis=1)
            beat = batch.column("beat").to_numpy(zero_copy_only=False).astype(float)
            beat = np.where(np.isnan(beat), -np.finfo(float).max, beat)
            yield lists(batch, [np.flatnonzero(m >= b) for m, b in zip(most, beat, strict=True)])

    asked = "query_id long, query_key long, v array<long>, block int, wanted array<int>"
    first = stored(top(solve(queries.mapInArrow(likely, asked), data, blocks, width, k), k), "knn-first")
    beat = first.where(F.col("rank") == k).select("query_id", "query_key", F.col("score").alias("beat"))
    bounded = queries.join(beat, ["query_id", "query_key"], "left")
    second = solve(bounded.mapInArrow(possible, asked), data, blocks, width, k)
    both = first.select("query_id", "query_key", "vec_id", "score").unionByName(second)
    return top(both, k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH q AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM pairs
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 5
"""
