"""Ranked lexical search over buckets of impact vectors ordered by their length (after LEMP).

A document is the sparse vector of the impacts of its terms, a query the set of its terms; the score is
their inner product.  Vectors are sorted into buckets of similar length.  Buckets are searched from the
longest on: Cauchy-Schwarz drops a bucket for every query whose k-th score it cannot reach, bounds on
single coordinates drop vectors inside a bucket, and what survives is scored exactly in 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, floor, log, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sunledger.llm.common import read_table, slices, stored, text_or_empty

K = 10
SLICE_BYTES = 2 << 20  # text that a task looks at together
FILTER_CELLS = 1 << 20  # cells of the filter for terms that no query holds (128 KB, whatever the queries)
SHORTEST = 0.9  # the vectors of a bucket are at least this share of the longest possible one
CELL_COORDINATES = 500_000  # coordinates that a task holds; fuller buckets are dealt over several tasks
BLOCK_TERMS = 50_000  # query terms that a task holds
ROUNDS = (1 / 32, 1 / 4, 1)  # shares of the vectors, longest first, searched up to each round
SLACK = 1 + 1e-9  # for rounding in the bounds

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_TERM = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])

FOUND = "query_row long, doc_id long, row long, score long"


def term_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(text of each term, code of each term, distinct terms): ASCII letters and digits and all beyond ASCII, A-Z lowered."""
    texts = texts.cast(pa.large_string())
    begins = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    held = np.frombuffer(raw, dtype=np.uint8)[begins[0] : begins[-1]] if raw else np.zeros(0, np.uint8)
    begins = begins - begins[0]
    inside = _IN_TERM[held]
    fresh = np.zeros(len(held) + 1, dtype=bool)
    fresh[begins] = True
    starts = inside & (fresh[:-1] | ~np.concatenate([[False], inside[:-1]])[: len(held)])
    first = np.flatnonzero(starts)
    kept = _LOWER[held[inside]]
    offsets = np.append((np.cumsum(inside) - 1)[first], len(kept)).astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(kept)).dictionary_encode()
    rows = np.searchsorted(begins, first, side="right") - 1
    return rows, terms.indices.to_numpy(zero_copy_only=False).astype(np.int64), terms.dictionary


def filter_cells(terms: pa.Array) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest(t, 42) % FILTER_CELLS for t in terms.to_pylist()], dtype=np.int64)


def term_counts(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame | None = None) -> DataFrame:
    """doc_id, n (terms of the text with repeats), terms (struct of term and tf); one row per input row with a term.

    With ``wanted`` (a column ``term``) terms are left out when a hashed filter proves them unwanted.
    """
    bits = None
    if wanted is not None:
        cell = F.pmod(F.xxhash64("term"), F.lit(FILTER_CELLS)).alias("cell")
        bits = np.zeros(FILTER_CELLS, dtype=bool)  # at most FILTER_CELLS numbers reach the driver
        bits[[r["cell"] for r in wanted.select(cell).distinct().collect()]] = True
        bits = np.packbits(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = None if bits is None else np.unpackbits(bits).astype(bool)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                rows, codes, terms = term_codes(part.column("text"))
                n = np.bincount(rows, minlength=part.num_rows)
                if asked is not None and len(terms):
                    keep = asked[filter_cells(terms)][codes]
                    rows, codes = rows[keep], codes[keep]
                found, tf = np.unique(rows * max(1, len(terms)) + codes, return_counts=True)
                rows, codes = found // max(1, len(terms)), found % max(1, len(terms))
                limits = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=part.num_rows))]).astype(np.int32)
                pairs = pa.StructArray.from_arrays([terms.take(pa.array(codes)).cast(pa.string()), pa.array(tf.astype(np.int64))], names=["term", "tf"])
                made = [part.column("doc_id"), pa.array(n.astype(np.int64)), pa.ListArray.from_arrays(pa.array(limits), pairs)]
                yield pa.RecordBatch.from_arrays(made, names=["doc_id", "n", "terms"]).filter(pa.array(n > 0))

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<struct<term:string,tf:long>>")


def weighted_terms(counted: DataFrame, wanted: DataFrame, documents: int) -> DataFrame:
    """term, term_key, weight for the wanted terms that occur: floor(1000 ln((2N + 2) / (2 df + 1)))."""
    df = counted.select(F.explode("terms.term").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    ratio = F.lit(2.0 * documents + 2.0) / (2 * F.col("df") + 1).cast("double")
    weights = df.join(wanted, "term", "left_semi").select(
        "term", F.floor(1000 * F.ln(ratio)).cast("long").alias("weight")
    )
    return stored(weights.withColumn("term_key", F.monotonically_increasing_id()), "lexical-weights")


def impact_vectors(counted: DataFrame, weights: DataFrame, documents: int, terms: int) -> DataFrame:
    """doc_id, row, length, terms, impacts, bucket: the sparse vector of each document that shares a term with a query.

    ``bucket`` numbers lengths so that those of one bucket differ by at most the factor ``SHORTEST``.
    """
    spread = 10 + F.expr(f"(90 * n * {documents}L) div {terms}L")
    coordinates = counted.select("doc_id", "row", spread.alias("m"), F.explode("terms").alias("t")).select(
        "doc_id", "row", "m", "t.term", "t.tf"
    )
    impact = F.expr("weight * ((1000000000L * tf) div (1000L * tf + 8L * m))")
    vectors = (
        coordinates.join(weights, "term")
        .select("row", "doc_id", "term_key", impact.alias("impact"))
        .where("impact > 0")
        .groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.sqrt(F.sum(F.col("impact").cast("double") * F.col("impact"))).alias("length"),
            F.collect_list(F.struct("term_key", "impact")).alias("c"),
        )
    )
    bucket = F.floor(F.ln("length") / -log(SHORTEST)).cast("int")
    return vectors.select("doc_id", "row", "length", F.col("c.term_key").alias("terms"), F.col("c.impact").alias("impacts"), bucket.alias("bucket"))


@dataclass(frozen=True)
class Cell:
    """Neighbouring buckets searched together, or one bucket dealt over several ``parts``."""

    number: int
    buckets: tuple[int, ...]
    parts: int
    longest: float


def cells_of(buckets: dict[int, tuple[int, int]], shares: tuple[float, ...] = ROUNDS) -> list[list[Cell]]:
    """Cells of each round, longest first; ``buckets``: vectors and coordinates per bucket."""
    total = sum(n for n, _ in buckets.values())
    rounds: list[list[Cell]] = [[] for _ in shares]
    seen, number, group, held, at = 0, 0, [], 0, 0
    for b in sorted(buckets, reverse=True):
        turn = next(i for i, s in enumerate(shares) if seen < s * total)
        if group and (turn != at or held + buckets[b][1] > CELL_COORDINATES):
            rounds[at].append(Cell(number, tuple(group), ceil(held / CELL_COORDINATES), SHORTEST ** -(group[0] + 1)))
            number, group, held = number + 1, [], 0
        at = turn
        group.append(b)
        held += buckets[b][1]
        seen += buckets[b][0]
    if group:
        rounds[at].append(Cell(number, tuple(group), ceil(held / CELL_COORDINATES), SHORTEST ** -(group[0] + 1)))
    return [r for r in rounds if r]


class Postings:
    """The vectors of a cell by term."""

    def __init__(self, table: pa.Table):
        terms, impacts = (table.column(c).combine_chunks() for c in ("terms", "impacts"))
        owner = np.repeat(np.arange(len(table)), np.diff(terms.offsets.to_numpy()))
        keys, values = terms.flatten().to_numpy(), impacts.flatten().to_numpy()
        order = np.argsort(keys, kind="stable")
        self.owner, self.values = owner[order], values[order]
        self.keys, self.begin = np.unique(keys[order], return_index=True)
        self.end = np.append(self.begin[1:], len(order))
        self.most = np.maximum.reduceat(self.values, self.begin) if len(order) else np.zeros(0, np.int64)
        self.length = table.column("length").to_numpy()
        self.row = table.column("row").to_numpy()
        ids = table.column("doc_id")
        self.null = pc.is_null(ids).to_numpy()
        self.doc_id = pc.fill_null(ids, 0).to_numpy()
        self.longest = float(self.length.max(initial=0))

    def best(self, terms: np.ndarray, beat: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best vectors with a score of at least ``beat`` (and above 0), and their scores."""
        at = np.flatnonzero(np.isin(self.keys, terms, assume_unique=True))
        none = np.zeros(0, np.int64)
        if not len(at) or sqrt(len(at)) * self.longest * SLACK < beat:
            return none, none
        at = at[np.argsort(self.most[at])]
        # terms whose highest impacts do not add up to the score to beat need not be looked up
        needed = at[np.cumsum(self.most[at]) >= beat] if beat else at
        alive = np.zeros(len(self.row), dtype=bool)
        for t in needed:
            span = slice(self.begin[t], self.end[t])
            owner, own = self.owner[span], self.values[span].astype(float)
            if beat:  # this coordinate, and the most that the others can add
                rest = np.sqrt(np.maximum(self.length[owner] ** 2 * SLACK - own**2, 0))
                owner = owner[(own + sqrt(len(at) - 1) * rest) * SLACK >= beat]
            alive[owner] = True
        score = np.zeros(len(self.row), dtype=np.int64)
        for t in at:
            owner, values = self.owner[self.begin[t] : self.end[t]], self.values[self.begin[t] : self.end[t]]
            live = alive[owner]
            score[owner[live]] += values[live]
        found = np.flatnonzero(alive & (score >= max(beat, 1)))
        if len(found) > k:  # all that tie with the k-th are ordered
            least = np.partition(score[found], len(found) - k)[len(found) - k]
            found = found[score[found] >= least]
        found = found[np.lexsort((self.row[found], self.doc_id[found], self.null[found], -score[found]))][:k]
        return found, score[found]


def solve(queries: DataFrame, vectors: DataFrame, cells: list[Cell], k: int) -> DataFrame:
    """Best rows (``FOUND``) of each query in each cell that it can use.

    ``queries``: query_row, block, terms, beat, reach.  A part of a cell meets a block of queries in one
    task; it goes only to blocks with a query that the cell's length can still serve.
    """
    reach = {r["block"]: r["least"] for r in queries.groupBy("block").agg(F.min("reach").alias("least")).collect()}
    routes = [(c, b) for c in cells for b, least in sorted(reach.items()) if c.longest * SLACK >= least]
    of_cell = {c.number: [b for d, b in routes if d is c] for c in cells}
    of_block = {b: [c for c, d in routes if d == b] for b in reach}
    where = lambda d: F.create_map(*[x for key, value in d.items() for x in (F.lit(key), value)])
    ints = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<int>")
    number = F.element_at(where({b: F.lit(c.number) for c in cells for b in c.buckets}), F.col("bucket"))
    parts = where({c.number: F.lit(c.parts) for c in cells})
    sent = (
        vectors.where(F.col("bucket").isin([b for c in cells for b in c.buckets]))
        .withColumn("cell", number)
        .withColumn("part", F.pmod(F.xxhash64("row"), F.element_at(parts, F.col("cell"))).cast("int"))
        .withColumn("to_block", F.explode(F.element_at(where({n: ints(b) for n, b in of_cell.items()}), F.col("cell"))))
    )
    asked = (
        queries.withColumn("cell", F.explode(F.element_at(where({b: ints([c.number for c in cs]) for b, cs in of_block.items()}), F.col("block"))))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.element_at(parts, F.col("cell")) - 1)))
        .select("query_row", "terms", "beat", "block", "cell", "part")
    )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_row", "doc_id", "row", "score"]
        out = {name: [] for name in names}
        if left.num_rows and right.num_rows:
            postings = Postings(right)
            ids = right.column("doc_id").combine_chunks()
            for query_row, terms, beat in zip(*(left.column(c).to_pylist() for c in ("query_row", "terms", "beat")), strict=True):
                found, score = postings.best(np.unique(np.array(terms, dtype=np.int64)), beat, k)
                out["query_row"] += [query_row] * len(found)
                out["doc_id"] += ids.take(pa.array(found)).to_pylist()
                out["row"] += postings.row[found].tolist()
                out["score"] += score.tolist()
        return pa.table({n: pa.array(out[n], pa.int64()) for n in names})

    sent = sent.select("doc_id", "row", "length", "terms", "impacts", "cell", "part", "to_block")
    data_side = sent.groupBy("cell", "part", "to_block")
    return asked.groupBy("cell", "part", "block").cogroup(data_side).applyInArrow(meet, FOUND)


def best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    shares: tuple[float, ...] = ROUNDS,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item with a score above 0.

    Terms are runs of ASCII letters and digits and of all beyond ASCII, A-Z lowered; a null text has none.
    The score adds weight x impact over the different terms of the item.  Each row of ``docs`` is a
    document and each row of ``items`` a query of its own, repeated ids included; equal scores go to the
    smaller doc_id, a null one comes last.  Fewer documents give fewer rows; empty tables and items
    without a term give none.  Other columns are ignored.

    Items meet the documents in blocks; nothing but counts per bucket, the reach per block of queries and
    the cells of a hashed filter passes the driver.
    """
    spark = docs.sparkSession
    asked = term_counts(items, item_col, item_text_col).select(F.col("doc_id").alias("item_id"), F.col("terms.term").alias("terms"))
    # row numbers are written with the rows: a later scan may deal them differently
    asked = stored(asked.withColumn("query_row", F.monotonically_increasing_id()), "lexical-items")
    wanted = asked.select(F.explode("terms").alias("term")).distinct()
    counted = term_counts(docs, id_col, text_col, wanted).withColumn("row", F.monotonically_increasing_id())
    counted = stored(counted, "lexical-counts")
    documents, terms = counted.agg(F.count("*"), F.sum("n")).first()
    if not documents:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    weights = weighted_terms(counted, wanted, documents)
    vectors = stored(impact_vectors(counted, weights, documents, terms), "lexical-vectors")
    keyed = (
        asked.select("query_row", "item_id", F.explode("terms").alias("term"))
        .join(weights, "term")
        .groupBy("query_row")
        .agg(F.first("item_id").alias("item_id"), F.collect_list("term_key").alias("terms"))
    )
    keyed = stored(keyed, "lexical-queries")
    blocks = max(1, ceil((keyed.agg(F.sum(F.size("terms"))).first()[0] or 0) / BLOCK_TERMS))
    keyed = keyed.withColumn("block", F.pmod(F.xxhash64("query_row"), F.lit(blocks)).cast("int"))
    per_bucket = vectors.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.size("terms")).alias("coordinates"))
    buckets = {r["bucket"]: (r["n"], r["coordinates"]) for r in per_bucket.collect()}
    found = spark.createDataFrame([], "query_row long, doc_id long, row long, score long, rank int")
    for cells in cells_of(buckets, shares):
        kth = found.where(F.col("rank") == k).select("query_row", F.col("score").alias("beat"))
        queries = keyed.join(kth, "query_row", "left").withColumn("beat", F.coalesce("beat", F.lit(0)))
        queries = queries.withColumn("reach", F.col("beat") / F.sqrt(F.size("terms")))
        new = solve(queries, vectors, cells, k)
        found = stored(best(found.drop("rank").unionByName(new), k), "lexical-found")
    return found.join(keyed.select("query_row", "item_id"), "query_row").select("item_id", "rank", "doc_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH terms AS (
  SELECT doc_id, rowid AS row,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT doc_id, text, row_number() OVER () AS rowid FROM documents)),
tf AS (SELECT doc_id, row, term, count(*) AS tf FROM terms GROUP BY doc_id, row, term),
n AS (SELECT row, sum(tf)::BIGINT AS n FROM tf GROUP BY row),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM n),
weight AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, total GROUP BY term),
asked AS (
  SELECT DISTINCT item_id, row,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT item_id, text, row_number() OVER () AS row FROM benchmark)),
scored AS (
  SELECT a.row AS item_row, any_value(a.item_id) AS item_id, t.row, any_value(t.doc_id) AS doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))))::BIGINT AS score
  FROM asked a JOIN tf t USING (term) JOIN weight USING (term) JOIN n ON n.row = t.row, total
  GROUP BY a.row, t.row)
SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
WINDOW w AS (PARTITION BY item_row ORDER BY score DESC, doc_id, row)
QUALIFY rank <= 10
"""
