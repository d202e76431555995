"""Phrase collocations by best-first growth with bounds.

A phrase that starts with the word w scores at most floor(1000 n / f(w)), whatever follows: the cut behind
w divides by f(w), and the rest is at least as frequent as the phrase.  So first words are expanded from
the highest bound (the rarest word) on, in rounds.  Phrases of expanded words grow word by word, only from
prefixes that are frequent themselves.  A language is settled when its 2000th surviving score is above the
bound of every word not yet expanded; ties with it are expanded too.

Counting passes read a table of 64-bit word codes.  Codes are checked to be different for all words that
could be mistaken for a frequent one.  Between passes, only bit filters of a fixed size go to the tasks;
they never drop a frequent phrase, and every count is made exact by grouping on the codes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sunledger.llm.common import give_back, read_table, slices, stored, text_or_empty

LEAST_COUNT = 100
LONGEST = 5
TOP = 2000
NO_LANGUAGE = "und"
SLICE_BYTES = 2 << 20  # text that a task looks at together
FILTER_BITS = 22  # a filter has 2**22 cells (512 KB), whatever the corpus
SHARES = (1 / 8, 1)  # of the occurrences of frequent words, expanded up to each round
STEPS = 4  # histogram steps per doubling of a word's count

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, dtype=np.uint8)  # 0 in a word, 1 between words, 2 between pieces
_KIND[[9, 32]] = 1
_KIND[[*b".,;:!?", 10, 11, 12, 13]] = 2

COUNTS = "lang string, words array<long>, n long, least_before long, most_before long"


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit mixing step, for cells of filters only."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def prefix_cells(codes: np.ndarray, longest: int) -> Iterator[np.ndarray]:
    """Filter cell of the phrase of 1, 2, ... words that starts at each place of ``codes`` (0 is a break)."""
    h = np.zeros(len(codes), dtype=np.uint64)
    padded = np.concatenate([codes, np.zeros(longest, np.int64)]).view(np.uint64)
    for k in range(longest):
        h = mixed(h * np.uint64(31) + padded[k : k + len(codes)])
        yield (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(text of each word, first of its piece, code of each word in the list, list of words), A-Z lowered."""
    texts = texts.cast(pa.large_string())
    begins = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    held = np.frombuffer(raw, dtype=np.uint8)[begins[0] : begins[-1]] if raw else np.zeros(0, np.uint8)
    begins = begins - begins[0]
    kind = _KIND[held]
    inside = kind == 0
    fresh = np.zeros(len(held) + 1, dtype=bool)
    fresh[begins] = True
    first = np.flatnonzero(inside & (fresh[:-1] | ~np.concatenate([[False], inside[:-1]])[: len(held)]))
    borders = np.cumsum((kind == 2) | fresh[:-1])[first]  # pieces and texts begun up to each word
    kept = _LOWER[held[inside]]
    offsets = np.append((np.cumsum(inside) - 1)[first], len(kept)).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(kept)).dictionary_encode()
    rows = np.searchsorted(begins, first, side="right") - 1
    opens = np.concatenate([[True], np.diff(borders) > 0])[: len(first)]
    return rows, opens, words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    """Texts of a slice, language by language."""
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            langs = part.column("lang").dictionary_encode()
            codes = langs.indices.to_numpy(zero_copy_only=False)
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                yield lang, part.column("text").take(pa.array(np.flatnonzero(codes == i)))


def codes_of(words: pa.Array, seed: int) -> np.ndarray:
    import xxhash

    found = np.array([xxhash.xxh64_intdigest(w, seed) for w in words.to_pylist()], dtype=np.uint64)
    return found.view(np.int64)


def word_counts(texts: DataFrame, seed: int) -> DataFrame:
    """lang, word, code, f: every different word of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, part in by_language(batches):
            _, _, codes, words = words_of(part)
            n = np.bincount(codes, minlength=len(words))
            made = [pa.array([lang] * len(words), pa.string()), words.cast(pa.string()), pa.array(codes_of(words, seed)), pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(made, names=["lang", "word", "code", "n"])

    counted = texts.mapInArrow(run, "lang string, word string, code long, n long")
    return counted.groupBy("lang", "word", "code").agg(F.sum("n").alias("f"))


def code_table(texts: DataFrame, seed: int, frequent: np.ndarray) -> DataFrame:
    """lang, codes: word codes of many texts, 0 for the end of a piece and for words that are surely not frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(frequent).astype(bool)
        for lang, part in by_language(batches):
            _, opens, local, words = words_of(part)
            code = codes_of(words, seed)
            code[~known[next(prefix_cells(code, 1))]] = 0
            codes = code[local]
            at = np.flatnonzero(opens)
            codes = np.insert(codes, at, 0)
            # keep words with a neighbour, and one break between runs
            alone = codes == 0
            before, after = np.concatenate([[True], alone[:-1]]), np.concatenate([alone[1:], [True]])
            lonely = ~alone & before & after
            codes[lonely] = 0
            alone |= lonely
            codes = codes[~(alone & np.concatenate([[True], alone[:-1]]))]
            if len(codes):
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([codes])], names=["lang", "codes"])

    return texts.mapInArrow(run, "lang string, codes array<long>")


def bit_filter(phrases: DataFrame) -> np.ndarray:
    """Cells of the phrases in column ``words`` (of any length) as bits; languages share them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("words")
            sizes = np.diff(lists.offsets.to_numpy())
            flat, at = lists.flatten().to_numpy(), np.cumsum(sizes) - sizes
            cells = np.zeros(len(sizes), dtype=np.int64)
            longest = int(sizes.max(initial=0))
            for k, cell in enumerate(prefix_cells(flat, longest), 1):
                cells[sizes == k] = cell[at[sizes == k]]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(cells))], names=["cell"])

    cells = phrases.select("words").mapInArrow(run, "cell long")
    group = cells.groupBy(F.shiftright("cell", 5).alias("place")).agg(F.bit_or(F.expr("shiftleft(1L, int(cell % 32))")).alias("bits"))
    bits = np.zeros(1 << (FILTER_BITS - 5), dtype=np.uint32)
    for r in group.toLocalIterator():  # at most 2**(FILTER_BITS - 5) rows
        bits[r["place"]] = r["bits"]
    return np.packbits(np.unpackbits(bits.view(np.uint8), bitorder="little"))


def local_groups(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(rows in groups of equal ones, start of each group): sorted by one hash, exactly compared afterwards."""
    h = np.zeros(len(columns[0]), dtype=np.uint64)
    for column in columns:
        h = mixed(h * np.uint64(31) + column.view(np.uint64))
    order = np.argsort(h, kind="stable")
    new = np.concatenate([[True], np.diff(h[order]) != 0])[: len(order)]
    differs = reduce(np.logical_or, (np.diff(column[order]) != 0 for column in columns))
    if (differs & ~new[1:]).any():  # two phrases share a hash: sort by the columns themselves
        order = np.lexsort(columns)
        differs = reduce(np.logical_or, (np.diff(column[order]) != 0 for column in columns))
        new = np.concatenate([[True], differs])
    return order, np.flatnonzero(new)


def phrase_counts(codes: DataFrame, length: int, wanted: np.ndarray, prefix: bool) -> DataFrame:
    """``COUNTS`` of the phrases of ``length`` words whose prefix of one word less (or which themselves) pass the filter.

    Occurrences are added up per row of ``codes``, then by Spark before and after the shuffle.
    ``least_before`` and ``most_before`` bound the codes of the words before the phrase (0: none that counts).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = np.unpackbits(wanted).astype(bool)
        for batch in batches:
            for lang, held in zip(batch.column("lang"), batch.column("codes"), strict=True):
                row = held.values.to_numpy()
                *_, cell = prefix_cells(row, length - prefix)
                padded = np.concatenate([[0], row, np.zeros(LONGEST, np.int64)])
                full = reduce(np.logical_and, (padded[1 + k : 1 + k + len(row)] != 0 for k in range(length)))
                at = np.flatnonzero(full & asked[cell])
                if not len(at):
                    continue
                columns = [padded[1 + k + at] for k in range(length)]
                order, edges = local_groups(columns)
                first, n = order[edges], np.diff(np.append(edges, len(order)))
                before = padded[at[order]]
                phrases = np.stack([c[first] for c in columns], axis=1).ravel()
                made = [
                    pa.array([lang.as_py()] * len(first), pa.string()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1, dtype=np.int32) * length), pa.array(phrases)),
                    pa.array(n.astype(np.int64)),
                    pa.array(np.minimum.reduceat(before, edges)),
                    pa.array(np.maximum.reduceat(before, edges)),
                ]
                yield pa.RecordBatch.from_arrays(made, names=["lang", "words", "n", "least_before", "most_before"])
            give_back()

    counted = codes.mapInArrow(run, COUNTS)
    return counted.groupBy("lang", "words").agg(
        F.sum("n").alias("a"), F.min("least_before").alias("least_before"), F.max("most_before").alias("most_before")
    )


def scored(phrase: str, l: str, r: str, n: str) -> Column:  # noqa: E741
    """floor(1000 a n / (l r)) in 38-digit decimals."""
    exact = "decimal(38,0)"
    return F.expr(f"cast(cast(cast(1000 as {exact}) * {phrase} as {exact}) * {n} as {exact}) div cast(cast({l} as {exact}) * {r} as {exact})")


def best_cuts(candidates: DataFrame, counts: DataFrame, rests: DataFrame) -> DataFrame:
    """``candidates`` with l, r and score of their lowest-scoring cut, the first of equals."""
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = cuts.withColumn("front", F.slice("words", F.lit(1), F.col("k"))).withColumn(
        "rest", F.slice("words", F.col("k") + 1, F.size("words") - F.col("k"))
    )
    fronts = counts.select("lang", F.col("words").alias("front"), F.col("a").alias("l"))
    ends = rests.select("lang", F.col("words").alias("rest"), F.col("a").alias("r"))
    cuts = cuts.join(fronts, ["lang", "front"]).join(ends, ["lang", "rest"])
    cuts = cuts.withColumn("score", scored("a", "l", "r", "total"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return (
        cuts.groupBy("lang", "words")
        .agg(best, F.first("a").alias("a"), F.first("total").alias("total"), F.count("*").alias("cuts"))
        .select("lang", "words", "a", "total", "cut.l", "cut.r", "cut.score")
    )


def first_of(survivors: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return survivors.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def expanded_upto(frequent: DataFrame, share: float) -> DataFrame:
    """lang, limit: the count up to which first words are expanded so that they hold about ``share`` of all occurrences.

    Taken from a histogram with at most a few hundred steps per language.
    """
    steps = frequent.groupBy("lang", F.floor(STEPS * F.log2("f")).alias("step")).agg(
        F.sum("f").alias("held"), F.max("f").alias("highest")
    )
    upto = Window.partitionBy("lang").orderBy("step")
    steps = steps.withColumn("before", F.sum("held").over(upto) - F.col("held")).withColumn(
        "all", F.sum("held").over(Window.partitionBy("lang"))
    )
    return steps.where(F.col("before") < F.col("all") * share).groupBy("lang").agg(F.max("highest").alias("limit"))


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST_COUNT,
    top: int = TOP,
    shares: tuple[float, ...] = SHARES,
    report: Callable[[str, int, int], None] | None = None,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` collocations of each language.

    Words are what lies between spaces and tabs in pieces between ``.,;:!?`` and line ends, A-Z lowered.
    A null text is empty, a null language is ``und``.  Phrases have 2 to 5 words and at least ``least``
    occurrences; the score is the least over all cuts.  Phrases inside a longer one that is as frequent are
    dropped.  Equal scores go by count, then by phrase in byte order.  Repeated rows count as often as
    they occur; languages without a phrase have no row, nor has an empty table.  Other columns are ignored.

    ``report`` is told (stage, rows of that stage, round), for tests of the bounds.
    """
    texts = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        text_or_empty(f"`{text_col}`").alias("text"),
    )
    words, frequent, seed = _checked_words(texts, least)
    totals = stored(words.groupBy("lang").agg(F.sum("f").alias("total")), "colloc-totals")
    frequent = stored(
        frequent.join(totals, "lang").withColumn("words", F.array("code")).withColumn("bound", F.expr("1000 * total div f")),
        "colloc-frequent",
    )
    codes = stored(code_table(texts, seed, bit_filter(frequent)), "colloc-codes")
    single = frequent.select("lang", "words", F.col("f").alias("a"))
    empty = "lang string, phrase string, a long, l long, r long, total long, score long, rank int"
    found = docs.sparkSession.createDataFrame([], empty)
    done = docs.sparkSession.createDataFrame([], "lang string, done long")
    for turn, share in enumerate(shares):
        settled = found.groupBy("lang").agg(F.count_if(F.col("rank") == top).alias("full"), F.min("score").alias("beat"))
        beat = F.when(F.col("full") > 0, F.col("beat")).otherwise(0)
        open_ = (
            frequent.join(done, "lang", "left")
            .join(settled.select("lang", beat.alias("beat")), "lang", "left")
            .join(expanded_upto(frequent, share), "lang")
            .where((F.col("f") > F.coalesce("done", F.lit(0))) & (F.col("bound") >= F.coalesce("beat", F.lit(0))))
        )
        first = stored(open_.where(F.col("f") <= F.col("limit")).select("lang", "words", "total", F.coalesce("beat", F.lit(0)).alias("beat")), "colloc-first")
        survivors = _survivors(codes, first, single, frequent, least, report, turn)
        done = expanded_upto(frequent, share).select("lang", F.col("limit").alias("done"))
        if survivors is not None:
            found = stored(first_of(found.drop("rank").unionByName(survivors), top), "colloc-found")
    return found.select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


def _checked_words(texts: DataFrame, least: int) -> tuple[DataFrame, DataFrame, int]:
    """All words, the frequent ones, and a seed for which no other word has the code of a frequent one (or 0)."""
    for seed in range(8):
        words = stored(word_counts(texts, seed), "colloc-words")
        frequent = words.where(F.col("f") >= least)
        codes = frequent.select("code", F.col("word").alias("frequent_word")).distinct()
        alike = words.join(codes, "code").where("word <> frequent_word")
        if alike.isEmpty() and frequent.where("code = 0").isEmpty():
            return words, frequent, seed
    raise RuntimeError("no seed gives the words codes of their own")


def _survivors(codes, first, single, frequent, least, report, turn) -> DataFrame | None:
    """Scored phrases that start with a word of ``first`` and lie in no longer phrase as frequent."""
    grown, prefixes = [], first
    for length in range(2, LONGEST + 1):
        counted = phrase_counts(codes, length, bit_filter(prefixes), prefix=True).where(F.col("a") >= least)
        front = F.slice("words", 1, length - 1)
        counted = counted.withColumn("front", front).join(
            prefixes.select("lang", F.col("words").alias("front")), ["lang", "front"], "left_semi"
        )
        prefixes = stored(counted, f"colloc-{length}")
        rows = prefixes.count()
        if report:
            report(f"phrases of {length}", rows, turn)
        if not rows:
            break
        grown.append(prefixes)
    if not grown:
        return None
    phrases = reduce(DataFrame.unionByName, grown)
    counts = phrases.select("lang", "words", "a").unionByName(single)
    # inside a longer phrase: always before the same next word, or always behind the same word
    children = phrases.groupBy("lang", F.col("front").alias("words")).agg(F.max("a").alias("child"))
    outer = phrases.join(children, ["lang", "words"], "left").where(
        (F.size("words") == LONGEST)
        | ((F.coalesce("child", F.lit(0)) < F.col("a")) & ((F.col("least_before") != F.col("most_before")) | (F.col("least_before") == 0)))
    )
    about = first.select("lang", F.col("words").alias("w1"), "total", "beat")
    outer = outer.withColumn("w1", F.slice("words", 1, 1)).join(about, ["lang", "w1"])
    # the cut before the last word needs no further counting: its score bounds the phrase's
    last = single.select("lang", F.col("words").alias("w9"), F.col("a").alias("last"))
    prefix = counts.select("lang", F.col("words").alias("front"), F.col("a").alias("before_last"))
    outer = outer.withColumn("w9", F.slice("words", -1, 1)).join(last, ["lang", "w9"]).join(prefix, ["lang", "front"])
    hopeful = outer.where(scored("a", "before_last", "last", "total") >= F.col("beat"))
    candidates = stored(hopeful.select("lang", "words", "a", "total"), "colloc-candidates")
    rests = (
        candidates.select("lang", F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("k"), "words")
        .where("size(words) > 2 AND k < size(words)")
        .select("lang", F.slice("words", F.col("k"), F.size("words") - F.col("k") + 1).alias("words"))
        .where("size(words) > 1")
        .distinct()
    )
    rests = stored(rests, "colloc-rests")
    wanted = bit_filter(rests)
    counted = [
        phrase_counts(codes, length, wanted, prefix=False).join(rests, ["lang", "words"], "left_semi").select("lang", "words", "a")
        for length in range(2, LONGEST)
    ]
    ends = stored(reduce(DataFrame.unionByName, counted), "colloc-ends").unionByName(single)
    if report:
        report("scored", candidates.count(), turn)
    cut = best_cuts(candidates, counts, ends)
    return _spelt(cut, frequent)


def _spelt(scored_phrases: DataFrame, frequent: DataFrame) -> DataFrame:
    """``phrase`` in place of word codes."""
    letters = frequent.select("lang", "code", "word")
    spelt = (
        scored_phrases.select("*", F.posexplode("words").alias("place", "code"))
        .join(letters, ["lang", "code"])
        .groupBy("lang", "words")
        .agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "word"))), lambda s: s["word"]), " ").alias("phrase"),
            *[F.first(c).alias(c) for c in ("a", "l", "r", "total", "score")],
        )
    )
    return spelt.select("lang", "phrase", "a", "l", "r", "total", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i : i + k - 1], ' '))) AS g
  FROM w, (SELECT unnest(range(1, 6)) AS k)),
f AS (SELECT lang, k, g, count(*) AS f FROM g GROUP BY lang, k, g HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT lang, k, g AS phrase, f AS a, string_split(g, ' ') AS ws FROM f WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.k, c.a, j, x.f AS l, y.f AS r, n.n,
         (1000::HUGEINT * c.a * n.n) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, array_to_string(ws[1 : j], ' ') AS front, array_to_string(ws[j + 1 : k], ' ') AS rest
        FROM c, (SELECT unnest(range(1, 5)) AS j) WHERE j < k) c
  JOIN n ON n.lang = c.lang
  JOIN f x ON x.lang = c.lang AND x.k = c.j AND x.g = c.front
  JOIN f y ON y.lang = c.lang AND y.k = c.k - c.j AND y.g = c.rest),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
outer_ AS (
  SELECT * FROM lowest p WHERE NOT EXISTS (
    SELECT 1 FROM c b WHERE b.lang = p.lang AND b.k > p.k AND 100 * b.a >= 100 * p.a
      AND contains(' ' || b.phrase || ' ', ' ' || p.phrase || ' ')))
SELECT lang, CAST(row_number() OVER w AS INTEGER) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM outer_
WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY rank <= 2000
"""
