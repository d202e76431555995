"""Token counts by dynamic programming over prefixes.

For every text the operator stores the exact number of tokens of *every* prefix (in code points), so that
later questions (how long is this text, where must it be cut for 2048 tokens, what does its first half
cost) are look-ups and never encode again.

The programme rests on two facts about byte-pair encoding.  An encoding cut after one of its tokens is the
encoding of that part; and a sequence of tokens is an encoding when every two neighbours are one.  So the
encoding of a prefix is its last token after the encoding of a shorter prefix, and the last token is the
longest suffix in the vocabulary that is compatible with the token before.  Only the last token and the
number of tokens are kept per prefix; pairs of tokens are judged once.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm.common import give_back, letter_kinds, read_table, slices, text_or_empty

VOCABULARY = "word_bpe_49k.json"
LIMIT_TOKENS = 2048
WORD_END = "</w>"
SLICE_BYTES = 1 << 20  # text that a task looks at together
CACHED_POINTS = 8_000_000  # code points of pieces whose counts a task remembers; a full memory starts anew
CACHED_PAIRS = 4_000_000  # judged pairs of tokens that a task remembers
TOGETHER_BYTES = 64  # pieces up to this length are counted together, longer ones by themselves
NO_TOKEN = 65_535  # stands before the first token of a piece
#: Letter runs after an apostrophe that the tokenizer keeps together with it (fixed values of its pattern).
SHORT_FORMS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


@cache
def _joins_back() -> frozenset[str]:
    """Code points without a combining class that can still compose with what stands before them."""
    found = {chr(c) for span in ((0x1161, 0x1176), (0x11A8, 0x11C3)) for c in range(*span)}
    for code in range(0xA0, 0x30000):
        parts = unicodedata.decomposition(chr(code)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            found.add(chr(int(parts[1], 16)))
    return frozenset(found)


@cache
def _continues(c: str) -> bool:
    """True when normalisation may join ``c`` with the code point before it."""
    if c < "̀":
        return False
    first = unicodedata.normalize("NFD", c)[0]
    return unicodedata.combining(first) != 0 or first in _joins_back()


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary: itself, or the next free one from 256."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Pieces:
    """The vocabulary: which strings are tokens, and which two tokens may stand side by side."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.rank = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(model["merges"])}
        self.ids: dict[str, int] = model["vocab"]
        self.names = {i: token for token, i in self.ids.items()}
        if max(self.names) >= NO_TOKEN:
            raise ValueError(f"token ids have to be below {NO_TOKEN}")
        self.longest = max(len(t.removesuffix(WORD_END)) for t in self.ids)
        self.keys, self.fit = np.zeros(0, np.uint32), np.zeros(0, bool)  # judged pairs, in order of their key
        self._plant()

    def _plant(self) -> None:
        """A tree over the bytes of all tokens: children per node, and the open and closing token that a node spells."""
        byte_of = {letter: b for b, letter in enumerate(_byte_letters())}
        nodes: dict[tuple[int, int], int] = {}
        spelt = []
        for token, i in self.ids.items():
            node, closing = 0, token.endswith(WORD_END)
            for letter in token.removesuffix(WORD_END):
                node = nodes.setdefault((node, byte_of[letter]), len(nodes) + 1)
            spelt.append((node, closing, i))
        self.child = np.zeros((len(nodes) + 1, 256), dtype=np.int32)
        at = np.array(list(nodes), dtype=np.int64).reshape(-1, 2)
        self.child[at[:, 0], at[:, 1]] = np.arange(1, len(nodes) + 1)
        self.open, self.close = (np.full(len(nodes) + 1, -1, dtype=np.int32) for _ in range(2))
        for node, closing, i in spelt:
            (self.close if closing else self.open)[node] = i

    def merged(self, symbols: list[str]) -> list[str]:
        """Byte-pair encoding of a few symbols: the best-ranked pair first, the leftmost of equals."""
        symbols = list(symbols)
        none = len(self.rank)
        while len(symbols) > 1:
            ranks = [self.rank.get(p, none) for p in zip(symbols, symbols[1:], strict=False)]
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def judged(self, key: int) -> bool:
        left, right = self.names.get(key >> 16), self.names[key & 0xFFFF]
        letters, last = (right.removesuffix(WORD_END), WORD_END) if right.endswith(WORD_END) else (right, "")
        want = [right] if left is None else [left, right]
        return self.merged([*(left or ""), *letters[:-1], letters[-1] + last]) == want

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Is left, right an encoding?  ``NO_TOKEN`` on the left asks for the start of a piece."""
        wanted = (left.astype(np.uint32) << np.uint32(16)) | right.astype(np.uint32)
        at = np.searchsorted(self.keys, wanted)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == wanted[known]
        if not known.all():
            new = np.unique(wanted[~known])
            if len(self.keys) > CACHED_PAIRS:
                self.keys, self.fit = self.keys[:0], self.fit[:0]
                new = np.unique(wanted)
            place = np.searchsorted(self.keys, new)
            self.fit = np.insert(self.fit, place, [self.judged(k) for k in new.tolist()])
            self.keys = np.insert(self.keys, place, new)
            at = np.searchsorted(self.keys, wanted)
        return self.fit[at]

    def fit_one(self, left: int, right: int) -> bool:
        return bool(self.fits(np.array([left]), np.array([right]))[0])

    def closed_counts(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tokens of every prefix (in bytes) of many pieces: the programme, run on all pieces at once.

        Pieces lie one after the other in ``data``.  Step j finds the last token of each prefix of j bytes.
        """
        total = len(data)
        begin, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
        inside = np.arange(total) - begin  # bytes of the piece before each byte
        spans_open, spans_close = [], []  # by length - 1: the token that ends at each byte
        active, node = np.arange(total), np.zeros(total, dtype=np.int64)
        for length in range(1, self.longest + 1):
            within = inside[active] + length <= size[active]
            active, node = active[within], node[within]
            node = self.child[node, data[active + length - 1]]
            active, node = active[node > 0], node[node > 0]
            if not len(active):
                break
            for spans, tokens in ((spans_open, self.open), (spans_close, self.close)):
                here = np.full(total, -1, dtype=np.int32)
                here[active + length - 1] = tokens[node]
                spans.append(here)
        last, count = np.full(total, NO_TOKEN, dtype=np.int64), np.zeros(total, dtype=np.int32)
        steps = np.argsort(inside, kind="stable")
        edges = np.concatenate([[0], np.cumsum(np.bincount(inside))]) if total else [0]
        for j in range(len(edges) - 1):
            self._settle(steps[edges[j] : edges[j + 1]], inside, spans_open, last, count, last, count)
        closed = np.zeros(total, dtype=np.int32)
        self._settle(np.arange(total), inside, spans_close, last, count, np.zeros_like(last), closed)
        return closed

    def _settle(self, ends, inside, spans, last, count, token_out, count_out) -> None:
        """The last token of the prefixes that end at ``ends``: the longest that fits the token before it."""
        for length in range(min(len(spans), int(inside[ends].max(initial=-1)) + 1), 0, -1):
            token = spans[length - 1][ends]
            some = np.flatnonzero(token >= 0)
            if not len(some):
                continue
            end, token = ends[some], token[some]
            first = inside[end] < length
            before = np.where(first, 0, end - length)
            fits = self.fits(np.where(first, NO_TOKEN, last[before]), token)
            done, before = end[fits], before[fits]
            token_out[done] = token[fits]
            count_out[done] = np.where(first[fits], 0, count[before]) + 1
            rest = np.ones(len(ends), dtype=bool)
            rest[some[fits]] = False
            ends = ends[rest]
        if len(ends):
            raise ValueError("the vocabulary lacks a byte")


class Piece:
    """Growing piece of a text (letters, or marks): the table of its prefixes."""

    def __init__(self, vocabulary: Pieces):
        self.vocabulary = vocabulary
        self.letters = ""
        self.last, self.tokens = [NO_TOKEN], [0]  # of the open prefix (no word end) after each byte

    def grown(self, letters: str) -> Piece:
        """This piece with more letters; the rows known so far are shared by copying, for a cut inside a cluster."""
        other = Piece(self.vocabulary)
        other.letters, other.last, other.tokens = self.letters, list(self.last), list(self.tokens)
        return other.grow(letters)

    def grow(self, letters: str) -> Piece:
        for letter in letters:
            self.letters += letter
            end = len(self.letters)
            token, before = self._last(end, "")
            self.last.append(token)
            self.tokens.append(self.tokens[before] + 1)
        return self

    def _last(self, end: int, mark: str) -> tuple[int, int]:
        letters, last, ids = self.letters, self.last, self.vocabulary.ids
        for before in range(max(0, end - self.vocabulary.longest), end):
            token = ids.get(letters[before:end] + mark)
            if token is not None and self.vocabulary.fit_one(last[before], token):
                return token, before
        raise ValueError(f"the vocabulary lacks the byte {letters[end - 1]!r}")

    def closed(self) -> int:
        """Tokens of the piece when it ends here."""
        return self.tokens[self._last(len(self.letters), WORD_END)[1]] + 1 if self.letters else 0


class State:
    """What stands before the next letter: finished tokens, and the open piece with its kind.

    Kinds: ``L`` letters, ``O`` other marks, ``A`` one apostrophe that may start a short form, ``B`` a
    letter after it that may be the first half of one, ``""`` none open.
    """

    __slots__ = ("counter", "done", "kind", "piece", "before")

    def __init__(self, counter: Counter, done: int = 0, kind: str = "", piece: Piece | None = None, before: int = 0):
        self.counter, self.done, self.kind, self.piece, self.before = counter, done, kind, piece, before

    def count(self) -> int:
        return self.done + (self.piece.closed() if self.piece else 0)

    def copy(self) -> State:
        piece = self.piece.grown("") if self.piece else None
        return State(self.counter, self.done, self.kind, piece, self.before)

    def _open(self, kind: str, letters: str) -> None:
        self.done = self.count()
        self.kind, self.piece = kind, Piece(self.counter.vocabulary).grow(letters)

    def _close(self) -> None:
        self.done, self.kind, self.piece = self.count(), "", None

    def feed(self, c: str) -> None:
        """Take one normalised code point."""
        kind, letters = self.counter.kind(c)
        if kind == "S":
            self._close()
        elif kind == "N":
            self._open("", letters)
            self._close()
        elif kind == "O":
            if self.kind in ("O", "A"):
                self.kind = "O"
                self.piece.grow(letters)
            else:
                self.before = self.count()
                self._open("A" if c == "'" else "O", letters)
        elif self.kind == "A" and "'" + c in SHORT_FORMS:
            self.piece.grow(letters)
            self._close()
        elif self.kind == "A" and any(s.startswith("'" + c) for s in SHORT_FORMS):
            self._open("B", letters)
        elif self.kind == "B" and "'" + self.piece.letters + c in SHORT_FORMS:
            form = Piece(self.counter.vocabulary).grow("'" + self.piece.letters + letters)
            self.done, self.piece = self.before, form
            self._close()
        elif self.kind in ("L", "B"):
            self.kind = "L"
            self.piece.grow(letters)
        else:
            self._open("L", letters)


def code_points(tokenizer) -> tuple[np.ndarray, np.ndarray]:
    """Kind and normal form of each code point below 0x20000 that normalisation leaves alone or maps to one other.

    Kinds: L letter, N number, O other, B blank (ASCII white space), X any that needs its neighbours.
    """
    codes = [c for c in range(1, 0x20000) if not 0xD800 <= c < 0xF900]
    forms = tokenizer.normalizer.normalize_str("\0".join(map(chr, codes))).split("\0")
    kind, form = np.full(0x110000, ord("X"), dtype=np.uint8), np.arange(0x110000, dtype=np.uint32)
    single = [(c, f) for c, f in zip(codes, forms, strict=True) if len(f) == 1 and f != " " and not _continues(chr(c))]
    at = np.array([c for c, _ in single])
    form[at] = [ord(f) for _, f in single]
    kind[at] = letter_kinds(tokenizer.pre_tokenizer, "".join(f for _, f in single))
    kind[[9, 10, 11, 12, 13, 32]] = ord("B")
    return kind, form


class Counter:
    """Tables of prefix counts for the tokenizer file at ``path``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.normal = tokenizer.normalizer.normalize_str
        self.pre_tokenizer = tokenizer.pre_tokenizer
        added = tokenizer.get_added_tokens_decoder().values()
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in added):
            raise ValueError("added tokens have to be plain strings")
        self.added = "|".join(sorted((re.escape(t.content) for t in added), key=len, reverse=True))
        self.vocabulary = Pieces(path)
        self.bytes = _byte_letters()
        self.kinds: dict[str, tuple[str, str]] = {}
        self.kind_of, self.form_of = code_points(tokenizer)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}  # place of a piece (or, after NUL, of a whole run) in sizes and begins
        self.begins, self.sizes, self.flat = (np.zeros(0, np.int64) for _ in range(3))

    def kind(self, c: str) -> tuple[str, str]:
        """Kind of a normalised code point (L, N, S space, O other) and its bytes as vocabulary letters."""
        found = self.kinds.get(c)
        if found is None:
            kind = "S" if c == " " else chr(letter_kinds(self.pre_tokenizer, c)[0])
            found = self.kinds[c] = kind, "".join(self.bytes[b] for b in c.encode("utf-8", "replace"))
        return found

    def run(self, text: str, state: State | None = None) -> tuple[list[int], State]:
        """Count of every prefix of ``text`` (without the empty one), and the state behind it."""
        state = state or State(self)
        counts: list[int] = []
        at, size = 0, len(text)
        while at < size:
            end = at + 1
            while end < size and _continues(text[end]):
                end += 1
            for cut in range(at + 1, end):  # inside a cluster: its code points normalise together
                side = state.copy()
                for c in self.normal(text[at:cut]):
                    side.feed(c)
                counts.append(side.count())
            for c in self.normal(text[at:end]):
                state.feed(c)
            counts.append(state.count())
            at = end
        return counts, state

    def text(self, text: str) -> list[int]:
        """Count of every prefix of a whole text, added tokens included."""
        counts: list[int] = []
        done = at = 0
        for found in [*(re.finditer(self.added, text) if self.added else ()), None]:
            end = found.end() if found else len(text)
            # before its last letter the string of an added token is ordinary text
            part, _ = self.run(text[at : end - 1 if found else end])
            counts += [done + n for n in part]
            if found:
                start = found.start() - at
                done += (part[start - 1] if start else 0) + 1
                counts.append(done)
            at = end
        return counts

    def learn(self, pieces: list[str]) -> np.ndarray:
        """Places of the tables of ``pieces``: normalised letters or marks, or NUL and a run as written."""
        if len(self.flat) + 32 * len(self.sizes) > CACHED_POINTS:
            self.forget()
        new = [p for p in pieces if p not in self.known]
        if new:
            short = [p for p in new if not p.startswith("\0") and len(p) * 4 <= TOGETHER_BYTES]
            other = [p for p in new if p.startswith("\0") or len(p) * 4 > TOGETHER_BYTES]
            tables = [np.array(self.run(p.removeprefix("\0"))[0], dtype=np.int64) for p in other]
            data = "".join(short).encode("utf-8")
            points = np.array([len(p) for p in short], dtype=np.int64)
            held = np.frombuffer(data, dtype=np.uint8)
            last_bytes = np.append((held[1:] & 0xC0) != 0x80, True) if len(held) else np.zeros(0, bool)
            ends = np.flatnonzero(last_bytes)[np.cumsum(points) - 1] + 1 if len(short) else np.zeros(0, np.int64)
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(short)]
            together = self.vocabulary.closed_counts(held, starts, ends - starts)[last_bytes]
            sizes = np.concatenate([points, np.array([len(t) for t in tables], dtype=np.int64)])
            self.known.update(zip([*short, *other], range(len(self.sizes), len(self.sizes) + len(sizes)), strict=True))
            self.begins = np.concatenate([self.begins, len(self.flat) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.flat = np.concatenate([self.flat, together, *tables])
        return np.fromiter((self.known[p] for p in pieces), dtype=np.int64, count=len(pieces))

    def slice(self, texts: pa.Array) -> pa.ListArray:
        """Counts of the prefixes 0, 1, ... of each text (no nulls)."""
        special = np.zeros(len(texts), dtype=bool)
        if self.added and len(texts):
            special = pc.match_substring_regex(texts, self.added).to_numpy(zero_copy_only=False)
        held = texts.to_pylist()
        if special.any():
            plain = self._plain(["" if s else t for s, t in zip(special, held, strict=True)])
            lists = [[0, *self.text(t)] if s else p for s, t, p in zip(special, held, plain.to_pylist(), strict=True)]
            return pa.array(lists, pa.list_(pa.int32()))
        return self._plain(held)

    def _plain(self, texts: list[str]) -> pa.ListArray:
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        begins = np.concatenate([[0], np.cumsum(sizes)])
        counts = self._counted(codes, begins)
        out = np.insert(counts, begins[:-1], 0)
        limits = np.concatenate([[0], np.cumsum(sizes + 1)])
        return pa.ListArray.from_arrays(pa.array(limits.astype(np.int32)), pa.array(out.astype(np.int32)))

    def _counted(self, codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Count of every prefix of the texts that lie between ``begins`` in ``codes``."""
        size = len(codes)
        if not size:
            return np.zeros(0, np.int64)
        kind, form = self.kind_of[codes], self.form_of[codes]
        blank = kind == ord("B")
        fresh = np.zeros(size + 1, dtype=bool)
        fresh[begins] = True
        fresh = fresh[:-1]  # first code point of a text
        run_start = ~blank & (fresh | np.concatenate([[True], blank[:-1]]))
        run = np.cumsum(run_start) - 1  # run of each code point that is not blank
        # runs that need the state machine: joining code points, or an apostrophe before a short form's letter
        after = np.concatenate([form[1:], [0]])
        short_form = (form == ord("'")) & np.isin(after, [ord(s[1]) for s in SHORT_FORMS]) & ~blank
        whole = np.zeros(int(run[-1]) + 1, dtype=bool)
        whole[run[((kind == ord("X")) | short_form) & ~blank]] = True
        as_whole = ~blank & whole[run] if len(whole) else np.zeros(size, bool)
        changed = np.concatenate([[True], kind[1:] != kind[:-1]]) | (kind == ord("N"))
        piece_start = np.where(as_whole, run_start, ~blank & (run_start | changed))
        # the pieces as strings: normal forms, or NUL and what is written
        kept = ~blank
        written = np.where(as_whole, codes, form)[kept]
        starts = np.flatnonzero(piece_start[kept])
        marked = np.insert(written, starts[as_whole[kept][starts]], 0).astype("<u4")
        extra = np.cumsum(as_whole[kept][starts]) - as_whole[kept][starts]
        data = np.frombuffer(marked.tobytes().decode("utf-32-le", "replace").encode("utf-8"), dtype=np.uint8)
        byte_at = np.flatnonzero((data & 0xC0) != 0x80)
        offsets = np.append(byte_at[starts + extra], len(data)).astype(np.int64)
        pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        place = self.learn(pieces.dictionary.to_pylist())[pieces.indices.to_numpy(zero_copy_only=False)]
        lengths, at = self.sizes[place], self.begins[place]
        # tokens before each piece, from the start of the slice and of its text
        upto = np.concatenate([[0], np.cumsum(self.flat[at + lengths - 1])])
        where = np.flatnonzero(piece_start)
        first = np.searchsorted(where, begins)  # first piece at or after the start of each text
        base = upto[:-1] - np.repeat(upto[first[:-1]], np.diff(first))
        ends = np.cumsum(lengths)
        counts = np.zeros(size, dtype=np.int64)
        counts[kept] = self.flat[np.repeat(at - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]
        counts[kept] += np.repeat(base, lengths)
        begun = np.cumsum(piece_start)[blank]  # the pieces before white space are finished
        counts[blank] = upto[begun] - np.repeat(upto[first[:-1]], np.diff(begins))[blank]
        return counts


def worker_counter(path: str) -> Counter:
    """The counter of this worker process: the vocabulary and the judged pairs serve all its tasks."""
    held = vars(sys.modules.setdefault("_token_counts_worker", ModuleType("_token_counts_worker")))
    if path not in held:
        held[path] = Counter(path)
    return held[path]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def prefix_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, counts.

    ``counts[i]`` (from 0) is the number of tokens of the first i code points of the text, as
    ``Tokenizer.encode(prefix, add_special_tokens=False)`` gives it; the last one is that of the whole.
    Texts are never cut; long ones take time in proportion to their length.  A null text counts as empty:
    counts is then [0].  Repeated rows are counted alike, null ids stay null, other columns are ignored,
    an empty table gives an empty result.  One narrow stage, no shuffle; the memory of a worker is bounded
    by ``SLICE_BYTES`` (or one text), ``CACHED_POINTS`` during a task and ``CACHED_PAIRS`` beyond it.
    """
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_counter(path)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                kept = [part.column("doc_id"), part.column("n_bytes"), counter.slice(part.column("text"))]
                yield pa.RecordBatch.from_arrays(kept, names=["doc_id", "n_bytes", "counts"])
        counter.forget()
        give_back()

    text = text_or_empty(f"`{text_col}`")
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")
    )
    return rows.mapInArrow(run, "doc_id long, n_bytes long, counts array<int>")


def total(counts: Column) -> Column:
    """Tokens of the whole text."""
    return F.element_at(counts, -1)


def tokens_upto(counts: Column, points: Column) -> Column:
    """Tokens of the first ``points`` code points (the whole text, if it is shorter)."""
    return F.get(counts, F.least(F.greatest(points.cast("int"), F.lit(0)), F.size(counts) - 1))


def longest_prefix(counts: Column, budget: Column) -> Column:
    """Code points of the longest prefix with at most ``budget`` tokens (a longer prefix may have fewer tokens)."""
    fits = F.transform(counts, lambda n, i: F.when(n <= budget, i))
    return F.array_max(fits)


def truncated(docs: DataFrame, stored: DataFrame, budget: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each text cut to its longest prefix of at most ``budget`` tokens, from stored counts.

    ``stored`` is the result of :func:`prefix_counts`; ids have to be unique.  Rows without an id are left out.
    """
    cut = stored.select(F.col("doc_id").alias("_cut_id"), longest_prefix(F.col("counts"), F.lit(budget)).alias("_cut"))
    joined = docs.join(cut, F.col(f"`{id_col}`").cast("long") == F.col("_cut_id"))
    return joined.withColumn(text_col, F.substr(F.col(f"`{text_col}`"), F.lit(1), F.col("_cut"))).drop("_cut_id", "_cut")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = prefix_counts(read_table(spark, sf_dir, "documents"))
    tokens = total(F.col("counts")).cast("long")
    return counted.select("doc_id", "n_bytes", tokens.alias("n_tokens"), (tokens > LIMIT_TOKENS).alias("over_limit"))
