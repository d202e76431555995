"""Packing by power-of-two decomposition.

Every document is cut into full sequences and then into pieces whose lengths are the binary digits of
the rest.  A piece is a sequence by itself: equal lengths share a bucket (a batch is drawn from one
bucket), nothing is padded and no sequence crosses documents.  One narrow stage, no shuffle.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm.common import give_back, letter_kinds, read_table, slices, text_or_empty, word_codes

SEQUENCE_TOKENS = 2048
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
CACHED_BYTES = 64 << 20  # memory for the words whose ids a task remembers; a full one starts anew
WORD_OVERHEAD = 220  # bytes that a remembered word takes besides its letters and ids
SLICE_BYTES = 3 << 20  # text that a task looks at together
JOINED_WORDS = 2000
WORD_END = "</w>"
LETTER_THEN_MARK = r"([\p{L}\p{N}])([!-&(-/:-@\[-`{-~])"  # the tokenizer splits between the two in simple texts

PIECES = "doc_id long, start long, length long, doc_tokens long, bucket int, ids array<int>"


def unsimple_letters(tokenizer) -> str:
    """Pattern of all marks, and of the code points that are letters or numbers here but not, or not alone, to the tokenizer.

    Normalisation and lower case may turn a letter into a letter and a mark, and the tokenizer's table of
    letters may be of another age than the one used here.
    """
    codes = [c for c in range(0xA0, 0x40000) if not 0xD800 <= c < 0xF900]
    lettered = pc.match_substring_regex(pa.array(list(map(chr, codes)), pa.string()), r"[\p{L}\p{N}]")
    letters = "".join(chr(c) for c, x in zip(codes, lettered.to_pylist(), strict=True) if x)
    forms = tokenizer.normalizer.normalize_str("\0".join(letters)).split("\0")
    kinds = letter_kinds(tokenizer.pre_tokenizer, "".join(f[-1] for f in forms))
    found = "".join(f"\\x{{{ord(c):X}}}" for c, k in zip(letters, kinds, strict=True) if chr(k) not in "LN")
    return r"[\p{M}" + found + "]"


class WordEncoder:
    """Ids of whole texts from the ids of their words.

    The tokenizer drops white space and never merges across it, so words are encoded independently,
    each of them once.  In texts without marks (and without letters that normalise to a letter and a
    mark) case may be folded first, and a letter and a following ASCII mark are parted as well.  The
    other texts keep their letters as written: a mark can make a letter another one, or end its run.
    With ``added_tokens``, texts are split at the added tokens of the vocabulary (``<|endoftext|>``,
    case as written) first; these have their own ids, as in the tokenizer's plain call.
    """

    def __init__(self, path: str, added_tokens: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # words are ordinary text: case folding may make up an added token
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that end a run of letters
        self.closes[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        added = self.tokenizer.get_added_tokens_decoder() if added_tokens else {}
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in added.values()):
            raise ValueError("added tokens have to be plain strings")
        self.closing = np.array([END_ID, *added], dtype=np.int32)  # places 0, 1, ...: what a part of a text ends with
        self.closing_place = {t.content: i for i, t in enumerate(added.values(), 1)}
        longest_first = sorted(map(re.escape, self.closing_place), key=len, reverse=True)
        self.added = f"({'|'.join(longest_first)})" if added else None
        self.marked = unsimple_letters(self.tokenizer)
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.held_bytes = 0
        self.ids, self.sizes = [self.closing], [np.ones(len(self.closing), dtype=np.int64)]

    def _learn(self, words: list[str]) -> None:
        """Runs of letters are encoded many at a time, as each ends with a closing id."""
        letters = pc.match_substring_regex(pa.array(words, pa.string()), r"^\p{L}+$").to_numpy(zero_copy_only=False)
        plain = [w for w, x in zip(words, letters, strict=True) if x]
        single = [w for w, x in zip(words, letters, strict=True) if not x]
        chunks = [plain[i : i + JOINED_WORDS] for i in range(0, len(plain), JOINED_WORDS)]
        for chunk, found in zip(chunks, self._encode([" ".join(c) for c in chunks]), strict=True):
            ids = np.array(found.ids, dtype=np.int32)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(chunk) and ends[-1] == len(ids):
                self._add(chunk, ids, np.diff(ends, prepend=0))
            else:
                single += chunk
        for begin in range(0, len(single), JOINED_WORDS):
            chunk = single[begin : begin + JOINED_WORDS]
            found = [e.ids for e in self._encode(chunk)]
            self._add(chunk, np.array([i for ids in found for i in ids], dtype=np.int32), np.array([len(i) for i in found]))

    def _encode(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def _add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        first = len(self.place) + len(self.closing)
        self.place.update(zip(words, range(first, first + len(words)), strict=True))
        self.held_bytes += WORD_OVERHEAD * len(words) + 4 * sum(map(len, words)) + 4 * len(ids)
        self.ids.append(ids)
        self.sizes.append(sizes.astype(np.int64))

    def _parts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The parts between added tokens, and the place of the id that each part ends with."""
        if not self.added or not pc.any(pc.match_substring_regex(texts, self.added)).as_py():
            return texts, np.zeros(len(texts), dtype=np.int64)
        parts, closing = [], []
        for text in texts.to_pylist():
            pieces = re.split(self.added, text or "")
            parts += pieces[::2]
            closing += [*(self.closing_place[p] for p in pieces[1::2]), 0]
        return pa.array(parts, pa.large_string()), np.array(closing, dtype=np.int64)

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text closed by ``END_ID``, and the number of ids per text."""
        parts, closing = self._parts(texts)
        simple = pc.invert(pc.match_substring_regex(parts, self.marked))
        spaced = pc.replace_substring_regex(pc.ascii_lower(parts), LETTER_THEN_MARK, r"\1 \2")
        rows, codes, words = word_codes(pc.if_else(simple, spaced, parts))
        if self.held_bytes > CACHED_BYTES:
            self.forget()
        self._learn([w for w in words if w not in self.place])
        self.ids, self.sizes = [np.concatenate(self.ids)], [np.concatenate(self.sizes)]
        ids, sizes = self.ids[0], self.sizes[0]
        starts = np.cumsum(sizes) - sizes
        place = np.fromiter((self.place[w] for w in words), dtype=np.int64, count=len(words))
        per_part = np.bincount(rows, minlength=len(parts))
        closed = np.insert(place[codes], np.cumsum(per_part), closing)
        lengths = sizes[closed]
        ends = np.cumsum(lengths)
        counts = np.diff(ends[np.cumsum(per_part + 1)[closing == 0] - 1], prepend=0)
        return ids[np.repeat(starts[closed] - ends + lengths, lengths) + np.arange(ends[-1])], counts


def worker_encoder(path: str, added_tokens: bool = False) -> WordEncoder:
    """The encoder of this worker process, read once; a task forgets the words it has learnt when it ends."""
    held = vars(sys.modules.setdefault("_packing_worker", ModuleType("_packing_worker")))
    key = f"{path}-{added_tokens}"
    if key not in held:
        held[key] = WordEncoder(path, added_tokens)
    return held[key]


def piece_lengths(tokens: int, longest: int) -> list[int]:
    """Full sequences, then the powers of two of the rest, longest first."""
    rest = tokens % longest
    return [longest] * (tokens // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def cut(batches: Iterator[pa.RecordBatch], path: str, longest: int, added_tokens: bool = False) -> Iterator[pa.RecordBatch]:
    """Pieces (columns ``PIECES``) of batches with doc_id and text."""
    encoder = worker_encoder(path, added_tokens)
    names = ["doc_id", "start", "length", "doc_tokens", "bucket", "ids"]
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            ids, counts = encoder.texts(part.column("text"))
            cuts = [piece_lengths(int(n), longest) for n in counts]
            per_doc = np.array([len(c) for c in cuts])
            lengths = np.array([x for c in cuts for x in c], dtype=np.int64)
            offsets = np.concatenate([[0], np.cumsum(lengths)])
            begins = np.repeat(np.concatenate([[0], np.cumsum(counts)[:-1]]), per_doc)
            which = np.repeat(np.arange(len(counts)), per_doc)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(which)),
                    pa.array(offsets[:-1] - begins),
                    pa.array(lengths),
                    pa.array(counts[which].astype(np.int64)),
                    pa.array(np.log2(lengths).astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)),
                ],
                names=names,
            )
    encoder.forget()
    give_back()


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with the CRC-32 of their ids (little-endian, 32 bits each) in place of the ids."""
    for batch in batches:
        lists = batch.column("ids")
        flat, at = lists.values.to_numpy().astype("<u4"), lists.offsets.to_numpy()
        crc = [zlib.crc32(flat[s:e]) for s, e in zip(at, at[1:], strict=False)]
        kept = batch.select(["doc_id", "start", "length", "doc_tokens", "bucket"])
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(crc, pa.int64())], names=[*kept.schema.names, "ids_crc32"]
        )


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    longest: int = SEQUENCE_TOKENS,
    digest: bool = False,
    added_tokens: bool = False,
) -> DataFrame:
    """Pieces of all rows: ``PIECES`` and sequence_id, offset.

    ``longest`` is a power of two.  Each row of ``docs`` is a document of its own (repeated rows give
    repeated pieces with ids of their own); a null text counts as empty and has one id.  An empty
    table gives an empty result; other columns are ignored.  ``digest`` replaces the ids by their
    checksum ids_crc32.  ``added_tokens`` gives the strings of the vocabulary's added tokens their own
    ids, as ``Tokenizer.encode(text, add_special_tokens=False)`` does; without it they are ordinary
    text.  sequence_id is unique and, for the same files, the same on every attempt.
    """
    if longest & (longest - 1):
        raise ValueError("the sequence length must be a power of two")
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = cut(batches, path, longest, added_tokens)
        yield from digests(pieces) if digest else pieces

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = PIECES.replace("ids array<int>", "ids_crc32 long") if digest else PIECES
    return (
        rows.mapInArrow(run, schema)
        .withColumn("sequence_id", F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast("long"))
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Sequences as files by bucket: one folder per length."""
    pieces.write.partitionBy("bucket").parquet(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), digest=True, added_tokens=True).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
