"""Documents as token ids, packed into sequences of bounded length by bounded-space online best-fit.

A packer holds at most ``open_bins`` open sequences. A bitset over free space, one bit for each amount that some
open sequence has left, finds the fullest sequence that still takes a piece in a few word operations. Where none
does, a new sequence is opened; if as many as allowed are open, the fullest one is closed first.

Pieces are dealt out evenly to packers of about ``ROWS_PER_PACKER`` pieces each, so the number of packers, and of
sequences left half full at their ends, follows the data. A packer keeps counters only; pieces stream through it.

Null text counts as empty and becomes the end id alone. Repeated rows are packed each. A document of more than
``capacity`` ids is cut, the first piece taking the remainder. Token ids of a whole text are held one text at a
time.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from notewright.llm.base import column_rows, ready, row_batches, texts
from notewright.session import scratch_path, settle

CAPACITY = 2048
OPEN_BINS = 4096
ROWS_PER_PACKER = 250_000
END_ID = 0

# The split into words that byte-level tokenizer files of this kind use; a fixed value.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same for texts of Latin-1 characters but those below, on which the two notions of a word character differ.
LATIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
LATIN_ODD = "[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbe]"
# Words whose ids are remembered: as many recent ones, and as many from before.
MOST_WORDS = 200_000


class WordTokenizer:
    """Ids of whole texts by a byte-level tokenizer file, through the ids of their distinct words.

    Such a tokenizer cuts a text into words by a pattern and encodes each by itself, so a word's ids never depend
    on what is around it. New words are merged by the file's vocabulary, whose order is the order of merges. A
    text that holds the string of a special token goes to the tokenizer whole.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.special = sorted(added)
        code = {char: byte for byte, char in enumerate(byte_characters())}
        ranks = {
            bytes(code[c] for c in token): rank
            for token, rank in self.tokenizer.get_vocab(with_added_tokens=False).items() if token not in added
        }
        self.merged = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.words, self.latin = regex.compile(WORD_PATTERN), re.compile(LATIN_PATTERN)
        self.odd = re.compile(LATIN_ODD)
        self.recent: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def cut(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.words.findall(text)
        return (self.words if self.odd.search(text) else self.latin).findall(text)

    def _learn(self, words: list[str]) -> None:
        if len(self.recent) > MOST_WORDS:
            self.recent, self.before = {}, self.recent
        recent, before, encode = self.recent, self.before, self.merged.encode_ordinary
        for word in [w for w in words if w not in recent]:
            ids = before.get(word)
            if ids is None:
                merged = encode(word)
                ids = struct.pack(f"<{len(merged)}I", *merged)
            recent[word] = ids

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        words = self.cut(text)
        self._learn(words)
        return b"".join(map(self.recent.__getitem__, words))


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable bytes stand for themselves,
    the others follow from code point 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(byte if byte in plain else next(others)) for byte in range(256)]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """The path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


_TOKENIZERS: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for each file and worker process."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def cut(length: int, capacity: int) -> list[int]:
    """The lengths of a document's pieces: all full but the first."""
    rest = length % capacity
    return ([rest] if rest else []) + [capacity] * (length // capacity)


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, ids)`` of all documents; ``path`` is a tokenizer's file."""
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    end = np.array([END_ID], dtype="<u4").tobytes()

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids]
    kinds = {"piece": pa.int32(), "ids": pa.binary()}
    fields = pa.schema([(name, kinds.get(name, pa.int64())) for name in names])

    def pieces(rows: Iterable[tuple]) -> Iterator[tuple]:
        tokenizer = word_tokenizer(path)
        for doc_id, text in rows:
            data = tokenizer.ids(text) + end
            start = 0
            for piece, length in enumerate(cut(len(data) // 4, capacity)):
                ids = data[4 * start:4 * (start + length)]
                yield (doc_id, piece, start, length, zlib.crc32(ids), ids)[:len(names)]
                start += length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return row_batches(pieces(column_rows(batches, "doc_id", "text")), fields)

    return texts(docs).mapInArrow(run, schema)


class BestFit:
    """Bounded-space online best-fit of lengths into bins of one capacity."""

    def __init__(self, capacity: int, open_bins: int, first: int = 0) -> None:
        self.capacity, self.most, self.next = capacity, open_bins, first
        self.open = 0
        self.bits = 0  # bit f is set while some open bin has f free
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        taken = bins.pop()
        if not bins:
            self.bits ^= 1 << free
        self.open -= 1
        return taken

    def place(self, length: int) -> tuple[int, int]:
        """The bin that the next length goes to and its place in it."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            chosen = self._take(free)
        else:
            if self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, chosen = self.capacity, self.next
            self.next += 1
        rest = free - length
        if rest:
            if not self.by_free[rest]:
                self.bits |= 1 << rest
            self.by_free[rest].append(chosen)
            self.open += 1
        return chosen, self.capacity - free


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """All rows and columns of ``pieces``, which has a column ``length`` of 1 to ``capacity``, and
    ``sequence_id`` and ``offset``."""
    pieces = settle(pieces, scratch_path(pieces.sparkSession, "pieces"))
    packers = max(1, math.ceil(pieces.count() / ROWS_PER_PACKER))
    added = [StructField(name, LongType()) for name in ("sequence_id", "offset")]
    schema = StructType(pieces.schema.fields + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = BestFit(capacity, open_bins, first=TaskContext.get().partitionId() << 40)
        for batch in batches:
            lengths = batch.column(batch.schema.get_field_index("length")).to_numpy()
            order = np.argsort(-lengths, kind="stable")
            placed = np.array([packer.place(n) for n in lengths[order].tolist()], dtype=np.int64).reshape(-1, 2)
            columns = batch.take(pa.array(order)).columns + [pa.array(placed[:, 0]), pa.array(placed[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "sequence_id", "offset"])

    # Dealt out without a key, so equal rows and ids spread like all others. Pieces arrive in an order that has
    # nothing to do with their length, and each batch of arrivals is placed from the longest down.
    mixed = pieces.repartition(packers).sortWithinPartitions(F.xxhash64(*pieces.columns))
    return mixed.mapInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, length, ids)``: the packed ids themselves, from pieces with their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most ``capacity`` pieces
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda all_, p: F.concat(all_, p["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))


def pack_documents(
    docs: DataFrame, path: str, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, with_ids: bool = False
) -> DataFrame:
    ready(docs.sparkSession)
    return pack(token_pieces(docs, path, capacity, with_ids), capacity, open_bins)
