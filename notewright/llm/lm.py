"""A word bigram model in Elias-Fano tries, trained and queried shard by shard.

The model is p(w | v) = (c(vw) + K p(w)) / (c(v) + K). p(w) is the word's share of the training tokens, less what
the unknown word takes, which is the share of words seen once (Good-Turing, within bounds). A text's tokens are its
words and one end; the first is preceded by a start.

A trie node is a word, its children are the words seen before it. A shard holds the nodes of some words: the
sorted hashes of the words, the monotone pointers to their children and the children, 32-bit hashes set off by
their node's rank, are three Elias-Fano sequences. Exact counts of words, and for each child one byte for its
smoothed log probability from a codebook, stand beside them. Numerator and denominator are summed apart: log(c(vw)
+ K p(w)) is known where w's node is, log(c(v) + K) where v's is, and every token is the one or the other there. So
a shard answers for all its words by itself.

Documents are read in chunks of about ``CHUNK_TOKENS`` tokens. A chunk sends each shard its distinct pairs with
counts, and when scoring also the documents they occur in, as one compressed row. The shard's trie is written
to an unnamed file, mapped, and searched: the node by its hash, then the child relative to the node by successor
search. Its answers go back as sums for each document of the chunk. All counts come from all training documents,
and the volume sent follows the text. The pairs of heavy words, which have more than their share of the tokens, are
dealt over all shards by the word before; their list is shorter than four times the number of shards.

Null texts are empty and have one token. A null id is no held-out id. Repeated rows are counted and scored each.
Without training documents every score is 0.
"""

from __future__ import annotations

import math
import mmap
import tempfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.llm.base import column_rows, mixed, ready, row_batches, texts
from notewright.llm.eliasfano import EliasFano, encode
from notewright.session import scratch_path, settle, shuffle_partitions

CHUNK_TOKENS = 1_000_000
CHUNK_DOCS = 60_000
CONCENTRATION = 200.0
LEVELS = 256
START, END = 0x5354415254, 0x454E44

SENT = "shard int, chunk string, pairs binary, info binary"
SENT_SCHEMA = pa.schema([
    ("shard", pa.int32()), ("chunk", pa.string()), ("pairs", pa.binary()), ("info", pa.binary()),
])


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed block."""
    head = np.array([len(arrays), *(len(a) for a in arrays)], dtype=np.int64).tobytes()
    kinds = ",".join(a.dtype.str for a in arrays).encode().ljust(64)
    return zstandard.ZstdCompressor(level=1).compress(head + kinds + b"".join(a.tobytes() for a in arrays))


def planes(a: np.ndarray) -> np.ndarray:
    """The bytes of numbers, all first ones before all second ones, which compress better."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).reshape(-1)


def from_planes(a: np.ndarray, kind) -> np.ndarray:
    """The numbers of :func:`planes`."""
    return np.ascontiguousarray(a.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def unsqueeze(block: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(block)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    lengths = np.frombuffer(data, np.int64, n, 8)
    at, found = 8 * (n + 1) + 64, []
    for kind, length in zip(data[8 * (n + 1):at].decode().strip().split(","), lengths.tolist()):
        found.append(np.frombuffer(data, kind, length, at))
        at += found[-1].nbytes
    return found


@dataclass
class Chunk:
    """The tokens of some documents: word and word before by local number, and the document of each."""

    hashes: np.ndarray
    word: np.ndarray
    before: np.ndarray
    doc: np.ndarray
    doc_ids: list = field(default_factory=list)
    lengths: np.ndarray | None = None


def read_chunks(rows: Iterable[tuple], most: int = CHUNK_TOKENS) -> Iterator[Chunk]:
    """Chunks of ``(doc_id, text)`` rows."""
    local: dict[bytes, int] = {}
    parts: list[np.ndarray] = []
    ids: list = []
    total = 0

    def close() -> Chunk:
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in local), np.uint64, len(local))
        hashes = np.concatenate([np.array([START, END], dtype=np.uint64), hashes])
        lengths = np.array([len(p) for p in parts], dtype=np.int64)
        word = np.concatenate(parts)
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[np.cumsum(lengths) - lengths] = 0
        doc = np.repeat(np.arange(len(parts)), lengths).astype(np.uint16)
        return Chunk(hashes, word, before, doc, list(ids), lengths)

    for doc_id, text in rows:
        known = local.setdefault
        numbers = [known(w, len(local) + 2) for w in text.encode().lower().split()]
        numbers.append(1)
        parts.append(np.array(numbers, dtype=np.int32))
        ids.append(doc_id)
        total += len(numbers)
        if total >= most or len(ids) >= CHUNK_DOCS:
            yield close()
            local, parts, ids, total = {}, [], [], 0
    if ids:
        yield close()


def pair_blocks(chunk: Chunk, shards: int, heavy: np.ndarray, with_docs: bool) -> Iterator[tuple[int, bytes]]:
    """For each shard with pairs: words, children of each, children, counts, and the document of each occurrence."""
    order = np.argsort(chunk.hashes)
    rank = np.empty(len(order), dtype=np.uint64)
    rank[order] = np.arange(len(order), dtype=np.uint64)
    short = (mixed(chunk.hashes) >> np.uint64(32)).astype(np.uint64)
    home = (mixed(chunk.hashes) % np.uint64(shards)).astype(np.uint32)
    key = (rank[chunk.word] << np.uint64(32)) | short[chunk.before]
    shard = home[chunk.word]
    hot = np.isin(chunk.hashes, heavy)[chunk.word]
    # By the hashes themselves, as the shard must not depend on what else the chunk holds.
    both = chunk.hashes[chunk.word[hot]] + short[chunk.before[hot]]
    shard[hot] = (mixed(both) % np.uint64(shards)).astype(np.uint32)
    by_key = np.argsort(key, kind="stable")
    by_shard = by_key[np.argsort(shard[by_key], kind="stable")]
    key, shard, doc = key[by_shard], shard[by_shard], chunk.doc[by_shard]
    sorted_hashes = chunk.hashes[order]
    cuts = np.searchsorted(shard, np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(cuts)).tolist():
        keys = key[cuts[s]:cuts[s + 1]]
        firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.diff(np.append(firsts, len(keys))).astype(np.uint32)
        nodes, children = np.unique(keys[firsts] >> np.uint64(32), return_counts=True)
        arrays = [sorted_hashes[nodes.astype(np.int64)], children.astype(np.uint32),
                  keys[firsts].astype(np.uint32), counts]
        yield s, squeeze(*arrays, *([doc[cuts[s]:cuts[s + 1]]] if with_docs else []))


def _send(docs: DataFrame, shards: int, heavy: list[int], with_docs: bool, most: int) -> DataFrame:
    """``docs`` as one row a chunk and shard; with documents, one of a chunk's rows has their ids and lengths."""
    heavy_hashes = np.array(heavy, dtype=np.uint64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        task = TaskContext.get().partitionId()
        for n, chunk in enumerate(read_chunks(column_rows(batches, "doc_id", "text"), most)):
            info = None
            if with_docs:
                missing = np.array([i is None for i in chunk.doc_ids], dtype=np.uint8)
                ids = np.array([i or 0 for i in chunk.doc_ids], dtype=np.int64)
                info = squeeze(ids, missing, chunk.lengths)
            for s, block in pair_blocks(chunk, shards, heavy_hashes, with_docs):
                yield s, f"{task}-{n}", block, info
                info = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return row_batches(rows(batches), SENT_SCHEMA, 8)

    return docs.mapInArrow(run, SENT)


def heavy_words(docs: DataFrame, shards: int, most: int = CHUNK_TOKENS) -> list[int]:
    """Hashes of the words with more than a quarter of a shard's share of tokens, fewer than ``4 * shards``."""
    schema = pa.schema([("word", pa.int64()), ("n", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for chunk in read_chunks(column_rows(batches, "doc_id", "text"), most):
            counts = np.bincount(chunk.word, minlength=len(chunk.hashes))
            for k in np.flatnonzero(counts * (8 * shards) > len(chunk.word)).tolist():
                yield int(chunk.hashes[k].view(np.int64)), int(counts[k])
            yield None, len(chunk.word)

    each = docs.mapInArrow(lambda batches: row_batches(rows(batches), schema), "word bigint, n bigint")
    sums = each.groupBy("word").agg(F.sum("n").alias("n"))
    sums = settle(sums, scratch_path(docs.sparkSession, "heavy"))
    total = sums.where("word IS NULL").first()
    if total is None:
        return []
    heavy = sums.where(F.col("word").isNotNull() & (F.col("n") * (4 * shards) > F.lit(total["n"]))).collect()
    return sorted(row["word"] % 2**64 for row in heavy)


def merged(blocks: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Sorted words, children of each, children and counts, of the blocks of one shard together."""
    words = np.concatenate([b[0] for b in blocks])
    nodes, place = np.unique(words, return_inverse=True)
    starts = np.cumsum([0] + [len(b[0]) for b in blocks])
    keys = np.concatenate([
        (np.repeat(place[starts[k]:starts[k + 1]], b[1]).astype(np.uint64) << np.uint64(32)) | b[2]
        for k, b in enumerate(blocks)
    ])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], np.concatenate([b[3] for b in blocks])[order].astype(np.int64)
    firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.add.reduceat(counts, firsts)
    keys = keys[firsts]
    children = np.bincount((keys >> np.uint64(32)).astype(np.int64), minlength=len(nodes))
    return [nodes, children.astype(np.uint32), keys.astype(np.uint32), counts.astype(np.uint32)]


def by_shard(rows: Iterable[tuple]) -> Iterator[tuple]:
    """``(key, rows of that key)`` for rows sorted by their first field."""
    now: list[tuple] = []
    for row in rows:
        if now and now[0][0] != row[0]:
            yield now[0][0], now
            now = []
        now.append(row)
    if now:
        yield now[0][0], now


COUNTS = "shard int, pairs binary, tokens bigint, types bigint, once bigint, heavy array<struct<word:bigint,n:bigint>>"


def pair_counts(docs: DataFrame, shards: int, heavy: list[int], most: int = CHUNK_TOKENS) -> DataFrame:
    """A row for each shard: its pairs with their counts, and sums over its words; on shared storage."""
    spark = docs.sparkSession
    sent = _send(docs, shards, heavy, False, most).select("shard", "pairs")
    sent = sent.repartition(shards, "shard").sortWithinPartitions("shard")
    hot = np.array(heavy, dtype=np.uint64)
    pair = pa.struct([("word", pa.int64()), ("n", pa.int64())])
    schema = pa.schema([("shard", pa.int32()), ("pairs", pa.binary()), ("tokens", pa.int64()), ("types", pa.int64()),
                        ("once", pa.int64()), ("heavy", pa.list_(pair))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for shard, group in by_shard(column_rows(batches, "shard", "pairs")):
            table = merged([unsqueeze(pairs) for _, pairs in group])
            totals = word_totals(table)
            at = np.isin(table[0], hot)
            known = [{"word": int(w), "n": int(n)} for w, n in zip(table[0][at].view(np.int64), totals[at])]
            yield (shard, squeeze(*table), int(totals.sum()), int((~at).sum()), int((totals[~at] == 1).sum()), known)

    counts = sent.mapInArrow(lambda batches: row_batches(rows(batches), schema, 1), COUNTS)
    return settle(counts, scratch_path(spark, "counts"))


def word_totals(table: list[np.ndarray]) -> np.ndarray:
    ends = np.cumsum(table[1].astype(np.int64))
    sums = np.concatenate([[0], np.cumsum(table[3].astype(np.int64))])
    return sums[ends] - sums[ends - table[1]]


@dataclass
class Totals:
    """What all shards need to know: sums over the corpus and the counts of heavy words."""

    tokens: int
    types: int
    unknown: float
    documents: int
    heavy: dict[int, int]
    concentration: float

    def log_word(self, counts: np.ndarray) -> np.ndarray:
        """log10 of K p(w), by the word's count."""
        known = (1 - self.unknown) * counts / max(1, self.tokens)
        return np.log10(self.concentration * np.where(counts > 0, known, self.unknown))


def totals(counts: DataFrame, documents: int, concentration: float) -> Totals:
    sums = counts.agg(F.sum("tokens"), F.sum("types"), F.sum("once")).first()
    tokens, types, once = (int(x or 0) for x in sums)
    heavy = counts.select(F.inline("heavy")).groupBy("word").agg(F.sum("n").alias("n")).collect()
    heavy = {row["word"] % 2**64: row["n"] for row in heavy}
    once += sum(1 for n in heavy.values() if n == 1)
    unknown = min(0.5, max(once / tokens, 1 / (tokens + 1))) if tokens else 1.0
    return Totals(tokens, types + len(heavy), unknown, documents, heavy, concentration)


def build_trie(table: list[np.ndarray], known: Totals) -> bytes:
    """The levels of a shard's trie, one after the other."""
    nodes, children, kids, counts = table
    words = word_totals(table)
    for k in np.flatnonzero(np.isin(nodes, np.array(list(known.heavy), dtype=np.uint64))).tolist():
        words[k] = known.heavy[int(nodes[k])]
    rank = np.repeat(np.arange(len(nodes), dtype=np.uint64), children)
    lower = 10.0 ** known.log_word(words)
    values = np.log10(counts + np.repeat(lower, children))
    # A codebook of the means of bins of equal width.
    low, high = (values.min(), values.max()) if len(values) else (0.0, 0.0)
    bins = np.minimum((values - low) * (LEVELS / max(high - low, 1e-9)), LEVELS - 1).astype(np.uint8)
    size = np.maximum(np.bincount(bins, minlength=LEVELS), 1)
    book = np.bincount(bins, weights=values, minlength=LEVELS) / size
    pointers = np.concatenate([[0], np.cumsum(children.astype(np.int64))]).astype(np.uint64)
    levels = [encode(nodes), encode(pointers), encode((rank << np.uint64(32)) | kids)]
    return b"".join([*levels, words.astype(np.int64).tobytes(), book.tobytes(), bins.tobytes()])


class Trie:
    """A trie that ``build_trie`` wrote, mapped from an unnamed file."""

    def __init__(self, data: bytes) -> None:
        with tempfile.TemporaryFile() as file:
            file.write(data)
            file.flush()
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        self.nodes = EliasFano(self.map)
        self.pointers = EliasFano(self.map, self.nodes.end)
        self.children = EliasFano(self.map, self.pointers.end)
        at = self.children.end
        self.counts = np.frombuffer(self.map, np.int64, self.nodes.n, at)
        self.book = np.frombuffer(self.map, np.float64, LEVELS, at + 8 * self.nodes.n)
        self.bins = np.frombuffer(self.map, np.uint8, self.children.n, at + 8 * self.nodes.n + 8 * LEVELS)

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The node of each word, -1 if it has none, and the word's count."""
        if not self.nodes.n:
            return np.full(len(words), -1), np.zeros(len(words), dtype=np.int64)
        at = np.minimum(self.nodes.successor(words), self.nodes.n - 1)
        found = self.nodes.values(at) == words
        return np.where(found, at, -1), np.where(found, self.counts[at], 0)

    def pairs(self, node: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each node has the child, and the smoothed log of the pair."""
        if not self.children.n:
            return np.zeros(len(node), dtype=bool), np.zeros(len(node))
        wanted = (np.maximum(node, 0).astype(np.uint64) << np.uint64(32)) | before
        at = self.children.successor(wanted)
        inside = (node >= 0) & (at < self.pointers.values(np.maximum(node, 0) + 1).astype(np.int64))
        at = np.minimum(at, self.children.n - 1)
        found = inside & (self.children.values(at) == wanted)
        return found, self.book[self.bins[at]]


def answer(trie: Trie, known: Totals, block: list[np.ndarray]) -> bytes:
    """Of each document in the block: its number, known tokens, base sum and score sum."""
    words, children, kids, counts, doc = block
    node, total = trie.find(words)
    total = total.copy()
    for k in np.flatnonzero(np.isin(words, np.array(list(known.heavy), dtype=np.uint64))).tolist():
        total[k] = known.heavy[int(words[k])]  # its node may be elsewhere
    lower = known.log_word(total)
    spread = lambda x: np.repeat(x, children)
    found, value = trie.pairs(spread(node), kids)
    value = np.where(found, value, spread(lower))
    # A word that is no end comes before the next token, and its count is that token's denominator.
    after = np.where(words == END, 0.0, np.log10(total + known.concentration))
    each = lambda x: np.repeat(x, counts)
    score = each(value - spread(after))
    base = each(spread(np.log10(total + 1.0)))
    seen = each(spread(total > 0))
    sums = lambda x: np.bincount(doc, weights=x)
    here = np.flatnonzero(np.bincount(doc))
    return squeeze(here.astype(np.uint16), sums(seen)[here].astype(np.uint32), sums(base)[here],
                   sums(score)[here])


SCORES = "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
SCORES_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
    ("base_score", pa.float64()), ("score", pa.float64()),
])


@dataclass
class Model:
    counts: DataFrame
    known: Totals
    shards: int

    def tries(self) -> DataFrame:
        """``(shard, trie)``: the levels of every shard's trie, from the counts on shared storage."""
        known = self.known
        schema = pa.schema([("shard", pa.int32()), ("trie", pa.binary())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = column_rows(batches, "shard", "pairs")
            return row_batches(((shard, build_trie(unsqueeze(pairs), known)) for shard, pairs in rows), schema, 1)

        return self.counts.select("shard", "pairs").mapInArrow(run, "shard int, trie binary")

    def score(self, docs: DataFrame, most: int = CHUNK_TOKENS) -> DataFrame:
        """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` of every row of ``docs``."""
        known, shards = self.known, self.shards
        spark = ready(docs.sparkSession)
        sent = _send(texts(docs), shards, list(known.heavy), True, most)
        tries = self.tries().select(
            "shard", F.lit(None).cast("string").alias("chunk"), F.col("trie").alias("pairs"),
            F.lit(None).cast("binary").alias("info"),
        )
        schema = pa.schema([("chunk", pa.string()), ("sums", pa.binary()), ("info", pa.binary())])

        def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            # A shard's trie comes first, as its chunk is null.
            of, trie = None, None
            empty = build_trie([np.empty(0, np.uint64)] + [np.empty(0, np.uint32)] * 3, known)
            for shard, chunk, pairs, info in column_rows(batches, "shard", "chunk", "pairs", "info"):
                if shard != of:
                    of, trie = shard, Trie(empty if chunk is not None else pairs)
                if chunk is not None:
                    yield chunk, answer(trie, known, unsqueeze(pairs)), info

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return row_batches(answers(batches), schema, 16)

        together = sent.unionByName(tries).repartition(shards, "shard").sortWithinPartitions("shard", "chunk")
        sums = together.mapInArrow(run, "chunk string, sums binary, info binary")
        sums = sums.repartition(shuffle_partitions(spark), "chunk").sortWithinPartitions("chunk")

        def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            for _, group in by_shard(column_rows(batches, "chunk", "sums", "info")):
                ids, missing, lengths = next(unsqueeze(info) for _, _, info in group if info is not None)
                seen, base, score = (np.zeros(len(ids)) for _ in range(3))
                for _, part, _ in group:
                    here, s, b, p = unsqueeze(part)
                    seen[here] += s
                    base[here] += b
                    score[here] += p
                base -= lengths * math.log10(known.tokens + known.types + 1)
                score -= math.log10(known.documents + known.concentration)
                for k in range(len(ids)):
                    yield (None if missing[k] else int(ids[k]), int(lengths[k]), int(seen[k]), known.tokens,
                           float(base[k]), float(score[k]))

        return sums.mapInArrow(lambda batches: row_batches(finish(batches), SCORES_SCHEMA), SCORES)


def train(docs: DataFrame, concentration: float = CONCENTRATION, shards: int | None = None,
          most: int = CHUNK_TOKENS) -> Model:
    """The model of all rows of ``docs``; ``shards`` should be so many that one fits a task several times over."""
    spark = ready(docs.sparkSession)
    shards = shards or shuffle_partitions(spark)
    rows = texts(docs)
    heavy = heavy_words(rows, shards, most)
    counts = pair_counts(rows, shards, heavy, most)
    return Model(counts, totals(counts, rows.count(), concentration), shards)
