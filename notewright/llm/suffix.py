"""Byte strings of a fixed length that repeat across documents, removed by suffix arrays.

Every byte is removed that lies in a string of ``LENGTH`` bytes which also starts in a document with a smaller id.

A suffix array of everything would mean comparing every shard of the corpus with every other. So suffixes are
sampled first: of every ``LENGTH`` bytes in a row, the ``GRAM`` bytes with the least hash are an anchor, so equal
strings have equal anchors at the same place. Each shard of documents sorts its anchors by hash; shards are merged
by binary search of their hashes, a bucket of the hash space in each task. Only the surroundings of anchors
that two documents share go on: all strings of ``LENGTH`` bytes that hold the anchor. They meet by the anchor's
hash, and there the suffixes that start them are sorted as Larsson and Sadakane do, by ranks of ever longer
prefixes, going on only with those not yet told apart. Kasai's method gives the common prefixes of neighbours, run in
step over all surroundings; suffixes with ``LENGTH`` bytes in common form a group, and all but those of the
group's smallest document are marked. Nothing is lost, and the work does not grow with the square of the shards.

A null text is empty. A null id comes after all others; ids that are equal are not smaller than each other, so
repeated rows have equal results. Texts shorter than ``LENGTH`` bytes keep all of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.llm.base import column_rows, mixed, one_a_task, ready, row_batches
from notewright.llm.lm import by_shard, squeeze, unsqueeze
from notewright.session import scratch_path, settle, shuffle_partitions

LENGTH = 50
GRAM = 24  # a multiple of 8
STARTS = LENGTH - GRAM + 1  # of strings that hold an anchor
WIDTH = LENGTH + STARTS - 1  # of an anchor's surroundings
LAST = np.iinfo(np.int64).max

CHUNK_BYTES = 24_000_000
CHUNK_DOCS = 60_000
SORTED_AT_ONCE = 16_384  # surroundings

BLOCK = "bucket int, chunk string, block binary, info binary"
BLOCK_SCHEMA = pa.schema([
    ("bucket", pa.int32()), ("chunk", pa.string()), ("block", pa.binary()), ("info", pa.binary()),
])
REPLY = "chunk string, block binary, info binary"
REPLY_SCHEMA = pa.schema([("chunk", pa.string()), ("block", pa.binary()), ("info", pa.binary())])


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, in the last axis, as one number."""
    n = data.shape[-1] - 7
    total = np.zeros((*data.shape[:-1], n), dtype=np.uint64)
    for k in range(8):
        total = (total << np.uint64(8)) | data[..., k:n + k]
    return total


def _gram_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of ``GRAM`` bytes, from their words of eight bytes in the first axis."""
    total = mixed(words[0])
    for word in words[1:]:
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + word)
    return total


def _sliding(pick: np.ufunc, values: np.ndarray, window: int) -> np.ndarray:
    size = 1
    while 2 * size <= window:
        values = pick(values[:-size], values[size:])
        size *= 2
    rest = window - size
    return pick(values[:-rest], values[rest:]) if rest else values


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of a text of bytes."""
    if len(data) < LENGTH:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    words = _words(data)
    n = len(data) - GRAM + 1
    hashes = _gram_hashes(np.stack([words[k:k + n] for k in range(0, GRAM, 8)]))
    least = _sliding(np.minimum, hashes, STARTS)
    edge = np.zeros(STARTS - 1, dtype=np.uint64)
    # The largest of the minima of the windows that a position is in; its own hash where it is one of them.
    chosen = np.flatnonzero(_sliding(np.maximum, np.concatenate([edge, least, edge]), STARTS) == hashes)
    return chosen, hashes[chosen]


class Chunk:
    """Documents of one shard, and what each bucket of the hash space gets of it."""

    def __init__(self) -> None:
        self.keys: list[str] = []
        self.ords: list[int] = []
        self.copies: list[str] = []
        self.parts: list[tuple] = []
        self.size = 0

    def full(self) -> bool:
        return self.size >= CHUNK_BYTES or len(self.keys) >= CHUNK_DOCS

    def info(self) -> bytes:
        keys = np.frombuffer(bytes.fromhex("".join(self.keys)), dtype=np.uint8)
        copies = np.frombuffer(bytes.fromhex("".join(self.copies)), dtype=np.uint8)
        return squeeze(keys, np.array(self.ords, dtype=np.int64), copies)

    def shifts(self) -> np.ndarray:
        """The order numbers as differences, which compress well."""
        return np.diff(np.array(self.ords, dtype=np.int64), prepend=0)


def _hex_keys(data: np.ndarray) -> list[str]:
    digits = data.tobytes().hex()
    return [digits[k:k + 32] for k in range(0, len(digits), 32)]


def anchor_chunks(rows: Iterable[tuple]) -> Iterator[Chunk]:
    """Chunks of ``(key, ord, text)`` rows; of equal texts in a chunk the one that comes first goes on."""

    def close(held: list[tuple]) -> Chunk:
        chunk, first = Chunk(), {}
        for key, ord_, text in held:
            if text not in first or ord_ < first[text]:
                first[text] = ord_
        done = set()
        for key, ord_, text in held:
            if key in done:
                continue
            done.add(key)
            if ord_ > first[text]:
                chunk.copies.append(key)
                continue
            position, hashes = anchors(np.frombuffer(text.encode(), dtype=np.uint8))
            if len(position):
                chunk.parts.append((hashes, np.full(len(position), len(chunk.keys), np.uint16), position))
                chunk.keys.append(key)
                chunk.ords.append(ord_)
        return chunk

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2])
        if size >= CHUNK_BYTES or len(held) >= CHUNK_DOCS:
            yield close(held)
            held, size = [], 0
    if held:
        yield close(held)


def _to_buckets(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each bucket the places of its hashes, by hash."""
    order = np.argsort(hashes, kind="stable")
    bucket = (hashes[order] % np.uint64(buckets)).astype(np.uint32)
    order, bucket = order[np.argsort(bucket, kind="stable")], np.sort(bucket)
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        yield b, order[cuts[b]:cuts[b + 1]]


def send_anchors(docs: DataFrame, buckets: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        task = TaskContext.get().partitionId()
        for n, chunk in enumerate(anchor_chunks(column_rows(batches, "key", "ord", "text"))):
            info, shifts = chunk.info(), chunk.shifts()
            if not chunk.parts:
                yield 0, f"{task}-{n}", None, info
                continue
            hashes, doc, position = (np.concatenate(part) for part in zip(*chunk.parts))
            for b, at in _to_buckets(hashes, buckets):
                block = squeeze(np.diff(hashes[at], prepend=np.uint64(0)), doc[at], position[at].astype(np.uint32), shifts)
                yield b, f"{task}-{n}", block, info
                info = None

    return docs.mapInArrow(lambda batches: row_batches(rows(batches), BLOCK_SCHEMA, 8), BLOCK)


def shared_anchors(sent: DataFrame, buckets: int) -> DataFrame:
    """Back to each chunk: document and position of its anchors that another document has too."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for _, group in by_shard(column_rows(batches, "bucket", "chunk", "block", "info")):
            for _, chunk, block, info in group:
                if info is not None:
                    yield chunk, None, info
            blocks = []
            for _, chunk, block, _ in group:
                if block is not None:
                    hashes, doc, position, shifts = unsqueeze(block)
                    blocks.append((chunk, np.cumsum(hashes, dtype=np.uint64), doc, position, np.cumsum(shifts)))
            if not blocks:
                continue
            merged = np.unique(np.concatenate([b[1] for b in blocks]))
            least, most = np.full(len(merged), LAST), np.full(len(merged), np.iinfo(np.int64).min)
            for _, hashes, doc, _, ords in blocks:
                at = np.searchsorted(merged, hashes)
                np.minimum.at(least, at, ords[doc])
                np.maximum.at(most, at, ords[doc])
            shared = least < most
            for chunk, hashes, doc, position, _ in blocks:
                kept = shared[np.searchsorted(merged, hashes)]
                if kept.any():
                    yield chunk, squeeze(doc[kept], position[kept]), None

    spread = one_a_task(sent, buckets).sortWithinPartitions("bucket", "chunk")
    return spread.mapInArrow(lambda batches: row_batches(rows(batches), REPLY_SCHEMA, 8), REPLY)


def positions(replies: DataFrame) -> DataFrame:
    """``(key, copy, at)``: the shared anchors of each document, or that it is a copy of another in its chunk."""
    schema = pa.schema([("key", pa.string()), ("copy", pa.bool_()), ("at", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for _, group in by_shard(column_rows(batches, "chunk", "block", "info")):
            keys, _, copies = next(unsqueeze(info) for _, _, info in group if info is not None)
            for key in _hex_keys(copies):
                yield key, True, None
            blocks = [unsqueeze(block) for _, block, _ in group if block is not None]
            if blocks:
                doc, place = (np.concatenate(part) for part in zip(*blocks))
                for key, at in _by_document(_hex_keys(keys), doc, place):
                    yield key, False, np.sort(at).tobytes()

    return _by_chunk(replies).mapInArrow(lambda batches: row_batches(rows(batches), schema), "key string, copy boolean, at binary")


def _by_chunk(replies: DataFrame) -> DataFrame:
    parts = shuffle_partitions(replies.sparkSession)
    return replies.repartition(parts, "chunk").sortWithinPartitions("chunk")


def _by_document(keys: list[str], doc: np.ndarray, values: np.ndarray) -> Iterator[tuple[str, np.ndarray]]:
    order = np.argsort(doc, kind="stable")
    doc, values = doc[order], values[order]
    cuts = np.append(np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])), len(doc))
    for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield keys[doc[start]], values[start:end]


def surroundings(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row for each anchor: the bytes around it, and which of them the text has, as first and end."""
    first = at.astype(np.int64) - (STARTS - 1)
    padded = np.zeros(len(data) + 2 * WIDTH, dtype=np.uint8)
    padded[WIDTH:WIDTH + len(data)] = data
    rows = np.empty((len(at), WIDTH + 2), dtype=np.uint8)
    rows[:, :WIDTH] = padded[(first + WIDTH)[:, None] + np.arange(WIDTH)]
    rows[:, WIDTH] = np.maximum(-first, 0)
    rows[:, WIDTH + 1] = np.minimum(len(data) - first, WIDTH)
    return rows


def _anchor_of(rows: np.ndarray) -> np.ndarray:
    words = _words(rows[:, STARTS - 1:STARTS - 1 + GRAM])
    return _gram_hashes(np.stack([words[:, k] for k in range(0, GRAM, 8)]))


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows and the place among them of each, by hashes; equal hashes are compared byte by byte."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), dtype=np.uint8)
    wide[:, :rows.shape[1]] = rows
    words = wide.view(np.uint64)
    total = np.zeros(len(rows), dtype=np.uint64)
    for column in words.T:
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + column)
    order = np.argsort(total)
    total, words = total[order], words[order]
    equal = (words[1:] == words[:-1]).all(axis=1)
    if (equal != (total[1:] == total[:-1])).any():
        whole = np.ascontiguousarray(rows).view(f"V{rows.shape[1]}").ravel()
        found, place = np.unique(whole, return_inverse=True)
        return found.view(np.uint8).reshape(-1, rows.shape[1]), place
    new = np.concatenate([np.ones(min(1, len(rows)), dtype=bool), ~equal])
    place = np.empty(len(rows), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return rows[order[new]], place


def send_surroundings(docs: DataFrame, buckets: int) -> DataFrame:
    """``docs`` has ``(key, ord, text, at)``."""

    def chunks(rows: Iterable[tuple]) -> Iterator[Chunk]:
        chunk = Chunk()
        for key, ord_, text, at in rows:
            at = np.frombuffer(at, dtype=np.uint32)
            around = surroundings(np.frombuffer(text.encode(), dtype=np.uint8), at)
            chunk.parts.append((around, np.full(len(at), len(chunk.keys), np.uint16), at))
            chunk.keys.append(key)
            chunk.ords.append(ord_)
            chunk.size += around.nbytes
            if chunk.full():
                yield chunk
                chunk = Chunk()
        if chunk.parts:
            yield chunk

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        task = TaskContext.get().partitionId()
        for n, chunk in enumerate(chunks(column_rows(batches, "key", "ord", "text", "at"))):
            info, shifts = chunk.info(), chunk.shifts()
            around, doc, position = (np.concatenate(part) for part in zip(*chunk.parts))
            for b, at in _to_buckets(_anchor_of(around), buckets):
                some, place = _distinct(around[at])
                block = squeeze(some.ravel(), place.astype(np.uint32), doc[at], position[at], shifts)
                yield b, f"{task}-{n}", block, info
                info = None

    return docs.mapInArrow(lambda batches: row_batches(rows(batches), BLOCK_SCHEMA, 4), BLOCK)


def suffix_array(around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The starts of strings, as ``row * STARTS + column``, sorted by their ``LENGTH`` bytes, and their ranks."""
    rows = len(around)
    rank = _ranked(_words(around[:, :WIDTH]))
    for have, to in ((8, 16), (16, 32), (32, LENGTH)):
        columns = WIDTH - to + 1
        rank = _refined(rank[:, :columns], rank[:, to - have:to - have + columns])
    order = np.argsort(rank.ravel().astype(np.uint32))
    return order, rank.reshape(rows, STARTS)


def _ranked(values: np.ndarray) -> np.ndarray:
    """Ranks by value, where the rank of a group of equals is the number of smaller ones."""
    flat = values.ravel()
    order = np.argsort(flat)
    ordered = flat[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    rank = np.empty(len(flat), dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(len(flat)), 0))
    return rank.reshape(values.shape)


def _refined(rank: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Ranks by both; those that one rank alone has told apart are left as they are."""
    flat = rank.ravel().copy()
    todo = np.flatnonzero(np.bincount(flat)[flat] > 1)
    old, other = flat[todo], second.ravel()[todo]
    order = np.argsort((old.astype(np.uint64) << np.uint64(32)) | other.astype(np.uint64))
    todo, old, other = todo[order], old[order], other[order]
    if len(todo):
        new_old = np.concatenate([[True], old[1:] != old[:-1]])
        new = new_old | np.concatenate([[True], other[1:] != other[:-1]])
        at = np.arange(len(todo))
        start = np.maximum.accumulate(np.where(new_old, at, 0))
        flat[todo] = old + np.maximum.accumulate(np.where(new, at, 0)) - start
    return flat.reshape(rank.shape)


def common_prefixes(around: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each suffix of ``order`` has in common with the one before it, up to ``LENGTH``.

    Going one byte on in a text loses at most one byte of the common prefix, as long as the other suffix, one byte
    on, stands before it too. That fails only at the last column and among strings that are equal in all bytes
    that count; there the comparison begins anew. The texts go on side by side, one column at a time.
    """
    rows = len(around)
    before = np.full(rows * STARTS, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    place = np.empty(rows * STARTS, dtype=np.int64)
    place[order] = np.arange(rows * STARTS)
    flat = np.ascontiguousarray(around[:, :WIDTH]).ravel()
    result = np.zeros(rows * STARTS, dtype=np.int64)
    have = np.zeros(rows, dtype=np.int64)
    for column in range(STARTS):
        here = np.arange(rows) * STARTS + column
        if column:
            still = (other >= 0) & (other % STARTS < STARTS - 1)
            still[still] = place[other[still] + 1] < place[here[still]]
            have = np.where(still, np.maximum(have - 1, 0), 0)
        other = before[here]
        mine, theirs = np.arange(rows) * WIDTH + column, other // STARTS * WIDTH + other % STARTS
        going = np.flatnonzero((other >= 0) & (have < LENGTH))
        while len(going):
            same = flat[mine[going] + have[going]] == flat[theirs[going] + have[going]]
            going = going[same]
            have[going] += 1
            going = going[have[going] < LENGTH]
        result[here] = have
    return result[order]


def least_orders(around: np.ndarray, ords: np.ndarray) -> np.ndarray:
    """For each row and start the smallest order number of a row that holds the same string; ``LAST`` if none."""
    table = np.full((len(around), STARTS), LAST, dtype=np.int64)
    anchor = _anchor_of(around)
    by_anchor = np.argsort(anchor, kind="stable")
    anchor = anchor[by_anchor]
    ends = np.append(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, len(anchor))
    start = 0
    while start < len(anchor):
        # Whole anchors, as equal strings lie with equal anchors.
        end = int(ends[np.searchsorted(ends, min(start + SORTED_AT_ONCE, len(anchor)))])
        some = by_anchor[start:end]
        start = end
        part = around[some]
        order, _ = suffix_array(part)
        column = order % STARTS
        row = order // STARTS
        inside = (column >= part[row, WIDTH]) & (column + LENGTH <= part[row, WIDTH + 1])
        group = np.cumsum(common_prefixes(part, order) < LENGTH)
        # A string that runs over the end of its text is none, and takes no part in its group.
        value = np.where(inside, ords[some][row], LAST)
        least = np.full(group[-1] + 1, LAST, dtype=np.int64)
        np.minimum.at(least, group, value)
        found = np.full(len(part) * STARTS, LAST, dtype=np.int64)
        found[order] = np.where(inside, least[group], LAST)
        table[some] = found.reshape(len(part), STARTS)
    return table


def marked_starts(sent: DataFrame, buckets: int) -> DataFrame:
    """Back to each chunk: document, position and the starts, as bits, that a smaller document has too."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for _, group in by_shard(column_rows(batches, "bucket", "chunk", "block", "info")):
            blocks = []
            for _, chunk, block, info in group:
                if info is not None:
                    yield chunk, None, info
                around, place, doc, position, shifts = unsqueeze(block)
                blocks.append((chunk, around.reshape(-1, WIDTH + 2), place, doc, position, np.cumsum(shifts)))
            merged, to = _distinct(np.concatenate([b[1] for b in blocks]))
            starts = np.cumsum([0] + [len(b[1]) for b in blocks])
            ords = np.full(len(merged), LAST, dtype=np.int64)
            for k, (_, _, place, doc, _, order) in enumerate(blocks):
                np.minimum.at(ords, to[starts[k]:starts[k + 1]][place], order[doc])
            least = least_orders(merged, ords)
            for k, (chunk, _, place, doc, position, order) in enumerate(blocks):
                mine = least[to[starts[k]:starts[k + 1]][place]] < order[doc][:, None]
                bits = mine.astype(np.uint32) @ (np.uint32(1) << np.arange(STARTS, dtype=np.uint32))
                kept = bits > 0
                if kept.any():
                    yield chunk, squeeze(doc[kept], position[kept], bits[kept].astype(np.uint32)), None

    spread = one_a_task(sent, buckets).sortWithinPartitions("bucket", "chunk")
    return spread.mapInArrow(lambda batches: row_batches(rows(batches), REPLY_SCHEMA, 4), REPLY)


def spans(replies: DataFrame) -> DataFrame:
    """``(key, copy, at)``: for each document pairs of an anchor's position and the starts marked around it."""
    schema = pa.schema([("key", pa.string()), ("copy", pa.bool_()), ("at", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for _, group in by_shard(column_rows(batches, "chunk", "block", "info")):
            blocks = [unsqueeze(block) for _, block, _ in group if block is not None]
            if blocks:
                keys = _hex_keys(next(unsqueeze(info) for _, _, info in group if info is not None)[0])
                doc, position, bits = (np.concatenate(part) for part in zip(*blocks))
                for key, at in _by_document(keys, doc, np.stack([position, bits], axis=1)):
                    yield key, False, at.astype(np.uint32).tobytes()

    return _by_chunk(replies).mapInArrow(lambda batches: row_batches(rows(batches), schema), "key string, copy boolean, at binary")


def covered(n: int, copy: bool, at: bytes | None) -> np.ndarray:
    """Which of ``n`` bytes are removed."""
    if copy and n >= LENGTH:
        return np.ones(n, dtype=bool)
    change = np.zeros(n + 1, dtype=np.int64)
    if at is not None:
        position, bits = np.frombuffer(at, dtype=np.uint32).reshape(-1, 2).astype(np.int64).T
        for start in range(STARTS):
            first = position[(bits >> start) & 1 == 1] - (STARTS - 1) + start
            np.add.at(change, first, 1)
            np.add.at(change, first + LENGTH, -1)
    return np.cumsum(change[:n]) > 0


def without_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, kept, n_bytes, n_removed, n_spans)``: the bytes that stay of every row's text."""
    spark = ready(docs.sparkSession)
    buckets = shuffle_partitions(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    ident = F.col("doc_id").cast("bigint")
    rows = docs.select(
        ident.alias("doc_id"), text.alias("text"), F.coalesce(ident, F.lit(LAST)).alias("ord"),
        F.md5(F.concat(F.coalesce(ident.cast("string"), F.lit("")), F.lit("\0"), text)).alias("key"),
    )
    shared = positions(shared_anchors(send_anchors(rows.select("key", "ord", "text"), buckets), buckets))
    shared = settle(shared, scratch_path(spark, "anchors"))
    # Both joins below read the same rows by the same key, so their texts are shuffled once.
    by_key = rows.select("key", "doc_id", "text").repartition(buckets, "key")
    at = shared.where(~F.col("copy")).select("key", "at").dropDuplicates(["key"])
    order = F.coalesce("doc_id", F.lit(LAST)).alias("ord")
    around = by_key.join(at, "key").select("key", order, "text", "at")
    marked = spans(marked_starts(send_surroundings(around, buckets), buckets))
    # A row that one chunk holds twice is told of once; a copy in one chunk may be a first in another.
    both = marked.unionByName(shared.where("copy").select("key", "copy", "at"))
    both = both.groupBy("key").agg(F.max("copy").alias("copy"), F.max("at").alias("at"))

    ddl = "doc_id bigint, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint"
    schema = pa.schema([("doc_id", pa.int64()), ("kept", pa.binary()), ("n_bytes", pa.int64()),
                        ("n_removed", pa.int64()), ("n_spans", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_id, text, copy, at in column_rows(batches, "doc_id", "text", "copy", "at"):
            data = text.encode()
            if not copy and at is None:
                yield doc_id, data, len(data), 0, 0
                continue
            gone = covered(len(data), bool(copy), at)
            kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
            n_spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
            yield doc_id, kept, len(data), len(data) - len(kept), n_spans

    whole = by_key.join(both, "key", "left").select("doc_id", "text", "copy", "at")
    return whole.mapInArrow(lambda batches: row_batches(cut(batches), schema, 256), ddl)
