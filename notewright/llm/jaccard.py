"""Documents linked by the Jaccard similarity of their word shingles, joined by adaptive multi-match prefixes.

A document's set is its distinct shingles, hashed to 64 bits. Equal sets are one class, known by a 128-bit digest. In one
pass over the texts each chunk of documents sends its hashes to buckets of the hash space; a bucket counts in how
many sets a shingle is (copies within a chunk are one) and answers for those of two sets or more. What only one set has
can match nothing. A set of which less than the needed overlap is shared has no partner and ends here; so most
documents never meet another. The answer is the place of a shingle among the shared ones of its bucket. From both
follows a number of its own, so sets go on as short numbers, which stand for the hashes one to one.

The shingles of what is left are ordered by that count, rarest first. Two sets of similarity t share at least ``ceil(t * n)``
shingles, so their prefixes of ``n - ceil(t * n) + m`` share at least ``m``. Each set chooses its ``m`` by the least
estimated cost: a longer prefix scans more postings, but a candidate must share more of it, and so fewer are verified.
A pair goes by the choice of its larger set.

Sets meet by the shingles of their prefixes. Of a group, pairs pass that may still be links by their sizes, the prefix
places of the shingle, the shingles that only one of them has and the parity sketches of the others, of which the
Hamming distance is a lower bound of the true difference. First a group returns only a spanning forest of the pairs that
pass, which is verified by prefix and by whole sets; that contracts families of near copies without their square. Then
all pairs that pass and are not yet connected are counted by shared prefix shingles, and those with ``m`` or more verified. No
link between parts that are not connected otherwise is lost, so the components are exact. Groups above
``PIECE`` are dealt over tasks as pairs of pieces; the number of pieces follows from the shingle's count.

Null texts are empty. A document without words has no set and links with nothing. Repeated rows and rows without an id are
members of the class of their text; ``component_id`` is the smallest id reachable, null where none has one. Texts of
any length go whole. No rows give no rows. Other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.llm.base import (
    bucket_count, by_bucket, column_rows, lane, mixed, one_a_task, ready, row_batches, texts,
)
from notewright.llm.components import components
from notewright.llm.lm import by_shard, from_planes, planes, squeeze, unsqueeze
from notewright.llm.simhash import with_components
from notewright.session import scratch_path, settle, shuffle_partitions

SHINGLE = 3
PERCENT = 90
MOST_MATCHES = 4
VERIFY_COST = 16.0  # of a candidate, in postings scanned
SKETCH_BITS = 1024
PIECE = 4096

CHUNK_BYTES = 8_000_000
CHUNK_DOCS = 60_000
BUCKET_BYTES = 32_000_000
BATCH_ROWS = 100_000
MOST_WORDS = 200_000  # of which a task keeps the hashes

_ODD = np.uint64(0x9E3779B97F4A7C15)
SENT_DDL = "bucket int, chunk string, block binary, info binary"
SENT = pa.schema([("bucket", pa.int32()), ("chunk", pa.string()), ("block", pa.binary()), ("info", pa.binary())])


def overlap(n: int) -> int:
    """The least number of shingles that a set of ``n`` shares with any partner."""
    return -(-PERCENT * n // 100)


class Sets:
    """Shingle sets of texts; words are hashed once a chunk."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def of(self, text: str) -> np.ndarray:
        known, words = self.known, text.encode().lower().split()
        for word in words:
            if word not in known:
                known[word] = lane(word)
        lanes = np.array([known[w] for w in words], dtype=np.uint64)
        width = min(SHINGLE, len(lanes))
        if not width:
            return lanes
        total = np.full(len(lanes) - width + 1, width, dtype=np.uint64)
        for k in range(width):
            total = mixed(total * _ODD + lanes[k:len(lanes) - width + 1 + k])
        return np.unique(total)


def digest(hashes: np.ndarray) -> bytes | None:
    """Of a set; none of the empty one, which is like no other."""
    return xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None


def digests(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, fingerprint)``: the size and the digest of each document's set."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("fingerprint", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        sets = Sets()
        for doc_id, text in column_rows(batches, "doc_id", "text"):
            found = sets.of(text)
            yield doc_id, len(found), digest(found)
            if len(sets.known) > MOST_WORDS:
                sets = Sets()

    ddl = "doc_id bigint, n_shingles bigint, fingerprint binary"
    return docs.mapInArrow(lambda batches: row_batches(rows(batches), schema), ddl)


def send_sets(docs: DataFrame, buckets: int) -> DataFrame:
    """The hashes of each chunk's distinct sets dealt to buckets; one row of a chunk has its sets' sizes and digests.

    A bucket has the hashes of one remainder, so only the quotients are sent."""

    def closed(held: list[tuple[np.ndarray, bytes]], name: str) -> Iterator[tuple]:
        if not held:
            return
        sizes = np.array([len(h) for h, _ in held], dtype=np.int64)
        info = squeeze(sizes, np.frombuffer(b"".join(same for _, same in held), dtype=np.uint8))
        hashes = np.concatenate([h for h, _ in held])
        order = np.argsort(hashes)
        doc = np.repeat(np.arange(len(held), dtype=np.uint16), sizes)[order]
        hashes = hashes[order]
        for b, at in by_bucket(hashes % np.uint64(buckets), buckets):
            steps = np.diff(hashes[at] // np.uint64(buckets), prepend=np.uint64(0))
            yield b, name, squeeze(planes(steps), planes(doc[at])), info
            info = None

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        task, n = TaskContext.get().partitionId(), 0
        sets, held, seen, size = Sets(), [], set(), 0
        for (text,) in column_rows(batches, "text"):
            found = sets.of(text)
            same = digest(found)
            if same is None or same in seen:
                continue
            seen.add(same)
            held.append((found, same))
            size += len(text)
            if size >= CHUNK_BYTES or len(held) >= CHUNK_DOCS:
                yield from closed(held, f"{task}-{n}")
                sets, held, seen, size, n = Sets(), [], set(), 0, n + 1
        yield from closed(held, f"{task}-{n}")

    return docs.select("text").mapInArrow(lambda batches: row_batches(rows(batches), SENT, 8), SENT_DDL)


def shared_shingles(sent: DataFrame, buckets: int) -> DataFrame:
    """``(chunk, bucket, block, info)``: back to each chunk the shingles that two sets or more have, by their places
    among those of the bucket, with their counts."""
    schema = pa.schema([("chunk", pa.string()), ("bucket", pa.int32()), ("block", pa.binary()), ("info", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for bucket, group in by_shard(column_rows(batches, "bucket", "chunk", "block", "info")):
            blocks = []
            for _, name, block, info in group:
                if info is not None:
                    yield name, bucket, None, info
                steps, doc = map(from_planes, unsqueeze(block), (np.uint64, np.uint16))
                blocks.append((name, np.cumsum(steps, dtype=np.uint64), doc))
            every = np.sort(np.concatenate([b[1] for b in blocks]))
            first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
            counts = np.diff(np.append(first, len(every)))
            found, counts = every[first[counts > 1]], counts[counts > 1].astype(np.uint32)
            if not len(found):
                continue
            for name, hashes, doc in blocks:
                at = np.minimum(np.searchsorted(found, hashes), len(found) - 1)
                kept = found[at] == hashes
                if kept.any():
                    steps = np.diff(at[kept].astype(np.uint64), prepend=np.uint64(0))
                    yield name, bucket, squeeze(*map(planes, (doc[kept], steps, counts[at[kept]]))), None

    spread = one_a_task(sent, buckets).sortWithinPartitions("bucket", "chunk")
    return spread.mapInArrow(
        lambda batches: row_batches(rows(batches), schema, 8), "chunk string, bucket int, block binary, info binary"
    )


def short(tokens: np.ndarray) -> bytes:
    """The numbers of shingles in 4 bytes each if they fit, else in 8."""
    return tokens.astype(np.uint32 if int(tokens.max(initial=0)) < 1 << 32 else np.uint64).tobytes()


def whole(tokens: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of :func:`short`."""
    return np.frombuffer(tokens, f"u{len(tokens) // n}").astype(np.uint64)


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Bits that tell whether an odd number of shingles falls on them; two differ in no more bits than shingles."""
    place = (mixed(tokens) % np.uint64(SKETCH_BITS)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=SKETCH_BITS) & 1).astype(np.uint8))


def matches(counts: np.ndarray, free: int, need: int) -> int:
    """How many prefix shingles a candidate must share: the number with the least estimated cost.

    ``counts`` are those of the shared shingles in order; with ``m`` the prefix has ``free + m`` of them."""
    best, cost = 1, None
    for m in range(1, min(MOST_MATCHES, need) + 1):
        scanned = float(counts[:free + m].sum() - min(free + m, len(counts)))
        whole = scanned + VERIFY_COST * scanned / m  # a candidate is met m times at least
        if cost is None or whole < cost:
            best, cost = m, whole
    return best


SET_DDL = "same binary, n bigint, own bigint, wanted int, tokens binary, counts binary, sketch binary"
SET = pa.schema([
    ("same", pa.binary()), ("n", pa.int64()), ("own", pa.int64()), ("wanted", pa.int32()), ("tokens", pa.binary()),
    ("counts", pa.binary()), ("sketch", pa.binary()),
])


def possible_sets(shared: DataFrame, buckets: int) -> DataFrame:
    """The distinct sets that share enough to have a partner: ``own`` shingles are theirs alone, ``tokens`` are the
    others in order, ``counts`` those of the longest prefix, ``wanted`` the shared prefix shingles they ask for."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for _, group in by_shard(column_rows(batches, "chunk", "bucket", "block", "info")):
            sizes, names = next(unsqueeze(info) for _, _, _, info in group if info is not None)
            blocks = []
            for _, bucket, block, _ in group:
                if block is not None:
                    doc, steps, counts = map(from_planes, unsqueeze(block), (np.uint16, np.uint64, np.uint32))
                    places = np.cumsum(steps, dtype=np.uint64)
                    blocks.append((doc, places * np.uint64(buckets) + np.uint64(bucket), counts))
            if not blocks:
                continue
            doc, tokens, counts = (np.concatenate(part) for part in zip(*blocks))
            order = np.lexsort((tokens, counts, doc))
            doc, tokens, counts = doc[order], tokens[order], counts[order]
            cuts = np.searchsorted(doc, np.arange(len(sizes) + 1))
            for k, n in enumerate(sizes.tolist()):
                start, end = int(cuts[k]), int(cuts[k + 1])
                need, free = overlap(n), end - start - overlap(n)
                if free < 0:
                    continue
                mine, often = tokens[start:end], counts[start:end]
                yield (names[16 * k:16 * k + 16].tobytes(), n, n - len(mine), matches(often, free, need),
                       short(mine), often[:free + MOST_MATCHES].tobytes(), sketch(mine).tobytes())

    spread = shared.repartition(shuffle_partitions(shared.sparkSession), "chunk").sortWithinPartitions("chunk")
    found = spread.mapInArrow(lambda batches: row_batches(rows(batches), SET, 64), SET_DDL)
    return found.dropDuplicates(["same"])


POSTING_DDL = (
    "token bigint, low int, high int, piece int, n bigint, same binary, own bigint, wanted int, level int, sketch binary"
)
POSTING = pa.schema([
    ("token", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("piece", pa.int32()), ("n", pa.int64()),
    ("same", pa.binary()), ("own", pa.int64()), ("wanted", pa.int32()), ("level", pa.int32()), ("sketch", pa.binary()),
])


def postings(sets: DataFrame) -> DataFrame:
    """Each set under each shingle of its longest prefix; ``level`` is the least number of matches whose prefix has it.

    A shingle of very many sets has a group for each pair of ``pieces`` of them."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for same, n, own, wanted, tokens, counts, bits in column_rows(
            batches, "same", "n", "own", "wanted", "tokens", "counts", "sketch"
        ):
            often = np.frombuffer(counts, np.uint32).tolist()
            prefix = whole(tokens, n - own)[:len(often)].tolist()
            free = n - own - overlap(n)
            mine = int.from_bytes(same[:8], "little")
            for at, (token, count) in enumerate(zip(prefix, often)):
                pieces = -(-count // PIECE)
                piece = mine % pieces
                for other in range(pieces):
                    yield (token, min(piece, other), max(piece, other), piece, n, same, own, wanted,
                           max(1, at - free + 1), bits)

    return sets.mapInArrow(lambda batches: row_batches(rows(batches), POSTING), POSTING_DDL)


def passing_pairs(batch: dict[str, np.ndarray], connected: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs of a batch that may be links. Rows are sorted by group and size; the second is the larger set.

    With ``connected``, rows of one label are left out."""
    group, n, own = batch["group"], batch["n"], batch["own"]
    low, step = np.arange(len(n)), 0
    while len(low):
        step += 1
        low = low[low < len(n) - step]
        high = low + step
        # Sorted by size, so a pair that is too far apart is so at any larger step.
        near = (group[low] == group[high]) & (100 * n[low] >= PERCENT * n[high])
        low = low[near]
        i, j = low, low + step
        wanted = batch["wanted"][j]
        fits = (batch["level"][i] <= wanted) & (batch["level"][j] <= wanted)
        # Pairs of one piece meet in the group of that piece with itself.
        fits &= (batch["piece"][i] != batch["piece"][j]) | (batch["low"][i] == batch["high"][i])
        if connected:
            fits &= batch["label"][i] != batch["label"][j]
        i, j = i[fits], j[fits]
        apart = own[i] + own[j] + np.bitwise_count(batch["sketch"][i] ^ batch["sketch"][j]).sum(axis=1, dtype=np.int64)
        # 100 * both >= PERCENT * any, in terms of the sum of the sizes and of what only one of them has.
        links = (100 + PERCENT) * apart <= (100 - PERCENT) * (n[i] + n[j])
        if links.any():
            yield i[links], j[links]


def spanning(pairs: Iterator[tuple[np.ndarray, np.ndarray]], size: int) -> Iterator[tuple[int, int]]:
    root = list(range(size))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for i, j in pairs:
        for a, b in zip(i.tolist(), j.tolist()):
            one, two = find(a), find(b)
            if one != two:
                root[max(one, two)] = min(one, two)
                yield a, b


PAIR_DDL = "a binary, b binary, wanted int"
PAIR = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("wanted", pa.int32())])


def candidates(posted: DataFrame, connected: bool) -> DataFrame:
    """``(a, b, wanted)``: pairs that pass, once for each prefix shingle; ``b`` is the larger set.

    Without labels a spanning forest of each group, with labels all pairs of different ones."""
    names = [*POSTING.names, "label"] if connected else POSTING.names
    numbers = [name for name in names if name not in ("same", "sketch", "label")]

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        """Batches that end with a whole group."""
        held: list[pa.RecordBatch] = []
        size = 0

        def close(table: pa.Table) -> dict[str, np.ndarray]:
            batch = {name: table.column(name).to_numpy() for name in numbers}
            batch["same"] = np.array(table.column("same").to_pylist(), dtype=object)
            bits = b"".join(table.column("sketch").to_pylist())
            batch["sketch"] = np.frombuffer(bits, np.uint64).reshape(-1, SKETCH_BITS // 64)
            if connected:
                batch["label"] = np.array(table.column("label").to_pylist(), dtype=object)
            keys = np.stack([batch["token"], batch["low"], batch["high"]])
            batch["group"] = np.concatenate([[0], np.cumsum((keys[:, 1:] != keys[:, :-1]).any(axis=0))])
            return batch

        for batch in chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                size += batch.num_rows
            if not size or (batch is not None and size < BATCH_ROWS):
                continue
            table = pa.Table.from_batches(held)
            cut = size
            if batch is not None:
                whole = close(table)["group"]
                cut = int(np.searchsorted(whole, whole[-1], "left"))
            if cut:
                yield close(table.slice(0, cut))
            held, size = table.slice(cut).to_batches(), size - cut

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in grouped(batches):
            pairs = passing_pairs(batch, connected)
            places = chain.from_iterable(zip(i.tolist(), j.tolist()) for i, j in pairs)
            same, wanted = batch["same"], batch["wanted"]
            for a, b in places if connected else spanning(pairs, len(same)):
                yield same[a], same[b], int(wanted[b])

    key = ["token", "low", "high"]
    ordered = posted.select(*names).repartition(shuffle_partitions(posted.sparkSession), *key)
    ordered = ordered.sortWithinPartitions(*key, "n", "same")
    return ordered.mapInArrow(lambda batches: row_batches(rows(batches), PAIR), PAIR_DDL)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``(a, b)``: the pairs that share enough of their prefixes and of their whole sets."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    side = lambda name: sets.select(
        F.col("same").alias(name), F.col("n").alias(f"n_{name}"), F.col("own").alias(f"own_{name}"),
        F.col("tokens").alias(f"tokens_{name}"),
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for a, b, wanted, n_a, own_a, one, n_b, own_b, two in column_rows(
            batches, "a", "b", "wanted", "n_a", "own_a", "tokens_a", "n_b", "own_b", "tokens_b"
        ):
            one, two = whole(one, n_a - own_a), whole(two, n_b - own_b)
            # In the order of all shingles, so the prefix is what comes first.
            heads = [t[:n - own - overlap(n) + wanted] for t, n, own in ((one, n_a, own_a), (two, n_b, own_b))]
            if len(np.intersect1d(*heads, assume_unique=True)) < wanted:
                continue
            both = len(np.intersect1d(one, two, assume_unique=True))
            if 100 * both >= PERCENT * (n_a + n_b - both):
                yield a, b

    met = pairs.join(side("a"), "a").join(side("b"), "b")
    return met.mapInArrow(lambda batches: row_batches(rows(batches), schema), "a binary, b binary")


def links(sets: DataFrame) -> DataFrame:
    """``(a, b)``: links enough to connect all sets that are linked."""
    spark = sets.sparkSession
    posted = settle(postings(sets), scratch_path(spark, "postings"))
    first = candidates(posted, connected=False).dropDuplicates(["a", "b"])
    first = settle(verified(first, sets), scratch_path(spark, "links"))
    labels = components(first).select(F.col("vertex").alias("same"), F.col("root").alias("label"))
    labelled = posted.join(labels, "same", "left").withColumn("label", F.coalesce("label", "same"))
    rest = candidates(labelled, connected=True).groupBy("a", "b", "wanted").agg(F.count("*").alias("met"))
    rest = verified(rest.where("met >= wanted").drop("met"), sets)
    return first.unionByName(settle(rest, scratch_path(spark, "links")))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row."""
    spark = ready(docs.sparkSession)
    docs = texts(docs)
    buckets = bucket_count(docs, BUCKET_BYTES, shuffle_partitions(spark))
    rows = settle(digests(docs), scratch_path(spark, "digests"))
    # Only what is sent is shuffled; the texts are read again rather than kept a second time as hashes.
    shared = shared_shingles(send_sets(docs, buckets), buckets)
    sets = settle(possible_sets(shared, buckets), scratch_path(spark, "possible"))
    found = with_components(rows.where("fingerprint IS NOT NULL"), links(sets))
    lone = rows.where("fingerprint IS NULL").withColumn("component_id", F.col("doc_id"))
    return found.select("doc_id", "n_shingles", "component_id").unionByName(lone.drop("fingerprint"))
