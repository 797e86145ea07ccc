"""Benchmark passages in documents, found by spaced seeds and verified with room for substituted words.

A seed is the hash of the words under the ones of a fixed mask laid at some position; words under its zeros do not
matter, so a substituted word there costs nothing. The masks follow from the rule by the pigeonhole principle: of
a window cut into blocks, substituted words touch at most as many blocks as there are such words, and for each
choice of untouched blocks there is a mask that keeps them. So no overlap that the rule accepts is missed. Items
shorter than the window have masks of their own length. Seeds of benchmark items and documents are joined. Each hit
names a diagonal, on which item and document are compared word for word; the document is contaminated by the item if
``SIMILARITY`` of some window of ``WINDOW`` words agree (of the whole item, where it is shorter).

Before the join a document's seeds pass a filter of fixed size with the bits of all benchmark seeds. A benchmark
of any size may be used: the filter only gets fuller, and the join decides. Equal texts are looked at once.

Words are runs of letters, their marks and digits of any script, lower case. Null or empty texts and items match
nothing. An item of one to four words must occur whole, so an item of one word is found in every document that has the
word. Repeated rows of documents or items are found like single ones. A text of any length is hashed by running sums in
one pass. Columns of either table are kept in one struct, so none of their names can clash. No rows on either side
give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.llm.base import column_rows, mixed, ready, row_batches, whole_row, whole_text
from notewright.session import scratch_path, settle

WINDOW = 20
SIMILARITY = 0.8
LEAST_KEPT = 6  # words that a mask keeps, where the rule leaves so many
FILTER_BITS = 1 << 24
PROBES = 3

_FACTOR = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_FACTOR, -1, 2**64)
# Punctuation, blanks and signs beyond ASCII end a word like those of ASCII; marks go with their letters.
_BETWEEN = regex.compile(r"[^\x00-\x7F\p{L}\p{M}\p{N}]+")
_IN_WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = max(n, 1 << 16)
        for name, factor in (("up", _FACTOR), ("down", _INVERSE)):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def substitutions(size: int, similarity: float) -> int:
    """The words of a window of ``size`` that may differ."""
    return max(k for k in range(size + 1) if size - k >= similarity * size)


def masks_for(size: int, similarity: float) -> tuple[str, ...]:
    """Masks of which one, laid somewhere in a window, keeps none of its differing words, whichever these are.

    1 keeps a position; all masks begin and end with a kept one. Blocks are of equal length, the words left over
    at the end do not count, so that choices of blocks that are alike but for their place are one mask.
    """
    apart = substitutions(size, similarity)
    if not apart or apart == size:
        return ("1" * size,) if not apart else ("1",)
    kept = lambda n: (n - apart) * (size // n)
    most = max(map(kept, range(apart + 1, size + 1)))
    blocks = next(n for n in range(apart + 1, size + 1) if kept(n) >= min(LEAST_KEPT, most))
    width = size // blocks
    masks = {}
    for some in combinations(range(blocks), blocks - apart):
        masks["".join(("1" if k in some else "0") * width for k in range(blocks)).strip("0")] = None
    return tuple(masks)


# Of windows of whole length.
MASKS = masks_for(WINDOW, SIMILARITY)


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash for each word, from running sums of a polynomial over the bytes of the text."""
    if not text.isascii():
        text = _BETWEEN.sub(" ", text)
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8)
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = _IN_WORD[data]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """The hash of the kept words at each position where the mask fits."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.full(n, len(mask) * 1000 + int(mask, 2), dtype=np.uint64)
    for k, kept in enumerate(mask):
        if kept == "1":
            total += words[k:k + n] * np.uint64(pow(_FACTOR, k + 2, 2**64))
    return mixed(total)


def all_seeds(words: np.ndarray, masks: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    each = [seeds(words, mask) for mask in masks]
    return np.concatenate(each), np.concatenate([np.arange(len(s)) for s in each])


def filter_places(hashes: np.ndarray) -> np.ndarray:
    """The bits of the filter that a seed sets, a column for each probe."""
    return np.stack([mixed(hashes + np.uint64(k)) % np.uint64(FILTER_BITS) for k in range(PROBES)], axis=1)


def item_words(benchmark: DataFrame) -> DataFrame:
    """``(item, item_id, words)``: distinct items, numbered on shared storage, with the hashes of their words."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), whole_text().alias("text")).distinct()
    schema = pa.schema([("item_id", pa.int64()), ("words", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = column_rows(batches, "item_id", "text")
        return row_batches(((item, word_hashes(text).tobytes()) for item, text in rows), schema)

    items = rows.mapInArrow(run, "item_id bigint, words binary").distinct()
    return settle(items.withColumn("item", F.monotonically_increasing_id()), scratch_path(spark, "items"))


def item_seeds(items: DataFrame, masks: tuple[str, ...], window: int = WINDOW,
               similarity: float = SIMILARITY) -> DataFrame:
    """``(seed, item, place)`` of every item: by ``masks``, or by those of its length if it is below the window."""
    schema = pa.schema([("seed", pa.int64()), ("item", pa.int64()), ("place", pa.int32())])

    def of(item: int, data: bytes) -> Iterator[tuple]:
        words = np.frombuffer(data, dtype=np.uint64)
        if not len(words):
            return iter(())
        hashes, places = all_seeds(words, masks if len(words) >= window else masks_for(len(words), similarity))
        return zip(hashes.view(np.int64).tolist(), [item] * len(hashes), places.tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return row_batches((r for row in column_rows(batches, "item", "words") for r in of(*row)), schema)

    found = items.select("item", "words").mapInArrow(run, "seed bigint, item bigint, place int")
    return settle(found.distinct(), scratch_path(items.sparkSession, "seeds"))


def seed_filter(known: DataFrame) -> bytes:
    """The filter over all benchmark seeds, ``FILTER_BITS / 8`` bytes whatever their number.

    Each task sets bits for its seeds; the places set are aggregated, and there are ``FILTER_BITS`` at most.
    """
    schema = pa.schema([("word", pa.int32()), ("bits", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS, dtype=bool)
        for batch in batches:
            bits[filter_places(batch.column(0).to_numpy().view(np.uint64)).ravel()] = True
        words = np.packbits(bits, bitorder="little").view(np.int64)
        at = np.flatnonzero(words)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(words[at])], schema=schema)

    each = known.select("seed").mapInArrow(run, "word int, bits bigint")
    words = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    for word, bits in each.groupBy("word").agg(F.bit_or("bits")).collect():
        words[word] = bits
    return words.tobytes()


def documents_with_hits(docs: DataFrame, masks: tuple[str, ...], known: bytes) -> DataFrame:
    """``(doc_id, key, words, hits)`` of the documents with a seed that passes the filter."""
    ddl = "doc_id bigint, key binary, words binary, hits array<struct<seed:bigint,place:int>>"
    hit = pa.struct([("seed", pa.int64()), ("place", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("words", pa.binary()), ("hits", pa.list_(hit))])
    bits = docs.sparkSession.sparkContext.broadcast(known)

    def of(rows: Iterator[tuple]) -> Iterator[tuple]:
        passing = np.unpackbits(np.frombuffer(bits.value, dtype=np.uint8), bitorder="little").view(bool)
        for doc_id, key, text in rows:
            words = word_hashes(text)
            hashes, places = all_seeds(words, masks)
            found = np.flatnonzero(passing[mixed(hashes) % np.uint64(FILTER_BITS)])
            if len(found):
                found = found[passing[filter_places(hashes[found])].all(axis=1)]
            if len(found):
                at = zip(hashes[found].view(np.int64).tolist(), places[found].tolist())
                yield doc_id, key, words.tobytes(), [{"seed": s, "place": p} for s, p in at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return row_batches(of(column_rows(batches, "doc_id", "key", "text")), schema, 256)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key().alias("key"), whole_text().alias("text"))
    return rows.mapInArrow(run, ddl)


def text_key():
    """Equal for equal texts, whatever their ids."""
    return F.unhex(F.md5(whole_text()))


def best_window(item: np.ndarray, doc: np.ndarray, window: int) -> tuple[int, int]:
    """The most words that agree in a window of the item, and the size of the window."""
    size = min(window, len(item))
    agree = np.concatenate([[0], np.cumsum(item == doc)])
    return int((agree[size:] - agree[:-size]).max()), size


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, similarity: float = SIMILARITY,
             masks: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, key)`` of documents with hits, and ``(key, item_id, agreeing, window)`` of verified overlaps."""
    spark = ready(docs.sparkSession)
    items = item_words(benchmark)
    masks = masks or masks_for(window, similarity)
    known = item_seeds(items, masks, window, similarity)
    short = items.select((F.octet_length("words") / 8).cast("int").alias("n")).where(f"n > 0 AND n < {window}")
    lengths = sorted(r["n"] for r in short.distinct().collect())  # fewer than the window has words
    masks = tuple(dict.fromkeys([*masks, *(m for n in lengths for m in masks_for(n, similarity))]))
    hits = settle(documents_with_hits(docs, masks, seed_filter(known)), scratch_path(spark, "hits"))
    once = settle(hits.drop("doc_id").dropDuplicates(["key"]), scratch_path(spark, "once"))
    at = once.select("key", F.inline("hits")).withColumnRenamed("place", "here")
    pairs = at.join(known, "seed").select("key", "item", (F.col("here") - F.col("place")).alias("shift")).distinct()
    shifted = F.greatest(F.col("shift"), F.lit(0))
    sides = pairs.join(items.withColumnRenamed("words", "item_words"), "item").join(once.drop("hits"), "key").select(
        "key", "item_id", "item_words", "shift",
        F.substring("words", 8 * shifted + F.lit(1), F.octet_length("item_words")).alias("words"),
    )
    schema = pa.schema([
        ("key", pa.binary()), ("item_id", pa.int64()), ("agreeing", pa.int32()), ("window", pa.int32()),
    ])

    def compare(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, item_id, item, shift, here in rows:
            item, here = np.frombuffer(item, np.uint64), np.frombuffer(here, np.uint64)
            lead = min(max(0, -shift), len(item))
            aligned = np.zeros(len(item), dtype=np.uint64)  # zero where the document has no word
            part = here[:len(item) - lead]
            aligned[lead:lead + len(part)] = part
            agreeing, size = best_window(item, aligned, window)
            if agreeing >= similarity * size:
                yield key, item_id, agreeing, size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return row_batches(compare(column_rows(batches, "key", "item_id", "item_words", "shift", "words")), schema)

    verified = sides.mapInArrow(run, "key binary, item_id bigint, agreeing int, window int")
    best = verified.groupBy("key", "item_id").agg(F.max("agreeing").alias("agreeing"), F.max("window").alias("window"))
    return hits.select("doc_id", "key"), settle(best, scratch_path(spark, "overlaps"))


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``(doc_id, item_id, agreeing, window)``: a row for every document and item that it overlaps with."""
    hits, found = overlaps(docs, benchmark, **options)
    return hits.distinct().join(found, "key").drop("key").groupBy("doc_id", "item_id").agg(
        F.max("agreeing").alias("agreeing"), F.max("window").alias("window")
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose text overlaps with no item."""
    _, found = overlaps(docs, benchmark, **options)
    keyed = docs.select(whole_row(docs), text_key().alias("key"))
    return keyed.join(found.select("key").distinct(), "key", "left_anti").select("row.*")
