"""Near-duplicate texts by SimHash, linked through tables of distances to pivots.

A fingerprint bit is 1 where more than half of the hashes of a text's word shingles have it. Equal fingerprints
are one vertex. Vertices meet in cells: parts of the fingerprint that a linked pair must share, or shares almost
surely. Inside a cell each fingerprint has a row in a table of distances to ``PIVOTS`` reference fingerprints. By
the triangle inequality the rows of a linked pair differ by at most the radius everywhere. The table is sorted by
its first column, so pairs beyond the radius there are never looked at; the other columns discard most of the
rest, and the true distance is taken of the survivors. A cell returns a spanning forest of its links, not all of
them, and the forests of all cells make the components.

With ``exact_cells`` (radius 2 on 64 bits) nothing is lost: two differing bits touch at most two of six stripes, so
a linked pair agrees on four whole stripes, and each choice of four is a cell. A cell leaves at most 22 bits free
and so holds at most 4 million fingerprints. With ``least_cells`` (cells of least hashes of the distinct five-word
shingles) a pair of similarity J meets but for a chance of ``(1 - J**CELL_HASHES)**CELLS``, wherever in the text its
differences are. The links within such cells only say which texts are compared; what is similar is decided by
the shingle sets themselves.

Null text counts as empty. Texts without words have fingerprint zero and are linked like any other. Repeated rows
are vertices of their own ids. No rows give no components. A text of any length is one fingerprint, summed over blocks
of its shingles. Columns of the table are kept in one struct, so none of their names can clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright.llm.base import column_rows, join_counted, mixed, ready, row_batches, whole_row, whole_text
from notewright.llm.components import components
from notewright.session import scratch_path, settle, shuffle_partitions

SEED = 42
PIVOTS = 16
STRIPES = (11, 11, 11, 11, 10, 10)
RADIUS = 2
# Of the stage that finds similar texts: five words, similarity 0.8, and the margin in standard deviations.
SHINGLE, SIMILARITY, MARGIN = 5, 0.8, 5.0
LINK_LANES = 4
# At 0.8 a pair that meets in none of the cells is one in 30 million.
CELLS, CELL_HASHES = 24, 3
# The largest share of differing bits at 0.8 is that of four shingles and one more: 6/16 * 1/2.
FEW_SHINGLES = 0.1875
# Members of a group that meet the group's first text in one piece.
PIECE = 256

_GOLDEN = 0x9E3779B97F4A7C15
_REST_DDL = "root binary, last boolean, doc_id bigint, key binary, hashes binary"
_REST = pa.schema([
    ("root", pa.binary()), ("last", pa.bool_()), ("doc_id", pa.int64()), ("key", pa.binary()), ("hashes", pa.binary()),
])


def shingles(words: list[bytes], size: int) -> list[bytes]:
    if len(words) < size:
        return [b" ".join(words)] if words else []
    return [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)]


def part_hashes(parts: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(p, SEED) for p in parts), dtype=np.uint64, count=len(parts))


def fingerprint(parts: list[bytes], lanes: int = 1) -> np.ndarray:
    """``lanes`` numbers of 64 bits. The first is of the hashes themselves, the others of mixed hashes."""
    return hash_fingerprint(part_hashes(parts), lanes)


def hash_fingerprint(hashes: np.ndarray, lanes: int) -> np.ndarray:
    if not len(hashes):
        return np.zeros(lanes, dtype=np.uint64)
    result = np.empty(lanes, dtype=np.uint64)
    for lane in range(lanes):
        h = mixed(hashes * np.uint64(_GOLDEN * (2 * lane + 1) % 2**64)) if lane else hashes
        ones = np.zeros(64, dtype=np.int64)
        for start in range(0, len(h), 8192):
            bits = np.unpackbits(h[start:start + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        result[lane] = np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0]
    return result


def shingle_set(text: str, size: int) -> np.ndarray:
    """The sorted hashes of the distinct shingles."""
    return np.unique(part_hashes(list(dict.fromkeys(shingles(text.encode().lower().split(), size)))))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted sets; two empty ones are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def least_hashes(hashes: np.ndarray) -> np.ndarray:
    """``CELLS`` numbers, each of the least values of ``CELL_HASHES`` rehashings."""
    factors = mixed(np.arange(1, CELLS * CELL_HASHES + 1, dtype=np.uint64) * np.uint64(_GOLDEN)) | np.uint64(1)
    least = np.full(len(factors), 2**64 - 1, dtype=np.uint64)
    for start in range(0, len(hashes), 4096):
        least = np.minimum(least, (factors[:, None] * mixed(hashes[start:start + 4096])).min(axis=1))
    total = np.arange(CELLS, dtype=np.uint64)
    for part in least.reshape(CELLS, CELL_HASHES).T:
        total = mixed(total + part) + np.uint64(1)
    return total


def packed(lanes: np.ndarray) -> bytes:
    return lanes.astype(">u8").tobytes()


def unpacked(values: list[bytes], lanes: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype=">u8").astype(np.uint64).reshape(-1, lanes)


def with_fingerprints(rows: DataFrame, of: Callable[[str], tuple[bytes, ...]], names: list[str]) -> DataFrame:
    """The columns of ``rows`` but ``text``, and the binary columns that ``of`` gives for a text."""
    kept = [c for c in rows.columns if c != "text"]
    fields = rows.select(*kept).schema
    ddl = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in fields] + [f"{n} binary" for n in names])
    kinds = {"bigint": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in fields] + [(n, pa.binary()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = column_rows(batches, *kept, "text")
        return row_batches(((*row[:-1], *of(row[-1])) for row in rows), schema)

    return rows.mapInArrow(run, ddl)


def exact_cells(lanes: np.ndarray) -> np.ndarray:
    """For 64-bit fingerprints, the cells in which any two that differ in two bits meet."""
    ends = np.cumsum(STRIPES)
    masks = [((1 << int(w)) - 1) << int(e - w) for w, e in zip(STRIPES, ends)]
    return np.stack([
        mixed(mixed(lanes[:, 0] & np.uint64(sum(masks[k] for k in some))) + np.uint64(n + 1))
        for n, some in enumerate(combinations(range(len(STRIPES)), len(STRIPES) - RADIUS))
    ], axis=1)


def least_cells(lanes: np.ndarray) -> np.ndarray:
    """Of ``least_hashes``, which are cells already."""
    return lanes


def distances(lanes: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.bitwise_count(lanes ^ others).sum(axis=-1, dtype=np.int16)


def pivot_table(lanes: np.ndarray) -> np.ndarray:
    """Distances to the reference fingerprints, a column for each."""
    width = lanes.shape[1]
    seeds = np.arange(1, PIVOTS * width + 1, dtype=np.uint64) * np.uint64(_GOLDEN)
    return np.stack([distances(lanes, pivot) for pivot in mixed(seeds).reshape(PIVOTS, width)], axis=1)


def spanning_links(cells: np.ndarray, lanes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of pairs that make a spanning forest of the links inside each cell."""
    table = pivot_table(lanes)
    order = np.lexsort((table[:, 0], cells))
    cells, lanes, table = cells[order], lanes[order], table[order]
    label = np.arange(len(cells))
    found: list[tuple[int, int]] = []
    low, step = np.arange(len(cells)), 0
    while len(low):
        step += 1
        low = low[low < len(cells) - step]
        high = low + step
        # Sorted by cell and first pivot, so a pair that fails here fails at any larger step.
        near = (cells[low] == cells[high]) & (table[high, 0] - table[low, 0] <= radius)
        low = low[near]
        i, j = low, low + step
        for pivot in range(1, PIVOTS):
            if not len(i):
                break
            close = np.abs(table[i, pivot] - table[j, pivot]) <= radius
            i, j = i[close], j[close]
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
        linked = distances(lanes[i], lanes[j]) <= radius
        for a, b in zip(i[linked].tolist(), j[linked].tolist()):
            one, two = int(label[a]), int(label[b])
            if one != two:
                found.append((a, b))
                start = np.searchsorted(cells, cells[a], "left")
                end = np.searchsorted(cells, cells[a], "right")
                part = label[start:end]
                part[part == max(one, two)] = min(one, two)
    pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
    return order[pairs[:, 0]], order[pairs[:, 1]]


def link_edges(vertices: DataFrame, cells: Callable[[np.ndarray], np.ndarray], lanes: int, band_lanes: int,
               radius: int) -> DataFrame:
    """``(a, b)``: links enough to connect what is linked. ``vertices`` has ``fingerprint`` and ``bands``."""
    vertex = pa.schema([("cell", pa.int64()), ("fingerprint", pa.binary())])

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            places = cells(unpacked(batch.column(1).to_pylist(), band_lanes))
            for k in range(places.shape[1]):
                yield pa.RecordBatch.from_arrays([pa.array(places[:, k].view(np.int64)), batch.column(0)], schema=vertex)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edge = pa.schema([("a", pa.binary()), ("b", pa.binary())])
        rest_cells, rest = np.empty(0, np.int64), np.empty((0, lanes), np.uint64)
        for batch in chain(_chunks(batches), [None]):
            if batch is None:
                ready_cells, ready_lanes, rest_cells = rest_cells, rest, rest_cells[:0]
            else:
                place = np.concatenate([rest_cells, batch[0]])
                value = np.concatenate([rest, unpacked(batch[1], lanes)])
                cut = int(np.searchsorted(place, place[-1], "left"))  # the last cell may go on
                ready_cells, ready_lanes, rest_cells, rest = place[:cut], value[:cut], place[cut:], value[cut:]
            if len(ready_cells) > 1:
                i, j = spanning_links(ready_cells, ready_lanes, radius)
                pairs = ((packed(ready_lanes[a]), packed(ready_lanes[b])) for a, b in zip(i, j))
                yield from row_batches(pairs, edge)

    spread = vertices.select("fingerprint", "bands").mapInArrow(scatter, "cell bigint, fingerprint binary")
    spread = spread.repartition(shuffle_partitions(vertices.sparkSession), "cell")
    return spread.sortWithinPartitions("cell", "fingerprint").mapInArrow(gather, "a binary, b binary")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column(0).to_numpy(), batch.column(1).to_pylist()


def with_components(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """``rows``, which have ``doc_id`` and ``fingerprint``, with ``component_id``: the smallest id reachable."""
    spark = rows.sparkSession
    classes = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows"))
    roots = components(edges).withColumnRenamed("vertex", "fingerprint")
    classes = classes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    classes = settle(classes, scratch_path(spark, "classes"))
    least = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    named = classes.join(least, "root").select("fingerprint", "rows", "root", "component_id")
    return join_counted(rows, settle(named, scratch_path(spark, "named")), "fingerprint")


def linked(rows: DataFrame, shingle: int) -> DataFrame:
    """``rows``, which have ``doc_id`` and ``text``, without ``text`` and with ``fingerprint``, ``root``, ``component_id``.

    Rows of one ``root`` are one component; ``component_id`` is null where none of them has an id.
    """
    def of(text: str) -> tuple[bytes]:
        return (packed(fingerprint(shingles(text.encode().lower().split(), shingle))),)

    spark = ready(rows.sparkSession)
    rows = settle(with_fingerprints(rows, of, ["fingerprint"]), scratch_path(spark, "fingerprints"))
    vertices = rows.select("fingerprint", F.col("fingerprint").alias("bands")).distinct()
    return with_components(rows, link_edges(vertices, exact_cells, 1, 1, RADIUS))


def simhash_components(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row; fingerprints of 64 bits link at 2 differing bits."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return linked(rows, shingle).select("doc_id", "fingerprint", "component_id")


def row_key() -> Column:
    """Of the id and the whole text; rows that have both in common are repeats."""
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))
    return F.unhex(F.md5(F.concat(ident, F.lit("\0"), whole_text())))


def first_of_linked(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns, that come first in their component of :func:`simhash_components`.

    Rows go by id, those without an id last, ties by text. One of equal rows stays.
    """
    spark = ready(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), row_key().alias("key"), whole_text().alias("text"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    firsts = linked(rows, shingle).groupBy("root").agg(F.min(order).alias("least")).select("least.key")
    firsts = settle(firsts, scratch_path(spark, "firsts"))
    # Repeats are counted down in each task before they are sent, so no key is hot.
    once = docs.select(whole_row(docs), row_key().alias("key")).dropDuplicates(["key"])
    return once.join(firsts, "key", "left_semi").select("row.*")


def similar_radius(similarity: float, bits: int, margin: float = MARGIN) -> int:
    """The distance that texts of a Jaccard similarity keep within, but for chance beyond ``margin`` deviations."""
    share = max(FEW_SHINGLES, math.acos(2 * similarity / (1 + similarity)) / math.pi)
    return math.ceil(bits * share + margin * math.sqrt(bits * share * (1 - share)))


def first_of_similar(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, without those similar to one that stays.

    Rows go by id, those without an id last, ties by text. A row stays unless one that stays before it has a
    Jaccard similarity of ``similarity`` or more by the sets of shingles. One of equal rows stays.
    """
    spark = ready(docs.sparkSession)
    key = row_key()
    keyed = docs.select(whole_row(docs), key.alias("key"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), key.alias("key"), whole_text().alias("text"))

    def of(text: str) -> tuple[bytes, bytes, bytes]:
        hashes = shingle_set(text, shingle)
        same = xxhash.xxh3_128_digest(hashes.tobytes())
        return packed(hash_fingerprint(hashes, LINK_LANES)), packed(least_hashes(hashes)), same

    prints = settle(with_fingerprints(rows, of, ["fingerprint", "bands", "same"]), scratch_path(spark, "fingerprints"))
    # Equal sets share a fate, so the first of them stands for all.
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    sets = prints.groupBy("same").agg(F.min(order).alias("ord"), F.first("fingerprint").alias("fingerprint"))
    radius = similar_radius(similarity, 64 * LINK_LANES)
    vertices = prints.select("fingerprint", "bands").distinct()
    edges = link_edges(vertices, least_cells, LINK_LANES, CELLS, radius)
    roots = components(edges).withColumnRenamed("vertex", "fingerprint")
    sets = sets.join(roots, "fingerprint", "left").select("ord.*", F.coalesce("root", "fingerprint").alias("root"))
    sets = settle(sets, scratch_path(spark, "sets"))
    first = F.min(F.struct("last", "doc_id", "key")).alias("least")
    groups = sets.groupBy("root").agg(first, F.count("*").alias("rows"))
    groups = settle(groups.select("root", F.col("least.key").alias("first"), "rows"), scratch_path(spark, "groups"))
    # The first of a group stays. What is similar to it goes; the rest is compared with each other.
    kept = groups.select(F.col("first").alias("key"))
    rest = settle(unlike_first(sets, groups.where("rows > 1"), rows, shingle, similarity), scratch_path(spark, "rest"))
    kept = kept.unionByName(first_unlike(rest, similarity))
    return keyed.join(kept, "key").dropDuplicates(["key"]).select("row.*")


def unlike_first(sets: DataFrame, groups: DataFrame, rows: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """``(root, last, doc_id, key, hashes)`` of the members that are not similar to the first of their group.

    A group of any size is spread over pieces of about ``PIECE`` members, each of which meets a copy of the first.
    """
    spark = sets.sparkSession
    pieces = (F.floor(F.col("members") / F.lit(PIECE)) + F.lit(1)).cast("bigint")
    members = join_counted(sets, groups.withColumn("members", F.col("rows")), "root").where("key != first")
    members = members.withColumn("piece", F.pmod(F.xxhash64("key"), pieces)).drop("members")
    members = settle(members, scratch_path(spark, "members"))
    wanted = members.select("key").unionByName(groups.select(F.col("first").alias("key")))
    texts = rows.join(wanted, "key", "left_semi").select("key", "text")

    def of(text: str) -> tuple[bytes]:
        return (shingle_set(text, shingle).tobytes(),)

    hashed = with_fingerprints(texts, of, ["hashes"]).dropDuplicates(["key"])
    hashed = settle(hashed, scratch_path(spark, "hashes"))
    pieces = F.explode(F.sequence(F.lit(0), F.floor(F.col("rows") / F.lit(PIECE)).cast("bigint"))).alias("piece")
    firsts = groups.select(F.col("first").alias("key"), "rows").join(hashed, "key")
    firsts = firsts.select(F.col("key").alias("first"), F.col("hashes").alias("first_hashes"), pieces)
    met = members.join(hashed, "key").join(firsts, ["first", "piece"])

    def unlike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = column_rows(batches, *_REST.names, "first_hashes")
        return row_batches((
            row[:-1] for row in rows
            if jaccard(np.frombuffer(row[-2], np.uint64), np.frombuffer(row[-1], np.uint64)) < similarity
        ), _REST, 256)

    return met.select(*_REST.names, "first_hashes").mapInArrow(unlike, _REST_DDL)


def first_unlike(rest: DataFrame, similarity: float) -> DataFrame:
    """``(key)`` of the members of each group that are similar to none before them that stays."""
    rest = rest.repartition(shuffle_partitions(rest.sparkSession), "root")
    rest = rest.sortWithinPartitions("root", "last", "doc_id", "key")

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        now, kept = None, []
        for root, key, data in rows:
            if root != now:
                now, kept = root, []
            hashes = np.frombuffer(data, np.uint64)
            size = len(hashes)
            if not any(
                min(size, len(other)) >= similarity * max(size, len(other)) and jaccard(hashes, other) >= similarity
                for other in kept
            ):
                kept.append(hashes)
                yield (key,)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return row_batches(run(column_rows(batches, "root", "key", "hashes")), pa.schema([("key", pa.binary())]))

    return rest.mapInArrow(of, "key binary")
