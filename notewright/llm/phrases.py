"""Phrases of two to four words that keep together, from a weighted de Bruijn graph of each language.

Nodes are three words in a row, edges four. Every place of a text sends the longest gram that begins there: an edge,
or near the end of a piece the two or three words and the last word that are left. Chunks count these and deal
them to buckets by the hash of the node they leave. A bucket adds the weights of its edges, and to the flow of each node
the grams that a piece's end cut short there (the correction). What flows through nodes goes on to pairs of
words, and from them to single words. So only the longest grams are counted in texts and every shorter count follows
from the graph. A node all of whose words are frequent ones could gather too many edges; its edges are dealt one by
one, and their sums meet at the node afterwards. Any other node has a word of less than a quarter of an even share.
Pairs and words are added up within each bucket before they are dealt anew, so each has one number a bucket at most.

Nodes that one edge enters and one edge leaves, both with the node's whole flow, lie inside an unary path. They are
contracted: the path stands for them. Of the others those that a longer phrase covers are left out as well.

A word seen less than ``LEAST`` times in every language can be in no phrase and ends a gram as a piece's end
does. Which words those are is told by a filter of fixed size, made of exact counts; a word that it lets through costs
work and changes nothing. Words travel as 64-bit hashes, which a block gives once for each of its words. For the most
frequent words, as many as a table of fixed size holds, it gives their places in that table instead, so what blocks
repeat of the words hardly grows with their number. No frequent word may share its hash with another word of the
corpus: that is checked on the whole vocabulary, and another salt is taken if it fails, so counts are exact. Scores are
computed in decimals of 38 digits.

Null texts are empty, a null language is ``und``. Texts go whole, of any length. Repeated rows count each, ids play no
part, nor do other columns, whatever their names. No rows, or no frequent phrase, give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notewright.llm.base import (
    bucket_count, by_bucket, column_rows, join_counted, lane, mixed, one_a_task, ready, row_batches, whole_text,
)
from notewright.llm.lm import by_shard, squeeze, unsqueeze
from notewright.session import scratch_path, settle, shuffle_partitions

LONGEST = 4
LEAST = 30
COVERED_PERCENT = 80
SCALE = 2_000_000
FIRST = 2000

STOPS = b".,;:!?\n\v\f\r"
SEED = 42  # of Spark's own hash of a text
FILTER_BITS = 1 << 25
COMMON_WORDS = 1 << 19  # that have places at most, 4 MB of hashes
STEPS = 8  # of counts to a doubling, by which the words with places are told
CHUNK_BYTES = 8_000_000  # of one language
HELD_BYTES = 4 * CHUNK_BYTES  # of all languages that a task holds
BUCKET_BYTES = 32_000_000
MOST_COUNTED = 300_000  # distinct words that a task counts before it sends them

_STOPPED = bytes.maketrans(STOPS + b"\t", b"\n" * len(STOPS) + b" ")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BREAK = b"\n"
# The level of edges and ends of pieces that are dealt by their first three words; others are a number of words.
NODES = LONGEST + 1
_NONE = np.zeros(0, dtype=np.uint64)


def tokens(text: str) -> list[bytes]:
    """The words of a text, and ``_BREAK`` where a piece ends."""
    marked = text.encode().lower().translate(_STOPPED).replace(_BREAK, b" \n ")
    return [word for word in marked.split(b" ") if word]


def _languages(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), whole_text().alias("text"))


def word_counts(docs: DataFrame) -> DataFrame:
    """``(lang, word, n)``: how often each word of each language occurs."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        counts: dict[str, Counter] = {}

        def sent() -> Iterator[tuple]:
            for lang, held in counts.items():
                held.pop(_BREAK, None)
                for word, n in held.items():
                    yield lang, word.decode(), n

        for lang, text in column_rows(batches, "lang", "text"):
            counts.setdefault(lang, Counter()).update(tokens(text))
            if sum(map(len, counts.values())) > MOST_COUNTED:
                yield from sent()
                counts = {}
        yield from sent()

    each = docs.mapInArrow(lambda batches: row_batches(rows(batches), schema, 8192), "lang string, word string, n bigint")
    return each.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def coded(words: DataFrame, salt: str):
    return F.xxhash64(F.concat(F.lit(salt), "word"))


def safe_salt(words: DataFrame, least: int = LEAST) -> str:
    """A salt under which no frequent word has the hash of another word, nor the hash 0, which marks no word."""
    plain = words.groupBy("word").agg(F.max("n").alias("n"))
    for salt in ("", *map(str, range(1, 100))):
        met = plain.groupBy(coded(plain, salt).alias("code")).agg(F.count("*").alias("words"), F.max("n").alias("n"))
        if met.where((F.col("n") >= least) & ((F.col("words") > 1) | (F.col("code") == 0))).isEmpty():
            return salt
    raise ValueError("no salt tells all frequent words apart")


def frequent_filter(words: DataFrame, salt: str, least: int = LEAST, bits: int = FILTER_BITS) -> bytes:
    """``bits`` bits, of which those of words seen ``least`` times are set; of that size whatever the corpus holds."""
    at = F.pmod(coded(words, salt), F.lit(bits))
    often = words.where(F.col("n") >= least).select(at.alias("at"))
    parts = often.groupBy(F.expr("bitmap_bucket_number(at)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bits")
    ).collect()
    whole = np.zeros(bits // 8 + 1, dtype=np.uint8)
    for bucket, held in parts:
        # Bucket n + 1 has the numbers from n * 32768 + 1 on; the places count from the first of them.
        start = (bucket - 1) * 32768 + 1
        places = np.flatnonzero(np.unpackbits(np.frombuffer(held, np.uint8), bitorder="little")) + start
        np.bitwise_or.at(whole, places >> 3, (1 << (places & 7)).astype(np.uint8))
    return whole.tobytes()


def common_words(words: DataFrame, salt: str, least: int = LEAST, most: int = COMMON_WORDS) -> np.ndarray:
    """The sorted codes of the words with the largest counts, ``most`` or fewer of them, after that of the break."""
    plain = words.groupBy("word").agg(F.max("n").alias("often"), F.sum("n").alias("n")).where(F.col("often") >= least)
    plain = plain.select(coded(plain, salt).alias("code"), F.floor(F.log2("n") * STEPS).alias("step"))
    held, lowest = 0, None
    for step, n in sorted(plain.groupBy("step").count().collect(), reverse=True):
        held += n
        if held > most:
            break
        lowest = step
    found = plain.where(F.col("step") >= lowest) if lowest is not None else plain.limit(0)
    codes = found.select("code").toArrow().column("code").to_numpy().view(np.uint64)
    return np.unique(np.append(codes, np.uint64(0)))


SENT_DDL = "level int, lang string, bucket int, block binary, gram array<bigint>, n bigint"
SENT = pa.schema([
    ("level", pa.int32()), ("lang", pa.string()), ("bucket", pa.int32()), ("block", pa.binary()),
    ("gram", pa.list_(pa.int64())), ("n", pa.int64()),
])


def keys_of(columns: list[np.ndarray]) -> list[np.ndarray]:
    """The columns of numbers packed into as few keys of 64 bits as hold them."""
    width = max(1, max(int(c.max(initial=0)) for c in columns).bit_length())
    each = max(1, 64 // width)
    keys = []
    for start in range(0, len(columns), each):
        key = np.zeros(len(columns[0]), dtype=np.uint64)
        for column in columns[start:start + each]:
            key = (key << np.uint64(width)) | column.astype(np.uint64)
        keys.append(key)
    return keys


def added(columns: list[np.ndarray], weights: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows and the sums of their weights."""
    if not len(weights):
        return columns, weights
    keys = keys_of(columns)
    order = np.argsort(keys[0]) if len(keys) == 1 else np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    new[0] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    firsts = np.flatnonzero(new)
    return [c[order[firsts]] for c in columns], np.add.reduceat(weights[order], firsts)


def packed(codes: np.ndarray, columns: list[np.ndarray], weights: np.ndarray, common: np.ndarray = _NONE) -> bytes:
    """Sorted codes, and grams sorted by the places of their words among them, as one block.

    Codes in ``common`` go as their places there. Places, other codes and the first words go as steps and all numbers by
    their bytes' places, for much better compression."""
    plane = lambda a: np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).reshape(-1)
    step = lambda a: np.diff(a, prepend=a.dtype.type(0))
    there = np.searchsorted(common, codes).astype(np.uint32)
    known = np.zeros(len(codes), dtype=bool)
    inside = there < len(common)
    known[inside] = common[there[inside]] == codes[inside]
    return squeeze(np.packbits(known), plane(step(there[known])), plane(step(codes[~known])), plane(step(columns[0])),
                   *map(plane, columns[1:]), plane(weights))


def unpacked(block: bytes, common: np.ndarray = _NONE) -> list[np.ndarray]:
    """The codes, columns and weights of a block that was packed with the same ``common``."""
    bits, there, others, *parts = unsqueeze(block)
    rows = len(parts[-1]) // 8
    whole = lambda a, kind: np.ascontiguousarray(
        a.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)
    there = np.cumsum(whole(there, np.uint32), dtype=np.uint32)
    others = np.cumsum(whole(others, np.uint64), dtype=np.uint64)
    codes = np.empty(len(there) + len(others), dtype=np.uint64)
    known = np.unpackbits(bits, count=len(codes)).astype(bool)
    codes[known], codes[~known] = common[there], others
    columns = [whole(a, f"u{len(a) // rows}") for a in parts[:-1]]
    columns[0] = np.cumsum(columns[0], dtype=columns[0].dtype)
    return [codes, *columns, whole(parts[-1], np.int64)]


def dealt(
    codes: np.ndarray, columns: list[np.ndarray], weights: np.ndarray, buckets: int, by: int, common: np.ndarray = _NONE
) -> Iterator[tuple[int, bytes]]:
    """Grams as blocks for buckets, dealt by their first ``by`` words. ``codes`` are the words that the numbers in
    ``columns`` stand for."""
    total = np.full(len(weights), by, dtype=np.uint64)
    for column in columns[:by]:
        total = mixed(total * _ODD + codes[column])
    for b, at in by_bucket(total % np.uint64(buckets), buckets):
        mine = [c[at] for c in columns]
        used = np.unique(np.concatenate(mine))
        kind = np.uint16 if len(used) < 1 << 16 else np.uint32
        place = np.zeros(int(used[-1]) + 1, dtype=kind)
        place[used] = np.arange(len(used), dtype=kind)
        yield b, packed(codes[used], [place[c] for c in mine], weights[at].astype(np.int64), common)


def longest_grams(codes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct codes, and for each place the numbers of the words from there on; 0, the number of the break, after
    the end of its piece. ``codes`` end with a break."""
    found, ids = np.unique(codes, return_inverse=True)
    ids = np.concatenate([ids.astype(np.int32), np.zeros(LONGEST, dtype=np.int32)])
    begun = np.flatnonzero(ids[:len(codes)])
    columns = [ids[begun]]
    for k in range(1, LONGEST):
        columns.append(np.where(columns[-1] > 0, ids[begun + k], 0))
    return found, columns


def by_level(columns: list[np.ndarray], hot: np.ndarray) -> Iterator[tuple[int, np.ndarray, int, int]]:
    """``(level, which, words, by)``: which rows go to which level, their number of words and of those they are dealt
    by. ``hot`` tells which numbers are frequent words."""
    length = sum((c > 0).astype(np.int8) for c in columns)
    spread = hot[columns[0]] & hot[columns[1]] & hot[columns[2]] & (length > 2)
    parts = [(NODES, (length > 2) & ~spread, LONGEST, LONGEST - 1), (LONGEST, (length == LONGEST) & spread, LONGEST, LONGEST),
             (LONGEST - 1, (length == LONGEST - 1) & spread, LONGEST - 1, LONGEST - 1)]
    parts += [(n, length == n, n, n) for n in range(1, LONGEST - 1)]
    yield from (part for part in parts if part[1].any())


def send_grams(
    docs: DataFrame, buckets: int, known: bytes, salt: str, heavy: list[int], bits: int = FILTER_BITS,
    common: np.ndarray = _NONE,
) -> DataFrame:
    """The longest grams of each chunk, a block for each level and bucket."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        often, start, hot = np.frombuffer(known, np.uint8), salt.encode(), np.array(heavy, dtype=np.uint64)
        held: dict[str, list[np.ndarray]] = {}
        sizes: Counter = Counter()
        numbers: dict[bytes, int] = {_BREAK: 0}
        total = 0

        def number(word: bytes) -> int:
            code = lane(start + word, SEED)
            at = code & (bits - 1)
            numbers[word] = found = code if often[at >> 3] >> (at & 7) & 1 else 0
            return found

        def close(lang: str) -> Iterator[tuple]:
            del sizes[lang]
            codes, columns = longest_grams(np.concatenate(held.pop(lang)))
            columns, weights = added(columns, np.ones(len(columns[0]), dtype=np.int64))
            for level, those, size, by in by_level(columns, np.isin(codes, hot)):
                for b, block in dealt(codes, [c[those] for c in columns[:size]], weights[those], buckets, by, common):
                    yield level, lang, b, block, None, None

        for lang, text in column_rows(batches, "lang", "text"):
            words = tokens(text)
            codes = [numbers[w] if w in numbers else number(w) for w in words]
            codes.append(0)
            held.setdefault(lang, []).append(np.array(codes, dtype=np.uint64))
            sizes[lang] += len(text)
            total += len(text)
            # The fuller a chunk of a language, the fewer blocks repeat its words and grams.
            if sizes[lang] >= CHUNK_BYTES or total >= HELD_BYTES:
                most = max(sizes, key=sizes.get)
                total -= sizes[most]
                yield from close(most)
            if len(numbers) > MOST_COUNTED:
                numbers.clear()
                numbers[_BREAK] = 0
        for lang in list(held):
            yield from close(lang)

    return docs.mapInArrow(lambda batches: row_batches(rows(batches), SENT, 16), SENT_DDL)


def merged(
    blocks: Iterable[bytes], size: int, common: np.ndarray = _NONE
) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Codes, grams and weights of all blocks of a bucket together. Code 0 is number 0, as in the blocks."""
    parts = [unpacked(block, common) for block in blocks]
    codes, place = np.unique(np.concatenate([np.zeros(1, np.uint64), *[p[0] for p in parts]]), return_inverse=True)
    place = place[1:].astype(np.int32)
    starts = np.cumsum([0] + [len(p[0]) for p in parts])
    columns = [np.concatenate([place[starts[k]:starts[k + 1]][p[1 + c]] for k, p in enumerate(parts)])
               for c in range(size)]
    return codes, *added(columns, np.concatenate([p[-1] for p in parts]))


def flowed(blocks: DataFrame, now: tuple[int, ...], buckets: int, least: int, common: np.ndarray = _NONE) -> DataFrame:
    """The grams of the levels of ``now`` with their counts, where these are ``least`` or more, and as blocks the
    flow through the grams one word shorter that they begin with. Blocks of other levels are added up and dealt anew."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (_, level, lang), group in by_shard(
            ((bucket, level, lang), block) for bucket, level, lang, block
            in column_rows(batches, "bucket", "level", "lang", "block")
        ):
            size = min(level, LONGEST)
            codes, columns, weights = merged((block for _, block in group), size, common)
            if level not in now:
                for b, block in dealt(codes, columns, weights, buckets, size, common):
                    yield level, lang, b, block, None, None
                continue
            for size in range(size, LONGEST - 2 if level == NODES else size - 1, -1):
                # Of the edges, without the pieces' ends among them.
                many = np.flatnonzero((weights >= least) & (columns[-1] > 0))
                words = np.stack([codes[c[many]].view(np.int64) for c in columns], axis=1).tolist()
                for gram, n in zip(words, weights[many].tolist()):
                    yield size, lang, None, None, gram, n
                columns, weights = added(columns[:-1], weights) if size > 1 else ([], weights[:0])
            if columns:
                for b, block in dealt(codes, columns, weights, buckets, size - 1, common):
                    yield size - 1, lang, b, block, None, None

    spread = one_a_task(blocks.select("bucket", "level", "lang", "block"), buckets)
    spread = spread.sortWithinPartitions("bucket", "level", "lang")
    return spread.mapInArrow(lambda batches: row_batches(rows(batches), SENT, 256), SENT_DDL)


def heavy_words(words: DataFrame, salt: str, buckets: int) -> list[int]:
    """The codes of the words with more than a quarter of a bucket's share of all, fewer than ``4 * buckets``."""
    plain = words.groupBy("word").agg(F.sum("n").alias("n"))
    total = plain.agg(F.sum("n")).first()[0] or 0
    often = plain.where(F.col("n") * (4 * buckets) > F.lit(total)).select(coded(plain, salt)).collect()
    return [row[0] % 2**64 for row in often]


def frequent_grams(docs: DataFrame, words: DataFrame, salt: str, least: int = LEAST) -> DataFrame:
    """``(lang, gram, n)``: all grams of one to four words that occur ``least`` times, by the hashes of their words."""
    spark = docs.sparkSession
    buckets = bucket_count(docs, BUCKET_BYTES, shuffle_partitions(spark))
    known, common = frequent_filter(words, salt, least), common_words(words, salt, least)
    flow = send_grams(docs, buckets, known, salt, heavy_words(words, salt, buckets), common=common)
    found = None
    for now in ((NODES, LONGEST), *((level,) for level in range(LONGEST - 1, 0, -1))):
        flow = settle(flowed(flow, now, buckets, least, common), scratch_path(spark, "grams"))
        grams = flow.where("gram IS NOT NULL").select("lang", "gram", "n")
        found = grams if found is None else found.unionByName(grams)
        flow = flow.where("block IS NOT NULL")
    return found


def _inside(gram, length: int, start: int):
    return F.slice(gram, start + 1, length)


def candidates(grams: DataFrame) -> DataFrame:
    """The phrases, as ``(lang, gram, n)``, that neither lie inside an unary path nor are covered by a longer phrase."""
    size, gram = F.size("gram"), F.col("gram")
    part = lambda length, start: F.struct(
        _inside(gram, length, start).alias("gram"),
        # Edges that leave the node of their first words, or enter that of their last.
        F.lit(start == 0).alias("leaves"), (F.lit(start + length) == size).alias("enters"), size.alias("size"),
    )
    inside = {3: [part(2, 0), part(2, 1)], 4: [part(3, 0), part(3, 1), part(2, 0), part(2, 1), part(2, 2)]}
    longer = [grams.where(size == n).select("lang", F.explode(F.array(*parts)).alias("part"), "n")
              for n, parts in inside.items()]
    edge = lambda way: F.max(F.when(
        F.col(f"part.{way}") & (F.col("part.size") == F.size("part.gram") + 1), F.col("n")))
    most = longer[0].unionByName(longer[1]).groupBy("lang", "part.gram").agg(
        edge("enters").alias("enters"), edge("leaves").alias("leaves"), F.max("n").alias("most")
    )
    phrases = grams.where(size > 1).join(most, ["lang", "gram"], "left")
    # An edge with the whole flow of a node is the only one.
    unary = F.coalesce((F.col("enters") == F.col("n")) & (F.col("leaves") == F.col("n")), F.lit(False))
    covered = F.coalesce(100 * F.col("most") >= COVERED_PERCENT * F.col("n"), F.lit(False))
    return phrases.where(~unary & ~covered).select("lang", "gram", "n")


def scored(phrases: DataFrame, grams: DataFrame) -> DataFrame:
    """``(lang, gram, a, l, r, score)``: each phrase by its weakest cut."""
    gram = F.col("gram")
    cuts = F.sequence(F.lit(1), F.size(gram) - 1)
    cut = phrases.select("lang", "gram", F.col("n").alias("a"), F.explode(cuts).alias("k"))
    sides = F.array(
        F.struct(F.lit(True).alias("left"), F.slice(gram, F.lit(1), F.col("k")).alias("part")),
        F.struct(F.lit(False).alias("left"), F.slice(gram, F.col("k") + 1, F.size(gram)).alias("part")),
    )
    each = cut.select("lang", "gram", "a", "k", F.inline(sides))
    each = each.withColumn("key", F.struct("lang", "part")).drop("part")
    keys = grams.select(F.struct("lang", F.col("gram").alias("part")).alias("key"), "n")
    keys = each.groupBy("key").agg(F.count("*").alias("rows")).join(keys, "key")
    found = join_counted(each, settle(keys, scratch_path(grams.sparkSession, "cuts")), "key")
    found = found.groupBy("lang", "gram", "a", "k").agg(
        F.max(F.when(F.col("left"), F.col("n"))).alias("l"), F.max(F.when(~F.col("left"), F.col("n"))).alias("r")
    )
    score = F.expr(
        f"(cast({SCALE} as decimal(8,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + r)"
    )
    weakest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return found.groupBy("lang", "gram", "a").agg(weakest).select("lang", "gram", "a", "cut.l", "cut.r", "cut.score")


def phrases(docs: DataFrame, least: int = LEAST, first: int = FIRST) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first phrases of each language."""
    spark = ready(docs.sparkSession)
    docs = _languages(docs)
    words = settle(word_counts(docs), scratch_path(spark, "words"))
    salt = safe_salt(words, least)
    grams = frequent_grams(docs, words, salt, least)
    best = scored(settle(candidates(grams), scratch_path(spark, "phrases")), grams)
    # Ties go by the words themselves, so all rows that tie with the last one are spelled out.
    best = best.withColumn("_rank", F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))))
    best = settle(best.where(F.col("_rank") <= first).drop("_rank"), scratch_path(spark, "best"))
    names = words.where(F.col("n") >= least).select("lang", coded(words, salt).alias("code"), "word")
    each = best.select("lang", "gram", F.posexplode("gram").alias("at", "code")).join(names, ["lang", "code"])
    spelled = each.groupBy("lang", "gram").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
    spelled = spelled.select("lang", "gram", F.array_join("words.word", " ").alias("phrase"))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    found = best.join(spelled, ["lang", "gram"]).join(totals, "lang")
    found = found.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= first)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
