import random
import re
from collections import Counter

from pyspark.sql import functions as F

from notewright.llm import phrases

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())


def plain_phrases(rows, least, first):
    """``rows`` are (lang, text)."""
    counts = {}
    for lang, text in rows:
        held = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\n\v\f\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for size in range(1, 5):
                held.update(tuple(words[k:k + size]) for k in range(len(words) - size + 1))
    want = []
    for lang, f in counts.items():
        often = {g: n for g, n in f.items() if n >= least and len(g) > 1}
        gone = set()
        for g, n in often.items():
            for size in range(2, len(g)):
                for k in range(len(g) - size + 1):
                    if 100 * n >= 80 * f[g[k:k + size]]:
                        gone.add(g[k:k + size])
        found = []
        for g, a in often.items():
            if g not in gone:
                cuts = [(2000000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        total = sum(n for g, n in f.items() if len(g) == 1)
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:first], 1):
            want.append((lang, rank, phrase.decode(), -a, left, right, total, -score))
    return sorted(want)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def sentences(seed, n):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(25)] + ["Été", "東京", "x y", "ÀB"]
    fixed = ["new york city hall", "is here is here is here", "W1 w2\tw3", "of the", "the the the the the"]
    rows = []
    for k in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randint(0, 40))]
        text = "".join(p + rng.choice([" ", " ", " ", "  ", ". ", ",", "\n", "!"]) for p in parts)
        rows.append((rng.choice(["en", "en", "en", None, "und", "de", ""]), text))
    return rows


def test_against_plain_counts(spark, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(phrases, "MOST_COUNTED", 20)
    rows = sentences(1, 400)
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id bigint, lang string, text string")
    want = plain_phrases(rows, 4, 60)
    assert got(phrases.phrases(df, least=4, first=60)) == want
    assert {r[0] for r in want} >= {"en", "und", "de", ""}


def test_every_count_follows_from_the_longest_grams(spark):
    rows = sentences(2, 120)
    df = phrases._languages(spark.createDataFrame(rows, "lang string, text string"))
    words = phrases.word_counts(df)
    found = {(r["lang"], tuple(r["gram"])): r["n"] for r in phrases.frequent_grams(df, words, "", 1).collect()}
    want = Counter()
    for lang, text in rows:
        piece = []
        for word in [*phrases.tokens(text), b"\n"]:
            if word != b"\n":
                piece.append(phrases.lane(word, phrases.SEED))
                continue
            for size in range(1, 5):
                for k in range(len(piece) - size + 1):
                    gram = tuple((c ^ (1 << 63)) - (1 << 63) for c in piece[k:k + size])
                    want["und" if lang is None else lang, gram] += 1
            piece = []
    assert found == dict(want)


def test_filter_holds_every_frequent_word_and_few_others(spark):
    words = spark.createDataFrame([("en", f"w{k}", 30 if k % 2 else 29) for k in range(4000)],
                                  "lang string, word string, n bigint")
    known = phrases.frequent_filter(words, "s")
    held = []
    for k in range(4000):
        at = phrases.lane(f"sw{k}".encode(), phrases.SEED) % phrases.FILTER_BITS
        held.append(known[at >> 3] >> (at & 7) & 1)
    assert all(held[1::2]) and sum(held[::2]) < 10


def test_another_salt_where_two_words_share_a_hash(spark, monkeypatch):
    words = spark.createDataFrame([("en", "a", 50), ("en", "b", 1), ("en", "c", 2)], "lang string, word string, n bigint")
    assert phrases.safe_salt(words) == ""
    real = phrases.coded

    def coded(df, salt):
        return F.when(F.col("word").isin("a", "b") & (F.lit(salt) == ""), F.lit(7)).otherwise(real(df, salt))

    monkeypatch.setattr(phrases, "coded", coded)
    assert phrases.safe_salt(words) == "1"


def test_large_numbers_stay_exact(spark):
    big = 4_000_000_000_000_000_001
    grams = spark.createDataFrame([("en", [1, 2], big - 1), ("en", [1], big), ("en", [2], big + 2)],
                                  "lang string, gram array<bigint>, n bigint")
    row = phrases.scored(grams.where(F.size("gram") > 1), grams).first()
    assert row["score"] == 2000000 * (big - 1) // (2 * big + 2)


def test_odd_rows(spark, odd_documents, no_documents):
    rows = [(r["lang"], r["text"]) for r in odd_documents.collect()]
    assert got(phrases.phrases(odd_documents, least=3)) == plain_phrases(rows, 3, 2000)
    assert phrases.phrases(no_documents).count() == 0


def test_blocks_come_back_and_are_small():
    import numpy as np

    from notewright.llm.lm import squeeze
    from notewright.llm.phrases import added, packed, unpacked
    rng = np.random.default_rng(3)
    for many, rows in ((1, 1), (4000, 5000), (70_000, 90_000)):
        kind = np.uint16 if many < 1 << 16 else np.uint32
        codes = np.unique(rng.integers(0, 2**64, many, dtype=np.uint64))
        columns = [rng.integers(0, len(codes), rows).astype(kind) for _ in range(4)]
        columns, weights = added(columns, np.ones(rows, dtype=np.int64))
        block = packed(codes, columns, weights)
        for was, now in zip([codes, *columns, weights], unpacked(block), strict=True):
            assert was.dtype == now.dtype and (was == now).all()
        if rows > 1:
            assert len(block) < 0.85 * len(squeeze(codes, *columns, weights))


def test_a_chunk_is_full_whatever_other_languages_there_are(spark, monkeypatch):
    from notewright.llm import phrases as module
    monkeypatch.setattr(module, "CHUNK_BYTES", 4000)
    monkeypatch.setattr(module, "HELD_BYTES", 16_000)
    rows = [(f"l{k % 4}", "a b c d " * 25) for k in range(160)]
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    known = bytes([255]) * (module.FILTER_BITS // 8 + 1)
    sent = module.send_grams(docs, 1, known, "", []).groupBy("lang", "level").count().collect()
    # 40 texts of 200 bytes a language are two chunks.
    assert {r["count"] for r in sent} == {2}


def test_blocks_hardly_grow_with_the_number_of_buckets():
    """Each bucket had the 64-bit codes of its words again."""
    import numpy as np
    rng = np.random.default_rng(5)
    common = np.unique(np.append(rng.integers(1, 2**64, 60_000, dtype=np.uint64), np.uint64(0)))
    others = rng.integers(1, 2**64, 500, dtype=np.uint64)
    words = np.concatenate([rng.choice(common, 20_000, replace=False), others, np.zeros(1, np.uint64)])
    text = words[np.minimum(rng.zipf(1.3, 200_000), len(words)) - 1]
    codes, columns = phrases.longest_grams(np.append(text, np.uint64(0)))
    columns, weights = phrases.added(columns, np.ones(len(columns[0]), dtype=np.int64))
    sizes = {}
    for buckets in (4, 64):
        blocks = [b for _, b in phrases.dealt(codes, columns, weights, buckets, 3, common)]
        sizes[buckets] = sum(map(len, blocks))
        back_codes, back, back_weights = phrases.merged(blocks, 4, common)
        now = dict(zip(zip(*[back_codes[c].tolist() for c in back]), back_weights.tolist()))
        assert now == dict(zip(zip(*[codes[c].tolist() for c in columns]), weights.tolist()))
    assert sizes[64] < 1.3 * sizes[4]


def test_words_with_places_are_the_most_frequent_and_few(spark):
    words = spark.createDataFrame([("en", f"w{k}", k) for k in range(20, 1000)], "lang string, word string, n bigint")
    codes = [r[0] % 2**64 for r in words.orderBy("n").select(phrases.coded(words, "s")).collect()]
    assert phrases.common_words(words, "s").tolist() == sorted([0, *codes[10:]])
    some = phrases.common_words(words, "s", most=200).tolist()
    assert 100 < len(some) <= 201 and some == sorted([0, *codes[-(len(some) - 1):]])
    assert phrases.common_words(words, "s", most=0).tolist() == [0]


def test_the_table_of_words_changes_no_result(spark, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 2000)
    rows = sentences(6, 200)
    df = spark.createDataFrame(rows, "lang string, text string")
    want = plain_phrases(rows, 4, 60)
    real = phrases.common_words
    sizes = []

    def few(words, salt, least):
        found = real(words, salt, least, most)
        sizes.append(len(found))
        return found

    monkeypatch.setattr(phrases, "common_words", few)
    for most in (0, 12):
        assert got(phrases.phrases(df, least=4, first=60)) == want
    assert sizes[0] == 1 < sizes[1] <= 13
