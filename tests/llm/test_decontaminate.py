import itertools
import random
import re

import numpy as np

from notewright.llm import decontaminate
from notewright.llm.base import table

SF_DIR = "/root/testdata/sf0.01"


def words(text):
    return [w.encode() for w in re.findall(r"[^\W_]+", (text or "").lower())]


def plain_overlaps(docs, items):
    """Every item laid at every place of every document."""
    found = set()
    for doc_id, text in docs:
        here = words(text)
        for item_id, item in items:
            there = words(item)
            size = min(20, len(there))
            for shift in range(-len(there) + 1, len(here)) if there else ():
                same = [0 <= shift + k < len(here) and here[shift + k] == w for k, w in enumerate(there)]
                if max(sum(same[k:k + size]) for k in range(len(there) - size + 1)) >= 0.8 * size:
                    found.add((doc_id, item_id))
                    break
    return found


def got(docs, items, **options):
    return {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items, **options).collect()}


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id bigint, text string"),
            spark.createDataFrame(items, "item_id bigint, text string"))


def test_word_hashes_go_by_the_word():
    text = "Été ab, ab-AB (ab) x_y 東京 ab"
    hashes = decontaminate.word_hashes(text)
    assert len(hashes) == len(words(text))
    for word, h in zip(words(text), hashes):
        alone = decontaminate.word_hashes(word.decode())
        assert alone.tolist() == [h]
    assert len(decontaminate.word_hashes(" ,. ")) == 0


def test_signs_beyond_ascii_end_words(spark):
    item = [f"word{k}" for k in range(22)]
    quoted = [f"\u201c{w}\u201d" if k % 4 == 0 else w for k, w in enumerate(item)]
    docs, items = frames(spark, [(1, " ".join(quoted)), (2, "\u2014".join(item)), (3, "\u00a0".join(item)), (4, "word1")],
                         [(9, " ".join(item))])
    assert got(docs, items) == {(1, 9), (2, 9), (3, 9)}
    assert len(decontaminate.word_hashes("e\u0301te\u0301 \u2026 \u0928\u092e\u0938\u094d\u0924\u0947")) == 2


def test_passages_with_substituted_words(spark):
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(3000)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, some(rng.randrange(15, 50))) for k in range(12)] + [(100, some(6)), (101, some(1)), (102, [])]
    docs = []
    for k in range(120):
        passage = list(items[k % len(items)][1])
        for at in range(k % 4, len(passage), 6 + k % 5):
            if k % 3:
                passage[at] = "other"
        if k % 7 == 0:
            passage = passage[2:]
        body = some(30) + passage + some(30)
        docs.append((k, " ".join(body) if k % 2 else ", ".join(w.upper() for w in body)))
    items = [(i, " ".join(t)) for i, t in items]
    want = plain_overlaps(docs, items)
    have = got(*frames(spark, docs, items))
    assert have <= want and len(want) > 60
    assert len(have) >= 0.97 * len(want)


def test_whole_table_against_all_places(spark):
    docs, items = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "benchmark")
    have = got(docs, items)
    # All places that share five words in a row are looked at.
    rows, things = [tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.collect()]
    parts = {}
    for i, t in things:
        w = words(t)
        for k in range(len(w) - 4):
            parts.setdefault(tuple(w[k:k + 5]), set()).add(i)
    near = {}
    for d, t in rows:
        w = words(t)
        for k in range(len(w) - 4):
            for i in parts.get(tuple(w[k:k + 5]), ()):
                near.setdefault(i, set()).add(d)
    texts = dict(rows)
    want = set()
    for i, t in things:
        want |= plain_overlaps([(d, texts[d]) for d in near.get(i, ())], [(i, t)])
    assert have == want and len(have) > 5
    kept = decontaminate.without_contaminated(docs, items)
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.collect()} == set(texts) - {d for d, _ in have}


def test_odd_rows(spark, odd_documents, no_documents):
    text = odd_documents.where("doc_id = 1").first()["text"]
    items = spark.createDataFrame(
        [(1, text), (1, text), (None, text), (2, None), (3, ""), (4, "grüße 東京")], "item_id bigint, text string")
    have = got(odd_documents, items)
    assert {i for i, _ in have} == {1, 2, None, 7, 9_007_199_254_740_993}
    assert {(7, 4), (1, 1), (1, None)} <= have
    kept = decontaminate.without_contaminated(odd_documents, items)
    assert kept.schema == odd_documents.schema
    # The row without an id and without a text stays, the one with the text goes.
    assert sorted(r["row"] or 0 for r in kept.collect()) == [0, 0, 1, 3, 4]
    assert decontaminate.contaminated(no_documents, items).count() == 0
    assert decontaminate.contaminated(odd_documents, items.limit(0)).count() == 0
    assert decontaminate.without_contaminated(odd_documents, items.limit(0)).count() == 11
    assert np.unpackbits(np.frombuffer(decontaminate.seed_filter(
        decontaminate.item_seeds(decontaminate.item_words(items.limit(0)), decontaminate.MASKS)), np.uint8)).sum() == 0


def test_masks_hit_every_accepted_pattern():
    for size in range(1, 21):
        apart = decontaminate.substitutions(size, 0.8)
        assert size - apart >= 0.8 * size > size - apart - 1
        masks = decontaminate.masks_for(size, 0.8)
        laid = [int(m, 2) << at for m in masks for at in range(size - len(m) + 1)]
        for some in itertools.combinations(range(size), apart):
            gone = sum(1 << k for k in some)
            assert any(not m & gone for m in laid), (size, some)


def test_items_of_every_length_with_all_their_substitutions(spark):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(5000)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(n, some(n)) for n in [*range(1, 24), 40]]
    docs = []
    for n, item in items:
        window, at = min(n, 20), rng.randrange(max(1, n - 19))
        for k in range(12):
            passage = list(item)
            apart = decontaminate.substitutions(window, 0.8) + (k == 11)
            for place in rng.sample(range(window), apart):
                passage[at + place] = "other"
            if k == 10 and n < 20:  # the differing words are beyond the end
                passage = item[:n - apart]
            passage = [w if at <= j < at + 20 else "else" for j, w in enumerate(passage)]
            docs.append((len(docs), " ".join(some(25) + passage + (some(25) if k != 10 else []))))
    items = [(i, " ".join(t)) for i, t in items]
    want = plain_overlaps(docs, items)
    assert len(want) >= 11 * len(items)
    assert got(*frames(spark, docs, items)) == want
