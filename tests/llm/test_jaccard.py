import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from notewright.llm import jaccard
from notewright.llm.base import table

SF_DIR = "/root/testdata/sf0.01"


def plain_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 3:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(words, words[1:], words[2:]))


def plain_results(rows):
    """All pairs of distinct sets that share a shingle."""
    sets = {}
    for k, (_, text) in enumerate(rows):
        sets.setdefault(plain_set(text), []).append(k)
    names = [s for s in sets if s]
    root = list(range(len(names)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    having = {}
    for k, s in enumerate(names):
        for part in s:
            having.setdefault(part, []).append(k)
    for k, s in enumerate(names):
        met = {}
        for part in s:
            for other in having[part]:
                if other < k:
                    met[other] = met.get(other, 0) + 1
        for other, both in met.items():
            if 100 * both >= 90 * (len(s) + len(names[other]) - both):
                one, two = find(k), find(other)
                root[max(one, two)] = min(one, two)
    least = {}
    for k, s in enumerate(names):
        ids = [rows[m][0] for m in sets[s] if rows[m][0] is not None]
        least[find(k)] = min(ids + ([least[find(k)]] if least.get(find(k)) is not None else []), default=None)
    found = []
    for s, members in sets.items():
        for m in members:
            found.append((rows[m][0], len(s), least[find(names.index(s))] if s else rows[m][0]))
    return sorted(found, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def families(seed, n_bases, n_copies, words):
    """Bases and copies with words changed, cut off, added and moved."""
    rng = random.Random(seed)
    pool = [f"w{k}" for k in range(4000)]
    texts = []
    for _ in range(n_bases):
        base = rng.choices(pool, k=rng.randint(3, words))
        texts.append(" ".join(base))
        for _ in range(n_copies):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                at = rng.randrange(len(copy))
                kind = rng.randrange(4)
                if kind == 0:
                    copy[at] = rng.choice(pool)
                elif kind == 1:
                    copy.insert(at, rng.choice(pool))
                elif kind == 2 and len(copy) > 2:
                    del copy[at]
                else:
                    copy += rng.choices(pool, k=rng.randint(1, 4))
            texts.append(" ".join(copy))
    return texts


def test_every_link_of_the_table(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(jaccard.jaccard_components(docs)) == plain_results(rows)


def test_families_in_small_pieces_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PIECE", 5)
    monkeypatch.setattr(jaccard, "CHUNK_BYTES", 5000)
    monkeypatch.setattr(jaccard, "BATCH_ROWS", 300)
    texts = families(3, 12, 25, 150) + families(4, 30, 3, 12) + families(5, 1, 120, 90)
    rows = [(1000 - k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = plain_results(rows)
    assert len({r[2] for r in want}) < 0.7 * len(want)
    assert got(jaccard.jaccard_components(df)) == want


def test_without_the_spanning_round_the_count_of_matches_finds_all(spark, monkeypatch):
    """The second round alone is a whole multi-match join."""
    monkeypatch.setattr(jaccard, "spanning", lambda pairs, size: iter(()))
    rows = list(enumerate(families(8, 8, 12, 100)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(jaccard.jaccard_components(df)) == plain_results(rows)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=50), st.lists(st.integers(0, 60), max_size=50),
       st.integers(1, jaccard.MOST_MATCHES))
def test_prefixes_of_links_share_enough(one, two, wanted):
    a, b = sorted(set(one)), sorted(set(one[:45] + two[:3]))
    both = len(set(a) & set(b))
    if 100 * both >= 90 * (len(a) + len(b) - both):
        wanted = min(wanted, jaccard.overlap(max(len(a), len(b))))
        heads = [set(s[:len(s) - jaccard.overlap(len(s)) + wanted]) for s in (a, b)]
        assert len(heads[0] & heads[1]) >= wanted
    bits = [jaccard.sketch(np.array(s, dtype=np.uint64)) for s in (a, b)]
    assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= len(set(a) ^ set(b))


def test_more_matches_are_asked_for_where_that_costs_less():
    assert jaccard.matches(np.array([2, 2, 500, 500, 500], dtype=np.uint32), 1, 9) == 1
    assert jaccard.matches(np.array([400] * 40, dtype=np.uint32), 30, 9) > 1
    assert jaccard.matches(np.array([400] * 40, dtype=np.uint32), 30, 1) == 1


def test_odd_rows(spark, odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert got(jaccard.jaccard_components(odd_documents)) == plain_results(rows)
    assert jaccard.jaccard_components(no_documents).count() == 0


def test_short_numbers_stand_for_shingles_one_to_one(spark, monkeypatch):
    """They were hashes of 8 bytes, on the way back and in every set."""
    monkeypatch.setattr(jaccard, "CHUNK_BYTES", 5000)
    texts = families(11, 6, 12, 120)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    shared = jaccard.shared_shingles(jaccard.send_sets(df, 5), 5)
    found = {r["same"]: r for r in jaccard.possible_sets(shared, 5).collect()}
    hashes = {jaccard.digest(s): set(s.tolist()) for s in map(jaccard.Sets().of, texts)}
    assert len(found) > 20
    for r in found.values():
        assert len(r["tokens"]) == 4 * (r["n"] - r["own"])
    tokens = {same: set(np.frombuffer(r["tokens"], np.uint32).tolist()) for same, r in found.items()}
    for a in tokens:
        for b in tokens:
            if a != b:
                assert len(tokens[a] & tokens[b]) == len(hashes[a] & hashes[b])


def test_numbers_that_do_not_fit_stay_long():
    for top in (2**32 - 1, 2**32, 2**63):
        numbers = np.array([3, top, 5], dtype=np.uint64)
        held = jaccard.short(numbers)
        assert len(held) == (12 if top < 2**32 else 24) and (jaccard.whole(held, 3) == numbers).all()


def test_what_is_sent_is_small(spark):
    """Of the hashes the bucket and the order are known."""
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(400)) for _ in range(300)]
    sent = jaccard.send_sets(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1), 16)
    assert sum(len(r["block"]) for r in sent.collect()) < 8 * 300 * 398
