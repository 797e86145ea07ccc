import random
from collections import defaultdict

import numpy as np
import xxhash

from notewright.llm import simhash
from notewright.llm.base import table
from notewright.llm.components import components

SF_DIR = "/root/testdata/sf0.001"


def plain_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_roots(edges, vertices):
    root = {v: v for v in vertices}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {v: find(v) for v in vertices}


def plain_components(rows):
    """Every pair of rows compared."""
    prints = [plain_fingerprint(text) for _, text in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    roots = plain_roots(pairs, range(len(rows)))
    least = defaultdict(list)
    for k, r in roots.items():
        if rows[k][0] is not None:
            least[r].append(rows[k][0])
    return sorted(
        ((rows[k][0], f"{prints[k]:016x}", min(least[r], default=None)) for k, r in roots.items()), key=repr
    )


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 150)] + [(7, 7)]
    edges += [(rng.randrange(3000, 3300), rng.randrange(3000, 3300)) for _ in range(120)]
    rng.shuffle(edges)
    got = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    want = plain_roots(edges, {v for e in edges for v in e})
    assert {r["vertex"]: r["root"] for r in got} == {v: r for v, r in want.items() if v != r}


def test_every_pair_at_distance_two_shares_a_cell():
    rng = np.random.default_rng(3)
    some = rng.integers(0, 2**64, 400, dtype=np.uint64)
    bits = np.uint64(1) << rng.integers(0, 64, (2, 400)).astype(np.uint64)
    near = some ^ bits[0] ^ bits[1]
    cells = simhash.exact_cells(some[:, None]), simhash.exact_cells(near[:, None])
    assert (cells[0] == cells[1]).any(axis=1).all()


def test_links_in_cells_are_those_of_all_pairs():
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 2**64, 6, dtype=np.uint64)
    lanes = np.unique(centres[rng.integers(0, 6, 500)] ^ (np.uint64(1) << rng.integers(0, 12, 500).astype(np.uint64)))
    cells = (lanes >> np.uint64(63)).astype(np.int64)
    i, j = simhash.spanning_links(cells, lanes[:, None], 2)
    assert (np.bitwise_count(lanes[i] ^ lanes[j]) <= 2).all() and (cells[i] == cells[j]).all()
    pairs = [(a, b) for a in range(len(lanes)) for b in range(a)
             if cells[a] == cells[b] and int(lanes[a] ^ lanes[b]).bit_count() <= 2]
    want = plain_roots(pairs, range(len(lanes)))
    assert plain_roots(zip(i.tolist(), j.tolist()), range(len(lanes))) == want
    assert len(i) == len(lanes) - len(set(want.values()))


def test_whole_table_against_all_pairs(spark):
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    # Close copies, so that there are links between different fingerprints.
    rows += [(10_000 + k, t.replace(" the ", " The  ", 1) + " x" * (k % 2)) for k, (_, t) in enumerate(rows[:60])]
    rows += [(20_000 + k, t[:-1]) for k, (_, t) in enumerate(rows[:60])]
    got = simhash.simhash_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    have = sorted(((r["doc_id"], r["fingerprint"].hex(), r["component_id"]) for r in got), key=repr)
    assert have == plain_components(rows)


def test_odd_rows(odd_documents, no_documents):
    got = simhash.simhash_components(odd_documents).collect()
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    have = sorted(((r["doc_id"], r["fingerprint"].hex(), r["component_id"]) for r in got), key=repr)
    assert have == plain_components(rows)
    assert simhash.simhash_components(no_documents).count() == 0


def test_first_of_each_component_stays(spark, odd_documents, no_documents):
    docs = table(spark, SF_DIR, "documents")
    copies = docs.withColumn("doc_id", docs["doc_id"] + 10_000).unionByName(docs).unionByName(docs)
    got = simhash.first_of_linked(copies)
    assert got.columns == docs.columns
    want = {least for _, _, least in plain_components([tuple(r) for r in docs.select("doc_id", "text").collect()])}
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(want)
    odd = simhash.first_of_linked(odd_documents)
    parts = {}
    for doc_id, bits, least in plain_components([(r["doc_id"], r["text"]) for r in odd_documents.collect()]):
        parts.setdefault(least if least is not None else bits, doc_id)
    assert odd.columns == odd_documents.columns
    assert sorted(r["doc_id"] for r in odd.collect()) == sorted(k for k in parts if isinstance(k, int))
    assert simhash.first_of_linked(no_documents).count() == 0


def similarity(a, b):
    a, b = (set(simhash.shingles((t or "").encode().lower().split(), 5)) for t in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def test_one_of_similar_texts_stays(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    kept = simhash.first_of_similar(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert len(ids) == len(set(ids)) and 850 < len(ids) < len(whole)
    by_shingle = defaultdict(set)
    for i in ids:
        for s in simhash.shingles(whole[i].encode().lower().split(), 5):
            by_shingle[s].add(i)
    for i in set(whole) - set(ids):
        parts = simhash.shingles(whole[i].encode().lower().split(), 5)
        near = {j for s in parts for j in by_shingle[s]}
        assert max(similarity(whole[i], whole[j]) for j in near) > 0.5
    close = {(i, j) for some in by_shingle.values() if len(some) < 40 for i in some for j in some if i < j}
    missed = [p for p in close if similarity(whole[p[0]], whole[p[1]]) >= 0.8]
    assert len(missed) <= 1


def test_one_of_odd_rows_stays(odd_documents, no_documents):
    got = simhash.first_of_similar(odd_documents)
    assert got.columns == odd_documents.columns
    rows = got.collect()
    # Equal texts, those that have no words, and the long one; two words differ too much from the rest.
    assert sorted(r["doc_id"] for r in rows) == [1, 3, 5, 7] or sorted(r["doc_id"] for r in rows) == [
        1, 3, 5, 7, 9_007_199_254_740_993]
    assert simhash.first_of_similar(no_documents).count() == 0


def copies(rng, vocabulary, k):
    """A text of its own words and a near copy: a tail added, the end cut off, a passage replaced, words replaced."""
    n = rng.randrange(60, 300)
    some = lambda m: [rng.choice(vocabulary) for _ in range(m)]
    text, part = some(n), int(n * rng.uniform(0.05, 0.16))
    at = rng.randrange(n - part)
    copy = [
        text + some(part), text[:-part], text[:at] + some(part // 2) + text[at + part // 2:],
        [w if rng.random() > 0.015 else "other" for w in text],
    ][k % 4]
    return " ".join(text), " ".join(copy)


def test_copies_of_every_kind_share_a_cell():
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(4000)]
    for k in range(800):
        one, two = copies(rng, vocabulary, k)
        cells = [simhash.least_hashes(simhash.shingle_set(t, 5)) for t in (one, two)]
        assert similarity(one, two) < 0.8 or (cells[0] == cells[1]).any()


def plain_firsts(rows, least=0.8):
    """A row stays unless it is similar to one before it that stays; all pairs that share a shingle compared."""
    kept, by_shingle = [], defaultdict(set)
    sets = [set(simhash.shingles(t.encode().lower().split(), 5)) for _, t in rows]
    for k in range(len(rows)):
        near = {j for s in sets[k] or [b""] for j in by_shingle[s]}
        if not any(len(sets[k] & sets[j]) >= least * len(sets[k] | sets[j]) for j in near):
            kept.append(rows[k][0])
            for s in sets[k] or [b""]:  # texts without words are alike
                by_shingle[s].add(k)
    return kept


def test_copies_of_every_kind_meet(spark):
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(4000)]
    rows = []
    for k in range(600):
        for text in copies(rng, vocabulary, k):
            rows.append((len(rows), text))
    pairs = [similarity(rows[2 * k][1], rows[2 * k + 1][1]) for k in range(600)]
    assert all(sum(p >= 0.8 for p in pairs[kind::4]) > 40 for kind in range(4)) and min(pairs) < 0.8
    got = simhash.first_of_similar(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r["doc_id"] for r in got.collect()) == plain_firsts(rows)


def test_what_stays_is_as_by_all_pairs(spark):
    rng = random.Random(12)
    some = lambda n: [rng.choice("abcdefghijklmnop") * 3 + str(rng.randrange(90)) for _ in range(n)]
    rows, chain = [], some(120)
    for _ in range(40):  # each like the last one, the ends unlike
        chain = chain[6:] + some(6)
        rows.append(chain)
    family = some(150)
    rows += [family + some(rng.randrange(40)) for _ in range(600)]  # some below the similarity, more than a piece
    rows += [family[:k] for k in range(4, 12)] + [family[:3], family[:3]]
    rng.shuffle(rows)
    rows = [(k, " ".join(words)) for k, words in enumerate(rows)]
    got = simhash.first_of_similar(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r["doc_id"] for r in got.collect()) == plain_firsts(rows)


def test_whole_documents_stay_as_by_all_pairs(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    got = sorted(r["doc_id"] for r in simhash.first_of_similar(docs).collect())
    assert got == plain_firsts(rows)
