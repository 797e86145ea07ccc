import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from notewright.llm import toxicity
from notewright.llm.base import fold, table

SF_DIR = "/root/testdata/sf0.1"


def distance(a, b):
    """Edits of one letter and swaps of neighbours."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row, last = [i], rows[-1]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                row[-1] = min(row[-1], rows[-2][j - 2] + 1)
        rows.append(row)
    return rows[-1][-1]


def plain_edits(entries, word):
    best = 2
    for text, stem in entries:
        if stem is None:
            continue
        ends = [word[:n] for n in range(len(word) + 1)] if stem else [word]
        least = min(distance(text, end) for end in ends)
        longer = not stem and len(text) == toxicity.LEAST_EDITED - 1 and len(word) > len(text)
        if least == 0 or (least == 1 and not stem and (len(text) >= toxicity.LEAST_EDITED or longer)):
            best = min(best, least)
    return best


ENTRIES = [("abbab", False), ("babab", True), ("aab", False), ("bbbb", True), ("abcabc", False), ("cabba", True), ("caca", False)]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="abc", max_size=9))
def test_automaton_against_plain_distances(word):
    assert toxicity.FuzzyTrie(ENTRIES).edits(word) == plain_edits(ENTRIES, word)


def test_few_states_give_the_same():
    trie = toxicity.FuzzyTrie(ENTRIES, most_states=3)
    for word in ("abbab", "abab", "bababcc", "cabbba", "aabb", "", "abcabc"):
        assert trie.edits(word) == plain_edits(ENTRIES, word)


def test_context_tells_quotation_from_abuse():
    reader = toxicity.Reader([("idiot", False)])
    kinds = lambda text: [round(x, 2) for x in reader.features(text)[:6]]
    assert kinds("he wrote that word idiot once") == [0.69, 0, 0, 0, 0, 0]
    assert kinds('a sign with "an idiot" hung there') == [0.69, 0, 0, 0, 0, 0]
    assert kinds("some idiot left it there") == [0, 0.69, 0, 0, 0, 0]
    assert kinds("you are an idi0t") == [0, 0, 0, 0, 0, 0.69]
    assert kinds("nothing here") == [0] * 6


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    held_out = fold(F.col("doc_id"), 4) == 2
    entries, weights = toxicity.train(docs, labels.where(~held_out))
    marked = toxicity.with_toxicity(docs, entries, weights).join(labels.where(held_out), "doc_id")
    rows = marked.select("toxic", "score").collect()
    found = [r["score"] >= 0.3 for r in rows if r["toxic"]]
    false = [r["score"] >= 0.3 for r in rows if not r["toxic"]]
    assert sum(found) >= 0.9 * len(found) and sum(false) <= 0.02 * len(false)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (5, 0), (7, None), (None, 1), (1, 1)], "doc_id bigint, toxic int")
    entries, weights = toxicity.train(odd_documents, labels)
    rows = toxicity.with_toxicity(odd_documents, entries, weights).collect()
    assert len(rows) == 11 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not r["text"]}) == 1
    assert toxicity.with_toxicity(no_documents, entries, weights).count() == 0
    entries, weights = toxicity.train(odd_documents, labels.limit(0))
    assert {r["score"] for r in toxicity.with_toxicity(odd_documents, entries, weights).collect()} == {0.0}


def test_longer_entries_take_the_place_of_short_stems():
    evidence = {("idio", True): 40, ("idiot", True): 40, ("idiot", False): 30, ("path", True): 20, ("pathetic", True): 20,
                ("pathetic", False): 20, ("worthles", True): 9, ("worthless", False): 9}
    assert toxicity.without_short_stems(evidence) == [
        ("idiot", False), ("idiot", True), ("pathetic", False), ("worthless", False)]


def one_edit(word):
    found = {word[:k] + word[k + 1:] for k in range(len(word))}
    found |= {word[:k] + "q" + word[k + d:] for k in range(len(word) + 1) for d in (0, 1) if k + d <= len(word)}
    found |= {word[:k] + word[k + 1] + word[k] + word[k + 2:] for k in range(len(word) - 1)}
    return sorted(found - {word})


def plain_score(entries, weights, text, known):
    lower = text.lower()
    spans = [m.span() for m in toxicity.WORD.finditer(lower)]
    words = [lower[a:b] for a, b in spans]
    counts = [[0] * 3, [0] * 3]
    for k, word in enumerate(words):
        if word not in known:
            known[word] = plain_edits(entries, word)
            if known[word] and (word, None) in entries:
                known[word] = 2
        if known[word] < 2:
            counts[known[word]][toxicity.Reader.context(lower, words, spans, k)] += 1
    x = [math.log1p(n) for row in counts for n in row]
    x += [math.sqrt(sum(map(sum, counts)) / max(1, len(words))), math.log1p(len(words)) / 10]
    return 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, weights)) - weights[-1]))


def test_trained_terms_are_found_misspelled(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    entries, weights = toxicity.train(docs, labels.where(fold(F.col("doc_id"), 4) != 2))
    words = [e for e, stem in entries if stem is False and len(e) >= 5]
    ordinary = {e for e, stem in entries if stem is None}
    assert len(words) >= 5
    reader = toxicity.Reader(entries)
    missed = [(w, m) for w in words for m in one_edit(w) if m not in ordinary and reader.edits(m) > 1]
    assert not missed
    score = lambda text: 1 / (1 + math.exp(-np.dot(reader.features(text), weights[:-1]) - weights[-1]))
    strong = [w for w in words if score(f"you {w} and you {w}") >= 0.5]
    assert len(strong) >= 5
    for word in strong:
        for other in set(one_edit(word)) - ordinary:
            assert score(f"you {other} and you {other}") >= 0.3, (word, other)
        assert score(f'the sign said "{word}" and the word was "{word}" in a book of quotes about the town') < 0.3
    assert score("what a nice and sunny day for a walk along the river with all of my friends") < 0.1


def test_scores_against_a_plain_restatement(spark):
    docs, labels = table(spark, "/root/testdata/sf0.001", "documents"), table(spark, SF_DIR, "labels")
    entries, weights = toxicity.train(table(spark, SF_DIR, "documents"), labels.where(fold(F.col("doc_id"), 4) != 2))
    known = {}
    rows = toxicity.with_toxicity(docs.where("length(text) < 3000"), entries, weights).collect()
    assert len(rows) > 100
    for r in rows:
        assert abs(r["score"] - plain_score(entries, weights, r["text"], known)) < 1e-9
