"""Toxicity of whole texts: a learned lexicon matched with one edit, scored by the words around each match.

The lexicon holds words and stems that mark toxic documents in a bounded labelled sample, by a likelihood ratio
test over documents that are no near copies of each other. A stem matches any word that begins with it; it stands only where no longer entry has its evidence, and whole
words stand beside the stems that cover them, as only they are also found misspelled. Entries form a trie. The trie is
intersected with the Levenshtein automaton of each text word, in which a swap of neighbours is one edit; it is run as
one deterministic automaton over the trie's nodes and the edits spent, its states made when first reached. So a
misspelled word or stem is found at the cost of a few table lookups a letter, and most words leave the automaton after
a few letters. A word that several clean documents of the sample have is no misspelling.

Each match is weighed by a window of words around it. Quotation marks that enclose the match, and words of saying, make it
a quotation; words that address somebody make it abuse. Counts of exact and misspelled matches, quoted, plain
and addressed, go into a logistic model, trained on the same sample. Its texts are hardly misspelled, so each with a
match is taken a second time with its matches misspelled, one edit each, by the same label.

The sample takes at most ``SAMPLE`` labelled rows, chosen by a hash of the id, and neither language, source, id nor
label is an input of a score. A null or empty text has no matches and gets the score of such texts. Without
labelled rows every score is 0. Each row is scored by itself.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.llm.base import column_rows, ready, row_batches, texts, word_array

SAMPLE = 20_000
MOST_ENTRIES = 2_000
LEAST_RATIO = 6.0  # of the likelihood ratio statistic, beside twice the log of the sample size
LEAST_SHARE = 0.7  # of the documents with an entry that are toxic
STEMS = range(4, 9)
EDITS = 1
LEAST_EDITED = 5  # letters of an entry that may be misspelled; a word one shorter may have a letter too many
LEAST_ORDINARY = 2  # clean documents with a word, for it to be no misspelling
EQUAL = 0.95  # of a stem's toxic documents, with which a longer entry takes its place
REACH = 6
WORD = re.compile(r"\w+")

# Words of saying and of address, in the languages of the corpus, lower case.
SAYING = frozenset(
    "says said say called calls word words term quote quoted wrote writes dit disait mot terme cite appelle sagt "
    "sagte wort begriff zitat schrieb nannte dice dijo palabra cita escribe llama".split()
)
ADDRESS = frozenset(
    "you your yours youre u ur are tu toi vous ton ta votre es du dich dir dein deine ihr bist sie te ti usted "
    "eres tus".split()
)
MARKS = {'"': '"', "“": "”", "„": "“", "«": "»", "‘": "’"}
FEATURES = 8


class FuzzyTrie:
    """Entries ``(text, is_stem)``, or an ordinary word and None, and the automaton that finds words within ``EDITS`` edits of one."""

    def __init__(self, entries: list[tuple[str, bool]], most_states: int = 100_000) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.word_at: list[int] = [0]  # length of the entry that ends at the node, or 0
        self.stem_at: list[int] = [0]
        for text, is_stem in entries:
            if is_stem is None:
                continue
            node = 0
            for letter in text:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.word_at.append(0)
                    self.stem_at.append(0)
                node = self.children[node][letter]
            (self.stem_at if is_stem else self.word_at)[node] = len(text)
        self.most_states = most_states
        self._reset()

    def _reset(self) -> None:
        self.states: list[frozenset] = []
        self.number: dict[frozenset, int] = {}
        self.at_end: list[int] = []
        self.lengthened: list[bool] = []
        self.passed: list[int] = []
        self.steps: list[dict[str, int]] = []
        self.first = self._state(self._closed({(0, "", 0)}))

    def _closed(self, places: set) -> frozenset:
        """With letters of an entry left out, which spends edits; of each place the fewest edits count.

        A place is a node and, after the first of two swapped letters, the letter that must follow."""
        best: dict[tuple[int, str], int] = {}
        stack = list(places)
        while stack:
            node, owed, edits = stack.pop()
            if best.get((node, owed), EDITS + 1) <= edits:
                continue
            best[node, owed] = edits
            if edits < EDITS and not owed:
                stack += [(child, "", edits + 1) for child in self.children[node].values()]
        return frozenset((*place, edits) for place, edits in best.items())

    def _state(self, places: frozenset) -> int:
        if places not in self.number:
            self.number[places] = len(self.states)
            self.states.append(places)
            # Stems are found as they are only: with an edit they would begin too many words.
            fewest = lambda ends, most: min(
                [edits for node, owed, edits in places
                 if ends[node] and not owed and edits <= most and (not edits or ends[node] >= LEAST_EDITED)],
                default=EDITS + 1,
            )
            self.at_end.append(min(fewest(self.word_at, EDITS), fewest(self.stem_at, 0)))
            self.lengthened.append(any(
                self.word_at[node] == LEAST_EDITED - 1 and not owed and edits == 1 for node, owed, edits in places
            ))
            self.passed.append(fewest(self.stem_at, 0))
            self.steps.append({})
        return self.number[places]

    def _step(self, state: int, letter: str) -> int:
        after: set[tuple[int, str, int]] = set()
        for node, owed, edits in self.states[state]:
            if owed:
                if letter == owed:
                    after.add((node, "", edits))
                continue
            for other, child in self.children[node].items():
                if other == letter:
                    after.add((child, "", edits))
                elif edits < EDITS:
                    after.add((child, "", edits + 1))
                    if letter in self.children[child]:
                        after.add((self.children[child][letter], other, edits + 1))
            if edits < EDITS:
                after.add((node, "", edits + 1))
        self.steps[state][letter] = found = self._state(self._closed(after)) if after else -1
        return found

    def edits(self, word: str) -> int:
        """The edits that the nearest entry is away, ``EDITS + 1`` if none is near."""
        if len(self.states) > self.most_states:
            self._reset()
        state, fewest = self.first, EDITS + 1
        for letter in word:
            following = self.steps[state].get(letter)
            state = self._step(state, letter) if following is None else following
            if state < 0:
                return fewest
            fewest = min(fewest, self.passed[state])
            if not fewest:
                return 0
        if len(word) >= LEAST_EDITED and self.lengthened[state]:
            fewest = min(fewest, 1)
        return min(fewest, self.at_end[state])


class Reader:
    """Features of one text at a time."""

    def __init__(self, entries: list[tuple[str, bool]], most_known: int = 300_000) -> None:
        self.trie = FuzzyTrie(entries)
        self.ordinary = frozenset(text for text, is_stem in entries if is_stem is None)
        self.known: dict[str, int] = {}
        self.most_known = most_known

    def edits(self, word: str) -> int:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= self.most_known:
                self.known.clear()
            found = self.trie.edits(word)
            if found and word in self.ordinary:
                found = EDITS + 1
            self.known[word] = found
        return found

    def features(self, text: str) -> list[float]:
        """The log counts of exact and of misspelled matches in quoted, plain and addressed places; the share
        of words that match; the log of the number of words."""
        lower = text.lower()
        words = WORD.findall(lower)
        hits = {word for word in set(words) if self.edits(word) <= EDITS}
        counts = np.zeros((2, 3))
        if hits:
            spans = [m.span() for m in WORD.finditer(lower)]
            for k, word in enumerate(words):
                if word in hits:
                    counts[self.edits(word), self.context(lower, words, spans, k)] += 1
        share = counts.sum() / max(1, len(words))
        return [*np.log1p(counts).ravel().tolist(), math.sqrt(share), math.log1p(len(words)) / 10]

    def misspelled(self, text: str) -> str | None:
        """The text, lower case, with an edit in each word that matches; none where no word does."""
        lower, hits = text.lower(), 0

        def edited(match: re.Match) -> str:
            nonlocal hits
            word = match[0]
            if self.edits(word):
                return word
            hits += 1
            at = zlib.crc32(word.encode()) % len(word)
            return word[:at] + ("x" if word[at] != "x" else "z") + word[at + 1:]

        found = WORD.sub(edited, lower)
        return found if hits else None

    @staticmethod
    def context(text: str, words: list[str], spans: list[tuple[int, int]], k: int) -> int:
        """0 for a quotation, 2 for an address, 1 for neither."""
        first, last = max(0, k - REACH), min(len(words), k + REACH + 1)
        before, after = text[spans[first][0]:spans[k][0]], text[spans[k][1]:spans[last - 1][1] + 1]
        around = words[first:k] + words[k + 1:last]
        quoted = any(
            before.rfind(left) >= 0 and right in after and (left != right or before.count(left) % 2)
            and right not in before[before.rfind(left) + 1:]
            for left, right in MARKS.items()
        )
        if quoted or not SAYING.isdisjoint(around):
            return 0
        return 2 if not ADDRESS.isdisjoint(around) else 1


def word_entries(text: str) -> set[tuple[str, bool]]:
    """The words and stems of a text that could enter the lexicon."""
    found = set()
    for word in set(WORD.findall(text.lower())):
        if len(word) >= STEMS[0] and not word.isdigit():
            found.add((word, False))
            found.update((word[:n], True) for n in STEMS if n <= len(word))
    return found


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """``(doc_id, text, toxic)`` of at most ``most`` labelled documents; the ids are bounded, so broadcast."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return texts(docs).join(F.broadcast(known), "doc_id")


def without_near_copies(sample: DataFrame) -> DataFrame:
    """One text of those with equal labels and an equal least, or an equal largest, hash of their words.

    A family of near copies would else pass any word it shares for evidence of many documents."""
    hashes = F.transform(word_array(F.lower("text")), lambda w: F.xxhash64(w))
    for pick in (F.array_min, F.array_max):
        keyed = sample.withColumn("sign", F.coalesce(pick(hashes), F.lit(0)))
        sample = keyed.groupBy("sign", "toxic").agg(F.min("doc_id").alias("doc_id"), F.min_by("text", "doc_id").alias("text"))
        sample = sample.drop("sign")
    return sample


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("entry", pa.string()), ("stem", pa.bool_()), ("toxic", pa.int64()), ("clean", pa.int64())])
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    done = 0
    for text, toxic in column_rows(batches, "text", "toxic"):
        counts[0 if toxic else 1].update(word_entries(text))
        done += 1
        if done % 500 == 0:
            yield from row_batches(((*e, counts[0][e], counts[1][e]) for e in counts[0].keys() | counts[1].keys()), schema)
            counts = (Counter(), Counter())
    yield from row_batches(((*e, counts[0][e], counts[1][e]) for e in counts[0].keys() | counts[1].keys()), schema)


def lexicon(sample: DataFrame) -> list[tuple[str, bool]]:
    """Entries that mark toxic documents: of the ``MOST_ENTRIES`` with the most evidence in the bounded sample."""
    sizes = sample.agg(F.count(F.when(F.col("toxic") > 0, 1)), F.count("*")).first()
    toxic, clean = sizes[0], sizes[1] - sizes[0]
    if not toxic or not clean:
        return []
    each = sample.select("text", "toxic").mapInArrow(_counted, "entry string, stem boolean, toxic bigint, clean bigint")
    counts = each.groupBy("entry", "stem").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    share = toxic / (toxic + clean)
    least = LEAST_RATIO + 2 * math.log(toxic + clean)
    n, t, c = F.col("t") + F.col("c"), F.col("t"), F.col("c")
    part = lambda k, p: F.when(k > 0, k * F.log(k / (n * F.lit(p)))).otherwise(F.lit(0.0))
    counts = counts.withColumn("ratio", 2 * (part(t, share) + part(c, 1 - share)))
    # The share of toxic documents, as if both kinds were sampled alike.
    odds = (t + 0.1) / F.lit(toxic)
    chosen = counts.where((F.col("ratio") >= least) & (odds / (odds + (c + 0.1) / F.lit(clean)) >= LEAST_SHARE))
    chosen = chosen.orderBy(F.desc("ratio"), F.length("entry"), "entry", "stem").limit(MOST_ENTRIES)
    evidence = {(row["entry"], row["stem"]): row["t"] for row in chosen.collect()}
    return without_short_stems(evidence)


def ordinary_words(sample: DataFrame, entries: list[tuple[str, bool]]) -> list[tuple[str, None]]:
    """Words an edit away from an entry that several clean documents of the bounded sample have: no misspellings."""
    schema = pa.schema([("word", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(entries)
        rows = column_rows(batches, "text")
        return row_batches(((word,) for (text,) in rows for word in set(WORD.findall(text.lower()))
                            if reader.edits(word) == 1), schema)

    near = sample.where("toxic = 0").select("text").mapInArrow(run, "word string")
    found = near.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_ORDINARY)
    return [(row["word"], None) for row in found.orderBy("word").collect()]


def without_short_stems(evidence: dict[tuple[str, bool], int]) -> list[tuple[str, bool]]:
    """The entries without stems that a longer entry equals in evidence, and without stems that a kept one covers."""
    replaced = set()
    for (entry, is_stem), toxic in evidence.items():
        for n in STEMS:
            if (n < len(entry) or (n == len(entry) and not is_stem)) and toxic >= EQUAL * evidence.get((entry[:n], True), math.inf):
                replaced.add(entry[:n])
    kept: list[tuple[str, bool]] = []
    stems: set[str] = set()
    for entry, is_stem in sorted(evidence, key=lambda e: (len(e[0]), e[0], e[1])):
        if is_stem and (entry in replaced or any(entry[:n] in stems for n in STEMS)):
            continue
        kept.append((entry, is_stem))
        if is_stem:
            stems.add(entry)
    return kept


def fit(rows: np.ndarray, toxic: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights and intercept of a logistic model, by Newton's method with a ridge penalty."""
    x = np.hstack([rows, np.ones((len(rows), 1))])
    ridge = np.diag([penalty] * rows.shape[1] + [1e-3])
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (toxic - p) - ridge @ weights
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, slope)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> tuple[list[tuple[str, bool]], list[float]]:
    """The lexicon and the weights, from a bounded sample of the labelled rows given."""
    ready(docs.sparkSession)
    sample = labelled_sample(docs, labels, most)
    entries = lexicon(without_near_copies(sample))
    entries += ordinary_words(sample, entries)
    names = [f"f{k}" for k in range(FEATURES)]
    schema = pa.schema([(n, pa.float64()) for n in names] + [("toxic", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(entries)
        def seen() -> Iterator[tuple]:
            for text, toxic in column_rows(batches, "text", "toxic"):
                yield *reader.features(text), toxic
                other = reader.misspelled(text)
                if other is not None:
                    yield *reader.features(other), toxic

        return row_batches(seen(), schema)

    ddl = ", ".join(f"{n} double" for n in names) + ", toxic int"
    found = sample.select("text", "toxic").mapInArrow(run, ddl).toPandas()  # twice ``most`` rows of few numbers
    if not len(found) or not found["toxic"].gt(0).any():
        return entries, []
    return entries, fit(found[names].to_numpy(), found["toxic"].gt(0).to_numpy(float)).tolist()


def score_with(entries: list[tuple[str, bool]], weights: list[float]):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(entries)
        for batch in batches:
            if not weights:
                yield pd.Series(np.zeros(len(batch)))
                continue
            rows = np.array([reader.features(text) for text in batch]).reshape(len(batch), FEATURES)
            yield pd.Series(1 / (1 + np.exp(-(rows @ np.array(weights[:-1]) + weights[-1]))))

    return F.pandas_udf(run, "double")


def with_toxicity(docs: DataFrame, entries: list[tuple[str, bool]], weights: list[float],
                  name: str = "score") -> DataFrame:
    """``(doc_id, text)`` and the score, from the text alone."""
    ready(docs.sparkSession)
    return texts(docs).withColumn(name, score_with(entries, weights).asNondeterministic()("text"))
