"""Secrets in whole texts: fixed patterns, and strings in a sensitive context that do not compress.

The fixed patterns give the kinds ``assign``, ``access`` and ``hex``. The kind ``novel`` comes from
dictionary-primed compression. A candidate is a run of ``CANDIDATE`` characters that follows a sensitive word within
``REACH`` characters. zstandard compresses the surrounding text alone and with the candidate, primed with a
dictionary of identifiers. What the candidate adds is its novelty, taken relative to the entropy of the alphabet it
uses: a name of the dictionary or a repeat of something nearby adds little, a random key adds all of its entropy.

Names, paths and dates that the dictionary lacks do not compress either, so a candidate must also differ from its
look-alikes: strings of the same length put together from word parts, numbers and separators. ``Letters`` gives the
bits of such a reading, under the letters that follow each other in words of the corpus and of a public vocabulary. A candidate whose characters are
cheaper as random draws from its alphabet, and which so has ``LEAST_BITS`` or more, is no look-alike. Candidates at or
above ``NOVELTY`` that are none are reported, unless a span of a fixed pattern overlaps.

The identifier dictionary holds the most frequent identifiers of the corpus, and letters are counted in its most
frequent words, ``DICTIONARY`` and ``VOCABULARY`` of them at most, so both are bounded; they are counted over all
documents.

Positions are code points, ends are exclusive. A null text is an empty text and has no spans. Every row is
scanned by itself, so repeated rows, ids that are null and the size of the table do not matter. A text of any length is
scanned whole, in time that grows with it. Columns of the table are kept in one struct, so none of their names can clash.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from math import inf, log2

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from notewright.llm.base import ready, whole_row, whole_text
from notewright.llm.packing import vocabulary as default_vocabulary

# Fixed values of the base patterns, in the order that breaks ties of a start.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}

SENSITIVE = (
    r"api|auth|bearer|certificate|credential|jwt|key|license_key|login|passphrase|passwd|password|private|pwd|"
    r"secret|session|signature|ssh|token"
)
# A run of at least 8 characters that begins with a letter or digit; marks that end a sentence are not part of it.
CANDIDATE = r"(?<![^\x00-\x7F])[A-Za-z0-9][A-Za-z0-9+/_=.@#$%^&*!?~-]{6,}[A-Za-z0-9+/_=@#$%^&*~-](?![^\x00-\x7F])"
REACH = 48
AROUND = 512
NOVELTY = 0.5  # of the bits of random draws from the alphabet; a copy adds some 3 bytes, and short surroundings blur the measure
LEAST_BITS = 44  # eight random letters and digits have 47, a date and time of day to the second has fewer
DICTIONARY = 4096
VOCABULARY = 16_384
IDENTIFIER = r"[A-Za-z_][A-Za-z0-9]*(?:[_./-][A-Za-z0-9]+)+|[a-z]+[A-Z][A-Za-z0-9]+"

REDACTED = "[REDACTED]"


def identifiers(docs: DataFrame, most: int = DICTIONARY) -> list[str]:
    """The most frequent identifiers of all documents, at most ``most``; digits alone tell no name."""
    found = docs.select(F.explode(F.regexp_extract_all(whole_text(), F.lit(IDENTIFIER), F.lit(0))).alias("name"))
    found = found.where((F.length("name") <= 64) & ~F.col("name").rlike(r"[0-9].*[0-9].*[0-9]"))
    counts = found.groupBy("name").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    return [row["name"] for row in counts.orderBy(F.desc("n"), "name").limit(most).collect()]


def frequent_words(docs: DataFrame, most: int = VOCABULARY) -> list[str]:
    """The most frequent words of ASCII letters of all documents, in lower case, at most ``most``."""
    found = F.regexp_extract_all(F.lower(whole_text()), F.lit("[a-z]{3,}"), F.lit(0))
    counts = docs.select(F.explode(found).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return [r["word"] for r in counts.where("n > 1").orderBy(F.desc("n"), "word").limit(most).collect()]


def vocabulary_words(path: str) -> list[str]:
    """The words of ASCII letters in the vocabulary of a public tokenizer, in lower case."""
    tokens = Tokenizer.from_file(path).get_vocab()
    found = {t.lstrip("\u0120\u2581").lower() for t in tokens}
    return sorted(w for w in found if re.fullmatch("[a-z]{3,}", w))


def letters_of(docs: DataFrame, vocabulary: str | None = None) -> Letters:
    """Learned from the frequent words of ``docs`` and the words of a vocabulary file."""
    return Letters(frequent_words(docs) + vocabulary_words(vocabulary or default_vocabulary()))


class Letters:
    """Bits of a string as word parts, numbers and separators, and as random draws from an alphabet."""

    # Parts of a name: a capitalised or small word, capitals, a number, a separator.
    PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+|[^A-Za-z0-9]")
    # A number of up to 8 digits that stands alone, as in dates, times and versions.
    NUMBER = re.compile(r"(?<![A-Za-z0-9])[vV]?[0-9]{1,8}(?:[Tt][0-9]{1,6}[Zz]?)?(?![A-Za-z0-9])")
    ALPHABETS = tuple((re.compile(p), n) for p, n in (
        (r"[0-9]+", 10), (r"[0-9a-f]+", 16), (r"[0-9A-F]+", 16), (r"[a-z]+", 26), (r"[A-Z]+", 26),
        (r"[a-z0-9]+", 36), (r"[A-Z0-9]+", 36), (r"[A-Za-z]+", 52), (r"[A-Za-z0-9]+", 62),
    ))
    SIGNS = 2  # separators of names beside letters and digits: the two of base 64
    SEPARATOR, DIGIT, CASE = 2.0, log2(10), 1.0

    BACKOFF = 4.0  # how many counts the shorter context stands for

    def __init__(self, words: list[str]) -> None:
        self.trained = len(words) > 0  # without words there is no reading as a name
        # 0 is the edge of a word. A letter is told from the two before it, as far as words have them.
        counts = np.zeros((27, 27, 27))
        for word in words:
            places = np.array([0, 0, *(ord(c) - 96 for c in word), 0])
            np.add.at(counts, (places[:-2], places[1:-1], places[2:]), 1.0)
        pairs = counts.sum(axis=0) + 0.5
        shares = pairs / pairs.sum(axis=1, keepdims=True)
        shares = (counts + self.BACKOFF * shares) / (counts.sum(axis=2, keepdims=True) + self.BACKOFF)
        self.bits = -np.log2(shares)

    def as_name(self, text: str) -> float:
        bits = 0.0 if self.trained else inf
        for part in self.PARTS.findall(self.NUMBER.sub("-", text)):
            if part[0].isdigit():
                bits += self.DIGIT * len(part) + self.CASE
            elif not part[0].isalpha():
                bits += self.SEPARATOR
            else:
                places = np.array([0, 0, *(ord(c) - 96 for c in part.lower()), 0])
                bits += self.CASE + float(self.bits[places[:-2], places[1:-1], places[2:]].sum())
        return bits

    def like_a_name(self, text: str) -> bool:
        bits = self.as_random(text)
        return bits < LEAST_BITS or self.as_name(text) <= bits

    def as_random(self, text: str) -> float:
        """The alphabet is that of the letters and digits; separators between them are free if they are few."""
        plain = re.sub(r"[^A-Za-z0-9]", "", text)
        size = next((n for pattern, n in self.ALPHABETS if pattern.fullmatch(plain)), 62)
        signs = len(set(text) - set(plain))
        return len(text) * log2(size + max(self.SIGNS, signs) * bool(signs))


class Scanner:
    """Finds the spans of one text at a time."""

    def __init__(self, names: list[str], letters: Letters | None = None) -> None:
        fold = re.ASCII | re.IGNORECASE
        self.assign = re.compile(ASSIGN, fold)
        self.access = re.compile(ACCESS)
        # A shorter run fails the length test anyway, and a longer one is taken whole either way.
        self.hex = re.compile(r"[0-9a-f]{%d,}" % LEAST["hex"])
        self.sensitive = re.compile(SENSITIVE, fold)
        self.candidate = re.compile(CANDIDATE)
        self.letters = letters or Letters([])
        # The most frequent names come last, where matches are cheapest.
        prime = "\n".join(reversed(names)).encode("utf-8")
        if len(prime) >= 8:
            known = zstandard.ZstdCompressionDict(prime, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.packer = zstandard.ZstdCompressor(level=3, dict_data=known)
        else:
            self.packer = zstandard.ZstdCompressor(level=3)

    def base(self, text: str) -> list[tuple[int, int, str]]:
        spans, lower = [], text.lower()
        if any(word in lower for word in ("passw", "secret", "token", "api")):
            spans = [
                (m.start(), m.end(), "assign") for m in self.assign.finditer(text)
                if len(m[2]) >= LEAST["assign"]
            ]
        if "AKIA" in text:
            spans += [
                (m.start(), m.end(), "access") for m in self.access.finditer(text)
                if m.end() - m.start() >= LEAST["access"]
            ]
        return spans + [(m.start(), m.end(), "hex") for m in self.hex.finditer(text)]

    def novelty(self, text: str, start: int, end: int) -> float:
        """Bits that the string adds to the compressed text around it, as a share of those of random draws."""
        before, after = text[max(0, start - AROUND):start], text[end:end + AROUND]
        around = f"{after}\n{before}".encode("utf-8", "replace")
        candidate = text[start:end].encode("utf-8")
        added = len(self.packer.compress(around + candidate)) - len(self.packer.compress(around))
        return 8 * added / self.letters.as_random(text[start:end])

    def novel(self, text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        first = self.sensitive.search(text)
        if not first:
            return []
        found = []
        order = sorted(taken)
        starts = [start for start, _, _ in order]
        ends = list(accumulate((end for _, end, _ in order), max))
        for m in self.candidate.finditer(text):
            start, end = m.span()
            if start < first.end():
                continue
            before = bisect_left(starts, end)
            if before and ends[before - 1] > start:
                continue
            if not self.sensitive.search(text, max(0, start - REACH), start) or self.letters.like_a_name(m[0]):
                continue
            if self.novelty(text, start, end) >= NOVELTY:
                found.append((start, end, "novel"))
        return found

    def spans(self, text: str) -> str:
        found = self.base(text)
        found += self.novel(text, found)
        order = sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))
        return ",".join(f"{kind}:{start}:{end}" for start, end, kind in order)


def redacted(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with every stretch that spans cover replaced by ``REDACTED``."""
    parts, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            parts += [text[at:start], REDACTED]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def _by_text(make):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = make()
        for batch in batches:
            yield pd.Series([find(text) for text in batch], dtype=object)

    # The result is used more than once by what follows; as nondeterministic it is still computed once a row.
    return F.pandas_udf(run, "string").asNondeterministic()


def scanned(docs: DataFrame, most_identifiers: int = DICTIONARY, vocabulary: str | None = None) -> DataFrame:
    """``(row, spans)``: every row of ``docs`` as it is, and its spans ``kind:start:end``, comma-joined, by start."""
    ready(docs.sparkSession)
    names, letters = identifiers(docs, most_identifiers), letters_of(docs, vocabulary)
    scan = _by_text(lambda: Scanner(names, letters).spans)
    return docs.select(whole_row(docs), scan(whole_text()).alias("spans"))


def without_secrets(docs: DataFrame, most_identifiers: int = DICTIONARY, vocabulary: str | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, with each secret in the text replaced by ``REDACTED``.

    A text without secrets, a null one included, stays as it is; ``n_chars`` follows the new text.
    """
    ready(docs.sparkSession)
    names, letters = identifiers(docs, most_identifiers), letters_of(docs, vocabulary)

    def cleaner():
        scanner = Scanner(names, letters)

        def clean(text: str) -> str | None:
            spans = [s.split(":") for s in scanner.spans(text).split(",") if s]
            return redacted(text, [(int(start), int(end)) for _, start, end in spans]) if spans else None

        return clean

    found = docs.select(whole_row(docs), _by_text(cleaner)(whole_text()).alias("clean"))
    new = {"text": F.coalesce("clean", "row.text")}
    if "n_chars" in docs.columns:
        length = F.char_length("clean").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.coalesce(length, "row.n_chars")
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
