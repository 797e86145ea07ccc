import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from notewright.llm import packing
from notewright.llm.base import table

SF_DIR = "/root/testdata/sf0.001"
PATH = packing.vocabulary()


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=60))
def test_words_give_the_ids_of_whole_texts(plain, text):
    got = np.frombuffer(packing.word_tokenizer(PATH).ids(text), dtype="<u4").tolist()
    assert got == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [
    "", " ", "  a  b ", "x² ½\x1c\x1dy\x85z", "l'été, don't we'll", "<|endoftext|> x", "a\r\n\r\n b", "٣٤ Ⅷ ३", "_a_ __ 1_2",
])
def test_odd_texts_give_the_ids_of_whole_texts(plain, text):
    got = np.frombuffer(packing.word_tokenizer(PATH).ids(text), dtype="<u4").tolist()
    assert got == plain.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=300), st.integers(1, 8))
def test_best_fit_against_a_plain_search(lengths, most):
    packer = packing.BestFit(64, most)
    free: dict[int, int] = {}
    made = 0
    for length in lengths:
        chosen, offset = packer.place(length)
        fitting = [f for f in free.values() if f >= length]
        if fitting:
            assert free[chosen] == min(fitting)
        else:
            if len(free) == most:
                fullest = min(free.values())
                free.pop(next(b for b, f in free.items() if f == fullest and b not in _open(packer)))
            assert chosen == made
            made += 1
            free[chosen] = 64
        assert offset == 64 - free[chosen]
        free[chosen] -= length
        if not free[chosen]:
            del free[chosen]


def _open(packer):
    return {b for bins in packer.by_free for b in bins}


def check_packed(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_whole_table_is_packed(spark, plain):
    docs = table(spark, SF_DIR, "documents")
    rows = packing.pack_documents(docs, PATH, 256, with_ids=True).collect()
    want = {r["doc_id"]: plain.encode(r["text"] or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["piece"])):
        ids = np.frombuffer(r["ids"], dtype="<u4").tolist()
        assert r["start"] == len(got[r["doc_id"]]) and r["length"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(r["ids"]) and (r["piece"] == 0 or len(ids) == 256)
        got[r["doc_id"]] += ids
    assert got == want
    sequences = check_packed(rows, 256)
    least = -(-sum(map(len, want.values())) // 256)
    assert sequences <= 1.03 * least + 1


def test_sequences_hold_their_pieces(spark):
    docs = table(spark, SF_DIR, "documents").limit(20)
    packed = packing.pack_documents(docs, PATH, 128, with_ids=True)
    rows = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        whole = rows[r["sequence_id"]]["ids"]
        assert whole[4 * r["offset"]:4 * (r["offset"] + r["length"])] == r["ids"]


def test_odd_rows(odd_documents, no_documents):
    rows = packing.pack_documents(odd_documents, PATH).collect()
    check_packed(rows, 2048)
    firsts = [r for r in rows if r["piece"] == 0]
    assert len(firsts) == 11
    assert sum(r["length"] == 1 and r["ids_crc32"] == zlib.crc32(b"\0\0\0\0") for r in rows) == 3
    assert {r["doc_id"] for r in rows} == {1, 2, 3, 4, 5, 6, 7, None, 9_007_199_254_740_993}
    assert packing.pack_documents(no_documents, PATH).count() == 0
