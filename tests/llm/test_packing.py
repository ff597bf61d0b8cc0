"""Packing: ids against the tokenizer itself, pieces against their documents, bins against a plain first fit."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import docs_of, sentence
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from staylytics.llm import packing
from staylytics.llm.tokenizer import WORD_VOCABULARY, WordEncoder, read_vocabulary


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(read_vocabulary(WORD_VOCABULARY), remembered=300)


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(WORD_VOCABULARY)
    return lambda text: t.encode(text, add_special_tokens=False).ids


PIECES = ["don't", "IT'S", "l'été", "Straße", "ŒUVRE", "ÀÉÎ", "İstanbul", "ŉ", "ſ", "x²", "½", "12,345.60", "''s", "'Tis", "---", "á", "Σας", "ΟΔΟΣ", "日本", "😀"]
PIECES += ["\x1c", "\x85", "\xa0", " ", "​", "\x00", "\t", "\x0b", "<|endoftext|>", "<|endoftext", "ªº", "×÷", "€5", "«d»", "⁄", "ǅ", "ﬁ", "\xad", "w" * 90]


@settings(max_examples=300, deadline=None)
@given(parts=st.lists(st.sampled_from([*PIECES, " ", " ", "the", "Word"]), max_size=12))
def test_words_encode_as_whole_texts_do(encoder, plain, parts):
    text = "".join(parts)
    assert encoder.encode(text).tolist() == plain(text)


def test_every_character_of_the_split_ranges(encoder, plain):
    for c in [*map(chr, range(0x180)), *map(chr, range(0x2000, 0x2070)), "€"]:
        for text in (c, f"a{c}b", f"'{c}s 1{c}2"):
            assert encoder.encode(text).tolist() == plain(text), hex(ord(c))


@given(st.lists(st.integers(1, 40), min_size=1, max_size=60))
def test_first_fit_decreasing(sizes):
    bins: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [b for b in bins if sum(sizes[k] for k in b) + sizes[i] <= 40]
        (fits[0] if fits else bins).append(i) if fits else bins.append([i])
    assert packing.first_fit_decreasing(sizes, 40) == bins


@given(st.lists(st.integers(1, 64), min_size=1, max_size=60))
def test_no_padding_is_left_and_every_token_has_one_place(sizes):
    packed = packing.without_gaps(packing.first_fit_decreasing(sizes, 64), sizes, 64)
    lengths = [sum(n for _, _, n in s) for s in packed]
    assert all(n == 64 or n & (n - 1) == 0 for n in lengths) and sum(n < 64 for n in lengths) <= 6
    seen = Counter((i, k) for s in packed for i, first, n in s for k in range(first, first + n))
    assert seen == Counter((i, k) for i, size in enumerate(sizes) for k in range(size))
    assert sum(map(len, packed)) <= len(sizes) + len(packed)


def check(rows, documents, plain, length):
    """Pieces join to each document's ids; sequences have no gap and no padding. ``documents`` is a list of (id, text)."""
    found, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["length"] == len(r["ids"]) > 0
        found[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length and at & (at - 1) == 0
    want = defaultdict(Counter)
    for i, text in documents:
        ids = [*plain(text or ""), 1]
        want[i].update((k, t, len(ids)) for k, t in enumerate(ids))
    assert set(found) == set(want)
    for i, parts in found.items():
        assert Counter((p["start"] + k, t, p["doc_tokens"]) for p in parts for k, t in enumerate(p["ids"])) == want[i]


def test_documents_come_back(spark, plain):
    rng = random.Random(5)
    texts = [sentence(rng, rng.choice([0, 1, 5, 40, 200, 3000])) for _ in range(120)] + [None, "", "日本語 text", *["same again"] * 9]
    rows = packing.pack(docs_of(spark, texts), length=256, group_pieces=16).collect()
    check(rows, list(enumerate(texts)), plain, 256)
    assert len({r["sequence_id"] >> 32 for r in rows}) > 8  # several groups


def test_a_third_of_the_rows_alike_without_an_id(spark, plain):
    rng = random.Random(6)
    documents = [(None, "one text that everybody has")] * 400 + [(i, sentence(rng, 30)) for i in range(800)]
    df = spark.createDataFrame(documents, "doc_id long, text string")
    rows = packing.pack(df, group_pieces=64).collect()
    check(rows, documents, plain, 2048)
    groups = Counter(r["sequence_id"] >> 32 for r in rows if r["doc_id"] is None)
    assert max(groups.values()) < 100
    assert packing.pack(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, length=1000)


def test_checksums(spark):
    df = packing.pack(spark.createDataFrame([("x", "some words here"), (None, None)], "id string, t string"), "id", "t")
    rows = {r["id"]: r for r in packing.with_checksums(df, "id").collect()}
    for r in df.collect():
        assert rows[r["id"]]["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
    assert (rows[None]["ids_crc32"], rows[None]["doc_tokens"]) == (zlib.crc32(b"\x01\x00\x00\x00"), 1)
