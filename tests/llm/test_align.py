"""Alignment of two tokenizers against groups and pairs listed one by one."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from helpers import docs_of, sentence
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from staylytics.llm import align
from staylytics.llm.tokenizer import BYTE_VOCABULARY, PIECE_VOCABULARY, byte_level_encoding, read_vocabulary


@pytest.fixture(scope="module")
def encoders():
    a = Tokenizer.from_file(BYTE_VOCABULARY)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE_VOCABULARY)


def byte_level():
    """The 256 characters of byte-level vocabularies, as everyone writes them."""
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + n): b for n, b in enumerate(others)}


BYTES = byte_level()


def groups_of(text, encoders):
    """[(ids of A, ids of B)] by comparing all ends."""
    a, b = encoders
    raw = b" " + (text or "").encode()
    if not text:
        return []
    tokens = []
    for i in a.encode(" " + text, add_special_tokens=False).ids:
        tokens.append((i, bytes(BYTES[c] for c in a.id_to_token(i))))
    others = []
    for i in b.encode(text):
        name = b.id_to_piece(i)
        others.append((i, bytes([int(name[3:5], 16)]) if len(name) == 6 and name.startswith("<0x") else name.replace("▁", " ").encode()))
    if b"".join(t for _, t in tokens) != raw or b"".join(t for _, t in others) != raw:
        return []
    ends = [set(np.cumsum([len(t) for _, t in side]).tolist()) for side in (tokens, others)]
    cuts = sorted(ends[0] & ends[1])
    out, at = [([], []) for _ in cuts], 0
    for k, side in enumerate((tokens, others)):
        at, g = 0, 0
        for i, t in side:
            at += len(t)
            out[g][k].append(i)
            g += at == cuts[g]
    return out


def expected(texts, encoders):
    every = [groups_of(t, encoders) for t in texts]
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in every]
    held = Counter(p for c in links for p in c)
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    for groups, c in zip(every, links, strict=True):
        form = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        n_best = sum(k for p, k in c.items() if held[p] == best[p[0]])
        yield (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), c.total(), n_best, sum(k * held[p] for p, k in c.items()), form)


def test_byte_level_ids_are_those_of_the_vocabulary_file(encoders):
    """Characters of every script, beside letters, digits, spaces and each other."""
    fast = byte_level_encoding(read_vocabulary(BYTE_VOCABULARY))
    points = [*range(0x3000), *range(0x3000, 0xD800, 37), *range(0xE000, 0x20000, 53), *range(0x20000, 0x110000, 4099)]
    texts = [f"a{c}b {c}1{c} {c}{c}  's" for c in map(chr, points)]
    for text, found in zip(texts, encoders[0].encode_batch_fast(texts, add_special_tokens=False), strict=True):
        assert fast.encode_ordinary(text) == found.ids, text


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    words = ["the", "Straße", "日本語", "😀😀", "  ", "\n\n\n", "=" * 37, "x" * 50, "1234567", "don't", "<s>", "<|endoftext|>", "é", "á", "\t", "-" * 23 + ">", "ﬁ", "▁", "\x00"]
    made = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    made += [sentence(rng, rng.randint(1, 300)) for _ in range(40)] + [" lead", "trail ", " ", "▁", "a▁b", "same text", "same text", "", None]
    return [*made, sentence(rng, 6000), "=" * 3001, "ab" * 700 + "\U0001f9ea" * 300]


@pytest.mark.parametrize("common", [1 << 19, 20, 0])
def test_rows_are_those_of_the_definition(spark, texts, encoders, common):
    got = align.score(docs_of(spark, texts), common_pairs=common).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == list(expected(texts, encoders))
    assert sum(r["n_groups"] == 0 for r in got) < 70


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 4), min_size=1, max_size=30), st.lists(st.integers(1, 4), min_size=1, max_size=30)), max_size=5), st.integers(1, 40))
def test_lockstep_meets_every_cut_and_every_overlap(documents, stretch):
    flat_a, flat_b, first = [], [], [0]
    for a, b in documents:
        a, b = list(a), list(b)
        gap = sum(a) - sum(b)
        (b if gap > 0 else a).extend([abs(gap)] if gap else [])
        flat_a += a
        flat_b += b
        first.append(len(flat_a))
    ends_a, ends_b = np.cumsum(flat_a, dtype=np.int64), np.cumsum(flat_b, dtype=np.int64)
    links_a, links_b, cut_a, cut_b = align.lockstep(ends_a, ends_b, np.array(first), stretch)
    assert ends_a[cut_a].tolist() == sorted(set(ends_a) & set(ends_b)) == ends_b[cut_b].tolist()
    over = {(i, j) for i in range(len(flat_a)) for j in range(len(flat_b)) if max(ends_a[i] - flat_a[i], ends_b[j] - flat_b[j]) < min(ends_a[i], ends_b[j])}
    assert len(links_a) == len(over) and set(zip(links_a.tolist(), links_b.tolist(), strict=True)) == over


def test_a_group_of_many_tokens_on_both_sides_counts_all_pairs():
    n = 700
    ids = np.arange(n) % 5
    group, a, b, times = align.all_links(ids, ids, (np.arange(n), np.arange(n)), (np.array([n - 1]), np.array([n - 1])))
    assert len(a) == 25 and times.sum() == n * n and set(group) == {0}


def test_digest_null_ids_and_empty_tables(spark, encoders):
    df = spark.createDataFrame([(None, "one two"), (None, "one two"), (3, None), (3, "one two")], "doc_id long, text string")
    rows = align.score(df, digest=True).collect()
    form = list(expected(["one two"], encoders))[0][-1]
    assert sorted(r["groups"] for r in rows) == sorted(["", *[hashlib.sha256(form.encode()).hexdigest()] * 3])
    assert {r["count_sum"] // max(1, r["n_links"]) for r in rows} == {0, 3}
    assert align.score(df.limit(0)).count() == 0
