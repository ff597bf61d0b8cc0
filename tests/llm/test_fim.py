"""Fill-in-the-middle against units listed one by one."""

import hashlib
import random
import re

import pytest
from helpers import docs_of
from hypothesis import given, settings
from hypothesis import strategies as st

from staylytics.llm import fim

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def plain(i, text):
    """(n, form, prefix_chars, middle_chars, output) by the definition."""
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in fim.MARKS) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    lo, hi = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if h4 % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aBz é€😀\n0<", max_size=60), st.integers(1, 9))
def test_every_unit_is_found_in_blocks_of_any_size(text, block):
    units = fim.Units(text.encode(), block)
    found = UNIT.findall(text)
    assert len(units) == len(found)
    for k in range(len(found) + 1):
        front = "".join(found[:k])
        assert units.place(k) == (len(front.encode()), len(front))


def test_a_unit_longer_than_many_blocks():
    text = "é" + "a" * 5_000_000 + " b"
    units = fim.Units(text.encode())
    assert len(units) == 4
    assert [units.place(k) for k in range(5)] == [(0, 0), (2, 1), (5_000_002, 5_000_001), (5_000_003, 5_000_002), (5_000_004, 5_000_003)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    made = ["".join(rng.choice(["ab", "C", " ", "é", "😀", "\n", "<", ">", "P"]) for _ in range(rng.randint(0, 400))) for _ in range(150)]
    return [*made, "", None, "x", "<P>", "a <S> b", "<M", "<<P", "word " * 40_000, *["the same"] * 5]


def test_rows_are_those_of_the_definition_and_texts_come_back(spark, texts):
    got = fim.transform(docs_of(spark, texts), block_bytes=16)
    rows = got.select("*", fim.restored().alias("back")).collect()
    assert len(rows) == len(texts) and {r["form"] for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        text = texts[r["doc_id"]]
        assert tuple(r)[1:6] == plain(r["doc_id"], text)
        assert r["back"] == (text or "")


def test_null_and_repeated_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "one two three"), (None, None), (4, "a b"), (4, "a b")], "doc_id long, text string")
    rows = fim.transform(df).collect()
    assert sorted(tuple(r)[1:] for r in rows) == sorted(plain(i, t) for i, t in [(None, "one two three"), (None, None), (4, "a b"), (4, "a b")])
    assert fim.transform(df.limit(0)).count() == 0
    named = df.selectExpr("cast(doc_id as string) as `my id`", "text as `my text`", "1 as output", "2 as form")
    assert fim.transform(named, "my id", "my text").columns[0] == "my id"


def test_only_the_middle_blocks_of_a_large_output_are_held(spark, monkeypatch):
    """Outputs leave in parts; ids stay beside their rows."""
    df = spark.createDataFrame([(i, f"row {i} " * 20_000) for i in range(300)], "doc_id long, text string").coalesce(1)
    rows = fim.transform(df).select("doc_id", fim.restored().alias("back")).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(300))
    assert all(r["back"] == f"row {r['doc_id']} " * 20_000 for r in rows)
