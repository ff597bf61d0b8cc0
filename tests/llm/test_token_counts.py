import random

from helpers import docs_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from staylytics.llm.token_counts import TokenTree, edited_counts, redactions
from staylytics.llm.tokenizer import encoding, read_vocabulary

BPE = encoding(read_vocabulary())
ALPHABET = "ab 1.'\n\té\u00a0\u0085\x1f"


def plain(text):
    return len(BPE.encode_ordinary(text))


@given(st.text(ALPHABET, max_size=80), st.lists(st.tuples(st.integers(0, 80), st.integers(0, 30), st.text(ALPHABET, max_size=12)), max_size=5), st.integers(1, 12))
@settings(max_examples=400, deadline=None)
def test_edits_give_the_count_of_the_new_text(text, edits, leaf):
    tree = TokenTree(text, BPE, leaf)
    assert tree.text == text and tree.tokens == plain(text)
    edits = sorted((s, s + n, new) for s, n, new in edits)
    want, last, kept = "", 0, []
    for s, e, new in edits:
        if last <= s and e <= len(text):
            kept.append((s, e, new))
            want, last = want + text[last:s] + new, e
    want += text[last:]
    again = tree.edit(edits)
    assert tree.text == want and tree.tokens == plain(want) == sum(tree.counts)
    assert (again == 0) == (not kept) or want == ""
    more = TokenTree(want, BPE, leaf, counts=tree.counts, sizes=[len(x) for x in tree.leaves])
    assert more.tokens == tree.tokens
    more.edit([(0, len(want), "")])
    assert more.tokens == 0 and more.text == ""


def test_one_edit_in_a_long_text_encodes_little():
    text = "some words and more of them. " * 4000
    tree = TokenTree(text, BPE)
    assert tree.edit([(50_000, 50_004, "other")]) < 1200
    assert tree.tokens == plain(text[:50_000] + "other" + text[50_004:])


def test_counts_of_documents(spark):
    rng = random.Random(0)
    texts = [None, "", "x", "mail a.b@c.example.com or +1 (555) 123-4567, card 1234567812345678.", "word " * 50_000, "same", "same"]
    texts += ["".join(rng.choices(ALPHABET, k=300)) for _ in range(5)]
    rows = edited_counts(docs_of(spark, texts), edits=redactions).orderBy("doc_id").collect()
    for text, r in zip(texts, rows, strict=True):
        t = text or ""
        edits, new = redactions(t), t
        for s, e, mark in reversed(edits):
            new = new[:s] + mark + new[e:]
        assert (r["n_tokens"], r["n_edits"], r["n_tokens_edited"], r["n_chars"]) == (plain(t), len(edits), plain(new), len(t))
        assert r["n_chars_again"] <= len(new)
    assert rows[3]["n_edits"] == 3
    assert edited_counts(docs_of(spark, texts).limit(0)).collect() == []


def test_edits_from_a_column(spark):
    df = spark.createDataFrame([(1, "one two three"), (None, "a b"), (3, None)], "doc_id long, text string")
    edit = F.array(F.struct(F.lit(4).alias("start"), F.lit(7).alias("end"), F.lit("seven").alias("replacement")), F.lit(None))
    rows = {r["doc_id"]: r for r in edited_counts(df.withColumn("e", F.when(F.col("doc_id") == 1, edit)), edits_column="e").collect()}
    assert rows[1]["n_tokens_edited"] == plain("one seven three") and rows[1]["n_edits"] == 1
    assert rows[None]["n_edits"] == 0 and rows[3]["n_tokens"] == 0
