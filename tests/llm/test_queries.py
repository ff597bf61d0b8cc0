"""The registered queries against their SQL, brute force or their contracts, on the given tables."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from staylytics.llm.mixing import targets
from staylytics.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    from conftest import SF_DIR

    con = duckdb.connect()
    for t in "documents embeddings conversations benchmark labels".split():
        con.execute(f"create view {t} as select * from read_parquet('{SF_DIR}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def documents():
    import pyarrow.parquet as pq
    from conftest import SF_DIR

    return {r["doc_id"]: r for r in pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    want = duck.sql(ORACLES[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    rows = sorted(tuple(r[c] for c in names) for r in got.collect())
    order = [want.columns.index(c) for c in names]
    assert rows and rows == sorted(tuple(r[i] for i in order) for r in want.fetchall())


def test_there_is_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_op3(spark, sf_dir, documents):
    rows = QUERIES["op3_language_id"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(documents)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)


def test_op4(spark, sf_dir, documents):
    rows = QUERIES["op4_mixing"](spark, sf_dir).collect()
    sizes, taken = {}, {}
    for r in rows:
        source, size = documents[r["doc_id"]]["source"], len((documents[r["doc_id"]]["text"] or "").encode().split())
        assert r["size"] == size and 0 <= r["taken"] <= 2 * size
        sizes[source] = sizes.get(source, 0) + size
        taken[source] = taken.get(source, 0) + r["taken"]
    want = targets(sizes)
    assert all(abs(r["target"] - want[documents[r["doc_id"]]["source"]]) < 1e-6 for r in rows)
    assert abs(sum(taken.values()) / sum(want.values()) - 1) < 0.05


def test_op7_fingerprints(spark, sf_dir, documents):
    from test_simhash import plain_fingerprint

    rows = QUERIES["op7_simhash_near_dedup"](spark, sf_dir).collect()
    assert len(rows) == len(documents)
    for r in rows[:60]:
        assert r["fingerprint"] == f"{plain_fingerprint(documents[r['doc_id']]['text']):016x}"
    assert all(r["component_id"] <= r["doc_id"] for r in rows)


def test_op9(spark, sf_dir, documents):
    rows = QUERIES["op9_sharding"](spark, sf_dir).collect()
    assert len(rows) == len(documents) and {r["law"] for r in rows} == {"bytes"}
    total = [0] * 40
    for r in rows:
        text = (documents[r["doc_id"]]["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["grown_shard"]) == (len(text) + 16, zlib.crc32(text), None)
        total[r["shard"]] += r["size"]
    assert sum(total) == sum(r["size"] for r in rows)


def test_op12(spark, sf_dir, documents):
    """Digests and counts of every document, by comparing all ends."""
    import sentencepiece
    from test_align import expected
    from tokenizers import Tokenizer

    from staylytics.llm.tokenizer import BYTE_VOCABULARY, PIECE_VOCABULARY

    a = Tokenizer.from_file(BYTE_VOCABULARY)
    a.encode_special_tokens = True
    encoders = a, sentencepiece.SentencePieceProcessor(model_file=PIECE_VOCABULARY)
    ids = sorted(documents)
    want = list(expected([documents[i]["text"] for i in ids], encoders))
    rows = QUERIES["op12_token_alignment"](spark, sf_dir).orderBy("doc_id").collect()
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    assert [(r["doc_id"], *[r[c] for c in names]) for r in rows] == [(i, *w[:-1]) for i, w in zip(ids, want, strict=True)]
    assert [r["groups_sha256"] for r in rows] == [hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "" for w in want]


def test_op13(spark, sf_dir, documents):
    """Every id lies in one piece, by each piece's checksum; sequences are full or a power of two."""
    import numpy as np
    from tokenizers import Tokenizer

    from staylytics.llm.tokenizer import WORD_VOCABULARY

    words = Tokenizer.from_file(WORD_VOCABULARY)
    pieces, sequences = {}, {}
    for r in QUERIES["op13_packing"](spark, sf_dir).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        ends = np.cumsum([0] + [n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == ends[:-1].tolist() and ends[-1] <= 2048 and ends[-1] & (ends[-1] - 1) == 0
    assert set(pieces) == set(documents)
    for i, parts in pieces.items():
        ids = np.array([*words.encode(documents[i]["text"] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids[at : at + r["length"]].tobytes()))
            at += r["length"]
        assert at == len(ids)


def test_pipeline_stages(spark, sf_dir, documents, tmp_path):
    """Each stage on what the one before it kept; decisions follow from the operators' own tests."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != "shards":
            assert out.schema.simpleString() == docs.schema.simpleString()
            for r in out.limit(50).collect():
                assert r.asDict() == documents[r["doc_id"]]
        kept.append((name, [r[0] for r in out.select("doc_id").collect()]))
        docs = out
    found = dict(kept)
    letters = {i for i, r in documents.items() if any(c.isalpha() for c in r["text"] or "")}
    assert set(found["language_id"]) <= letters and len(found["language_id"]) > 0.97 * len(letters)
    assert len(found["near_duplicates"]) == len(set(found["near_duplicates"])) < len(found["language_id"])
    mixed = found["mix_sources"]
    assert set(mixed) <= set(found["decontamination"]) and all(mixed.count(i) <= 2 for i in set(mixed))
    assert sorted(found["shards"]) == sorted(mixed)


def test_pipeline_on_odd_rows_and_an_empty_table(spark, sf_dir, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, component string, row string"
    rows = [(1, None, None, None, None, "x", None), (None, "", "en", "a", 0, None, "y"), (2, "the same words again", "en", "a", 20, "z", "r")]
    rows += [(2, "the same words again", "en", "a", 20, "z", "r"), (3, "12 34", "en", None, 5, None, None), (None, "the words of nobody", "en", None, 1, None, None)]
    docs = spark.createDataFrame(rows, schema)
    for start in (docs, docs.limit(0)):
        df = start
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            df = stage(spark, df, sf_dir)
            path = str(tmp_path / f"{start is docs}-{k}")
            df.write.parquet(path)
            df = spark.read.parquet(path)
        assert (df.count() > 0) == (start is docs)


def test_stages_decide_by_row_not_by_id(spark, sf_dir):
    """Rows without an id are removed like others, and an id's other text is not."""
    rng = random.Random(11)
    a, b, c, d = (" ".join("".join(rng.choice("bcdfgaeiou") for _ in range(5)) for _ in range(60)) for _ in range(4))
    rows = [(2, b), (None, b), (5, a), (5, b), (5, c), (6, c), (6, c), (None, d), (None, d), (None, None), (7, None)]
    docs = spark.createDataFrame([(i, t, "en", None, 1, "x", "k") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, k string, key string")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()]
    assert sorted(got, key=repr) == sorted([(2, b), (5, a), (5, c), (None, d), (7, None)], key=repr)
    item = next(r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("length(text) > 150").collect())
    leaks = spark.createDataFrame([(None, f"{a} {item}"), (None, a), (5, f"{b} {item}"), (5, c), (6, None), (None, None)], "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.decontamination(spark, leaks, sf_dir).collect()]
    assert sorted(got, key=repr) == sorted([(None, a), (5, c), (6, None), (None, None)], key=repr)


def test_token_counts_and_secrets_cover_every_document(spark, sf_dir, documents):
    for name in ("op5_secret_scan", "op8_token_counts", "op10_quality"):
        ids = [r[0] for r in QUERIES[name](spark, sf_dir).select("doc_id").collect()]
        assert sorted(ids) == sorted(documents)
    empty = hashlib.sha256(b"").hexdigest()
    found = QUERIES["op5_secret_scan"](spark, sf_dir)
    assert found.where((F.col("base_sha256") == empty) != (F.col("n_assign") + F.col("n_access") + F.col("n_hex") == 0)).count() == 0
