import random
import zlib

from helpers import docs_of, sentence
from pyspark.sql import functions as F

from staylytics.llm import sharding


def run(df, **more):
    return sharding.shard(df, **more).collect()


def gapless(rows):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_bytes_are_near_equal_and_copies_stay_together(spark):
    rng = random.Random(0)
    texts = [sentence(rng, rng.randint(5, 60)) for _ in range(900)]
    texts += [texts[k] for k in range(60) for _ in range(2)] + ["the same text again"] * 300
    source = [rng.choice(["hot", "hot", "a", "b"]) for _ in texts]
    rows = run(docs_of(spark, texts, source=source, lang=[rng.choice(["en", "de"]) for _ in texts]), shards=10)
    assert len(rows) == len(texts)
    gapless(rows)
    sizes = [0] * 10
    for r in rows:
        text = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 16, zlib.crc32(text))
        sizes[r["shard"]] += r["size"]
    assert max(sizes) - min(sizes) < 0.25 * sum(sizes) / 10
    shards = {}
    for r in rows:
        shards.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    assert all(len(s) == 1 for t, s in shards.items() if t != "the same text again")


def test_edges(spark):
    texts = [None, "", "é" * 3, "x" * 200_000, None, ""]
    docs = docs_of(spark, texts, lang=[None, "en", "de", None, None, "en"], source=[None] * 6)
    rows = run(docs.union(docs))
    assert len(rows) == 12 and all(0 <= r["shard"] < 40 for r in rows)
    gapless(rows)
    assert {r["doc_id"]: r["size"] for r in rows} == {0: 16, 1: 16, 2: 22, 3: 200_016, 4: 16, 5: 16}
    assert {r["text_crc32"] for r in rows if r["doc_id"] in (0, 1)} == {0}
    assert run(docs.limit(0)) == []


def test_leaves_by_target_bytes_and_one_shard(spark):
    texts = [sentence(random.Random(k), 30) for k in range(200)]
    total = sum(len(t) + 16 for t in texts)
    rows = run(docs_of(spark, texts), shards=None, target_bytes=total // 5)
    assert len({r["shard"] for r in rows}) in (5, 6)
    assert {r["shard"] for r in run(docs_of(spark, texts), shards=1)} == {0}


def test_one_text_of_all_rows_is_dealt_out(spark):
    rows = run(docs_of(spark, ["one and the same"] * 400), shards=8)
    counts = [sum(r["shard"] == s for r in rows) for s in range(8)]
    assert min(counts) > 25 and max(counts) < 80


def test_copies_without_ids_or_of_one_id_are_dealt(spark):
    """A third of the bytes each: one text without ids, one text of one id, and others."""
    rng = random.Random(3)
    texts = ["no id at all"] * 1500 + ["always the same"] * 1500 + [sentence(rng, rng.randint(3, 8)) for _ in range(900)]
    ids = F.when(F.col("doc_id") < 1500, None).when(F.col("doc_id") < 3000, 7).otherwise(F.col("doc_id")).cast("long")
    rows = run(docs_of(spark, texts, lang=["en"] * len(texts), source=["s"] * len(texts)).withColumn("doc_id", ids), shards=10)
    assert len(rows) == len(texts)
    gapless(rows)
    sizes = [0] * 10
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert max(sizes) - min(sizes) < 0.3 * sum(sizes) / 10
