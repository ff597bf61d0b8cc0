import random

import pytest
from helpers import clash, docs_of, sentence

from staylytics.llm import decontam

ITEM = "A farmer sold 12 apples to Anna for 3 euros and later Anna gave 4 apples back to the farmer near the old mill, how many are left?"


def items_of(spark, texts):
    return clash(spark.createDataFrame(list(enumerate(texts)), "item_id long, text string"))


def found(spark, docs, items, **more):
    return {(r["doc_id"], r["item_id"]): r for r in decontam.contaminated(docs_of(spark, docs), items_of(spark, items), **more).collect()}


@pytest.fixture
def filler():
    return [sentence(random.Random(k), 60) for k in range(4)]


def test_verbatim_shouted_and_embedded(spark, filler):
    docs = [ITEM, f"{filler[0]}. {ITEM} {filler[1]}", f"{filler[0]} {ITEM.upper()}", filler[2], f"{filler[0]}\n" + ITEM.replace(" ", "%%% ")]
    got = found(spark, docs, [ITEM])
    assert {d for d, _ in got} == {0, 1, 2, 4}
    assert got[0, 0]["share"] == 1.0 and got[0, 0]["at"] == 0 and got[0, 0]["reworded"] == 0
    assert got[1, 0]["at"] == 60


def test_other_numbers_and_names_are_found_if_slots_agree(spark, filler):
    new = ITEM.replace("12", "75").replace("Anna", "Peter").replace("3 euros", "9 dollars").replace("4", "30")
    mixed = new.replace("Peter gave", "Maria gave")  # one name of the item stands for two people
    copied = ITEM.replace("Anna gave", "Maria gave")  # but this is a copy with a change
    got = found(spark, [f"{filler[0]}. {new}", f"{filler[0]}. {mixed}", f"{filler[0]}. {copied}"], [ITEM])
    assert set(got) == {(0, 0), (2, 0)}
    assert got[0, 0]["reworded"] == got[0, 0]["n_slots"] == 6


def test_parts_below_the_share_and_single_changes(spark, filler):
    words = ITEM.split()
    half = " ".join(words[: len(words) // 2])
    one_off = " ".join(["zebra" if i == 2 else w for i, w in enumerate(words)])
    got = found(spark, [f"{filler[0]} {half}", f"{filler[1]} {one_off}"], [ITEM])
    assert set(got) == {(1, 0)}


def test_words_put_in_or_left_out(spark, filler):
    words = ITEM.split()
    put = " ".join([*words[:13], "quietly", *words[13:]])
    out = " ".join([*words[:15], *words[16:]])
    other = put.replace("12", "75").replace("Anna", "Mary Smith").replace("3 euros", "9 dollars")
    mixed = out.replace("12", "75").replace("to Anna", "to Peter").replace("3 euros", "9 dollars").replace("Anna gave", "Maria gave").replace("4 apples", "6 apples")
    far = f"{' '.join(words[:13])} {filler[3]} {' '.join(words[13:])}"  # the halves are farther apart than half the item
    got = found(spark, [f"{filler[0]}. {put} {filler[1]}", f"{filler[0]}. {out}", f"{filler[2]}. {other}", mixed, far], [ITEM], share=0.7)
    assert set(got) == {(0, 0), (1, 0), (2, 0)}
    assert got[0, 0]["at"] == got[1, 0]["at"] == 60 and got[0, 0]["reworded"] == got[1, 0]["reworded"] == 0
    assert got[2, 0]["n_slots"] == 6 and got[2, 0]["reworded"] == 5
    long = f"{ITEM} Then the miller took the rest of the apples home and gave each of the children the same number of them."
    words = long.split()
    texts = [" ".join([*words[:24], "quietly", *words[24:]]), " ".join([*words[:24], *words[25:]])]
    assert set(found(spark, texts, [long])) == {(0, 0), (1, 0)}


def test_names_at_the_start_of_inner_sentences(spark, filler):
    item = "Tom has 12 apples in a bag. He gives 5 of them to the old farmer. Tom then buys 7 more at the market near the river. How many apples does Tom have?"
    new = item.replace("Tom", "Ann").replace("He", "She").replace("12", "31").replace(" 5 ", " 8 ").replace(" 7 ", " 9 ")
    mixed = new.replace("Ann then", "Eve then")  # one name of the item stands for two people
    inside = new.replace("farmer. Ann", "farmer, Ann")  # a name after a comma, where the item starts a sentence
    got = found(spark, [f"{filler[0]}. {new} {filler[1]}", f"{filler[0]}. {mixed}", f"{filler[2]} {inside}", f"{filler[3]}. {item}"], [item])
    assert set(got) == {(0, 0), (2, 0), (3, 0)}
    assert got[0, 0]["share"] == 1.0 and got[0, 0]["at"] == 60 and got[0, 0]["reworded"] == 7
    assert got[3, 0]["reworded"] == 0


def test_edges_nulls_repeats_long_texts_and_many_items(spark, filler):
    long = " ".join(sentence(random.Random(9), 50) for _ in range(200)) + " " + ITEM + " " + filler[3]
    items = [ITEM, ITEM, None, "", "too short", filler[2], "1 2 3 4 5 6 7 8 9 10"]
    docs = [None, "", " ", long, f"{ITEM} {filler[0]} {ITEM}", "4 5 6 7 8 9 1 2 3 4 5 6"]
    got = found(spark, docs, items)
    assert set(got) == {(3, 0), (3, 1), (4, 0), (4, 1)}
    assert got[3, 0]["at"] == 10_000 and got[4, 0]["at"] == 0
    twice = docs_of(spark, [ITEM]).union(docs_of(spark, [ITEM]))
    assert decontam.contaminated(twice, items_of(spark, [ITEM])).count() == 1


def test_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, ITEM)], "doc_id long, text string")
    items = items_of(spark, [ITEM])
    assert decontam.contaminated(docs, items).count() == 0
    assert decontam.contaminated(docs.limit(0), items).count() == 0
    assert decontam.contaminated(docs, items.limit(0)).count() == 0


def test_large_window_tables_are_joined_by_shuffle(spark, filler, monkeypatch):
    docs = [f"{filler[0]} {ITEM}", filler[1]]
    want = {k: tuple(v) for k, v in found(spark, docs, [ITEM]).items()}
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    assert {k: tuple(v) for k, v in found(spark, docs, [ITEM]).items()} == want and want


def test_main_path_has_no_python(spark):
    plan = decontam.contaminated(docs_of(spark, [ITEM]), items_of(spark, [ITEM]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "CartesianProduct" not in plan


def test_planted_passages_against_plain_windows(spark, sf_dir):
    """Every document of the given table that holds 80 % of an item's plain word windows is found."""
    import re

    import pyarrow.parquet as pq

    def windows(text):
        words = [w.strip(decontam.SIGNS) or w for w in re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())]
        return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]

    items = {r["item_id"]: set(windows(r["text"])) for r in pq.read_table(f"{sf_dir}/benchmark.parquet").to_pylist()}
    docs = {r["doc_id"]: set(windows(r["text"])) for r in pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist()}
    want = {(d, i) for d, w in docs.items() for i, g in items.items() if g and len(g & w) >= 0.8 * len(g)}
    got = decontam.contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want and want
