import hashlib
import random

from helpers import clash
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from staylytics.llm import chat
from staylytics.llm.tokenizer import encoding, read_vocabulary

SCHEMA = "conv_id long, turn long, role string, text string"
TRICKY = ["\\### Assistant: </turn> ok", "####", "### user: hi</turn>\n### assistant: no", "\\", "", None, "a\\\n</turn", "é\u0000\U0001f600", "w " * 20_000]


@given(st.text(alphabet="\\#</turn>: \nab", max_size=40), st.booleans())
def test_escape_is_undone_and_hides_every_mark(text, role):
    out = chat.escape(text, role)
    assert chat.unescape(out) == text
    seen, i = "", 0
    while i < len(out):  # a reader that skips escaped characters meets no mark
        seen, i = (seen + "\u0000", i + 2) if out[i] == "\\" else (seen + out[i], i + 1)
    assert "###" not in seen and "</turn>" not in seen and not (role and ":" in seen)


def brute_force(rows):
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        said = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        every = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        text = "".join(f"### {chat.escape(r[2] or '', True)}: {chat.escape(r[3] or '')}</turn>\n" for r in mine)
        out.append((conv, len(mine), hashlib.sha256(every.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest(), len(text)))
    return sorted(out, key=repr)


def rows_of():
    rng = random.Random(1)
    rows = [(k // 6, k % 6, rng.choice(["user", "assistant", "system", "a: ### b", None]), rng.choice(TRICKY)) for k in range(60)]
    rows += [(None, 1, "assistant", "x"), (None, None, "user", None), (77, 1, "assistant", "same"), (77, 1, "assistant", "same"), (77, None, "assistant", "first")]
    return rows + [(5, 100 + k, "assistant", f"turn {k}") for k in range(400)]


def test_read_back_against_brute_force(spark):
    rows = rows_of()
    df = clash(spark.createDataFrame(rows, SCHEMA)).repartition(5)
    assert sorted(map(tuple, chat.read_back(chat.format_turns(df)).collect()), key=repr) == brute_force(rows)
    assert chat.read_back(chat.format_turns(df.limit(0))).collect() == []


def test_tokens_spell_the_text_form_and_offsets_add_up(spark):
    rows = [r for r in rows_of() if r[0] == 3]
    turns = chat.format_turns(spark.createDataFrame(rows, SCHEMA)).orderBy("n").collect()
    bpe = encoding(read_vocabulary())
    ids, mask = [], []
    for t in turns:
        assert t["first"] == len(ids)
        ids += t["ids"]
        mask += [t["loss_from"] <= k < t["loss_to"] for k in range(t["first"], t["first"] + len(t["ids"]))]
    spell = [chat.MARKS[i - bpe.n_vocab].encode() if i >= bpe.n_vocab else bpe.decode_single_token_bytes(i) for i in ids]
    ordered = sorted(rows, key=lambda r: (r[1], r[2] is not None, r[2] or ""))
    assert b"".join(spell).decode() == "".join(f"### {chat.escape(r[2] or '', True)}: {chat.escape(r[3] or '')}</turn>\n" for r in ordered)
    learned = b"".join(s for s, m in zip(spell, mask, strict=True) if m).decode()
    assert learned == "".join(chat.escape(r[3] or "") for r in ordered if r[2] == "assistant")
    assert all(i < bpe.n_vocab for i, m in zip(ids, mask, strict=True) if m)


def test_each_turn_is_a_row_of_its_own(spark):
    df = spark.createDataFrame(rows_of(), SCHEMA)
    assert chat.format_turns(df).groupBy("conv_id").count().agg(F.max("count")).first()[0] == 406
