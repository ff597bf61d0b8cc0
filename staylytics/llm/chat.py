"""Chat formatting by assembling tokens.

Texts are encoded segment by segment, so no merge crosses from the template into a text, and the marks
of the template are reserved ids that no text can produce. The same holds for the text form:
whatever looks like a mark inside a role or text is escaped by a backslash, and so is a backslash, which
can be undone. Offsets and the loss mask follow from prefix sums of segment lengths along a conversation.

The text form of a turn is ``### role: text</turn>`` and a line break.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylytics.llm.common import column_type
from staylytics.llm.tokenizer import VOCABULARY, encoding, read_vocabulary

#: Reserved ids follow the vocabulary: begin of a turn, between role and text, end of a turn.
MARKS = ("### ", ": ", "</turn>\n")
_IN_TEXT = re.compile(r"\\|#(?=##)|<(?=/turn>)")
_IN_ROLE = re.compile(r"\\|#(?=##)|<(?=/turn>)|:")


def escape(text: str, role: bool = False) -> str:
    """A backslash before every backslash and before everything that could be read as a mark."""
    return (_IN_ROLE if role else _IN_TEXT).sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return re.sub(r"(?s)\\(.)", r"\1", text)


def format_turns(
    turns: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    loss_role: str = "assistant",
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """(id, n, ids, first, loss_from, loss_to): the tokens of each turn and where they stand in their conversation.

    ``n`` counts the turns of a conversation from 0, by turn, role and text (nulls first); ``first`` is the offset of the turn's first
    token; tokens from ``loss_from`` up to ``loss_to`` (offsets too) are those of the text if the role is ``loss_role``, else both are ``first``. A conversation of any
    length stays spread over its turns' rows. A null role or text is empty. Repeated rows are turns of their own. Turns
    without an id form one conversation. Other columns are not read, and an empty table gives an empty table.
    """
    shared = turns.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    names = ["id", "turn", "role", "text"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoding(shared.value)
        begin, middle, end = range(bpe.n_vocab, bpe.n_vocab + 3)
        for batch in batches:
            ids, before = [], []
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                head = [begin, *bpe.encode_ordinary(escape(role or "", role=True)), middle]
                ids.append([*head, *bpe.encode_ordinary(escape(text or "")), end])
                before.append(len(head))
            columns = [*batch.columns, pa.array(ids, pa.list_(pa.int32())), pa.array(before, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "ids", "before"])

    columns = (id_column, turn_column, role_column, text_column)
    rows = turns.select(*[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)])
    schema = ", ".join(f"{n} {column_type(rows, n)}" for n in names)
    encoded = rows.mapInArrow(run, f"{schema}, ids array<int>, before long")
    order = Window.partitionBy("id").orderBy("turn", "role", "text")
    sums = order.rowsBetween(Window.unboundedPreceding, -1)
    size = F.size("ids")
    placed = encoded.select(
        F.col("id").alias(id_column),
        (F.row_number().over(order) - 1).cast("long").alias("n"),
        "ids",
        F.coalesce(F.sum(size).over(sums), F.lit(0)).alias("first"),
        "before",
        F.coalesce(F.col("role") == loss_role, F.lit(False)).alias("learned"),
    )
    start = F.when(F.col("learned"), F.col("first") + F.col("before")).otherwise(F.col("first"))
    stop = F.when(F.col("learned"), F.col("first") + F.size("ids") - 1).otherwise(F.col("first"))
    return placed.select(id_column, "n", "ids", "first", start.alias("loss_from"), stop.alias("loss_to"))


def read_back(formatted: DataFrame, id_column: str = "conv_id", vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) per conversation, from its tokens alone.

    A hash over a conversation runs through its turns in order, so one task reads a conversation; it streams,
    and holds a batch of turns and two hash states, however long the conversation is.
    """
    shared = formatted.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    names = [id_column, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kind = formatted.schema[id_column].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoding(shared.value)
        begin, middle, end = range(bpe.n_vocab, bpe.n_vocab + 3)

        def out(done: list[tuple]) -> pa.RecordBatch:
            types = [like, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(types)], names=names)

        started, conv, like, n, chars, loss_chars = False, None, None, 0, 0, 0
        every, learned = hashlib.sha256(), hashlib.sha256()
        for batch in batches:
            done, like = [], batch.column(0).type
            for at in range(batch.num_rows):
                this = batch.column(0)[at].as_py()
                if not started or this != conv:
                    if started:
                        done.append((conv, n, every.hexdigest(), loss_chars, learned.hexdigest(), chars))
                    started, conv, n, chars, loss_chars = True, this, 0, 0, 0
                    every, learned = hashlib.sha256(), hashlib.sha256()
                ids = batch.column(1)[at].values.to_numpy()
                first, lo, hi = (batch.column(k)[at].as_py() for k in (2, 3, 4))
                cut = int(np.flatnonzero(ids == middle)[0])
                if ids[0] != begin or ids[-1] != end:
                    raise ValueError("a turn must begin and end with its marks")
                role, text = (bpe.decode(part.tolist()) for part in (ids[1:cut], ids[cut + 1 : -1]))
                every.update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                if hi > lo:
                    said = unescape(bpe.decode(ids[lo - first : hi - first].tolist()))
                    learned.update(said.encode())
                    loss_chars += len(said)
                n += 1
                chars += len(role) + len(text) + sum(map(len, MARKS))
            if done:
                yield out(done)
        if started:
            yield out([(conv, n, every.hexdigest(), loss_chars, learned.hexdigest(), chars)])

    schema = f"`{id_column}` {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    rows = formatted.select(id_column, "ids", "first", "loss_from", "loss_to", "n")
    return rows.repartition(id_column).sortWithinPartitions(id_column, "n").mapInArrow(run, schema)
