"""Packing documents into sequences of fixed length.

Texts are encoded once and cut into pieces of the sequence length; whole pieces are sequences already. The last
piece of each document is dealt to one of many random groups of a bounded number of pieces. In a group, pieces
go by falling length into the first bin with room. A tournament tree over the bins' capacities finds it: every inner node holds the
largest capacity below it, so walking down from the root, left where the left half has room, leads to the first.

What padding is left is then cut away: the emptiest bins are given up, their pieces fill the gaps of the fuller ones, and the one bin that may
stay unfilled is cut into lengths that are powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylytics.llm.common import column_type, utf8
from staylytics.llm.tokenizer import WORD_VOCABULARY, read_vocabulary, tokenizer, word_encoder
from staylytics.sources import materialize

_BATCH_TOKENS = 1 << 20
#: Between stages the ids of a piece are one binary value, which costs a copy where an array costs a loop; two bytes an id where all ids fit.
_PACKED = (np.dtype("<u2"), np.dtype("<u4"))


def packed_type(vocabulary: bytes, end: int) -> np.dtype:
    return _PACKED[max(tokenizer(vocabulary).get_vocab_size(), end + 1) > 1 << 16]



#: (piece, first token in the piece, tokens)
Part = tuple[int, int, int]


class Tournament:
    """Capacities of bins; finds the first bin with enough room."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def put(self, size: int) -> int:
        """Takes ``size`` from the first bin that has it and returns that bin; there must be one."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        found = at - self.leaves
        room[at] -= size
        at //= 2
        while at:
            best = max(room[2 * at], room[2 * at + 1])
            if room[at] == best:
                break
            room[at] = best
            at //= 2
        return found


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers; equal sizes keep their order."""
    tree = Tournament(len(sizes), capacity)
    bins: list[list[int]] = []
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = tree.put(sizes[item])
        if at == len(bins):
            bins.append([])
        bins[at].append(item)
    return bins


def without_gaps(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[Part]]:
    """The same items in full sequences, but for at most one, which is cut into powers of two.

    The fullest bins stay; the items of the others fill their gaps, cut where they don't fit.
    """
    order = sorted(bins, key=lambda b: -sum(sizes[i] for i in b))
    full = sum(sizes) // capacity
    out: list[list[Part]] = [[(i, 0, sizes[i]) for i in b] for b in order[:full]]
    loose: list[Part] = [(i, 0, sizes[i]) for b in order[full:] for i in b]
    loose.reverse()

    def fill(sequence: list[Part], room: int) -> None:
        while room and loose:
            item, start, n = loose.pop()
            sequence.append((item, start, min(n, room)))
            if n > room:
                loose.append((item, start + room, n - room))
            room -= min(n, room)

    for sequence in out:
        fill(sequence, capacity - sum(n for _, _, n in sequence))
    left = sum(n for _, _, n in loose)
    while left:
        size = 1 << (left.bit_length() - 1)
        out.append([])
        fill(out[-1], size)
        left -= size
    return out


def encoded_pieces(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = 2048, end: int = 1, vocabulary: str = WORD_VOCABULARY
) -> DataFrame:
    """(row, id, start, doc_tokens, n, ids): each text's ids and the id ``end``, cut after every ``length``; ids as packed bytes, see ``_PACKED``.

    ``row`` is different for every piece of one run; write the table before using it twice. A null text has the one id ``end``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    packed = packed_type(shared.value, end)
    kind = column_type(docs, id_column)
    names = ["row", "id", "start", "doc_tokens", "n", "ids"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = word_encoder(shared.value), TaskContext.get().partitionId() << 40
        for batch in batches:
            of, starts, totals, ids, held = [], [], [], [], 0

            def out() -> pa.RecordBatch:
                sizes = np.array([len(p) for p in ids], dtype=np.int32)
                columns = [
                    pa.array(np.arange(row - len(ids), row)),
                    batch.column(0).take(pa.array(of, pa.int64())),
                    pa.array(starts, pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array(sizes),
                    pa.array([p.astype(packed).tobytes() for p in ids], pa.binary()),
                ]
                return pa.RecordBatch.from_arrays(columns, names=names)

            for i, value in enumerate(batch.column(1)):
                tokens = np.append(encoder.encode((value.as_py() or b"").decode("utf-8", "replace")), np.int32(end))
                for at in range(0, len(tokens), length):
                    of.append(i)
                    starts.append(at)
                    totals.append(len(tokens))
                    ids.append(tokens[at : at + length])
                    row, held = row + 1, held + len(ids[-1])
                    if held >= _BATCH_TOKENS:
                        yield out()
                        of, starts, totals, ids, held = [], [], [], [], 0
            if ids:
                yield out()

    rows = docs.select(F.col(id_column).alias("id"), utf8(text_column).alias("text"))
    return rows.mapInArrow(run, f"row long, id {kind}, start long, doc_tokens long, n int, ids binary")


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = 2048,
    end: int = 1,
    group_pieces: int = 512,
    seed: int = 7,
    vocabulary: str = WORD_VOCABULARY,
) -> DataFrame:
    """(id, start, length, ids, doc_tokens, sequence_id, offset): every id of every document in exactly one piece.

    ``start`` counts the document's ids before the piece, ``offset`` the sequence's. ``doc_tokens`` is the document's number of ids with its ``end``.
    A sequence is ``length`` ids long or a power of two, so that nothing is padded. Groups hold about ``group_pieces`` pieces and become more with
    the table; they are drawn by the number of a row, so a third of all rows with one id or text spreads like any others. A null text is
    one id. Rows with null or repeated ids are documents of their own. Other columns are not read, and an empty table gives
    an empty table. A task holds one text or one group.
    """
    if length < 1 or length & (length - 1):
        raise ValueError("length must be a power of two")
    kind, packed_ids = column_type(docs, id_column), packed_type(read_vocabulary(vocabulary), end)
    rows = materialize(encoded_pieces(docs, id_column, text_column, length, end, vocabulary), "pieces")
    whole, rest = rows.where(F.col("n") == length), rows.where(F.col("n") < length)
    groups = max(1, -(-rest.count() // group_pieces))
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("row")
        sizes = table.column("n").to_pylist()
        packed = without_gaps(first_fit_decreasing(sizes, length), sizes, length)
        parts = np.array([(*part, s) for s, sequence in enumerate(packed) for part in sequence], dtype=np.int64)
        item, first, n, sequence = parts.T
        values = np.frombuffer(b"".join(table.column("ids").to_pylist()), dtype=packed_ids).astype(np.int32)
        at = np.cumsum(sizes) - sizes
        ends = np.cumsum(n)
        offset = ends - n
        new = np.append(True, sequence[1:] != sequence[:-1])
        base = offset[new][np.cumsum(new) - 1]
        ids = np.concatenate([values[s : s + k] for s, k in zip(at[item] + first, n, strict=True)])
        columns = [
            table.column("id").take(pa.array(item)),
            pa.array(table.column("start").to_numpy()[item] + first),
            pa.array(n),
            pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids)),
            table.column("doc_tokens").take(pa.array(item)),
            pa.array((table.column("grp").to_numpy()[item] << 32) + sequence),
            pa.array(offset - base),
        ]
        return pa.Table.from_arrays(columns, names=names)

    schema = f"id {kind}, start long, length long, ids array<int>, doc_tokens long, sequence_id long, offset long"
    dealt = rest.withColumn("grp", F.expr(f"pmod(xxhash64(row, {int(seed)}), {groups}L)"))
    packed = dealt.groupBy("grp").applyInArrow(run, schema)

    def single(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole pieces: sequences of their own, numbered after all others."""
        for batch in batches:
            n = np.full(batch.num_rows, length, dtype=np.int64)
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), dtype=packed_ids).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array((np.arange(len(n) + 1) * length).astype(np.int32)), pa.array(ids))
            number = pa.array(batch.column("row").to_numpy() + (1 << 62))
            columns = [batch.column("id"), batch.column("start"), pa.array(n), lists, batch.column("doc_tokens"), number, pa.array(n * 0)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    ready = whole.mapInArrow(single, schema)
    return ready.union(packed).withColumnRenamed("id", id_column)


def with_checksums(packed: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The packed pieces with ``ids_crc32`` (of the ids as little-endian unsigned 32-bit numbers) in place of ``ids``."""
    names = [id_column, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            values, at = lists.values.to_numpy().astype("<u4"), lists.offsets.to_numpy()
            sums = [zlib.crc32(values[s:e].tobytes()) for s, e in zip(at[:-1], at[1:], strict=True)]
            columns = [*batch.columns[:3], pa.array(sums, pa.int64()), *batch.columns[4:]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{id_column}` {column_type(packed, id_column)}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return packed.select(id_column, "start", "length", "ids", "doc_tokens", "sequence_id", "offset").mapInArrow(run, schema)
