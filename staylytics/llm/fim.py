"""Fill-in-the-middle: a text is cut at two unit boundaries and its parts are put in another order.

A unit is a run of ASCII letters or any other single code point, so whether a byte begins a unit
is seen from it and the byte in front of it. Texts are handled as UTF-8 in blocks of a fixed number of bytes. A
Fenwick tree over a text's blocks holds how many units and how many code points begin in each. The place of unit ``k`` is found by
descending the tree by powers of two to the block in which that unit begins; only this block is then
looked into. The same descent adds up the code points in front.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylytics.llm.common import column_type, utf8

#: Marks in front of the prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
BLOCK_BYTES = 4096
_SPAN_BLOCKS = 256
_BATCH_BYTES = 32 << 20


def beginnings(data: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes begin a unit and which begin a code point; ``before`` is the byte in front of ``data``."""
    folded = np.empty(len(data) + 1, dtype=np.uint8)
    folded[0] = before
    folded[1:] = data
    folded |= 0x20
    letter = (folded >= ord("a")) & (folded <= ord("z"))
    point = (data & 0xC0) != 0x80
    return point & ~(letter[1:] & letter[:-1]), point


class Fenwick:
    """Prefix sums of two counts per block, found by descent."""

    def __init__(self, units: np.ndarray, points: np.ndarray):
        self.n = len(units)
        ends = np.arange(1, self.n + 1)
        starts = ends - (ends & -ends)
        sums = [np.concatenate([[0], np.cumsum(c)]) for c in (units, points)]
        self.units, self.points = ([0, *(s[ends] - s[starts]).tolist()] for s in sums)
        self.total, self.length = (int(s[-1]) for s in sums)

    def descend(self, unit: int) -> tuple[int, int, int]:
        """(block, units, points): as many whole blocks as begin ``unit`` units or fewer, and both counts over them."""
        at, units, points = 0, 0, 0
        step = 1 << self.n.bit_length()
        while step:
            to = at + step
            if to <= self.n and units + self.units[to] <= unit:
                at, units, points = to, units + self.units[to], points + self.points[to]
            step >>= 1
        return at, units, points


class Units:
    """The units of one text, found by number."""

    def __init__(self, text: bytes, block: int = BLOCK_BYTES):
        self.block = block
        self.data = np.frombuffer(text, dtype=np.uint8)
        units, points = [], []
        for at in range(0, len(self.data), block * _SPAN_BLOCKS):
            begin = beginnings(self.data[at : at + block * _SPAN_BLOCKS], self._before(at))
            edges = np.arange(0, len(begin[0]), block)
            for counts, marks in zip((units, points), begin, strict=True):
                counts.append(np.add.reduceat(marks, edges, dtype=np.int64))
        none = np.zeros(0, dtype=np.int64)
        self.tree = Fenwick(np.concatenate(units or [none]), np.concatenate(points or [none]))

    def _before(self, at: int) -> int:
        return int(self.data[at - 1]) if at else 0

    def __len__(self) -> int:
        return self.tree.total

    def place(self, unit: int) -> tuple[int, int]:
        """(byte, code points in front) where unit ``unit`` begins, counted from 0; the end of the text for the number of units."""
        if unit >= self.tree.total:
            return len(self.data), self.tree.length
        number, units, points = self.tree.descend(unit)
        at = number * self.block
        begin, first = beginnings(self.data[at : at + self.block], self._before(at))
        inside = int(np.flatnonzero(begin)[unit - units])
        return at + inside, points + int(np.count_nonzero(first[:inside]))


def draws(id_column: str, seed: int) -> list[Column]:
    """Four whole numbers below 2^32 from the digest of seed and id; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    seed: int = 1,
    percent: int = 90,
    suffix_first_percent: int = 20,
    marks: tuple[str, str, str] = MARKS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row's whole text.

    ``n`` counts the units. ``form`` is ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle; ``suffix_first_percent`` of those cut) or
    ``plain``: the text as it is, for ``100 - percent`` percent of the rows, and whenever the text is empty or holds a mark. Cuts are drawn from
    ``seed`` and id among all ``n + 1`` boundaries, both ends included, and may coincide. Lengths are in code points and null if plain.
    A null text is empty. Rows with a null id are drawn alike, and so are repeated ids. Other columns are not read, and an
    empty table gives an empty table. A task holds one text, its output and a batch of at most 32 MB of others.
    """
    begin = [m.encode() for m in marks]
    kind = column_type(docs, id_column)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [None, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        names = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]
        for batch in batches:
            first, rows, held = 0, [], 0

            def out(last: int) -> pa.RecordBatch:
                columns = [pa.array([r[k] for r in rows], types[k + 1]) for k in range(5)]
                return pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), *columns], names=names)

            draw = [batch.column(k).to_numpy() for k in range(2, 6)]
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py() or b""
                units = Units(text, block_bytes)
                n = len(units)
                h1, h2, h3, h4 = (int(d[i]) for d in draw)
                if not text or h3 % 100 >= percent or any(m in text for m in begin):
                    rows.append((n, "plain", None, None, text))
                else:
                    (lo, before), (hi, upto) = (units.place(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
                    prefix, middle, suffix = text[:lo], text[lo:hi], text[hi:]
                    if h4 % 100 < suffix_first_percent:
                        form, parts = "spm", (begin[1], suffix, begin[0], prefix, begin[2], middle)
                    else:
                        form, parts = "psm", (begin[0], prefix, begin[1], suffix, begin[2], middle)
                    rows.append((n, form, before, upto - before, b"".join(parts)))
                held += len(rows[-1][-1])
                if held >= _BATCH_BYTES:
                    yield out(i + 1)
                    first, rows, held = i + 1, [], 0
            if rows:
                yield out(batch.num_rows)

    rows = docs.select(F.col(id_column).alias("id"), utf8(text_column).alias("text"), *[d.alias(f"h{i}") for i, d in enumerate(draws(id_column, seed))])
    found = rows.mapInArrow(run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return found.select(F.col("id").alias(id_column), "n", "form", "prefix_chars", "middle_chars", F.col("output").cast("string").alias("output"))


def restored(output: str = "output", form: str = "form", marks: tuple[str, str, str] = MARKS) -> Column:
    """The text again, from output and form alone.

    Parts hold no mark, and no mark begins with what another ends with, so the first mark found is the one that was put.
    """
    out = F.col(output)

    def after(text: Column, part: Column, mark: str) -> Column:
        return F.substr(text, F.char_length(part) + F.lit(len(mark) + 1))

    def split(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substr(out, F.lit(len(first) + 1))
        one = F.substring_index(body, second, 1)
        rest = after(body, one, second)
        two = F.substring_index(rest, marks[2], 1)
        return one, two, after(rest, two, marks[2])

    prefix, suffix, middle = split(marks[0], marks[1])
    suffix_2, prefix_2, middle_2 = split(marks[1], marks[0])
    psm, spm = F.concat(prefix, middle, suffix), F.concat(prefix_2, middle_2, suffix_2)
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(out)
