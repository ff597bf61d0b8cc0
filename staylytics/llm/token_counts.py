"""Token counts that follow edits without encoding a whole text again.

A text is cut into leaves at places where one ends on a non-space and the next begins with a
space. There the pre-tokenizer always ends a pre-token, so leaves are encoded apart and their counts
add up. The counts lie in a segment tree (an array; node ``i`` is the sum of ``2i`` and ``2i + 1``). An
edit touches the leaves it overlaps, and a neighbour where it spoils the boundary between them; only those are
encoded again, and the sums above them are updated.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylytics.llm.common import column_type
from staylytics.llm.tokenizer import VOCABULARY, encoding, read_vocabulary

Edit = tuple[int, int, str]

#: Personal data that the given query takes out: mail addresses, phone numbers, 16-digit card numbers.
PERSONAL = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|\+\d{1,2} \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b")


def redactions(text: str) -> list[Edit]:
    """Edits that put a mark in the place of personal data."""
    return [(m.start(), m.end(), "[redacted]") for m in PERSONAL.finditer(text)]


class TokenTree:
    """Leaves of a text with their token counts in a segment tree."""

    def __init__(self, text: str, bpe: tiktoken.Encoding, leaf_chars: int = 256, counts: Sequence[int] | None = None, sizes: Sequence[int] | None = None):
        self.bpe, self.leaf_chars = bpe, leaf_chars
        if sizes is None:
            self.leaves = re.findall(rf"(?s:.{{{leaf_chars},}}?\S(?= )|.+\Z)", text)
        else:
            ends = list(accumulate(sizes))
            self.leaves = [text[e - n : e] for e, n in zip(ends, sizes, strict=True)]
        self.room = 1 << max(0, len(self.leaves) - 1).bit_length()
        found = list(counts) if counts is not None else [self._count(x) for x in self.leaves]
        self.tree = [0] * self.room + found + [0] * (self.room - len(found))
        for i in range(self.room - 1, 0, -1):
            self.tree[i] = self.tree[2 * i] + self.tree[2 * i + 1]

    def _count(self, text: str) -> int:
        return len(self.bpe.encode_ordinary(text))

    @property
    def tokens(self) -> int:
        return self.tree[1]

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    @property
    def counts(self) -> list[int]:
        return self.tree[self.room : self.room + len(self.leaves)]

    def _set(self, leaf: int, count: int) -> None:
        at = self.room + leaf
        self.tree[at] = count
        while at > 1:
            at //= 2
            self.tree[at] = self.tree[2 * at] + self.tree[2 * at + 1]

    def edit(self, edits: Sequence[Edit]) -> int:
        """Apply edits given in positions of the present text; the number of characters encoded again.

        Edits go in order of their start. One that begins before the end of the one before it, or
        that doesn't lie within the text, is ignored.
        """
        ends = list(accumulate(map(len, self.leaves)))
        length, last, kept = (ends[-1] if ends else 0), 0, []
        for start, end, new in sorted(edits):
            if last <= start <= end <= length:
                kept.append((start, end, new))
                last = end
        if not self.leaves and kept:
            self.__init__("".join(e[2] for e in kept), self.bpe, self.leaf_chars)
            return len(self.text)
        dirty, merged = set(), len(ends) - 1
        for start, end, new in reversed(kept):  # so that positions further left stay valid
            a = min(bisect_right(ends, start), merged)
            b = min(max(a, bisect_right(ends, max(start, end - 1))), len(ends) - 1)
            base = ends[a - 1] if a else 0
            region = "".join(self.leaves[a : b + 1])
            region = region[: start - base] + new + region[end - base :]
            while b + 1 < len(self.leaves) and not (region[-1:].strip() and self.leaves[b + 1][:1] == " "):
                b += 1
                region += self.leaves[b]
            while a > 0 and not (self.leaves[a - 1][-1:].strip() and region[:1] == " "):
                a -= 1
                region = self.leaves[a] + region
            merged = a
            self.leaves[a : b + 1] = [region, *[""] * (b - a)]
            dirty.update(range(a, b + 1))
        for i in dirty:  # once, however many edits met in a leaf
            self._set(i, self._count(self.leaves[i]) if self.leaves[i] else 0)
        return sum(len(self.leaves[i]) for i in dirty)


def edited_counts(
    docs: DataFrame,
    edits: Callable[[str], Sequence[Edit]] | None = None,
    edits_column: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    leaf_chars: int = 256,
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """(id, n_tokens, n_edits, n_tokens_edited, n_leaves, n_chars, n_chars_again) per row, over whole texts.

    Edits come from a function of the text or from an array column of (start, end, replacement); without either there are none.
    An edit without a start or end is none, and a null replacement is empty.
    ``n_chars_again`` is what had to be encoded for the edits. A null text is empty and has no tokens. Repeated rows are counted each,
    ids (null too) are passed on, other columns are not read, and an empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoding(shared.value)
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py() or ""
                if edits_column:
                    wanted = [(e["start"], e["end"], e["replacement"] or "") for e in batch.column(2)[i].as_py() or [] if None not in (e["start"], e["end"])]
                else:
                    wanted = list(edits(text)) if edits else []
                tree = TokenTree(text, bpe, leaf_chars)
                before, leaves = tree.tokens, len(tree.leaves)
                again = tree.edit(wanted) if wanted else 0
                out.append((before, len(wanted), tree.tokens, leaves, len(text), again))
            columns = [pa.array([r[k] for r in out], pa.int64()) for k in range(6)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    names = [id_column, "n_tokens", "n_edits", "n_tokens_edited", "n_leaves", "n_chars", "n_chars_again"]
    schema = f"`{id_column}` {column_type(docs, id_column)}, " + ", ".join(f"{n} long" for n in names[1:])
    extra = [F.transform(edits_column, lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"), e["replacement"].alias("replacement"))).alias("__edits")] if edits_column else []
    return docs.select(F.col(id_column), F.col(text_column).alias("__text"), *extra).mapInArrow(run, schema)
