"""Secret scans: three fixed patterns, and strings that stay incompressible in a sensitive context.

A candidate is a long string of the alphabet of keys shortly after a word such as key, secret or
password. Its novelty is the number of bytes it adds to the compressed size of its surroundings, with a zstandard
dictionary primed with identifiers of the corpus: names, paths and repeated identifiers add few, random
strings add about what their alphabet carries. Identifiers are counted over all texts; the dictionary holds the most frequent
of them up to a fixed size, which zstandard itself has too.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylytics.llm.common import column_type, compiled_ascii

#: Fixed patterns and least lengths of the base kinds, in order.
ASSIGN = compiled_ascii(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "novel")

_IDENTIFIER = re.compile(r"(?a:\b[A-Za-z][A-Za-z0-9]*(?:[_.\-/][A-Za-z0-9]+)+\b)")
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
_SENSITIVE = compiled_ascii(r"passw|passwd|secret|token|api_?key|private|credential|bearer|authoriz|access_?key|signature|\bkey\b|\bauth\b|\bpwd\b")

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the base kinds by start, then kind; code points, end exclusive.

    A run of 16 or more hexadecimal digits is a whole match of the digits' pattern that is long enough, and likewise for
    access keys. An assignment is matched whatever its value's length and dropped after, for what it covers is not searched again.
    """
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


class Novelty:
    """Marginal compressed bytes of a string against its surroundings and a dictionary."""

    def __init__(self, dictionary: bytes, context: int = 160, reach: int = 40, share: float = 0.6):
        primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(dictionary) >= 8 else None
        self.compressor = zstandard.ZstdCompressor(level=9, dict_data=primed, write_checksum=False, write_content_size=False)
        self.context, self.reach, self.share = context, reach, share

    def marginal(self, before: str, candidate: str, after: str) -> int:
        around = (before + after).encode("utf-8", "replace")
        return len(self.compressor.compress(around + candidate.encode())) - len(self.compressor.compress(around))

    def spans(self, text: str, taken: list[Span]) -> list[Span]:
        """Incompressible candidates in a sensitive context that touch no span already found (``taken``, in order of start).

        Both lists are walked once, side by side: a candidate touches a span if one that starts before its end reaches beyond its start.
        """
        out, at, reached = [], 0, 0
        for m in _CANDIDATE.finditer(text):
            start, end = m.span()
            while at < len(taken) and taken[at][0] < end:
                reached = max(reached, taken[at][1])
                at += 1
            if reached > start or not _SENSITIVE.search(text, max(0, start - self.reach), start):
                continue
            word = m.group()
            if not (any(c.isdigit() for c in word) and any(c.isalpha() for c in word)):
                continue
            if self.marginal(text[max(0, start - self.context) : start], word, text[end : end + self.context]) >= self.share * len(word):
                out.append((start, end, "novel"))
        return out


def identifier_dictionary(docs: DataFrame, text_column: str = "text", dictionary_bytes: int = 32_768, longest: int = 256) -> bytes:
    """The most frequent identifiers of all texts, the most frequent last (nearest to what is compressed), up to a size.

    An identifier that no longer fits is passed over for shorter ones. Those of over ``longest`` characters are left out: one of them
    would fill a good part of the dictionary, and what comes to the driver stays bounded.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

        found: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0):
                found.update(_IDENTIFIER.findall(text.as_py() or ""))
                if len(found) > 100_000:
                    yield out()
                    found = Counter()
        yield out()

    counts = docs.select(F.col(text_column)).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # the shortest identifier has 3 bytes and a separator
    best = counts.where((F.col("n") > 1) & (F.length("word") <= longest)).orderBy(F.desc("n"), "word").limit(dictionary_bytes // 4).collect()
    words, size = [], 0
    for r in best:
        own = len(r["word"].encode()) + 1
        if size + own <= dictionary_bytes:
            size += own
            words.append(r["word"])
    return "\n".join(reversed(words)).encode()


def scan(docs: DataFrame, dictionary: bytes | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, spans array of (start, end, kind)) per row, over whole texts; base kinds first found, novel strings added.

    Spans are in order of their start, then of their kind. Without a ``dictionary`` one is counted from these texts. A null or
    empty text has no spans. Repeated rows are scanned each, ids (null too) are passed on, other columns are not read, and
    an empty table gives an empty table.
    """
    primed = identifier_dictionary(docs, text_column) if dictionary is None else dictionary

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(primed)
        item = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        for batch in batches:
            rows = []
            for value in batch.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                every = sorted([*base, *novelty.spans(text, base)], key=lambda s: (s[0], KINDS.index(s[2])))
                rows.append([{"start": s, "end": e, "kind": k} for s, e, k in every])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, item)], names=[id_column, "spans"])

    schema = f"`{id_column}` {column_type(docs, id_column)}, spans array<struct<start: long, end: long, kind: string>>"
    return docs.select(F.col(id_column), F.col(text_column).alias("__text")).mapInArrow(run, schema)


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans as text) of scanned documents."""

    def text(spans: str, base: bool) -> Column:
        kept = F.filter(spans, lambda s: s["kind"] != "novel") if base else F.col(spans)
        return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS[:3]]
    return found.select(id_column, *counts, F.sha2(text("spans", True), 256).alias("base_sha256"), text("spans", False).alias("spans"))
