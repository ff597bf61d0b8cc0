"""Alignment of two tokenizers over the same bytes.

Both tokenizers encode a text; wherever tokens of both end at the same byte, the text is cut, and tokens
between two cuts form a group, all of whose tokens of one side are linked with all of the other.

The two sequences of ends are merged for all documents of a batch at once. The state is one pair of NumPy vectors: for each
unfinished stretch of a document the token of A and the token of B under its pointers. A step emits the link of the two
tokens (they share bytes) and, where their ends agree, a cut; it moves the pointer whose token ends first, or both, and
drops stretches that are done. A long document is several stretches, so the number of steps does not depend on its length. Links of
tokens in one group that share no byte exist only where a group has two or more tokens on both sides; they are added after the steps.

Encoding happens once: digests and each document's distinct id pairs are staged. Documents per pair are counted from there with partial sums. The
pairs held by most documents, a bounded number of them, go to every task; the others are rare and are looked up by a shuffle on the
pair, so neither a pair that is everywhere nor a vocabulary of any size fills a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylytics.llm.common import column_type, utf8
from staylytics.llm.tokenizer import BYTE_VOCABULARY, PIECE_VOCABULARY, byte_level_encoding, byte_level_tokens, piece_tokens, pieces, read_vocabulary, runs
from staylytics.sources import materialize

_BATCH_BYTES = 2 << 20
_LARGE_GROUP = 1 << 16


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, stretch: int = 256) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(link_a, link_b, cut_a, cut_b) as token numbers: links of tokens that share bytes, and the last tokens of each group, in order.

    ``ends_a`` and ``ends_b`` are the ends of all documents' tokens, document after document, rising throughout, and equal
    at the end of every document; ``first_a`` has the number of each document's first token of A, and their total at the end.
    """
    sizes = np.diff(first_a)
    lanes = -(-sizes // stretch)
    document = np.repeat(np.arange(len(sizes)), lanes)
    i = first_a[document] + stretch * (np.arange(len(document)) - np.repeat(np.cumsum(lanes) - lanes, lanes))
    stop = np.minimum(i + stretch, first_a[document + 1])
    before = np.where(i > 0, ends_a[i - 1], 0)
    j = np.searchsorted(ends_b, before, side="right")
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(i):
        a, b = ends_a[i], ends_b[j]
        step_a, step_b = a <= b, b <= a
        cut = step_a & step_b
        links_a.append(i)
        links_b.append(j)
        cuts_a.append(i[cut])
        cuts_b.append(j[cut])
        i, j = i + step_a, j + step_b
        going = i < stop
        if not going.all():
            i, j, stop = i[going], j[going], stop[going]
    if not cuts_a:
        return (np.zeros(0, dtype=np.int64),) * 4
    cut_a, cut_b = np.concatenate(cuts_a), np.concatenate(cuts_b)
    order = np.argsort(cut_a)
    return np.concatenate(links_a), np.concatenate(links_b), cut_a[order], cut_b[order]


def all_links(
    ids_a: np.ndarray, ids_b: np.ndarray, links: tuple[np.ndarray, np.ndarray], cuts: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(group, id of A, id of B, times) of all links; a link occurs in several rows, whose times add up."""
    cut_a, cut_b = cuts
    start_a, start_b = np.append(0, cut_a[:-1] + 1), np.append(0, cut_b[:-1] + 1)
    n_a, n_b = cut_a + 1 - start_a, cut_b + 1 - start_b
    both = (n_a > 1) & (n_b > 1)
    group = np.repeat(np.arange(len(cut_a)), n_a)[links[0]]
    direct = ~both[group]
    out = [(group[direct], ids_a[links[0][direct]], ids_b[links[1][direct]], np.ones(np.count_nonzero(direct), dtype=np.int64))]
    many = np.flatnonzero(both & (n_a * n_b <= _LARGE_GROUP))
    products = np.cumsum(n_a[many] * n_b[many])
    for part in np.split(many, np.searchsorted(products, np.arange(1 << 20, int(products[-1]) if len(many) else 0, 1 << 20))):
        if len(part):
            a = runs(start_a[part], n_a[part])
            across = np.repeat(n_b[part], n_a[part])
            b = runs(np.repeat(start_b[part], n_a[part]), across)
            out.append((np.repeat(part, n_a[part] * n_b[part]), np.repeat(ids_a[a], across), ids_b[b], np.ones(len(b), dtype=np.int64)))
    for g in np.flatnonzero(both & (n_a * n_b > _LARGE_GROUP)):
        (a, times_a), (b, times_b) = (
            np.unique(ids[s : s + n], return_counts=True) for ids, s, n in ((ids_a, start_a[g], n_a[g]), (ids_b, start_b[g], n_b[g]))
        )
        out.append((np.full(len(a) * len(b), g), np.repeat(a, len(b)), np.tile(b, len(a)), np.outer(times_a, times_b).ravel()))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


class Aligner:
    """Encodes and aligns a list of texts."""

    def __init__(self, vocabulary_a: bytes, vocabulary_b: bytes):
        self.a, self.b = byte_level_encoding(vocabulary_a), pieces(vocabulary_b)
        self.bytes_a, self.bytes_b = byte_level_tokens(vocabulary_a), piece_tokens(vocabulary_b)
        self.size_a, self.size_b = (np.array([len(t) for t in tokens]) for tokens in (self.bytes_a, self.bytes_b))
        # each id's decimal form before a further one, and before the bar or semicolon
        self.text_a = np.array([b"%d," % i for i in range(len(self.bytes_a))] + [b"%d|" % i for i in range(len(self.bytes_a))], dtype=object)
        self.text_b = np.array([b"%d," % i for i in range(len(self.bytes_b))] + [b"%d;" % i for i in range(len(self.bytes_b))], dtype=object)

    def encode(self, raws: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and B of each text, both empty where the joined bytes of either are not a space and the text."""
        texts = [raw.decode("utf-8", "replace") for raw in raws]
        ids_a = [self.a.encode_ordinary(" " + t) for t in texts]
        ids_b = self.b.encode(texts, num_threads=1)
        for k, raw in enumerate(raws):
            want = b" " + raw
            if not raw or b"".join(map(self.bytes_a.__getitem__, ids_a[k])) != want or b"".join(map(self.bytes_b.__getitem__, ids_b[k])) != want:
                ids_a[k], ids_b[k] = [], []
        return ids_a, ids_b

    def align(self, raws: list[bytes]) -> dict[str, list | np.ndarray]:
        """Per text n_a, n_b, n_groups, n_links, its groups as bytes, and its distinct pairs (id of A x size of B's vocabulary + id of B) with their times."""
        encoded = self.encode(raws)
        (flat_a, first_a), (flat_b, first_b) = (
            (np.fromiter(chain.from_iterable(side), dtype=np.int64), np.concatenate([[0], np.cumsum([len(ids) for ids in side])])) for side in encoded
        )
        ends_a, ends_b = np.cumsum(self.size_a[flat_a]), np.cumsum(self.size_b[flat_b])
        links_a, links_b, cut_a, cut_b = lockstep(ends_a, ends_b, first_a)
        n = len(raws)
        first_cut = np.searchsorted(cut_a, first_a)
        last_of = np.searchsorted(first_a, cut_a, side="right") - 1  # document of each group

        group, a, b, times = all_links(flat_a, flat_b, (links_a, links_b), (cut_a, cut_b))
        width = len(self.bytes_b)
        key = (last_of[group] * len(self.bytes_a) + a) * width + b
        order = np.argsort(key)
        key, times = key[order], times[order]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, dtype=np.int64)
        times = np.add.reduceat(times, starts) if len(key) else times
        document, pair = np.divmod(key[starts], len(self.bytes_a) * width)
        first_pair = np.searchsorted(document, np.arange(n + 1))
        total = np.concatenate([[0], np.cumsum(times)])

        group_a, group_b = (np.repeat(np.arange(len(cut)), np.diff(cut, prepend=-1)) for cut in (cut_a, cut_b))
        start_b, end_a = np.append(0, cut_b[:-1] + 1), cut_a + 1
        parts = np.empty(len(flat_a) + len(flat_b), dtype=object)
        if len(cut_a):
            at_a, at_b = np.arange(len(flat_a)), np.arange(len(flat_b))
            parts[at_a + start_b[group_a]] = self.text_a[flat_a + len(self.bytes_a) * (at_a == cut_a[group_a])]
            parts[at_b + end_a[group_b]] = self.text_b[flat_b + width * (at_b == cut_b[group_b])]
        ends = first_a + first_b
        return {
            "n_a": np.diff(first_a),
            "n_b": np.diff(first_b),
            "n_groups": np.diff(first_cut),
            "n_links": total[first_pair[1:]] - total[first_pair[:-1]],
            "groups": [b"".join(parts[s:e].tolist())[:-1] for s, e in zip(ends[:-1], ends[1:], strict=True)],
            "first_pair": first_pair,
            "pairs": pair,
            "times": times,
        }


def aligned(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary_a: str = BYTE_VOCABULARY,
    vocabulary_b: str = PIECE_VOCABULARY,
    digest: bool = False,
) -> DataFrame:
    """(row, id, n_a, n_b, n_groups, n_links, groups, pairs, times) of every row's whole text.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``: ids of A and B, group by group; with ``digest`` its SHA-256 in hexadecimal instead, or '' without tokens. ``pairs`` are
    the distinct linked pairs, id of A times the size of B's vocabulary plus id of B, ``times`` how many links each
    has. ``row`` differs for every row of one run; write the table before using it twice. Texts that are null or
    empty, or that either tokenizer doesn't give back byte by byte, have no tokens and zeros. Rows with null or repeated ids stay rows of their own;
    other columns are not read, and an empty table gives an empty table. A task holds one text or 2 MB of texts at a time.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((read_vocabulary(vocabulary_a), read_vocabulary(vocabulary_b)))
    names = ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, row = Aligner(*shared.value), TaskContext.get().partitionId() << 40
        for batch in batches:
            sizes = np.cumsum(_lengths(batch.column(1)))
            first = 0
            while first < batch.num_rows:
                done = int(sizes[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(sizes, done + _BATCH_BYTES, side="right")))
                found = aligner.align([v.as_py() or b"" for v in batch.column(1).slice(first, last - first)])
                groups = [hashlib.sha256(g).hexdigest() if g else "" for g in found["groups"]] if digest else [g.decode() for g in found["groups"]]
                ends = pa.array(found["first_pair"].astype(np.int32))
                columns = [
                    pa.array(np.arange(row, row + last - first)),
                    batch.column(0).slice(first, last - first),
                    *[pa.array(found[k], pa.int64()) for k in names[2:6]],
                    pa.array(groups, pa.string()),
                    *[pa.ListArray.from_arrays(ends, pa.array(found[k], pa.int64())) for k in names[7:]],
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                row += last - first
                first = last

    rows = docs.select(F.col(id_column).alias("id"), utf8(text_column).alias("text"))
    counts = "n_a long, n_b long, n_groups long, n_links long"
    return rows.mapInArrow(run, f"row long, id {column_type(docs, id_column)}, {counts}, groups string, pairs array<long>, times array<long>")


def _lengths(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def pair_counts(rows: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): documents that hold each pair, and whether none of the pairs with its id of A is held by more."""
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    same = Window.partitionBy(F.expr(f"pair div {int(width)}"))
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(same)).alias("best"))


def score(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary_a: str = BYTE_VOCABULARY,
    vocabulary_b: str = PIECE_VOCABULARY,
    digest: bool = False,
    common_pairs: int = 1 << 19,
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) per row; ``groups`` as in :func:`aligned`.

    ``count_sum`` adds up, over the links, the number of rows that hold the link's pair; ``n_best`` counts the links whose pair has its
    A id's highest number, ties included. At most ``common_pairs`` pairs are sent to the tasks. Nulls, empty texts, repeated rows and
    empty tables are treated as in :func:`aligned`.
    """
    rows = materialize(aligned(docs, id_column, text_column, vocabulary_a, vocabulary_b, digest), "aligned")
    width = len(piece_tokens(read_vocabulary(vocabulary_b)))
    # pairs of one level are held by about as many rows; whole levels are common or not
    level = F.floor(8 * F.log2("n")).cast("int")
    counts = materialize(pair_counts(rows, width).withColumn("level", level), "pairs")
    least, held = 1 << 30, 0
    for r in counts.groupBy("level").agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect():
        held += r["n"]
        if held > common_pairs:
            break
        least = r["level"]
    common = counts.where(F.col("level") >= least).select("pair", "n", "best").toArrow().sort_by("pair")
    table = tuple(common.column(c).to_numpy() for c in ("pair", "n", "best"))
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        known, n, best = np.append(known, -1), np.append(n, 0), np.append(best, False)
        for batch in batches:
            lists = batch.column(1)
            pairs, times, at = lists.values.to_numpy(), batch.column(2).values.to_numpy(), lists.offsets.to_numpy()
            where = np.searchsorted(known[:-1], pairs)
            rare = known[where] != pairs
            where[rare] = len(n) - 1
            sums = [np.concatenate([[0], np.cumsum(v)])[at] for v in (times * best[where], times * n[where], rare)]
            ends = pa.array(sums[2].astype(np.int32) - np.int32(sums[2][0]))
            inside = rare.copy()
            inside[: at[0]] = False
            inside[at[-1] :] = False
            left = [pa.ListArray.from_arrays(ends, pa.array(v[inside])) for v in (pairs, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(np.diff(s)) for s in sums[:2]], *left], names=["row", "best", "total", "pairs", "times"])

    looked = rows.select("row", "pairs", "times").mapInArrow(look, "row long, best long, total long, pairs array<long>, times array<long>")
    looked = materialize(looked, "looked")
    rare = looked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    rare = rare.join(counts.where(F.col("level") < least).select("pair", "n", F.col("best").alias("is_best")), "pair")
    part = rare.groupBy("row").agg(F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("best"), F.sum(F.expr("times * n")).alias("total"))
    sums = looked.select("row", "best", "total").union(part).groupBy("row").agg(F.sum("best").alias("n_best"), F.sum("total").alias("count_sum"))
    out = rows.select("row", F.col("id").alias(id_column), "n_a", "n_b", "n_groups", "n_links", "groups").join(sums, "row")
    return out.select(id_column, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
