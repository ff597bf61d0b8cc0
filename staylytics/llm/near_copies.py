"""Near-copies by word shingles: candidates from SimHash and MinHash, decided by the exact Jaccard similarity.

SimHash with covering masks (:mod:`staylytics.llm.simhash`) proposes texts whose fingerprints almost agree, but of texts with a
Jaccard similarity of 0.8 most differ in more bits than masks can cover. So MinHash bands propose too: ``bands`` groups of
``rows`` minima, of which one must agree. 24 bands of 6 miss a pair at 0.8 once in 1,500 times, a closer one more seldom.

Texts with the same words are one class before anything is compared. A bucket first proposes a star, each member with the smallest one, and the exact
similarity decides. That settles nearly every bucket of copies, however large. Only in buckets whose members are then not
all connected, those outside the largest connected part are compared with every member, in blocks of bounded size, by a sketch of one
byte per minimum. A block proposes a maximum spanning forest by sketched similarity: it connects, at any threshold, what
the pairs above the threshold connect. Nothing is capped, and no bucket is listed as pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylytics.llm import simhash
from staylytics.llm.common import column_type, folded_words, utf8, whole_groups
from staylytics.llm.components import components
from staylytics.llm.decontam import few
from staylytics.sources import materialize

_SEED = 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FACTORS, _ADDED = np.random.default_rng(_SEED).integers(0, 1 << 31, (2, 1024), dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """Distinct hashes of all runs of ``shingle`` words, or of the whole where there are fewer; none without words.

    Words are hashed one by one, and a run's hash is a polynomial in theirs, finally mixed.
    """
    own = np.fromiter((xxhash.xxh64_intdigest(w, _SEED) for w in words), dtype=np.uint64, count=len(words))
    size = min(shingle, len(own))
    n = len(own) - size + 1 if size else 0
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out = out * _MIX + own[k : k + n]
    out ^= out >> np.uint64(32)
    out *= _MIX
    return np.unique(out ^ (out >> np.uint64(29)))


def minima(hashes: np.ndarray, count: int) -> np.ndarray:
    """``count`` MinHash values (up to 1,024) of a set of hashes, from their upper halves."""
    upper = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(count, np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(upper), 1 << 10):  # blocks that stay in the cache
        np.minimum(least, (upper[None, at : at + (1 << 10)] * _FACTORS[:count, None] + _ADDED[:count, None]).min(axis=1), out=least)
    return least


def fingerprint(hashes: np.ndarray) -> int:
    """SimHash of a set: bits set in over half of the hashes, as a signed number."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[at : at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def signatures(docs: DataFrame, id_column: str, text_column: str, shingle: int, bands: int, rows: int) -> DataFrame:
    """(id, cls, fp, sketch, bands, text) per row: cls is a digest of the text's words, fp its SimHash, sketch a byte per minimum."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, prints, sketches, keys = [], [], [], []
            for value in batch.column(1):
                words = folded_words(value.as_py())
                hashes = shingle_hashes(words, shingle)
                least = minima(hashes, bands * rows)
                cls.append(xxhash.xxh3_128_digest(b" ".join(words)))
                prints.append(fingerprint(hashes))
                sketches.append((least >> np.uint32(8)).astype(np.uint8).tobytes())
                keys += [xxhash.xxh64_intdigest(band.tobytes(), k) for k, band in enumerate(least.reshape(bands, rows))]
            ends = pa.array(np.arange(0, len(keys) + 1, bands, dtype=np.int32))
            columns = [
                batch.column(0),
                pa.array(cls, pa.binary()),
                pa.array(prints, pa.int64()),
                pa.array(sketches, pa.binary()),
                pa.ListArray.from_arrays(ends, pa.array(np.array(keys, dtype=np.uint64).view(np.int64))),
                batch.column(1),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "cls", "fp", "sketch", "bands", "text"])

    own = docs.select(F.col(id_column).alias("id"), utf8(text_column).alias("text"))
    return own.mapInArrow(run, f"id {column_type(docs, id_column)}, cls binary, fp long, sketch binary, bands array<long>, text binary")


def similar(pairs: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """Those of the pairs (a, b) of classes whose sets of shingles have a Jaccard similarity of ``least`` or more."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(folded_words(t.as_py()), shingle).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["cls", "shingles"])

    pairs = materialize(pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")
    needed = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    needed = few(materialize(needed, "compared"))  # so that only texts which are compared are shuffled
    sets = texts.join(needed, "cls", "left_semi").dropDuplicates(["cls"]).select("cls", "text")
    sets = materialize(sets.mapInArrow(run, "cls binary, shingles array<long>"), "shingles")
    left, right = (sets.select(F.col("cls").alias(k), F.col("shingles").alias(f"s{k}")) for k in "ab")
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(left, "a").join(right, "b").where(both >= least * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def spanning_forest(similarity: np.ndarray, floor: int) -> list[tuple[int, int]]:
    """A maximum spanning forest over rows and columns; entries below ``floor`` are no links."""
    n, m = similarity.shape
    best, via = np.full(n + m, -1, dtype=np.int32), np.zeros(n + m, dtype=np.int64)
    open_ = np.ones(n + m, dtype=bool)
    out = []
    for _ in range(n + m):
        at = int(np.argmax(np.where(open_, best, -2)))
        open_[at] = False
        if best[at] >= floor:
            r, c = sorted((at, int(via[at])))
            out.append((r, c - n))
        reach = similarity[at] if at < n else similarity[:, at - n]
        side = slice(n, None) if at < n else slice(0, n)
        better = reach > best[side]
        best[side][better] = reach[better]
        via[side][better] = at
    return out


def proposed_again(buckets: DataFrame, sketches: DataFrame, roots: DataFrame, floor: int, rest_block: int, block: int) -> DataFrame:
    """Pairs (a, b) from buckets (columns bucket, cls) whose members lie in several connected parts.

    Sketches (columns cls, sketch) are fetched for the members of those buckets only.
    """
    placed = buckets.join(roots, "cls", "left").select("bucket", "cls", F.coalesce("root", "cls").alias("root"))
    parts = placed.groupBy("bucket", "root").agg(F.count("*").alias("k"))
    largest = F.max(F.struct("k", "root")).alias("most")
    sizes = parts.groupBy("bucket").agg(F.sum("k").alias("n"), largest).where("n > most.k")
    sizes = materialize(sizes.select("bucket", "n", (F.col("n") - F.col("most.k")).alias("rest"), F.col("most.root").alias("main")), "unsettled")
    rows = materialize(placed.join(sizes, "bucket"), "members").join(sketches, "cls")
    many, few = F.ceil(F.col("n") / block).cast("int"), F.ceil(F.col("rest") / rest_block).cast("int")
    own = F.expr("pmod(xxhash64(cls, bucket), 2147483647)")
    keep = ["bucket", "cls", "root", "sketch"]
    every = rows.select(*keep, few.alias("few"), (own % many).cast("int").alias("q"))
    every = every.select(*keep, F.explode(F.expr("sequence(0, few - 1)")).alias("p"), "q", F.lit(0).alias("side"))
    rest = rows.where("root <> main").select(*keep, many.alias("many"), (own % few).cast("int").alias("p"))
    rest = rest.select(*keep, "p", F.explode(F.expr("sequence(0, many - 1)")).alias("q"), F.lit(1).alias("side"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ["bucket", "p", "q"]):
            cls, side = table.column("cls").to_pylist(), table.column("side").to_numpy()
            roots = np.unique(table.column("root").to_pylist(), return_inverse=True)[1]
            sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype=np.uint8).reshape(len(cls), -1)
            found = set()
            for s, e in zip(starts, [*starts[1:], len(cls)], strict=True):
                a, b = s + np.flatnonzero(side[s:e] == 1), s + np.flatnonzero(side[s:e] == 0)
                same = np.zeros((len(a), len(b)), dtype=np.int32)
                for k in range(sketch.shape[1]):
                    same += sketch[a, k][:, None] == sketch[b, k][None, :]
                same[roots[a][:, None] == roots[b][None, :]] = -1
                found.update((cls[a[i]], cls[b[j]]) for i, j in spanning_forest(same, floor))
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)], names=["a", "b"])

    columns = ["bucket", "p", "q", "side", "cls", "root", "sketch"]
    blocks = every.select(columns).union(rest.select(columns)).repartition("bucket", "p", "q").sortWithinPartitions("bucket", "p", "q")
    return blocks.mapInArrow(run, "a binary, b binary")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 5,
    least: float = 0.8,
    bands: int = 24,
    rows: int = 6,
    radius: int = 4,
    rest_block: int = 512,
    block: int = 2048,
) -> DataFrame:
    """(id, component) per row: component is the smallest id reachable over texts whose Jaccard similarity is ``least`` or more.

    Shingles are of ``shingle`` words with A-Z lower-cased; a text of fewer words is one shingle, and texts without words (null, empty,
    blank) are copies of each other. Every row comes back; repeated rows and equal texts are linked. Null ids never name a
    component; one of null ids only has none. Other columns are not read. An empty table gives an empty table. Links found
    are exact; a link exactly at ``least`` is missed with a probability of about ``(1 - least^rows)^bands``.
    """
    signed = materialize(signatures(docs, id_column, text_column, shingle, bands, rows), "signed")
    classes = signed.groupBy("cls").agg(F.min("id").alias("first"), F.any_value("fp").alias("fp"), F.any_value("sketch").alias("sketch"), F.any_value("bands").alias("bands"))
    classes = materialize(classes, "classes")

    prints = materialize(classes.groupBy("fp").agg(F.min("cls").alias("cls")), "prints")
    near = simhash.near_links(prints.select("fp"), radius)
    ends = [prints.select(F.col("fp").alias(k), F.col("cls").alias(f"c{k}")) for k in "ab"]
    stars = near.join(ends[0], "a").join(ends[1], "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    same = classes.select("fp", F.col("cls").alias("b")).join(prints.withColumnRenamed("cls", "a"), "fp").select("a", "b")

    buckets = classes.select("cls", F.explode("bands").alias("bucket"))
    sums = buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.min("cls").alias("lo"))
    shared = materialize(sums.where("n > 1"), "buckets")
    banded = buckets.select("bucket", F.col("cls").alias("b")).join(shared.select("bucket", F.col("lo").alias("a")), "bucket").select("a", "b")

    texts = signed.select("cls", "text")
    links = materialize(similar(stars.union(same).union(banded), texts, shingle, least), "links")
    roots = materialize(components(links).select(F.col("node").alias("cls"), F.col("component").alias("root")), "roots")
    crowded = buckets.join(shared.where("n > 2").select("bucket"), "bucket", "left_semi")
    more = proposed_again(crowded, classes.select("cls", "sketch"), roots, int(bands * rows * (least - 0.15)), rest_block, block)
    links = links.union(materialize(similar(more, texts, shingle, least), "links"))

    found = components(links).select(F.col("node").alias("cls"), F.col("component").alias("root"))
    named = materialize(classes.select("cls", "first").join(found, "cls", "left").select("cls", "first", F.coalesce("root", "cls").alias("root")), "named")
    least_ids = named.groupBy("root").agg(F.min("first").alias("component"))
    placed = materialize(named.join(least_ids, "root").select("cls", "component"), "placed")
    return signed.select("id", "cls").join(placed, "cls").select(F.col("id").alias(id_column), "component")
