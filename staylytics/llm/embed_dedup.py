"""Embedding near-duplicates by spherical k-means cells and blocked cosine products.

Centroids are fitted on a bounded sample. Every vector is at home in the cell of its nearest centroid and
a guest in each cell of a smaller number whose boundary is within the angle of the threshold:
a linked pair across two cells lies on both sides of their bisecting plane, so the one at home in
the larger cell is a guest in the smaller. Thus every linked pair meets exactly once, whatever the
centroids are; good centroids only save work. Members of a cell are cut into blocks
of bounded size, and one small matrix product compares two blocks.

Identical vectors are one class before anything is compared. A block reports link
counts and a spanning forest, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylytics.llm.common import column_type, whole_groups
from staylytics.llm.components import components, local_roots
from staylytics.sources import materialize


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, first by their largest entry so that squares stay finite."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def spherical_kmeans(points: np.ndarray, cells: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """Unit centroids of unit points; a centroid that loses all its points stays where it is."""
    pick = np.random.default_rng(seed).permutation(len(points))[:cells]
    centers = points[pick]
    for _ in range(rounds):
        home = (points @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, home, points)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), centers)
    return centers


def distances(centers: np.ndarray) -> np.ndarray:
    """Distances between unit centroids, by their products: a square of numbers, whatever their dimension."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (centers @ centers.T)))


def homes_and_guests(points: np.ndarray, centers: np.ndarray, threshold: float, between: np.ndarray | None = None) -> tuple[np.ndarray, list[list[int]]]:
    """The home cell of each unit point, and the smaller cells in which it must be a guest.

    ``between`` holds the centroids' ``distances``. Rounding there is below 1e-7, which is allowed for, so no guest is missed.
    """
    between = distances(centers) if between is None else between
    dots = points @ centers.T
    home = dots.argmax(axis=1)
    reach = float(np.sqrt(max(0.0, 1 - threshold**2))) if threshold > 0 else 1.0
    margin = dots[np.arange(len(points)), home][:, None] - dots
    near = margin <= reach * between[home] + 1e-7
    near &= np.arange(len(centers))[None, :] < home[:, None]
    return home, [np.flatnonzero(r).tolist() for r in near]


def _usable(vector: Column, label: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(label.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray, start: int, end: int, width: int) -> np.ndarray:
    values = column.slice(start, end - start).combine_chunks().flatten()
    return values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _block_links(classes: DataFrame, cells: int, threshold: float, block: int, sample_rows: int) -> DataFrame:
    """(cls, root, n): links of a class found in one pair of blocks, and a class it is connected with there."""
    sizes = classes.groupBy("width").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width").first()
    centers = np.zeros((1, 1))
    if sizes:
        chance = F.pmod(F.xxhash64(F.lit("cells"), "cls"), F.lit(1 << 30)) / float(1 << 30)
        taken = classes.where((F.col("width") == sizes["width"]) & (chance < sample_rows / sizes["n"])).select("vec")
        points = [r[0] for r in taken.collect()]
        if points:
            centers = spherical_kmeans(unit(np.array(points, dtype=np.float64)), min(cells, len(points)))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        between = distances(centers)
        for batch in batches:
            home, guests = np.zeros(batch.num_rows, dtype=np.int64), [[] for _ in range(batch.num_rows)]
            fits = np.flatnonzero(batch.column("width").to_numpy() == centers.shape[1])
            if len(fits) and len(centers) > 1:
                vec = batch.column("vec").take(pa.array(fits))
                points = unit(vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(fits), -1))
                home[fits], found = homes_and_guests(points, centers, threshold, between)
                for at, cell in zip(fits, found, strict=True):
                    guests[at] = cell
            arrays = [*batch.columns, pa.array(home), pa.array(guests, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "home", "guests"])

    kind = column_type(classes, "vec")
    schema = f"cls {column_type(classes, 'cls')}, n long, lkey long, width int, vec {kind}, home long, guests array<long>"
    placed = materialize(classes.select("cls", "n", "lkey", "width", "vec").mapInArrow(place, schema), "placed")
    at_home = F.array(F.struct(F.col("home").alias("cell"), F.lit(0).alias("guest")))
    spots = F.concat(at_home, F.transform("guests", lambda g: F.struct(g.alias("cell"), F.lit(1).alias("guest"))))
    entries = placed.select("cls", "n", "lkey", "width", "vec", F.inline(spots))
    counts = entries.groupBy("lkey", "width", "cell").agg(F.sum(1 - F.col("guest")).alias("homes"), F.sum("guest").alias("guests"))
    counts = counts.where("homes + guests > 1 and homes > 0")
    counts = materialize(counts.withColumns({"kh": F.ceil(F.col("homes") / block), "kg": F.ceil(F.col("guests") / block)}).drop("homes", "guests"), "cells")
    entries = entries.join(counts, ["lkey", "width", "cell"])
    entries = entries.withColumn("part", F.expr("pmod(xxhash64(cls), if(guest = 1, kg, kh))"))
    among = F.expr("transform(sequence(0L, kh - 1), q -> named_struct('kind', 0, 'i', least(part, q), 'j', greatest(part, q)))")
    ahead = F.expr("if(kg > 0, transform(sequence(0L, greatest(kg - 1, 0L)), q -> named_struct('kind', 1, 'i', part, 'j', q)), array())")
    behind = F.expr("transform(sequence(0L, kh - 1), q -> named_struct('kind', 1, 'i', q, 'j', part))")
    groups = F.when(F.col("guest") == 1, behind).otherwise(F.concat(among, ahead))
    keys = ["lkey", "width", "cell", "kind", "i", "j"]
    entries = entries.select("cls", "n", "lkey", "width", "cell", "vec", "guest", "part", F.inline(groups))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, keys):
            out: list[tuple[int, int, int]] = []
            kind, i, j, part, guest, width, n = (table.column(c).to_numpy() for c in ("kind", "i", "j", "part", "guest", "width", "n"))
            cls = table.column("cls").to_numpy()
            for s, e in zip(starts, [*starts[1:], table.num_rows], strict=True):
                rows = _matrix(table.column("vec"), s, e, int(width[s]))
                ids, times = cls[s:e], n[s:e]
                if kind[s] == 0 and i[s] == j[s]:
                    out += _links(rows, ids, times, threshold)
                else:
                    left = guest[s:e] == 0 if kind[s] == 1 else part[s:e] == i[s]
                    out += _links(rows[left], ids[left], times[left], threshold, rows[~left], ids[~left], times[~left])
            found = np.array(out, dtype=np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, k]) for k in range(3)], names=["cls", "root", "n"])

    sorted_rows = entries.repartition(*keys).sortWithinPartitions(*keys)
    return sorted_rows.mapInArrow(compare, "cls long, root long, n long")


def _links(
    rows: np.ndarray,
    ids: np.ndarray,
    times: np.ndarray,
    threshold: float,
    other: np.ndarray | None = None,
    other_ids: np.ndarray | None = None,
    other_times: np.ndarray | None = None,
) -> list[tuple[int, int, int]]:
    """(class, connected class, weighted links) of those rows of a block that have links."""
    one = other is None
    if one:
        other, other_ids, other_times = rows, ids, times
    if not len(rows) or not len(other):
        return []
    near = cosines(rows, other) >= threshold
    if one:
        np.fill_diagonal(near, False)
    if not near.any():
        return []
    mine, theirs = local_roots(near, one)
    degree = near @ other_times
    out = [(int(ids[i]), int(ids[mine[i]]), int(degree[i])) for i in np.flatnonzero(degree)]
    if not one:
        degree = times @ near
        out += [(int(other_ids[i]), int(ids[theirs[i]]), int(degree[i])) for i in np.flatnonzero(degree)]
    return out


def cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (left, right))
    return (a @ b.T) / np.outer(np.sqrt((a * a).sum(axis=1)), np.sqrt((b * b).sum(axis=1)))


def near_duplicates(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    threshold: float = 0.93,
    cell_rows: int = 4096,
    max_cells: int = 1024,
    block: int = 1024,
    sample_rows: int = 8192,
) -> DataFrame:
    """(id, n_links, component, kept) per vector; pairs of equal label and length with cosine at least ``threshold`` link.

    ``component`` is the smallest id reachable by links, ``kept`` whether that is the row itself. Vectors that
    are null, empty, zero, or hold null or non-finite components, and those without a label, link with nothing.
    Repeated rows of an id are one vector, the smallest (label, vector) stands. Rows without an id come back with
    no links and a null component. Whole-number ids are expected. ``sample_rows`` bounds what centroids are
    fitted on and ``max_cells`` how many there are; neither changes the result. An empty table gives an empty table.
    """
    kind = column_type(vectors, id_column)
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"), F.col(vector_column).alias("vec"))
    known = rows.where("id is not null").groupBy("id").agg(F.min(F.struct("label", "vec")).alias("v")).select("id", "v.label", "v.vec")
    # two hashes together stand for label and vector
    pair = F.struct(F.xxhash64("label", "vec").alias("a"), F.hash("label", "vec").alias("b"))
    known = known.select("id", _usable(F.col("vec"), F.col("label")).alias("usable"), pair.alias("same"), "label", "vec")
    known = materialize(known, "vectors")
    usable = known.where("usable")
    classes = usable.groupBy("same").agg(F.min("id").alias("cls"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("vec").alias("vec"))
    classes = classes.select("same", "cls", "n", F.xxhash64("label").alias("lkey"), F.size("vec").alias("width"), "vec")
    classes = materialize(classes, "classes")
    cells = int(min(max_cells, max(1, classes.count() // cell_rows)))
    found = materialize(_block_links(classes, cells, threshold, block, sample_rows), "links")
    degrees = found.groupBy("cls").agg(F.sum("n").alias("links"))
    tree = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    named = classes.select("same", "cls", "n").join(degrees, "cls", "left").join(tree.withColumnRenamed("node", "cls"), "cls", "left")
    named = named.select("same", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "cls").alias("component"))
    named = materialize(named, "named")
    linked = usable.select("id", "same").join(named, "same").select("id", "links", "component")
    alone = known.where("not usable").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    nameless = rows.where("id is null").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    out = linked.union(alone).union(nameless)
    return out.select(
        F.col("id").cast(kind).alias(id_column),
        F.col("links").alias("n_links"),
        F.col("component").cast(kind).alias("component"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )
