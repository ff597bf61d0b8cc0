"""Shards of near-equal bytes by a k-d tree over document metadata.

A node that is to become ``n`` shards is cut once, along the dimension that is widest in
it relative to the whole table, at the weighted quantile that gives ``n // 2`` shards to
the left. All nodes of a level are cut together: one aggregation for their extents, a few
histograms for their cuts. Only those sums reach the driver.

Dimensions are language, source (both by hash: rows of one value lie together) and size. Equal texts share all
coordinates, so a cut never parts them, except a group too large for that, which is dealt
into parts of bounded size first.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylytics.llm.common import crc32_text
from staylytics.llm.cuts import weighted_cuts
from staylytics.sources import materialize

CODES = 1 << 31


@dataclass
class Node:
    first: int
    shards: int
    dim: str | None = None
    cut: int = 0
    left: Node | None = None
    right: Node | None = None


def _place(node: Node) -> Column:
    """The shard (first shard of the open node) of a row, as nested conditions on the keys."""
    if node.left is None:
        return F.lit(node.first)
    return F.when(F.col(f"key_{node.dim}") < F.lit(node.cut), _place(node.left)).otherwise(_place(node.right))


def build_tree(rows: DataFrame, shards: int, dims: list[str], slack: float) -> Node:
    """The tree over ``rows`` (columns ``size`` and ``key_<dim>``); ``slack`` bytes at a cut need no further scan."""
    root = Node(0, shards)
    spans: dict[str, float] = {}
    while True:
        level = [n for n in _leaves(root) if n.shards > 1]
        if not level:
            return root
        extents = [F.sum("size").alias("bytes")]
        for d in dims:
            extents += [F.min(f"key_{d}").alias(f"lo_{d}"), F.max(f"key_{d}").alias(f"hi_{d}")]
        found = {r["grp"]: r for r in rows.groupBy(_place(root).alias("grp")).agg(*extents).collect()}
        if not found:
            return root
        if not spans:
            spans = {d: max(1, found[0][f"hi_{d}"] - found[0][f"lo_{d}"]) for d in dims}
        targets, bounds, key = {}, {}, F.lit(None).cast("long")
        for n in level:
            r = found.get(n.first)
            widths = [(r[f"hi_{d}"] - r[f"lo_{d}"]) / spans[d] if r else 0.0 for d in dims]
            n.dim = dims[widths.index(max(widths))]
            if r:
                bounds[n.first] = (r[f"lo_{n.dim}"], r[f"hi_{n.dim}"])
            targets[n.first] = (float(r["bytes"]) if r else 0.0) * (n.shards // 2) / n.shards
            key = F.when(F.col("grp") == n.first, F.col(f"key_{n.dim}")).otherwise(key)
        open_rows = rows.withColumn("grp", _place(root)).select("grp", key.alias("key"), F.col("size").alias("weight"))
        cuts = weighted_cuts(open_rows.where("key is not null"), targets, slack, nearest=True, bounds=bounds)
        for n in level:
            n.cut = cuts[n.first][0]
            n.left = Node(n.first, n.shards // 2)
            n.right = Node(n.first + n.shards // 2, n.shards - n.shards // 2)


def _leaves(node: Node) -> list[Node]:
    return [node] if node.left is None else [*_leaves(node.left), *_leaves(node.right)]


def shard(
    docs: DataFrame,
    shards: int | None = 40,
    target_bytes: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
    group_share: float = 0.1,
    slot_rows: int = 100_000,
) -> DataFrame:
    """(id, size, text_crc32, shard, slot) for every row; shards have near-equal bytes.

    ``size`` is the UTF-8 length of the text (null: 0) plus 16. Give the number of shards, or ``target_bytes``
    for as many shards of about that size as needed. ``slot`` numbers the rows of a shard from 0 without a gap.
    Rows of equal texts (null is a text of its own) go to one shard, unless they hold more than
    ``group_share`` of a shard's bytes: such a group is dealt into parts of about that size by id and a running number, written once
    with the sizes, so rows without an id or of one id are dealt too. A
    row is never split, so a shard is off by a row or a part at most. Null ids, languages and
    sources are values like others; repeated rows stay. Other columns are not read. An empty table gives an empty table.
    """
    size = F.coalesce(F.octet_length(text_column), F.lit(0)).cast("long") + 16
    rows = docs.select(
        F.col(id_column).alias("id"),
        size.alias("size"),
        crc32_text(F.col(text_column)).alias("text_crc32"),
        F.xxhash64(F.col(text_column), F.col(text_column).isNull()).alias("text_key"),
        F.col(lang_column).cast("string").alias("lang"),
        F.col(source_column).cast("string").alias("source"),
        F.monotonically_increasing_id().alias("number"),
    )
    rows = materialize(rows, "sizes")
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    n = shards or max(1, math.ceil((total or 0) / target_bytes))
    part_bytes = max(1.0, group_share * (total or 0) / n)
    groups = rows.groupBy("text_key").agg(
        F.least(F.count("*"), F.ceil(F.sum("size") / part_bytes)).alias("parts"), F.min("lang").alias("lang"), F.min("source").alias("source")
    )
    groups = materialize(groups, "texts")
    own = rows.drop("lang", "source").join(groups, "text_key")
    salt = F.pmod(F.xxhash64("text_key", "id", "number"), F.col("parts"))
    tie = F.pmod(F.xxhash64("text_key", salt), F.lit(CODES))
    codes = {
        "lang": F.pmod(F.xxhash64("lang"), F.lit(CODES)),
        "source": F.pmod(F.xxhash64("source"), F.lit(CODES)),
        "size": (F.log2("size") * (1 << 24)).cast("long"),
    }
    keys = [(c * CODES + tie).alias(f"key_{d}") for d, c in codes.items()]
    keyed = materialize(own.select("id", "size", "text_crc32", "text_key", "number", *keys), "keyed")
    tree = build_tree(keyed, n, list(codes), slack=0.001 * (total or 0) / n)

    subs = max(8, math.ceil(count / (n * slot_rows)))
    sub = F.pmod(F.xxhash64(F.lit("slot"), "text_key", "id", "number"), F.lit(subs)).cast("int")
    placed = keyed.select("id", "size", "text_crc32", _place(tree).cast("int").alias("shard"), sub.alias("sub"))
    counts = materialize(placed.groupBy("shard", "sub").agg(F.count("*").alias("n")), "counts")
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "sub", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("shard", "sub").orderBy("id", "text_crc32", "size")
    numbered = placed.withColumn("rank", F.row_number().over(order)).join(offsets, ["shard", "sub"])
    slot = (F.col("base") + F.col("rank") - 1).cast("long")
    return numbered.select(F.col("id").alias(id_column), "size", "text_crc32", "shard", slot.alias("slot"))
