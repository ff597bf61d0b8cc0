"""Exact grouped quantiles that never gather a group in one task.

Two passes over ``(by, value)``, whatever the number of values:

1. a mergeable sketch per group brackets every wanted rank between two values;
2. one aggregation counts the rows below and above each bracket and keeps the
   distinct values inside it. Only a sliver of the rows, about ``4 / accuracy``
   of a group, stays separate, so even a group with a third of all rows shrinks
   to a few rows per task before the shuffle.

The counted values are cut into ranges of about equal size; the counts before each range tell in
which one the wanted order statistic lies, and only that range is read in order. A bracket that
misses its rank is widened and the pass repeated, so the result is exact for any
input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from staylytics.sources.staging import materialize


def match_keys(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``by`` where null equals null; keeps the left key columns."""
    right = right.select(*[F.col(c).alias(f"__{c}") if c in by else F.col(c) for c in right.columns])
    on = None
    for c in by:
        test = left[c].eqNullSafe(right[f"__{c}"])
        on = test if on is None else on & test
    return left.join(right, on, how).drop(*[f"__{c}" for c in by])


def attach(df: DataFrame, table: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add the non-key columns of ``table``: by join on ``by``, or as scalars of its one row."""
    if by:
        return match_keys(df, table, by)
    return df.withColumns({c: table.select(c).scalar() for c in table.columns})


def _disc_rank(prob: float, n: Column) -> Column:
    """1-based rank of the discrete quantile: the first row whose share reaches ``prob``."""
    return F.greatest(F.lit(1), (n - F.floor(n - F.lit(float(prob)) * n)).cast("bigint"))


def quantile_table(
    df: DataFrame,
    value: str | Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    exact: bool = True,
    accuracy: int = 10_000,
    names: Sequence[str] | None = None,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row per group with the discrete quantile of ``value`` for each of ``probs``.

    Columns are ``by`` plus ``names`` (default ``q0, q1, ...``). Null values are
    left out; a group without values has no row. With ``exact=False`` the sketch
    alone answers, within ``1 / accuracy`` of the rank.

    Several values share the two passes: their quantiles stand side by side (as doubles), value by value
    (default names ``<value>_q0, ...``), null where a group has no value in that column. ``extra`` are aggregates
    of ``df`` taken while the sketches are; with them every group has a row.
    """
    by = list(by)
    values = [value] if isinstance(value, str) else list(value)
    if not names:
        names = [f"q{i}" if isinstance(value, str) else f"{v}_q{i}" for v in values for i in range(len(probs))]
    if len(values) == 1:
        rows = df.withColumn("__v", F.col(values[0]))
    else:
        rows = df.withColumns({f"__v{k}": F.col(v).cast("double") for k, v in enumerate(values)})
    cols = ["__v"] if len(values) == 1 else [f"__v{k}" for k in range(len(values))]
    if not extra:
        rows = rows.where(F.coalesce(*cols).isNotNull())
    if not exact:
        shares = [float(p) for p in probs]
        sketches = [F.percentile_approx(c, shares, accuracy).alias(f"__q{k}") for k, c in enumerate(cols)]
        packed = rows.groupBy(*by).agg(*sketches, *extra)
        cells = [F.col(f"__q{k}")[i] for k in range(len(values)) for i in range(len(probs))]
        kept = packed.columns[len(by) + len(values):]
        return materialize(packed.select(*by, *[c.alias(n) for c, n in zip(cells, names)], *kept), "quantiles")

    width = 2.0 / accuracy
    more = {"cols": cols, "extra": extra} if extra or len(cols) > 1 else {}
    while True:
        found = materialize(_order_statistics(rows, probs, by, width, accuracy, **more), "quantiles")
        if width >= 1.0 or found.where("__missed").isEmpty():
            break
        width *= 16.0
    kept = [c for c in found.columns[len(by):] if c not in ("__q", "__missed")]
    if not extra and by:
        found = found.where("__q is not null")
    return found.select(*by, *[F.col("__q")[i].alias(n) for i, n in enumerate(names)], *kept)


def _order_statistics(
    rows: DataFrame,
    probs: Sequence[float],
    by: list[str],
    width: float,
    accuracy: int,
    cols: Sequence[str] = ("__v",),
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Order statistics ``__q`` (value by value), ``__missed`` where a bracket missed one, and ``extra``."""
    edges = [e for p in probs for e in (max(0.0, p - width), min(1.0, p + width))]
    brackets = [f"__e{k}" for k in range(len(cols))]
    sketches = [F.percentile_approx(c, edges, accuracy).alias(e) for c, e in zip(cols, brackets)]
    sketch = materialize(rows.groupBy(*by).agg(*sketches, *extra), "brackets")

    # part 0 and 2 lose their value here: they only need counting
    marks = []
    for k, (c, bracket) in enumerate(zip(cols, brackets)):
        v = F.col(c)
        for i in range(len(probs)):
            low, high = F.col(bracket)[2 * i], F.col(bracket)[2 * i + 1]
            open_low, open_high = edges[2 * i] == 0.0, edges[2 * i + 1] == 1.0
            below = F.lit(False) if open_low else v < low
            above = F.lit(False) if open_high else v > high
            part = F.when(v.isNull(), None).when(below, 0).when(above, 2).otherwise(1)
            at = F.lit(k * len(probs) + i).alias("i")
            marks.append(F.struct(at, part.alias("part"), F.when(part == 1, v).alias("v")))
    narrow = rows.select(*by, *cols)
    marked = attach(narrow, sketch.select(*by, *brackets), by).select(*by, F.inline(F.array(*marks)))
    counted = marked.where("part is not null").groupBy(*by, "i", "part", "v").agg(F.count(F.lit(1)).alias("c"))

    # ranges of the counted values, about equal in rows, with the counts that lie before each
    counted = counted.repartitionByRange(*by, "i", "part", "v").withColumn("__p", F.spark_partition_id())
    counted = materialize(counted, "counted")
    sizes = counted.groupBy(*by, "i", "__p").agg(F.sum("c").alias("s"))
    group = Window.partitionBy(*by, "i")
    earlier = group.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumns({"base": F.coalesce(F.sum("s").over(earlier), F.lit(0)), "n": F.sum("s").over(group)})
    wanted = F.lit(None).cast("bigint")
    for i, p in enumerate(probs):
        wanted = F.when(F.col("i") % len(probs) == i, _disc_rank(p, F.col("n"))).otherwise(wanted)
    target = sizes.withColumn("rank", wanted).where("base < rank and rank <= base + s")
    target = materialize(target.select(*by, "i", "__p", "base", "rank"), "ranges")
    # only the range with the wanted rank is put in order
    inside = match_keys(counted, target, [*by, "i", "__p"])
    ordered = group.orderBy("part", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = inside.withColumn("upto", F.col("base") + F.sum("c").over(ordered))
    hit = ranked.where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("c") < F.col("rank")))
    cells = range(len(cols) * len(probs))
    picks = hit.groupBy(*by).agg(F.array(*[F.max(F.when(F.col("i") == i, F.col("v"))) for i in cells]).alias("__q"))
    if len(cols) == 1 and not extra and by:  # every group has values, so nothing else needs its row
        return picks.withColumn("__missed", F.exists("__q", lambda x: x.isNull()))
    found = match_keys(sketch, picks, by, "left") if by else sketch.withColumn("__q", picks.scalar())
    missed = F.lit(False)
    for i in cells:
        missed |= F.col(f"__e{i // len(probs)}").isNotNull() & (F.col("__q").isNull() | F.col("__q")[i].isNull())
    return found.withColumn("__missed", missed).drop(*brackets)
