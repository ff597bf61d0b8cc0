"""Exact-enough weighted cuts of many groups at once, by repeated histograms.

A cut is a key below which a group's weights sum up to a target. Each pass
splits every group's open interval of keys into equal bins, sums the weights by
(group, bin), which is pre-aggregated before the shuffle, and goes on with the bin
that holds the target. Only those sums reach the driver: at most ``sums`` numbers a pass (or 256 for each group, if there
are more groups), whatever the number of rows. A pass divides every interval by its number of bins, so the work is a few scans.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys are whole numbers from 0 to this, exclusive.
KEYS = 1 << 62


def weighted_cuts(
    df: DataFrame,
    targets: Mapping[int, float],
    slack: float = 0.0,
    sums: int = 32_768,
    nearest: bool = False,
    bounds: Mapping[int, tuple[int, int]] | None = None,
) -> dict[int, tuple[int, float]]:
    """For each group of ``df`` (columns ``grp`` int, ``key`` long, ``weight``), (cut, weight of the keys below the cut).

    Groups are whole numbers from 0, few enough to list: their limits are looked up in arrays inside each scan, so nothing is joined.

    Of the possible cuts, one is taken that leaves less than ``slack`` to the target, or else the
    largest that does not exceed the target (with ``nearest``, the one on either side that is nearer). A group without rows gets (KEYS, 0).
    ``bounds`` gives the least and the greatest key of groups where they are known: the search starts between them and takes fewer passes.
    """
    bounds = bounds or {}
    low = {g: (bounds[g][0] if g in bounds else 0, 0.0) for g in targets}
    high = {g: bounds[g][1] + 1 if g in bounds else KEYS for g in targets}
    done: dict[int, tuple[int, float]] = {g: (0, 0.0) for g, t in targets.items() if t <= 0}
    while open_groups := [g for g in targets if g not in done]:
        bins = max(2, min(256, sums), sums // len(open_groups))
        steps = {g: max(1, -(-(high[g] - low[g][0]) // bins)) for g in open_groups}
        span = range(max(targets) + 1)
        lo, hi, step = (
            F.get(F.array(*[F.lit(x).cast("long") for x in values]), F.col("grp"))
            for values in (
                [low[g][0] if g in steps else KEYS for g in span],
                [high[g] if g in steps else KEYS for g in span],
                [steps.get(g, 1) for g in span],
            )
        )
        inside = df.where((F.col("key") >= lo) & (F.col("key") < hi)).select("grp", "key", "weight", lo.alias("lo"), step.alias("step"))
        inside = inside.withColumn("bin", F.expr("(key - lo) div step"))
        found = inside.groupBy("grp", "bin").agg(F.sum("weight").alias("w")).collect()
        by: dict[int, list[tuple[int, float]]] = {g: [] for g in open_groups}
        for r in found:
            by[r["grp"]].append((r["bin"], float(r["w"])))
        for g in open_groups:
            start, below = low[g]
            for b, w in sorted(by[g]):
                if below + w > targets[g]:
                    low[g], end = (start + b * steps[g], below), min(high[g], start + (b + 1) * steps[g])
                    high[g] = end
                    if targets[g] - below <= slack:
                        done[g] = low[g]
                    elif steps[g] == 1:
                        over = nearest and below + w - targets[g] < targets[g] - below
                        done[g] = (high[g], below + w) if over else low[g]
                    break
                below += w
            else:
                done[g] = (high[g], below)
    return done
