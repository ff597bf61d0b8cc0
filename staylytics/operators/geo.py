"""Neighbourhood centroids and the nearest-by-value join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from staylytics.functions.geo import planar_km
from staylytics.functions.parse import to_double
from staylytics.operators.cleaning import require_not_null
from staylytics.operators.features import with_center
from staylytics.sources.staging import materialize


def neighborhood_lookup(df: DataFrame, centers: DataFrame, decimals: int | None = None) -> DataFrame:
    """``city, neighbourhood_cleansed, lat, lng, n, dist_km``: mean position, size, km to the centre.

    The distance is null for a city without a centre. Averages combine per task
    before the shuffle, so a crowded neighbourhood costs no more than a small one.
    """
    keys = ["city", "neighbourhood_cleansed"]

    def tidy(c: Column) -> Column:
        return c if decimals is None else F.round(c, decimals)

    mean = require_not_null(df, keys).groupBy(*keys).agg(
        tidy(F.avg(to_double("latitude"))).alias("lat"),
        tidy(F.avg(to_double("longitude"))).alias("lng"),
        F.count(F.lit(1)).alias("n"),
    )
    placed = with_center(mean, centers, "city", None, "__clat", "__clng")
    km = tidy(planar_km("lat", "lng", "__clat", "__clng"))
    return placed.select(*keys, "lat", "lng", "n", km.alias("dist_km"))


def nearest_in_group(
    left: DataFrame,
    right: DataFrame,
    on: str,
    left_value: str,
    right_value: str,
    tie_desc: str,
    then: Sequence[str] = (),
) -> DataFrame:
    """Each left row with the right row of its group whose value is nearest.

    Ties go to the larger ``tie_desc``, then to the smaller ``then`` columns. A right
    row without a value is taken only when its group has no better one; a left row
    without a value takes the group's first row by the tie rule; a left row whose
    group is unknown keeps nulls. Right columns other than ``on`` are added.

    Both sides are laid on one line, sorted by (group, value) and cut into ranges of about equal numbers
    of rows, so neither outliers nor a crowded value or group fill a task. The nearest right rows below and
    above a left row are the last ones seen when its range is read forwards and backwards; where a range has
    none, its neighbours' edges fill in, a few rows for each range. No pairs are formed.
    """
    best = _best_by_value(right, on, right_value, tie_desc, list(then))
    rank = F.struct((-F.col(tie_desc)).alias("t"), *[F.col(c) for c in then])
    lead = materialize(best.groupBy("__g").agg(F.min_by("__row", rank).alias("__lead")), "lead")

    nothing = F.lit(None).cast(best.schema["__row"].dataType)
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    value = F.col(left_value).cast("double")
    asked = left.select(F.col(on).alias("__g"), value.alias("__v"), F.lit(1).alias("__side"), spread.alias("__salt"), F.struct("*").alias("__left"), nothing.alias("__row"))
    known = best.where("__v is not null").select(
        "__g", "__v", F.lit(0).alias("__side"), F.lit(0).cast("bigint").alias("__salt"), F.lit(None).cast(asked.schema["__left"].dataType).alias("__left"), "__row"
    )
    # rows without a group or value go along; their salt spreads them over ranges as well
    line = known.unionByName(asked)
    line = line.repartitionByRange("__g", "__v", "__side", "__salt").withColumn("__part", F.spark_partition_id())
    line = materialize(line, "line")

    entry = F.when(F.col("__side") == 0, F.struct(F.col("__v").alias("v"), F.col("__row").alias("row")))
    edges = line.where("__side = 0").groupBy("__g", "__part").agg(F.min_by(entry, "__v").alias("__first"), F.max_by(entry, "__v").alias("__last"))
    parts = line.select("__g", "__part").distinct().join(edges, ["__g", "__part"], "left")
    by_part = Window.partitionBy("__g").orderBy("__part")
    earlier = F.last("__last", ignorenulls=True).over(by_part.rowsBetween(Window.unboundedPreceding, -1))
    by_part = Window.partitionBy("__g").orderBy(F.desc("__part"))
    later = F.last("__first", ignorenulls=True).over(by_part.rowsBetween(Window.unboundedPreceding, -1))
    edges = materialize(parts.select("__g", "__part", earlier.alias("__before"), later.alias("__after")), "edges")

    inside = Window.partitionBy("__g", "__part")
    low = F.last(entry, ignorenulls=True).over(inside.orderBy("__v", "__side", "__salt").rowsBetween(Window.unboundedPreceding, 0))
    high = F.last(entry, ignorenulls=True).over(inside.orderBy(F.desc("__v"), "__side", "__salt").rowsBetween(Window.unboundedPreceding, 0))
    seen = line.withColumns({"__low": low, "__high": high}).where("__side = 1").join(edges, ["__g", "__part"], "left")

    def candidate(end: Column) -> Column:
        row = end["row"]
        order = [F.abs(end["v"] - F.col("__v")).alias("d"), (-row[tie_desc]).alias("t"), *[row[c].alias(f"k{i}") for i, c in enumerate(then)]]
        return F.when(end.isNotNull() & F.col("__v").isNotNull(), F.struct(*order, row.alias("row")))

    ends = [candidate(F.coalesce(a, b)) for a, b in ((F.col("__low"), F.col("__before")), (F.col("__high"), F.col("__after")))]
    every = seen.select("__left", "__g", F.least(*ends)["row"].alias("__row")).join(lead, "__g", "left")
    picked = F.coalesce("__row", "__lead")
    extra = [c for c in right.columns if c != on]
    return every.select(*[F.col("__left")[c].alias(c) for c in left.columns], *[picked[c].alias(c) for c in extra])


def _best_by_value(right: DataFrame, on: str, value: str, tie: str, then: list[str]) -> DataFrame:
    """``__g, __v``, the tie columns and ``__row``: the best right row of each group and value; null is a value too."""
    payload = F.struct(*[F.col(c) for c in right.columns if c != on])
    # equal values in a group compete only among themselves
    best = Window.partitionBy("__g", "__v").orderBy(F.col(tie).desc(), *[F.col(c) for c in then])
    rows = right.where(F.col(on).isNotNull()).withColumns({"__g": F.col(on), "__v": F.col(value).cast("double")})
    rows = rows.withColumn("__rn", F.row_number().over(best)).where("__rn = 1")
    return materialize(rows.select("__g", "__v", tie, *then, payload.alias("__row")), "nearest")
