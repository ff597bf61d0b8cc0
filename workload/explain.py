"""Attributions, dependence curves and importance comparison with formulas, so SQL can state the rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from staylytics.functions import to_int
from staylytics.operators import explain, profile
from workload.clean import WITH_PRICED
from workload.features import _int, priced
from workload.profile import corr_sql
from workload.registry import query, rounded, rounded_sql, table

KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
WEIGHTS = {"l_quantity": 1500.0, "l_discount": -9000.0, "l_tax": 4000.0, "l_linenumber": 12.5}
INTERCEPT = 250.0


def _means(names, source):
    return f"(select {', '.join(f'avg({c}) as m_{c}' for c in names)} from {source})"


def _cells(weights, lead, source):
    """One row per feature: value and weight * (value - mean)."""
    base = " + ".join([f"{INTERCEPT}::double", *[f"{w}::double * m_{c}" for c, w in weights.items()]])
    total = " + ".join([f"{INTERCEPT}::double", *[f"{w}::double * {c}" for c, w in weights.items()]])
    return " union all ".join(
        f"select {lead}, {total} as prediction, {base} as base_value, '{c}' as feature, {c}::double as value, "
        f"{w}::double * ({c} - m_{c}) as contribution from {source}, {_means(weights, source)} m"
        for c, w in weights.items()
    )


_CELL_COLUMNS = ["prediction", "base_value", "value", "contribution"]
_LINE_CELLS = _cells(WEIGHTS, "l_orderkey, l_partkey, l_suppkey, l_linenumber as line", "lineitem")


def _line_attributions(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").withColumn("line", F.col("l_linenumber"))
    return explain.linear_contributions(df, [*KEYS[:3], "line"], WEIGHTS, INTERCEPT)


@query(rounded_sql(_LINE_CELLS, _CELL_COLUMNS))
def linear_attribution(spark, sf_dir):
    found = _line_attributions(spark, sf_dir)
    return rounded(found.select(*KEYS[:3], "line", "prediction", "base_value", F.inline("attributions")))


_IMPORTANCE = f"select feature, avg(abs(contribution)) as importance from ({_LINE_CELLS}) group by feature"


@query(rounded_sql(_IMPORTANCE, ["importance"]))
def attribution_importance(spark, sf_dir):
    return rounded(explain.attribution_importance(_line_attributions(spark, sf_dir)))


_ROOM_WEIGHTS = {"guests": 55.0, "rooms": 80.0, "price_clean": 0.25}
_ROOMS = f"(select id, price_clean, {_int('accommodates')} as guests, {_int('bedrooms')} as rooms from p where price_clean is not null and bedrooms is not null)"
POSITIONS = [0, 25, 50, 100, 200]


@query(
    rounded_sql(
        f"""{WITH_PRICED}, x as {_ROOMS}, c as ({_cells(_ROOM_WEIGHTS, 'id', 'x')}),
k as (select id from (select id, row_number() over (order by id) - 1 as i from x) where i in ({', '.join(map(str, POSITIONS))}))
select c.*, cast(row_number() over (partition by id order by abs(contribution) desc, feature) as int) as rank from c join k using (id)""",
        _CELL_COLUMNS,
    )
)
def local_explanation(spark, sf_dir):
    df = priced(spark, sf_dir).select(
        "id", "price_clean", to_int("accommodates").alias("guests"), to_int("bedrooms").alias("rooms")
    ).na.drop()
    found = explain.linear_contributions(df, "id", _ROOM_WEIGHTS, INTERCEPT)
    return rounded(explain.local_explanation(found, "id", explain.keys_at(df, "id", POSITIONS)))


def _predict(df):
    total = F.lit(INTERCEPT)
    for c, w in WEIGHTS.items():
        total = total + F.lit(w) * F.col(c)
    return df.withColumn("prediction", total + F.col("l_quantity") * F.col("l_discount") * 100.0)


def _curve(feature, values):
    total = " + ".join([f"{INTERCEPT}::double", *[f"{w}::double * {'g.value' if c == feature else c}" for c, w in WEIGHTS.items()]])
    quantity = "g.value" if feature == "l_quantity" else "l_quantity"
    return f"""with g as ({values}) select '{feature}' as feature, g.value, avg({total} + {quantity} * l_discount * 100.0::double) as avg_prediction
from lineitem, g group by g.value"""


@query(rounded_sql(_curve("l_quantity", "select distinct l_quantity as value from lineitem"), ["value", "avg_prediction"]))
def partial_dependence(spark, sf_dir):
    """A feature with few values: the grid is the values themselves."""
    df = table(spark, sf_dir, "lineitem").select(*WEIGHTS)
    return rounded(explain.partial_dependence(_predict, df, "l_quantity"))


_PRICE_GRID = """select q.lo + (q.hi - q.lo) * i / 99 as value from
(select quantile_disc(l_extendedprice, 0.05) lo, quantile_disc(l_extendedprice, 0.95) hi from lineitem) q, range(100) r(i)"""


@query(
    rounded_sql(
        f"""with g as ({_PRICE_GRID}) select 'l_extendedprice' as feature, g.value, avg(g.value * (1 - l_discount) * (1 + l_tax)) as avg_prediction
from lineitem, g group by g.value""",
        ["value", "avg_prediction"],
    )
)
def partial_dependence_grid(spark, sf_dir):
    """A feature with many values: an even grid between two quantiles."""
    df = table(spark, sf_dir, "lineitem").select("l_extendedprice", "l_discount", "l_tax")
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return rounded(explain.partial_dependence(lambda d: d.withColumn("prediction", charge), df, "l_extendedprice"))


_CORR = f"select \"column\" as feature, abs(correlation) as importance from ({corr_sql('l_extendedprice', WEIGHTS, 'lineitem')})"


@query(
    rounded_sql(
        f"""with a as ({_IMPORTANCE}), b as ({_CORR}),
j as (select feature, a.importance as gb_importance, b.importance as lr_importance from a join b using (feature)),
r as (select *, rank() over (order by gb_importance desc) + (count(*) over (partition by gb_importance) - 1) / 2.0::double as gb_rank,
        rank() over (order by lr_importance desc) + (count(*) over (partition by lr_importance) - 1) / 2.0::double as lr_rank from j)
select *, lr_rank - gb_rank as rank_difference,
case when abs(lr_rank - gb_rank) <= 3 then 'consistent' when abs(lr_rank - gb_rank) > 5 then 'different' else 'between' end as agreement from r""",
        ["gb_importance", "lr_importance", "gb_rank", "lr_rank", "rank_difference"],
    )
)
def importance_comparison(spark, sf_dir):
    """Features ranked by mean attribution and by correlation."""
    by_share = explain.attribution_importance(_line_attributions(spark, sf_dir))
    corr = profile.correlations(table(spark, sf_dir, "lineitem"), "l_extendedprice", list(WEIGHTS))
    by_corr = corr.select(F.col("column").alias("feature"), F.abs("correlation").alias("importance"))
    return rounded(explain.compare_importances(by_share, by_corr))
