"""Splits, samples, metrics, segments and model comparison.

Predictions are formulas over the listings, so SQL can state every result.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from staylytics import constants as K
from staylytics.functions import band, to_int
from staylytics.operators import combine, evaluate, results, split
from workload.clean import WITH_PRICED
from workload.features import _int, priced
from workload.registry import query, rounded, rounded_sql, table

PREDS = {"baseline": "baseline_pred", "gbt": "gbt_pred"}
WITH_SCORED = f"""{WITH_PRICED}, s as (select id, price_clean, city, room_type, {_int('accommodates')} as accommodates,
0.6::double * price_clean + 40.0::double + 6.0::double * {_int('accommodates')} as baseline_pred,
0.9::double * price_clean + 10.0::double + 3.0::double * {_int('bedrooms')} as gbt_pred from p)"""


def scored(spark, sf_dir):
    """Listings with two formula predictions; the second is null where bedrooms are unknown."""
    guests, rooms = to_int("accommodates"), to_int("bedrooms")
    price = F.col("price_clean")
    return priced(spark, sf_dir).select(
        "id", "price_clean", "city", "room_type", guests.alias("accommodates"),
        (F.lit(0.6) * price + F.lit(40.0) + F.lit(6.0) * guests).alias("baseline_pred"),
        (F.lit(0.9) * price + F.lit(10.0) + F.lit(3.0) * rooms).alias("gbt_pred"),
    )


# --- splits and samples -----------------------------------------------------------
_HASH = "concat('0x', substr(md5(concat('42|', o_orderkey)), 1, 8))::ubigint"


@query(f"select o_orderkey, o_totalprice, case when {_HASH} % 100 < 80 then 'train' else 'test' end as split from orders")
def hash_split(spark, sf_dir):
    return split.hash_split(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")


@query(
    f"""with n as (select least(3000, count(*)) / count(*)::double as share from orders)
select o_orderkey, o_custkey, o_totalprice from orders, n where {_HASH} / 4294967296.0::double < share"""
)
def sample_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return split.hash_sample(orders, "o_orderkey", n=3000)


@query("select o_orderkey, o_orderstatus, o_totalprice from orders order by o_orderkey limit 10")
def first_rows(spark, sf_dir):
    return results.first_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), "o_orderkey", 10)


# --- metrics -------------------------------------------------------------------------
def metrics_sql(source: str, actual: str, preds: dict[str, str], by: str = "") -> str:
    group, lead = (f" group by {by}", f"{by}, ") if by else ("", "")
    parts = []
    for model, pred in preds.items():
        y, p = actual, pred
        parts.append(
            f"""select {lead}'{model}' as model, sqrt(avg(pow({y} - {p}, 2))) as rmse, avg(abs({y} - {p})) as mae,
1 - sum(pow({y} - {p}, 2)) / nullif(var_pop({y}) * count(*), 0) as r2, avg(abs(({y} - {p}) / nullif({y}, 0))) * 100 as mape,
avg({y}) as actual_mean, avg({p}) as pred_mean, stddev_samp({y}) as actual_std, stddev_samp({p}) as pred_std,
max(abs({y} - {p})) as max_error, count(*) as n_samples from {source} where {y} is not null and {p} is not null{group}"""
        )
    return " union all ".join(parts)


_MEASURES = [m for m in evaluate.METRICS if m != "n_samples"]
_LINES = "(select *, 1500.0::double * l_quantity as flat_pred, 1480.0::double * l_quantity * (1 + l_tax) as tax_pred from lineitem)"
_LINE_PREDS = {"flat": "flat_pred", "tax": "tax_pred"}


def _line_scores(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    flat = F.lit(1500.0) * F.col("l_quantity")
    return lines.withColumns({"flat_pred": flat, "tax_pred": F.lit(1480.0) * F.col("l_quantity") * (1 + F.col("l_tax"))})


@query(rounded_sql(metrics_sql(_LINES, "l_extendedprice", _LINE_PREDS), _MEASURES))
def model_metrics(spark, sf_dir):
    return rounded(evaluate.regression_metrics(_line_scores(spark, sf_dir), "l_extendedprice", _LINE_PREDS))


@query(rounded_sql(metrics_sql(_LINES, "l_extendedprice", _LINE_PREDS, "l_returnflag"), _MEASURES))
def model_metrics_by_flag(spark, sf_dir):
    return rounded(evaluate.regression_metrics(_line_scores(spark, sf_dir), "l_extendedprice", _LINE_PREDS, ["l_returnflag"]))


@query(rounded_sql(f"{WITH_SCORED} {metrics_sql('s', 'price_clean', PREDS)}", _MEASURES))
def listing_model_metrics(spark, sf_dir):
    return rounded(evaluate.regression_metrics(scored(spark, sf_dir), "price_clean", PREDS))


@query(
    rounded_sql(
        f"""{WITH_SCORED}, a as (select id, price_clean, city, room_type, accommodates, baseline_pred from s),
b as (select id, gbt_pred from s where gbt_pred is not null)
select * from a join b using (id)""",
        ["price_clean", "baseline_pred", "gbt_pred"],
    )
)
def prediction_join(spark, sf_dir):
    df = scored(spark, sf_dir)
    sets = {
        "baseline_pred": df.withColumnRenamed("baseline_pred", "prediction"),
        "gbt_pred": df.where("gbt_pred is not null").withColumnRenamed("gbt_pred", "prediction"),
    }
    return rounded(combine.join_predictions(sets, "id", ["price_clean", "city", "room_type", "accommodates"]))


def _segment_sql(by: str, metrics, source: str = "s") -> str:
    forms = {"rmse": "sqrt(avg(pow(price_clean - {p}, 2)))", "mae": "avg(abs(price_clean - {p}))",
             "mape": "avg(abs((price_clean - {p}) / nullif(price_clean, 0))) * 100"}
    cols = [f"{forms[m].format(p=p)} as {n}_{m}" for m in metrics for n, p in PREDS.items()]
    return f"select {by}, count(*) as count, avg(price_clean) as avg_price, {', '.join(cols)} from {source} group by {by}"


def _segment_columns(metrics):
    return ["avg_price", *[f"{n}_{m}" for m in metrics for n in PREDS]]


@query(rounded_sql(f"{WITH_SCORED} {_segment_sql('city', ['rmse', 'mae'])}", _segment_columns(["rmse", "mae"])))
def segment_city(spark, sf_dir):
    return rounded(evaluate.segment_metrics(scored(spark, sf_dir), "price_clean", PREDS, "city"))


@query(rounded_sql(f"{WITH_SCORED} {_segment_sql('room_type', ['rmse'])}", _segment_columns(["rmse"])))
def segment_room(spark, sf_dir):
    return rounded(evaluate.segment_metrics(scored(spark, sf_dir), "price_clean", PREDS, "room_type", ["rmse"], "avg_price"))


_BAND = "case when price_clean < 75 then 'Budget (<$75)' when price_clean < 150 then 'Mid-range ($75-150)' when price_clean < 250 then 'Premium ($150-250)' else 'Luxury (>$250)' end"


@query(
    rounded_sql(
        f"{WITH_SCORED}, b as (select *, {_BAND} as price_range from s) {_segment_sql('price_range', ['rmse', 'mape'], 'b')}",
        _segment_columns(["rmse", "mape"]),
    )
)
def segment_band(spark, sf_dir):
    df = scored(spark, sf_dir).withColumn("price_range", band("price_clean", K.PRICE_BOUNDS, K.PRICE_RANGE_LABELS))
    return rounded(evaluate.segment_metrics(df, "price_clean", PREDS, "price_range", ["rmse", "mape"], "avg_price"))


_ERRORS = ", ".join(
    f"{p} - price_clean as {n}_error, abs({p} - price_clean) as {n}_abs_error, abs({p} - price_clean) / nullif(price_clean, 0) * 100 as {n}_error_pct"
    for n, p in PREDS.items()
)
_ERROR_COLUMNS = [f"{n}_{e}" for n in PREDS for e in ("error", "abs_error", "error_pct")]


@query(rounded_sql(f"{WITH_SCORED} select id, {_ERRORS} from s", _ERROR_COLUMNS))
def prediction_errors(spark, sf_dir):
    return rounded(evaluate.with_errors(scored(spark, sf_dir), "price_clean", PREDS).select("id", *_ERROR_COLUMNS))


@query(
    rounded_sql(
        f"{WITH_SCORED}, e as (select {_ERRORS} from s) "
        + " union all ".join(
            f"""select '{n}' as model, avg({n}_abs_error) as avg_abs_error, stddev_samp({n}_error) as error_std, max({n}_abs_error) as max_error,
quantile_disc({n}_error_pct, 0.5) as median_error_pct, quantile_disc({n}_error_pct, 0.9) as p90_error_pct from e"""
            for n in PREDS
        ),
        ["avg_abs_error", "error_std", "max_error", "median_error_pct", "p90_error_pct"],
    )
)
def error_distribution(spark, sf_dir):
    return rounded(evaluate.error_distribution(scored(spark, sf_dir), "price_clean", PREDS))


# --- comparison ---------------------------------------------------------------------
_M = f"{WITH_SCORED}, m as ({metrics_sql('s', 'price_clean', PREDS)}), b as (select * from m where model = 'baseline'), g as (select * from m where model = 'gbt')"
_LOWER = ", ".join(f"(b.{m} - g.{m}) / nullif(b.{m}, 0) * 100 as {m}_improvement_pct" for m in ("rmse", "mae", "mape"))
_IMPROVE = f"""select {_LOWER}, (g.r2 - b.r2) / nullif(abs(b.r2), 0) * 100 as r2_improvement_pct,
case when b.r2 > 0 then (g.r2 - b.r2) / b.r2 * 100 else 50.0::double end as r2_gain_pct from b, g"""


def _metrics(spark, sf_dir):
    return evaluate.regression_metrics(scored(spark, sf_dir), "price_clean", PREDS)


@query(
    rounded_sql(
        f"{_M} {_IMPROVE}",
        ["rmse_improvement_pct", "mae_improvement_pct", "mape_improvement_pct", "r2_improvement_pct", "r2_gain_pct"],
    )
)
def improvement(spark, sf_dir):
    return rounded(evaluate.improvement(_metrics(spark, sf_dir), fallback=50.0))


@query(
    rounded_sql(
        f"""{_M}, i as ({_IMPROVE}) select case when rmse_improvement_pct > 0 then 'gbt' else 'baseline' end as winner,
case when rmse_improvement_pct > 10 then 'use gbt' when rmse_improvement_pct > 5 then 'consider gbt' else 'keep baseline' end as advice,
rmse_improvement_pct from i""",
        ["rmse_improvement_pct"],
    )
)
def winner(spark, sf_dir):
    return rounded(evaluate.winner(evaluate.improvement(_metrics(spark, sf_dir))))


@query(
    rounded_sql(
        f"{_M} "
        + " union all ".join(f"select '{m}' as metric, b.{m} as baseline, g.{m} as gbt from b, g" for m in ("rmse", "mae", "r2", "mape")),
        ["baseline", "gbt"],
    )
)
def comparison_table(spark, sf_dir):
    return rounded(evaluate.comparison(_metrics(spark, sf_dir)))
