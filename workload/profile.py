"""Profiling reports."""

from __future__ import annotations

from staylytics import constants as K
from staylytics.operators import profile as ops
from staylytics.operators import selection
from staylytics.operators.features import target_column
from workload.adapters import listings
from workload.clean import WITH_L, WITH_PRICED
from workload.features import ENGINEERED_SQL, ENGINEERED_TEXT, NUMERIC_SQL, engineered, priced
from workload.registry import query, rounded, rounded_sql, table

LISTING_COLUMNS = [
    "id", "city", "neighbourhood_cleansed", "property_type", "room_type", "price", "latitude", "longitude", "host_since",
    "host_response_rate", "host_is_superhost", "accommodates", "bedrooms", "bathrooms_text", "amenities", "availability_30",
    "availability_365", "number_of_reviews", "review_scores_rating", "review_scores_location", "name",
]
_TEXT = [c for c in LISTING_COLUMNS if c not in ("id", "latitude", "longitude")]


def _union(parts) -> str:
    return " union all ".join(parts)


@query(f"{WITH_L} select count(*) as rows, {len(LISTING_COLUMNS)} as columns from l")
def row_stats(spark, sf_dir):
    return ops.row_stats(listings(spark, sf_dir))


@query(
    f"""{WITH_L}, d as (select case column_type when 'VARCHAR' then 'string' when 'BIGINT' then 'bigint' when 'DOUBLE' then 'double'
                             when 'INTEGER' then 'int' end as type from (describe select * from l))
select (select count(*) from l) as rows, type, count(*) as columns from d group by type"""
)
def type_census(spark, sf_dir):
    return ops.type_census(listings(spark, sf_dir))


_NULLS = _union(
    f"select '{c}' as \"column\", count(*) - count({c}) as nulls, (count(*) - count({c})) / count(*)::double * 100 as null_pct from p"
    for c in [*LISTING_COLUMNS, "price_clean"]
)


@query(
    rounded_sql(f'{WITH_PRICED} select * from ({_NULLS}) where nulls > 0 order by nulls desc, "column" limit 10', ["null_pct"])
)
def null_profile(spark, sf_dir):
    return rounded(ops.null_profile(priced(spark, sf_dir), top=10))


def _summary(col: str) -> str:
    return f"""avg({col}) as mean, stddev_samp({col}) as std, min({col}) as min, max({col}) as max,
quantile_disc({col}, 0.25) as q1, quantile_disc({col}, 0.5) as median, quantile_disc({col}, 0.75) as q3"""


_SUMMARY_COLUMNS = ["mean", "std", "min", "max", "q1", "median", "q3"]


@query(rounded_sql(f"select {_summary('l_extendedprice')} from lineitem", _SUMMARY_COLUMNS))
def target_summary(spark, sf_dir):
    return rounded(ops.target_summary(table(spark, sf_dir, "lineitem"), "l_extendedprice"))


@query(rounded_sql(f"{WITH_PRICED} select {_summary('price_clean')} from p", _SUMMARY_COLUMNS))
def listing_price_summary(spark, sf_dir):
    df = priced(spark, sf_dir)
    return rounded(ops.target_summary(df, target_column(df)))


def corr_sql(target: str, cols, source: str) -> str:
    return _union(f"select '{c}' as \"column\", corr({target}, {c}) as correlation from {source}" for c in cols)


_LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"]


@query(rounded_sql(corr_sql("l_extendedprice", _LINE_NUMBERS, "lineitem"), ["correlation"]))
def correlations(spark, sf_dir):
    return rounded(ops.correlations(table(spark, sf_dir, "lineitem"), "l_extendedprice"))


@query(rounded_sql(corr_sql("p_retailprice", ["p_partkey", "p_size"], "part"), ["correlation"]))
def part_correlations(spark, sf_dir):
    return rounded(ops.correlations(table(spark, sf_dir, "part"), "p_retailprice"))


_FEATURES = [c for c in NUMERIC_SQL if c != "price_clean"]
FEATURE_CORR_SQL = f"with e as ({ENGINEERED_SQL}) select * from ({corr_sql('price_clean', _FEATURES, 'e')}) where correlation is not null and not isnan(correlation)"


def feature_correlations(spark, sf_dir):
    return ops.correlations(engineered(spark, sf_dir), "price_clean", limit=None)


@query(
    rounded_sql(
        f"""with r as ({FEATURE_CORR_SQL}),
h as (select *, 'positive' as side from r order by correlation desc, "column" limit 10),
w as (select *, 'negative' as side from r order by correlation, "column" limit 10)
select * from h union all select * from w""",
        ["correlation"],
    )
)
def top_correlations(spark, sf_dir):
    return rounded(ops.top_correlations(feature_correlations(spark, sf_dir)))


@query(
    rounded_sql(
        f"{WITH_PRICED} select room_type, count(*) as listings, avg(price_clean) as avg_price from p group by room_type", ["avg_price"]
    )
)
def category_summary(spark, sf_dir):
    return rounded(ops.category_summary(priced(spark, sf_dir), "room_type", "price_clean"))


@query(f"{WITH_L} select property_type, count(*) as count from l group by property_type order by count desc, property_type limit 10")
def top_categories(spark, sf_dir):
    return ops.top_categories(listings(spark, sf_dir), "property_type")


@query(rounded_sql("select event_type, count(*) as listings, avg(value) as avg_price from events group by event_type", ["avg_price"]))
def event_summary(spark, sf_dir):
    return rounded(ops.category_summary(table(spark, sf_dir, "events"), "event_type", "value"))


_RANGED = ["amenities_count", "host_response_rate_clean", "host_days_active", "distance_to_center"]
_FLAGS = ["host_is_superhost_binary", *K.AMENITY_PATTERNS, "has_reviews", *K.ROOM_TYPES]
_WITH_E = f"with e as ({ENGINEERED_SQL})"


@query(
    rounded_sql(
        f"{_WITH_E} "
        + _union(
            f"select '{c}' as \"column\", avg({c})::double as avg, min({c})::double as min, max({c})::double as max from e" for c in _RANGED
        ),
        ["avg", "min", "max"],
    )
)
def column_ranges(spark, sf_dir):
    return rounded(ops.column_stats(engineered(spark, sf_dir), _RANGED))


@query(
    rounded_sql(
        f"{_WITH_E} " + _union(f"select '{c}' as \"column\", count(*) filter ({c} = 1) * 100.0::double / count(*) as pct from e" for c in _FLAGS),
        ["pct"],
    )
)
def flag_shares(spark, sf_dir):
    return rounded(ops.flag_share(engineered(spark, sf_dir), _FLAGS))


@query(
    f"{WITH_L} "
    + _union(
        f"select '{c}' as \"column\", count(distinct {c}) + max(case when {c} is null then 1 else 0 end) as n_distinct, "
        f"n_distinct between 2 and 50 as usable from l"
        for c in _TEXT
    )
)
def cardinality_gate(spark, sf_dir):
    df = listings(spark, sf_dir)
    counted = ops.cardinality(df, ops.string_columns(df))
    return counted.withColumn("usable", counted["n_distinct"].between(2, 50))


def _list(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


def _skip(words) -> str:
    return " and ".join(f"not contains(lower(c), '{w}')" for w in words)


_SELECTION = f"""{_WITH_E},
d as (select column_name as c, column_type as t, row_number() over () as i from (describe select * from e)),
num as (select * from d where t in ('BIGINT', 'INTEGER', 'DOUBLE') and c <> 'price_clean'),
base as (select * from num where c not in ({_list(K.BASELINE_BANNED)}) and {_skip(K.BASELINE_SKIP_WORDS)}),
card as ({_union(f"select '{c}' as c, count(distinct {c}) + max(case when {c} is null then 1 else 0 end) as n from e" for c in ENGINEERED_TEXT)}),
cat as (select d.* from d join card using (c) where t = 'VARCHAR' and n between 2 and 50),
cor as (select "column" as c, abs(correlation) as r from ({corr_sql('price_clean', _FEATURES, 'e')}) where not isnan(correlation)),
pref as (select c, i from (select unnest([{_list(K.PREFERRED_NUMERIC)}]) as c, generate_subscripts([{_list(K.PREFERRED_NUMERIC)}], 1) as i)
         where c in (select c from num)),
picks as (
 select 'baseline' as model, 'numeric' as kind, c, row_number() over (order by i) as p, 25 as k from base
 union all select 'baseline', 'categorical', c, row_number() over (order by i), 10 from cat
   where c not in ({_list(K.BASELINE_BANNED)}) and {_skip(K.BASELINE_SKIP_WORDS)}
 union all select 'baseline by correlation', 'numeric', c, row_number() over (order by round(coalesce(r, 0), 9) desc, i), 25 from base left join cor using (c)
 union all select 'gbt', 'numeric', c, row_number() over (order by i), 99 from pref where c not in ({_list(K.LEAKY_FEATURES)})
 union all select 'gbt', 'categorical', c, row_number() over (order by i), 10 from cat where c in ({_list(K.GBT_CATEGORICAL)})
 union all select 'explain', 'numeric', c, row_number() over (order by i), 99 from pref where c not in ({_list(K.EXPLAIN_BANNED)})
 union all select 'explain', 'categorical', c, row_number() over (order by i), 10 from cat where c in ({_list(K.EXPLAIN_CATEGORICAL)}))
select model, kind, cast(p as int) as position, c as feature from picks where p <= k"""


@query(_SELECTION)
def feature_selection(spark, sf_dir):
    """Which columns each model takes, one row per (model, kind, feature)."""
    df = engineered(spark, sf_dir)
    chosen = {
        ("baseline", "numeric"): selection.select_numeric(df),
        ("baseline", "categorical"): selection.select_categorical(df),
        ("baseline by correlation", "numeric"): selection.select_numeric(df, ranking=feature_correlations(spark, sf_dir)),
        ("gbt", "numeric"): selection.select_preferred(df),
        ("gbt", "categorical"): selection.select_categorical(df, K.GBT_CATEGORICAL),
        ("explain", "numeric"): selection.select_preferred(df, banned=K.EXPLAIN_BANNED, min_n=0),
        ("explain", "categorical"): selection.select_categorical(df, K.EXPLAIN_CATEGORICAL),
    }
    for names in chosen.values():
        selection.assert_no_leak(names)
    rows = [(m, k, i, c) for (m, k), names in chosen.items() for i, c in enumerate(names, 1)]
    return spark.createDataFrame(rows, "model string, kind string, position int, feature string")
