"""Result tables: groups, rankings, key figures, encodings, files."""

from __future__ import annotations

from pyspark.sql import functions as F

from staylytics.functions import pretty
from staylytics.operators import explain, models, profile, results
from staylytics.sources import literal_table, read_listings, read_table, scratch_path, write_table
from workload.adapters import listings
from workload.clean import WITH_L
from workload.evaluate import _MEASURES, PREDS, WITH_SCORED, _metrics, metrics_sql, scored
from workload.features import ENGINEERED_SQL, engineered
from workload.profile import _FEATURES, FEATURE_CORR_SQL, corr_sql, feature_correlations
from workload.registry import query, rounded, rounded_sql, table

_STRENGTH = f"select \"column\" as feature, abs(correlation) as importance from ({FEATURE_CORR_SQL})"


def strengths(spark, sf_dir):
    """Importance of every engineered feature as the size of its correlation with price."""
    corr = feature_correlations(spark, sf_dir)
    return corr.select(F.col("column").alias("feature"), F.abs("correlation").alias("importance"))


_CATEGORY = """case when regexp_matches(feature, 'host|superhost') then 'Host Quality' when regexp_matches(feature, 'review|rating') then 'Review Metrics'
when regexp_matches(feature, 'amenity|wifi|kitchen') then 'Amenities' when regexp_matches(feature, 'bedroom|bathroom|accommodate') then 'Property Size'
when regexp_matches(feature, 'distance|city|location') then 'Location' else 'Other' end"""


@query(
    rounded_sql(
        f"select {_CATEGORY} as category, sum(importance) as sum, avg(importance) as mean, count(*) as count from ({_STRENGTH}) group by 1",
        ["sum", "mean"],
    )
)
def importance_by_category(spark, sf_dir):
    return rounded(results.importance_by_category(strengths(spark, sf_dir)))


@query(
    rounded_sql(
        f"""select feature, array_to_string(list_transform(string_split(feature, '_'), lambda w: upper(w[1]) || w[2:]), ' ') as label, importance
from ({_STRENGTH}) order by importance desc, feature limit 15""",
        ["importance"],
    )
)
def top_features(spark, sf_dir):
    best = results.top_k(strengths(spark, sf_dir), "importance", 15, then="feature")
    return rounded(best.select("feature", pretty("feature").alias("label"), "importance"))


_OTHERS = [c for c in [*_FEATURES, "price_clean"] if c != "number_of_reviews"]
_REVIEW_STRENGTH = f"""with e as ({ENGINEERED_SQL}) select "column" as feature, abs(correlation) as importance
from ({corr_sql('number_of_reviews', _OTHERS, 'e')}) where correlation is not null and not isnan(correlation)"""


@query(
    rounded_sql(
        f"""with a as (select feature, round(importance, 2) as i from ({_STRENGTH})), b as (select feature, round(importance, 2) as i from ({_REVIEW_STRENGTH})),
j as (select coalesce(a.feature, b.feature) as feature, coalesce(a.i, 0) as gb_importance, coalesce(b.i, 0) as lr_importance
      from a full join b on a.feature = b.feature),
r as (select *, rank() over (order by gb_importance desc) + (count(*) over (partition by gb_importance) - 1) / 2.0::double as gb_rank,
        rank() over (order by lr_importance desc) + (count(*) over (partition by lr_importance) - 1) / 2.0::double as lr_rank from j)
select *, lr_rank - gb_rank as rank_difference,
case when abs(lr_rank - gb_rank) <= 3 then 'consistent' when abs(lr_rank - gb_rank) > 5 then 'different' else 'between' end as agreement from r""",
        ["gb_importance", "lr_importance", "gb_rank", "lr_rank", "rank_difference"],
    )
)
def importance_comparison_of_features(spark, sf_dir):
    """All engineered features ranked by what goes with price and with reviews: ties, wide gaps, features of one side only."""
    corr = profile.correlations(engineered(spark, sf_dir), "number_of_reviews", _OTHERS)
    sides = [strengths(spark, sf_dir), corr.select(F.col("column").alias("feature"), F.abs("correlation").alias("importance"))]
    sides = [d.select("feature", F.round("importance", 2).alias("importance")) for d in sides]
    return rounded(explain.compare_importances(*sides))


@query(
    f"{WITH_SCORED} select (select count(*) from ({_STRENGTH})) as features, count(distinct city) as cities from (select city from s group by city)"
)
def key_figures(spark, sf_dir):
    cities = scored(spark, sf_dir).groupBy("city").agg(F.count(F.lit(1)).alias("count"))
    return results.kpis(strengths(spark, sf_dir), cities)


_CODED = ["city", "property_type", "host_is_superhost"]


@query(
    f"{WITH_L} select id, "
    + ", ".join(f"cast(dense_rank() over (order by coalesce({c}, 'missing')) - 1 as int) as {c}" for c in _CODED)
    + " from l"
)
def alphabetical_encoding(spark, sf_dir):
    return models.encode_alphabetical(listings(spark, sf_dir).select("id", *_CODED), _CODED)


@query(rounded_sql(f"{WITH_L} select * from l", ["latitude", "longitude"]))
def csv_round_trip(spark, sf_dir):
    """Listings written as CSV, quotes and nulls included, and read back as text."""
    path = scratch_path(spark, "csv")
    write_table(listings(spark, sf_dir), path, "csv")
    back = read_listings(spark, path)
    typed = {"id": F.col("id").cast("bigint"), "latitude": F.col("latitude").cast("double"), "longitude": F.col("longitude").cast("double")}
    return rounded(back.withColumns(typed))


_LONG = " union all ".join(
    f"select 'formulas' as run, model, cast(null as varchar) as split, cast(null as varchar) as segment, '{m}' as metric, {m}::double as value from m"
    for m in [*_MEASURES, "n_samples"]
)


@query(rounded_sql(f"{WITH_SCORED}, m as ({metrics_sql('s', 'price_clean', PREDS)}) {_LONG}", ["value"]))
def metrics_sink(spark, sf_dir):
    """Metrics in the long form, through a single JSON file and back."""
    path = scratch_path(spark, "metrics")
    long = results.metrics_long(_metrics(spark, sf_dir), "formulas")
    write_table(long, path, "json", single_file=True)
    return rounded(read_table(spark, path, "json", schema=results.METRIC_SCHEMA))


@query("select r_regionkey, r_name, r_name || ', \"' || r_regionkey || '\"' as label from region")
def single_file_csv(spark, sf_dir):
    """A small table as one CSV file with quoted text, and back."""
    path = scratch_path(spark, "one-file")
    small = table(spark, sf_dir, "region").select("r_regionkey", "r_name", F.expr("concat(r_name, ', \"', r_regionkey, '\"')").alias("label"))
    write_table(small.repartition(3), path, "csv", single_file=True)
    back = read_table(spark, path, "csv")
    if len(back.inputFiles()) != 1:
        raise ValueError("one file was asked for")
    return back.withColumn("r_regionkey", F.col("r_regionkey").cast("int"))


@query("select n_name, v.w as weight from nation join (values (0, 1.5::double), (1, 2.5::double), (4, null)) v(k, w) on n_regionkey = v.k")
def literal_table_join(spark, sf_dir):
    """Given values as a table."""
    weights = literal_table(spark, [(0, 1.5), (1, 2.5), (4, None)], "k int, weight double")
    nation = table(spark, sf_dir, "nation")
    return nation.join(weights, nation["n_regionkey"] == weights["k"]).select("n_name", "weight")


@query("select s_suppkey, cast(null as double) as avg_price from supplier")
def absent_table(spark, sf_dir):
    """A result table that was never written is an empty one."""
    absent = read_table(spark, scratch_path(spark, "never-written"), empty_schema="s_key bigint, avg_price double")
    supplier = table(spark, sf_dir, "supplier")
    return supplier.join(absent, supplier["s_suppkey"] == absent["s_key"], "left").select("s_suppkey", "avg_price")
