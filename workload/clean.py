"""Prices, duplicates, outliers and the union of sources."""

from __future__ import annotations

from staylytics.functions import clean_price as price_of
from staylytics.functions import price_fallback as fallback_of
from staylytics.operators import cleaning, profile
from staylytics.plans import prepare
from staylytics.sources import read_sources, scratch_path, write_table
from workload.adapters import LISTINGS_SQL, PRICED_SQL, SCRAPES_SQL, dealt_scrapes, listings
from workload.registry import query, rounded, rounded_sql, table

# l: listings, s: listings with copies, u: priced and unique, c: within the city's quartile reach
WITH_L = f"with l as ({LISTINGS_SQL})"
WITH_PRICED = f"{WITH_L}, p as ({PRICED_SQL.format(source='l')})"
WITH_CLEAN = f"""{WITH_L}, s as ({SCRAPES_SQL}), sp as ({PRICED_SQL.format(source='s')}),
u as (select * exclude (t) from sp where price_clean is not null and latitude is not null and longitude is not null
      qualify row_number() over (partition by city, id order by name) = 1),
q as (select city, quantile_disc(price_clean, 0.25) q1, quantile_disc(price_clean, 0.75) q3 from u group by city),
c as (select u.* from u join q using (city)
      where price_clean between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))"""


def cleaned(spark, sf_dir, columns=None):
    return prepare.clean_listings(dealt_scrapes(spark, sf_dir), order_by=["name"], columns=columns)


@query(f"{WITH_PRICED} select id, price, round(price_clean, 6) as price_clean from p")
def price_clean(spark, sf_dir):
    return rounded(listings(spark, sf_dir).select("id", "price", price_of("price").alias("price_clean")))


@query(
    f"{WITH_L} select id, price, round(try_cast(regexp_replace(price, '[^0-9.]', '', 'g') as double), 6) as price_clean from l"
)
def price_fallback(spark, sf_dir):
    return rounded(listings(spark, sf_dir).select("id", "price", fallback_of("price").alias("price_clean")))


@query(rounded_sql(f"{WITH_CLEAN} select * from c", ["latitude", "longitude", "price_clean"]))
def clean_listings(spark, sf_dir):
    return rounded(cleaned(spark, sf_dir))


@query(
    rounded_sql(
        f"""{WITH_CLEAN}, a as (select city, count(*) n from c group by city), b as (select city, count(*) n from s group by city)
select city, b.n as rows_before, coalesce(a.n, 0) as rows_after, coalesce(a.n, 0) * 100.0::double / b.n as keep_pct
from b left join a using (city)""",
        ["keep_pct"],
    )
)
def keep_rate(spark, sf_dir):
    kept, came_in = prepare.clean_counted(dealt_scrapes(spark, sf_dir), order_by=["name"], columns=[])
    return rounded(cleaning.keep_rate(came_in, kept, ["city"], counted="__rows"))


_TRIM = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]


@query(
    f"""with q as (select quantile_disc(l_extendedprice, 0.025) lo, quantile_disc(l_extendedprice, 0.975) hi from lineitem)
select {', '.join(_TRIM)} from lineitem, q where l_extendedprice between lo and hi"""
)
def quantile_trim(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*_TRIM)
    return cleaning.quantile_trim(lines, "l_extendedprice", 0.025, 0.975)


@query(
    f"""with q as (select l_returnflag, l_linestatus, quantile_disc(l_extendedprice, 0.01) lo, quantile_disc(l_extendedprice, 0.99) hi
           from lineitem group by all)
select {', '.join(_TRIM)}, l_returnflag, l_linestatus from lineitem join q using (l_returnflag, l_linestatus)
where l_extendedprice between lo and hi"""
)
def quantile_trim_by_group(spark, sf_dir):
    by = ["l_returnflag", "l_linestatus"]
    return cleaning.quantile_trim(table(spark, sf_dir, "lineitem").select(*_TRIM, *by), "l_extendedprice", 0.01, 0.99, by)


def _unified(spark, sf_dir):
    """Write one table per city, read them back with one city that has none, and combine."""
    path = scratch_path(spark, "cities")
    write_table(listings(spark, sf_dir), path, partition_by=["city"])
    cities = ["nyc", "london", "amsterdam", "barcelona", "paris", "oslo"]
    parts = read_sources(spark, {c: f"{path}/city={c}" for c in cities}, on_missing="skip")
    parts["barcelona"] = parts["barcelona"].drop("name")
    return prepare.unify(parts)


@query(rounded_sql(f"{WITH_L} select * exclude (name) from l", ["latitude", "longitude"]))
def unify_sources(spark, sf_dir):
    return rounded(_unified(spark, sf_dir))


@query(f"{WITH_L} select city, count(*) as count from l group by city order by city")
def city_counts(spark, sf_dir):
    return profile.group_counts(_unified(spark, sf_dir), "city")


@query(
    rounded_sql(
        f"""{WITH_CLEAN} select city, count(price_clean) as count, avg(price_clean) as avg_price,
min(price_clean) as min_price, max(price_clean) as max_price from c group by city""",
        ["avg_price", "min_price", "max_price"],
    )
)
def city_price_stats(spark, sf_dir):
    return rounded(profile.group_stats(cleaned(spark, sf_dir, []), "city", "price_clean"))
