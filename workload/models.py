"""Fitted models. Rows only: SQL cannot state a model, except the one-feature line.

The trees are the package's own: 100 of depth 8.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from staylytics.operators import evaluate, explain, models, results, selection
from staylytics.operators.split import hash_split
from staylytics.plans import train
from staylytics.sources import scratch_path
from workload.adapters import REQUESTS_SQL, requests
from workload.features import ENGINEERED_SQL, engineered
from workload.registry import query, rounded, rounded_sql, table

_fitted: dict[tuple, object] = {}


def _once(spark, sf_dir, name, build):
    """A model is trained once per application and used by several queries."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _fitted:
        _fitted[key] = build()
    return _fitted[key]


def chosen(spark, sf_dir):
    df = engineered(spark, sf_dir)
    return _once(spark, sf_dir, "features", lambda: (train.baseline_features(df), train.gbt_features(df)))


def training(spark, sf_dir):
    base, gbt = chosen(spark, sf_dir)
    df = engineered(spark, sf_dir)
    return _once(spark, sf_dir, "training", lambda: train.training_table(df, [*base.all, *gbt.all]))


def linear(spark, sf_dir):
    base, _ = chosen(spark, sf_dir)
    return _once(spark, sf_dir, "linear", lambda: train.train_baseline(training(spark, sf_dir), base))


def trees(spark, sf_dir):
    _, gbt = chosen(spark, sf_dir)
    return _once(spark, sf_dir, "gbt", lambda: train.train_gbt(training(spark, sf_dir), gbt))


def quote_trees(spark, sf_dir):
    return _once(spark, sf_dir, "quote", lambda: _quote_model(spark, sf_dir))


def trees_inputs(spark, sf_dir):
    return chosen(spark, sf_dir)[1].all


def _by_split(model, df):
    return rounded(evaluate.regression_metrics(models.score(model, df), "price_clean", {"model": "prediction"}, ["split"]))


_TRIMMED = f"""with e as ({ENGINEERED_SQL}),
q as (select quantile_disc(price_clean, 0.01) lo, quantile_disc(price_clean, 0.99) hi from e),
t as (select id, price_clean, case when concat('0x', substr(md5(concat('42|', id)), 1, 8))::ubigint % 100 < 80 then 'train' else 'test' end as split
      from e, q where price_clean between lo and hi)"""


@query(rounded_sql(f"{_TRIMMED} select * from t", ["price_clean"]))
def training_rows(spark, sf_dir):
    """Rows the models see, and on which side of the split."""
    return rounded(training(spark, sf_dir).select("id", "price_clean", "split"))


@query(f"{_TRIMMED} select id, true as linear_adds_up, true as trees_add_up from t where split = 'test'")
def attributions_add_up(spark, sf_dir):
    """For every test row: contributions plus base give the model's own prediction."""
    test = training(spark, sf_dir).where("split = 'test'")
    scored = models.score_all({"p_linear": linear(spark, sf_dir), "p_trees": trees(spark, sf_dir)}, test)
    by_line = explain.linear_attributions(linear(spark, sf_dir), scored, "id", ["p_linear", "p_trees", *trees_inputs(spark, sf_dir)])
    total = F.aggregate("attributions", F.col("base_value"), lambda s, a: s + a["contribution"])
    checked = by_line.withColumn("linear_adds_up", F.abs(total - F.col("p_linear")) < 1e-6).drop(
        "prediction", "base_value", "attributions"
    )
    by_tree = explain.tree_attributions(trees(spark, sf_dir), checked, "id", ["p_trees", "linear_adds_up"])
    return by_tree.select("id", "linear_adds_up", (F.abs(total - F.col("p_trees")) < 1e-6).alias("trees_add_up"))


@query()
def linear_model_metrics(spark, sf_dir):
    return _by_split(linear(spark, sf_dir), training(spark, sf_dir))


@query()
def gbt_model_metrics(spark, sf_dir):
    return _by_split(trees(spark, sf_dir), training(spark, sf_dir))


@query()
def trained_model_comparison(spark, sf_dir):
    fitted = {"baseline_pred": linear(spark, sf_dir), "gbt_pred": trees(spark, sf_dir)}
    scored = models.score_all(fitted, training(spark, sf_dir)).where("split = 'test'")
    return rounded(evaluate.comparison(evaluate.regression_metrics(scored, "price_clean", train.PREDS)))


@query(
    rounded_sql(
        """with t as (select *, concat('0x', substr(md5(concat('42|', o_orderkey)), 1, 8))::ubigint % 100 < 80 as train from orders),
f as (select regr_slope(o_totalprice, o_custkey) as a, regr_intercept(o_totalprice, o_custkey) as b from t where train)
select o_orderkey, o_totalprice, a * o_custkey + b as prediction from t, f where not train""",
        ["o_totalprice", "prediction"],
        3,
    )
)
def one_feature_line(spark, sf_dir):
    """Total price by customer number: the fitted line against the closed form."""
    orders = hash_split(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey")
    model = models.fit(models.linear_pipeline(["o_custkey"], target="o_totalprice"), orders)
    return rounded(models.score(model, orders.where("split = 'test'")).drop("split", "o_custkey"), 3)


@query()
def coefficient_ranking(spark, sf_dir):
    table_of = models.coefficients(linear(spark, sf_dir))
    selection.assert_no_leak(r["feature"] for r in table_of.select("feature").collect())
    return rounded(results.top_k(table_of, "coefficient", 10, absolute=True, then="feature"))


@query()
def importance_ranking(spark, sf_dir):
    return rounded(results.top_k(models.importances(trees(spark, sf_dir)), "importance", 15, then="feature"))


@query()
def tree_attribution(spark, sf_dir):
    """Every contribution of every test row."""
    test = training(spark, sf_dir).where("split = 'test'")
    found = explain.tree_attributions(trees(spark, sf_dir), test, "id")
    return rounded(found.select("id", "prediction", "base_value", F.inline("attributions")))


@query()
def tree_attribution_importance(spark, sf_dir):
    test = training(spark, sf_dir).where("split = 'test'")
    return rounded(explain.attribution_importance(explain.tree_attributions(trees(spark, sf_dir), test, "id")))


@query()
def fitted_linear_attribution(spark, sf_dir):
    test = training(spark, sf_dir).where("split = 'test'")
    found = explain.linear_attributions(linear(spark, sf_dir), test, "id")
    return rounded(found.select("id", "prediction", "base_value", F.inline("attributions")))


@query()
def tree_partial_dependence(spark, sf_dir):
    test = training(spark, sf_dir).where("split = 'test'")
    return rounded(explain.partial_dependence(trees(spark, sf_dir), test, "distance_to_center"))


QUOTE_FEATURES = ["accommodates", "bedrooms", "bathrooms_numeric", "number_of_reviews", "distance_to_center", "has_wifi",
                  "has_kitchen", "has_ac", "has_parking", "has_pool", "has_gym", "host_is_superhost_binary"]


def _quote_model(spark, sf_dir):
    df = hash_split(engineered(spark, sf_dir), "id")
    return models.fit(models.gbt_pipeline(QUOTE_FEATURES, ["city", "room_type"]), df)


@query()
def model_quote(spark, sf_dir):
    """Requests priced by a model that was saved and loaded again."""
    path = scratch_path(spark, "model")
    models.save(quote_trees(spark, sf_dir), path)
    asked = requests(spark, sf_dir).withColumnsRenamed(
        {"bathrooms": "bathrooms_numeric", "host_is_superhost": "host_is_superhost_binary"}
    )
    priced = models.score(models.load(path), asked, "predicted_price")
    return rounded(priced.select("request_id", "city", "room_type", "predicted_price"))


@query(
    f"""with e as ({ENGINEERED_SQL}), g as (select host_is_superhost_binary as b, avg(price_clean) as mean from e
where concat('0x', substr(md5(concat('42|', id)), 1, 8))::ubigint % 100 < 80 group by 1)
select request_id, city, room_type, round(mean, 3) as predicted_price from ({REQUESTS_SQL}) q join g on g.b = q.host_is_superhost"""
)
def one_split_quote(spark, sf_dir):
    """Requests priced by a saved model of one split, which SQL can state."""
    path = scratch_path(spark, "model")
    pipeline = models.gbt_pipeline(["host_is_superhost_binary"], depth=1, iters=1, subsample=1.0)
    models.save(models.fit(pipeline, hash_split(engineered(spark, sf_dir), "id")), path)
    asked = requests(spark, sf_dir).withColumnRenamed("host_is_superhost", "host_is_superhost_binary")
    priced = models.score(models.load(path), asked, "predicted_price")
    return rounded(priced.select("request_id", "city", "room_type", "predicted_price"), 3)


# --- models small enough for SQL to state ---------------------------------------------
_SPLIT = "case when concat('0x', substr(md5(concat('42|', o_orderkey)), 1, 8))::ubigint % 100 < 80 then 'train' else 'test' end"
_ORDERS = f"""with t as (select o_orderkey, o_orderpriority, o_totalprice, o_custkey, cast(o_custkey % 3 = 0 as int) as third,
  {_SPLIT} as split from orders)"""
_MEANS = f"{_ORDERS}, g as (select third, avg(o_totalprice) as mean from t where split = 'train' group by third)"


def _orders(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_custkey")
    return hash_split(df.withColumn("third", (F.col("o_custkey") % 3 == 0).cast("int")), "o_orderkey")


def _stump(spark, sf_dir):
    """One tree with one split on a 0/1 column: its leaves are group means."""
    pipeline = models.gbt_pipeline(["third"], target="o_totalprice", depth=1, iters=1, subsample=1.0)
    return _once(spark, sf_dir, "stump", lambda: models.fit(pipeline, _orders(spark, sf_dir)))


@query(
    f"""{_ORDERS}, n as (select o_orderpriority, row_number() over (order by count(*) desc, o_orderpriority) - 1 as i from t where split = 'train' group by 1)
select o_orderkey, o_orderpriority, cast(i as double) as code from t join n using (o_orderpriority)"""
)
def category_index(spark, sf_dir):
    """Categories are numbered by frequency in the training rows, then by name."""
    rows = _orders(spark, sf_dir)
    pipeline = models.gbt_pipeline([], ["o_orderpriority"], "o_totalprice", depth=1, iters=1)
    coded = models.fit(pipeline, rows).transform(rows)
    return coded.select("o_orderkey", "o_orderpriority", F.col("o_orderpriority_indexed").alias("code"))


@query(rounded_sql(f"{_MEANS} select o_orderkey, split, mean as prediction from t join g using (third)", ["prediction"], 3))
def tree_group_means(spark, sf_dir):
    """Predictions of the one-split tree, saved and loaded again."""
    path = scratch_path(spark, "stump")
    models.save(_stump(spark, sf_dir), path)
    scored = models.score(models.load(path), _orders(spark, sf_dir))
    return rounded(scored.select("o_orderkey", "split", "prediction"), 3)


@query(
    rounded_sql(
        f"""{_MEANS}, e as (select split, o_totalprice as y, mean as p from t join g using (third))
select split, 'model' as model, sqrt(avg((y - p) * (y - p))) as rmse, avg(abs(y - p)) as mae,
1 - sum((y - p) * (y - p)) / (sum(y * y) - sum(y) * sum(y) / count(*)) as r2,
avg(case when y <> 0 then abs(y - p) / abs(y) end) * 100 as mape, count(*) as n_samples from e group by split""",
        ["rmse", "mae", "r2", "mape"],
        3,
    )
)
def tree_metrics_by_split(spark, sf_dir):
    scored = models.score(_stump(spark, sf_dir), _orders(spark, sf_dir))
    found = evaluate.regression_metrics(scored, "o_totalprice", {"model": "prediction"}, ["split"])
    return rounded(found.select("split", "model", "rmse", "mae", "r2", "mape", "n_samples"), 3)


@query(
    rounded_sql(
        f"""{_MEANS}, b as (select avg(o_totalprice) as base from t where split = 'train')
select o_orderkey, mean as prediction, base as base_value, 'third' as feature, third::double as value, mean - base as contribution
from t join g using (third), b where split = 'test'""",
        ["prediction", "base_value", "contribution"],
        3,
    )
)
def tree_attribution_means(spark, sf_dir):
    """With one feature its contribution is the leaf's mean minus the mean of the training rows."""
    test = _orders(spark, sf_dir).where("split = 'test'")
    found = explain.tree_attributions(_stump(spark, sf_dir), test, "o_orderkey")
    return rounded(found.select("o_orderkey", "prediction", "base_value", F.inline("attributions")), 3)


@query(rounded_sql(f"{_MEANS} select 'third' as feature, third::double as value, mean as avg_prediction from g", ["avg_prediction"], 3))
def tree_dependence_means(spark, sf_dir):
    rows = _orders(spark, sf_dir).where("split = 'test'")
    found = explain.partial_dependence(_stump(spark, sf_dir), rows, "third")
    return rounded(found.withColumn("value", F.col("value").cast("double")), 3)


@query("select 'third' as feature, 1.0::double as importance from (select count(*) as n from orders) where n > 0")
def tree_importance_of_one(spark, sf_dir):
    return rounded(models.importances(_stump(spark, sf_dir)))


def _round(n: int, rows: str) -> str:
    """One boosting round on two 0/1 features: means by either, the squares they explain, and the better feature."""
    return f"""f{n} as (select f, x, avg(y) as m, count(*) as n from
  (select 'third' as f, third as x, y from {rows} union all select 'even', even, y from {rows}) group by f, x),
g{n} as (select f, sum(n * (m - mu) * (m - mu)) as gain from f{n}, (select avg(y) as mu from {rows}) group by f),
c{n} as (select f{n}.* from f{n} join (select f from g{n} order by gain desc, f limit 1) using (f))"""


#: Boosting two trees of one split each: the second one learns twice the residuals of the first and counts for the step of 0.05.
_BOOSTED = f"""{_ORDERS}, o as (select *, cast(o_custkey % 2 = 0 as int) as even, o_totalprice as y from t),
s1 as (select * from o where split = 'train'), {_round(1, 's1')},
p1 as (select o.*, c1.m as p from o join c1 on c1.x = case when c1.f = 'third' then third else even end),
s2 as (select third, even, 2 * (y - p) as y from p1 where split = 'train'), {_round(2, 's2')}"""


def _boosted_orders(spark, sf_dir):
    return _orders(spark, sf_dir).withColumn("even", (F.col("o_custkey") % 2 == 0).cast("int"))


def _boosted(spark, sf_dir):
    pipeline = models.gbt_pipeline(["third", "even"], target="o_totalprice", depth=1, iters=2, subsample=1.0)
    return _once(spark, sf_dir, "boosted", lambda: models.fit(pipeline, _boosted_orders(spark, sf_dir)))


@query(
    rounded_sql(
        f"""{_BOOSTED} select o_orderkey, split, p + 0.05 * c2.m as prediction
from p1 join c2 on c2.x = case when c2.f = 'third' then third else even end""",
        ["prediction"],
        3,
    )
)
def boosted_predictions(spark, sf_dir):
    """Two boosting rounds: group means, then a step along the means of what is left."""
    scored = models.score(_boosted(spark, sf_dir), _boosted_orders(spark, sf_dir))
    return rounded(scored.select("o_orderkey", "split", "prediction"), 3)


@query(
    rounded_sql(
        f"""{_BOOSTED}, used as (select f, gain from g1 where f in (select f from c1) union all select f, gain from g2 where f in (select f from c2))
select n.f as feature, coalesce(sum(gain), 0) / (select sum(gain) from used) as importance
from (select unnest(['third', 'even']) as f) n left join used using (f) group by n.f""",
        ["importance"],
        6,
    )
)
def boosted_importances(spark, sf_dir):
    """The squares that each feature's splits explain, as shares."""
    return rounded(models.importances(_boosted(spark, sf_dir)), 6)


_TWO = f"""{_ORDERS}, s as (select third::double as a, o_custkey::double as b, o_totalprice as y from t where split = 'train'),
m as (select var_pop(a) as aa, var_pop(b) as bb, covar_pop(a, b) as ab, covar_pop(a, y) as ay, covar_pop(b, y) as yb,
      stddev_samp(a) as sa, stddev_samp(b) as sb from s)"""


@query(
    rounded_sql(
        f"""{_TWO} select 'third' as feature, (ay * bb - yb * ab) / (aa * bb - ab * ab) * sa as coefficient from m
union all select 'o_custkey', (yb * aa - ay * ab) / (aa * bb - ab * ab) * sb from m""",
        ["coefficient"],
        2,
    )
)
def two_feature_coefficients(spark, sf_dir):
    """Coefficients of the scaled columns, by the normal equations."""
    pipeline = models.linear_pipeline(["third", "o_custkey"], target="o_totalprice")
    return rounded(models.coefficients(models.fit(pipeline, _orders(spark, sf_dir))), 2)
