"""Stages that read and write a folder of tables, as ``python -m staylytics`` runs them.

Every stage reads what earlier stages wrote under ``out`` and overwrites its own
tables, so a stage can be run again by itself. A table is replaced only once its successor is whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylytics import constants as K
from staylytics.operators import models, pricing, results
from staylytics.operators.cleaning import keep_rate
from staylytics.plans import explore, interpret, prepare, train
from staylytics.sources import folders, read_sources, read_table, write_bucketed, write_table

LOOKUP_SCHEMA = "city string, neighbourhood_cleansed string, lat double, lng double, n bigint, dist_km double"
SEGMENT_SCHEMA = "city string, avg_price double"


def _write_report(df: DataFrame, path: str) -> None:
    """As many files as the report's tasks: some reports grow with the data."""
    write_table(df, path, "csv")


def clean(spark: SparkSession, raw: str, out: str, cities: Sequence[str] | None = None, multi_line: bool = True) -> None:
    """``<raw>/<city>/listings.csv`` of every city (by default each folder under ``raw``) to the unified, cleaned table."""
    cities = folders(spark, raw) if cities is None else cities
    paths = {c: f"{raw}/{c}/listings.csv" for c in cities}
    sources = read_sources(spark, paths, "csv", on_missing="skip", multi_line=multi_line)
    combined = prepare.combine_sources(sources)
    cleaned, came_in = prepare.clean_sources_counted(combined)
    write_table(cleaned, f"{out}/unified", partition_by=["source"])
    kept = read_table(spark, f"{out}/unified")
    _write_report(keep_rate(came_in, kept, ["source"], counted="__rows"), f"{out}/reports/keep_rate")


def features(spark: SparkSession, out: str, as_of: str | None = None) -> None:
    unified = read_table(spark, f"{out}/unified").drop("source")
    write_table(prepare.features(unified, as_of), f"{out}/features")


def lookup(spark: SparkSession, out: str) -> None:
    _write_report(prepare.lookup(read_table(spark, f"{out}/features")), f"{out}/lookup")


def profile(spark: SparkSession, out: str) -> None:
    for name, report in explore.explore(read_table(spark, f"{out}/features")).items():
        _write_report(report, f"{out}/reports/{name}")


def fit(spark: SparkSession, out: str, **gbt_params) -> None:
    """Train both models on one split and store models, importances and the training table."""
    df = read_table(spark, f"{out}/features")
    base, gbt = train.baseline_features(df), train.gbt_features(df)
    rows = train.training_rows(df, [*base.all, *gbt.all])
    write_table(rows, f"{out}/training", partition_by=["split"])
    write_table(train.features_table(spark, {"baseline": base, "gbt": gbt}), f"{out}/models/features")
    table = read_table(spark, f"{out}/training")
    linear, trees = train.train_baseline(table, base), train.train_gbt(table, gbt, **gbt_params)
    models.save(linear, f"{out}/models/baseline")
    models.save(trees, f"{out}/models/gbt")
    counts = [
        {"run": "trained", "model": name, "metric": "feature_count", "value": float(len(chosen.all))}
        for name, chosen in (("baseline", base), ("gbt", gbt))
    ]
    _write_report(results.metrics_table(spark, counts), f"{out}/models/feature_counts")
    _write_report(models.coefficients(linear), f"{out}/models/baseline_importance")
    ranked = models.importances(trees).orderBy(F.desc("importance"), "feature")
    _write_report(ranked, f"{out}/models/gbt_importance")


def evaluate(spark: SparkSession, out: str, buckets: int | None = None) -> None:
    """Score and compare. With ``buckets`` the scored rows are kept, hashed by id, to be joined with another run's."""
    fitted = {name: models.load(f"{out}/models/{name}") for name in ("baseline", "gbt")}
    scored = train.score_models(fitted, read_table(spark, f"{out}/training"))
    if buckets:
        scored = write_bucketed(scored, f"{out}/evaluation/scored", "id", buckets)
    reports = train.reports(scored)
    for name, report in reports.items():
        _write_report(report, f"{out}/evaluation/{name}")
    metrics = results.metrics_long(reports["metrics_by_split"], "trained", "split")
    write_table(metrics, f"{out}/evaluation/metrics_long")


def explain(spark: SparkSession, out: str, **gbt_params) -> None:
    """Explain a line and trees trained on one shared list of features, so that their rankings can be compared."""
    df = read_table(spark, f"{out}/features")
    chosen = train.explain_features(df)
    write_table(train.training_rows(df, chosen.all), f"{out}/explain/training", partition_by=["split"])
    table = read_table(spark, f"{out}/explain/training")
    fitted = [train.train_baseline(table, chosen), train.train_gbt(table, chosen, **gbt_params)]

    def store(df: DataFrame, name: str) -> DataFrame:
        write_table(df, f"{out}/explain/{name}")
        return read_table(spark, f"{out}/explain/{name}")

    found = interpret.interpret(*fitted, table, store=store)
    for name, report in found.items():
        if not name.endswith("_attributions"):
            _write_report(report, f"{out}/explain/{name}")


def quote(spark: SparkSession, out: str, requests: DataFrame) -> DataFrame:
    """Quotes for ``requests``; base prices, R² and places come from earlier stages where they exist."""
    segments = read_table(spark, f"{out}/evaluation/city_performance", "csv", SEGMENT_SCHEMA)
    base = segments.select("city", F.col("avg_price").try_cast("double").alias("avg_price"))
    metrics = read_table(spark, f"{out}/evaluation/metrics", "csv", "model string, r2 double")
    r2 = F.when(F.count(F.lit(1)) == 0, K.DEFAULT_R2).otherwise(F.max(F.col("r2").try_cast("double")))
    r2 = metrics.where("model = 'gbt'").agg(r2.alias("r2")).scalar()
    found = read_table(spark, [f"{out}/lookup.csv", f"{out}/lookup"], "csv", LOOKUP_SCHEMA)
    places = found.select(*[F.col(n).try_cast(t).alias(n) for n, t in (f.split() for f in LOOKUP_SCHEMA.split(", "))])
    return pricing.quote_with_location(requests, places, base, r2=r2)
