"""All stages on files, from raw CSV per city to quotes."""

from pyspark.sql import functions as F

from staylytics.plans import jobs
from staylytics.sources import read_table, write_table
from workload.adapters import listings, requests


def test_stages(spark, sf_dir, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    rows = listings(spark, sf_dir)
    for city in ("nyc", "london", "amsterdam"):  # the fourth city has no file and is skipped
        part = rows.where(F.col("city") == city).drop("city")
        write_table(part.drop("name") if city == "london" else part, f"{raw}/{city}/listings.csv", "csv")

    asked = requests(spark, sf_dir)
    jobs.clean(spark, raw, out)
    unified = read_table(spark, f"{out}/unified")
    assert {r["city"] for r in unified.select("city").distinct().collect()} == {"nyc", "london", "amsterdam"}
    assert "name" not in unified.columns
    rates = read_table(spark, f"{out}/reports/keep_rate", "csv")
    assert sum(int(r["rows_after"]) for r in rates.collect()) == unified.count()

    jobs.features(spark, out, "2024-01-01")
    jobs.lookup(spark, out)
    jobs.profile(spark, out)
    assert read_table(spark, f"{out}/reports/correlations", "csv").count() == 20
    assert {r["city"] for r in read_table(spark, f"{out}/lookup", "csv").collect()} == {"nyc", "london", "amsterdam"}

    jobs.fit(spark, out, depth=3, iters=3)
    jobs.evaluate(spark, out)
    jobs.explain(spark, out, depth=3, iters=3)
    metrics = {r["model"]: float(r["r2"]) for r in read_table(spark, f"{out}/evaluation/metrics", "csv").collect()}
    assert set(metrics) == {"baseline", "gbt"}
    assert read_table(spark, f"{out}/evaluation/metrics_long").count() == 40
    assert read_table(spark, f"{out}/explain/feature_importance_comparison", "csv").count() > 5
    assert not any("price_per" in r["feature"] for r in read_table(spark, f"{out}/models/baseline_importance", "csv").collect())

    quotes = jobs.quote(spark, out, asked).cache()
    assert quotes.count() == asked.count()
    assert quotes.select("confidence_factor").distinct().collect()[0][0] == metrics["gbt"]
    prices = {r["city"]: float(r["avg_price"]) for r in read_table(spark, f"{out}/evaluation/city_performance", "csv").collect()}
    entire = quotes.where("room_type = 'Entire home/apt' and city in ('nyc', 'london', 'amsterdam')")
    assert {(r["city"], r["base_price"]) for r in entire.select("city", "base_price").distinct().collect()} <= set(prices.items())
    assert quotes.where("city = 'nyc' and mapped_neighborhood is null").isEmpty()
    assert quotes.where("city = 'oslo' and mapped_neighborhood is not null").isEmpty()
    assert quotes.where("city = 'oslo' and mapped_distance != distance_to_center").isEmpty()
