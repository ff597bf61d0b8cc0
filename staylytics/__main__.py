"""``python -m staylytics STAGE --raw DIR --out DIR``: run one stage, or ``all`` of them in order."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from staylytics.plans import jobs
from staylytics.sources import drop_staged, read_table, write_table

STAGES = ("clean", "features", "lookup", "profile", "fit", "evaluate", "explain")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="staylytics", description=__doc__)
    parser.add_argument("stage", choices=(*STAGES, "quote", "all"))
    parser.add_argument("--raw", default="data/raw", help="folder with <city>/listings.csv")
    parser.add_argument("--cities", help="comma-separated; by default every folder under --raw")
    parser.add_argument("--out", default="output", help="folder for all results")
    parser.add_argument("--as-of", help="day (YYYY-MM-DD) that host age is counted to; today by default")
    parser.add_argument("--requests", help="parquet table of quote requests")
    parser.add_argument("--depth", type=int, default=8, help="depth of the boosted trees")
    parser.add_argument("--iters", type=int, default=100, help="number of boosted trees")
    parser.add_argument("--buckets", type=int, help="keep the scored rows in that many buckets by id, to join with another run's")
    parser.add_argument("--single-line", action="store_true", help="no field holds a line break: split large CSV files")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("staylytics").getOrCreate()
    run = {
        "clean": lambda: jobs.clean(spark, args.raw, args.out, args.cities.split(",") if args.cities else None, not args.single_line),
        "features": lambda: jobs.features(spark, args.out, args.as_of),
        "lookup": lambda: jobs.lookup(spark, args.out),
        "profile": lambda: jobs.profile(spark, args.out),
        "fit": lambda: jobs.fit(spark, args.out, depth=args.depth, iters=args.iters),
        "evaluate": lambda: jobs.evaluate(spark, args.out, args.buckets),
        "explain": lambda: jobs.explain(spark, args.out, depth=args.depth, iters=args.iters),
        "quote": lambda: write_table(
            jobs.quote(spark, args.out, read_table(spark, args.requests)), f"{args.out}/quotes"
        ),
    }
    for stage in STAGES if args.stage == "all" else [args.stage]:
        run[stage]()
    drop_staged(spark)


if __name__ == "__main__":
    main()
