"""Run pipeline stages as a Spark application (``spark-submit`` entry point).

    spark-submit --py-files regpanel.zip scripts/run_pipeline.py all --base s3://bucket/data \\
        --cities cities.csv --cities cities_additional.csv --settlements settlements.csv \\
        --abbr abbr.csv --classifier activity_codes_classifier.csv --ac 10.10 --ac D

Stages: ``extract``, ``aggregate``, ``geocode``, ``panelize``, ``all``. The
session (master, resources, ``spark.checkpoint.dir``) comes from the
submit configuration; the stage layout is described in
``regpanel.plans.pipeline``.
"""

from __future__ import annotations

import argparse
import json


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="regpanel")
    ap.add_argument("stage", choices=["extract", "aggregate", "geocode", "panelize", "all"])
    ap.add_argument("--base", required=True, help="root folder on shared storage")
    ap.add_argument("--cities", action="append", default=[], help="cities CSV (repeatable)")
    ap.add_argument("--settlements")
    ap.add_argument("--abbr")
    ap.add_argument("--regions", help="regions CSV (default: the shipped table)")
    ap.add_argument("--classifier")
    ap.add_argument("--ac", action="append", default=None,
                    help="activity code or group letter to keep (repeatable)")
    ap.add_argument("--no-csv", action="store_true", help="skip the CSV panel export")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from .plans import pipeline as P
    from .session import ensure_checkpoint_dir
    from .sources import dims as D

    spark = SparkSession.builder.appName(f"regpanel-{args.stage}").getOrCreate()
    # Unset checkpoint folder: use one under --base, which is shared storage.
    ensure_checkpoint_dir(spark, scratch_dir=f"{args.base.rstrip('/')}/_checkpoints")
    needs_dims = args.stage in ("extract", "geocode", "all")
    dims = None
    if needs_dims:
        dims = P.Dimensions(
            cities=D.load_cities(spark, *args.cities) if args.cities else None,
            settlements=D.load_settlements(spark, args.settlements) if args.settlements else None,
            regions=D.load_regions(spark, args.regions),
            abbreviations=D.load_abbreviations(spark, args.abbr) if args.abbr else None,
            classifier=D.load_classifier(spark, args.classifier) if args.classifier else None)
    metrics: dict = {}
    if args.stage in ("extract", "all"):
        P.run_extract(spark, args.base, dims, args.ac, metrics)
    if args.stage in ("aggregate", "all"):
        P.run_aggregate(spark, args.base, metrics)
    if args.stage in ("geocode", "all"):
        P.run_geocode(spark, args.base, dims, metrics)
    if args.stage in ("panelize", "all"):
        P.run_panel(spark, args.base, csv_export=not args.no_csv, metrics=metrics)
    print(json.dumps(P.report(metrics)))


if __name__ == "__main__":
    main()
