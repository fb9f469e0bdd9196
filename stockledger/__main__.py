"""Land, build and query a lake.

    python -m stockledger land SOURCE ROOT [TABLE ...]
    python -m stockledger build ROOT
    python -m stockledger sql ROOT "select ..." [--out PATH] [--limit N]

Run it through spark-submit on a cluster. S3 paths use the endpoint and keys of
the usual environment variables when S3_ENDPOINT is set.
"""

from __future__ import annotations

import argparse
import csv
import os
import sys

from pyspark.sql import DataFrame, SparkSession

from stockledger import settings
from stockledger.fixed_values import BRONZE
from stockledger.plans import lakehouse
from stockledger.sources import tables as lake


def main() -> None:
    parser = argparse.ArgumentParser(prog="stockledger")
    commands = parser.add_subparsers(dest="command", required=True)
    land = commands.add_parser("land", help="copy raw tables into the bronze layer")
    land.add_argument("source")
    land.add_argument("root")
    land.add_argument("tables", nargs="*")
    build = commands.add_parser("build", help="write silver and gold and run the checks")
    build.add_argument("root")
    sql = commands.add_parser("sql", help="query the raw tables and the facts")
    sql.add_argument("root")
    sql.add_argument("query")
    sql.add_argument("--out", help="write the result there as Parquet instead of printing it")
    sql.add_argument("--limit", type=int, help="no more rows than this")
    args = parser.parse_args()

    builder = SparkSession.builder.appName(f"stockledger {args.command}")
    if "S3_ENDPOINT" in os.environ:
        for key, value in settings.lake_conf_from_env().items():
            builder = builder.config(key, value)
    spark = settings.tune(builder.getOrCreate())
    if args.command == "land":
        sources = {name: f"{args.source}/{name}" for name in BRONZE}
        landed = lake.land_bronze(spark, sources, args.root, args.tables or None)
        _print(lake.row_counts(landed))
    elif args.command == "build":
        _print(lakehouse.build(spark, args.root))
    else:
        settings.tune(spark, args.root)
        lakehouse.open_views(spark, args.root)
        result = spark.sql(args.query)
        if args.limit is not None:
            result = result.limit(args.limit)
        if args.out:
            result.write.mode("overwrite").parquet(args.out)
        else:
            _print(result)


def _print(df: DataFrame) -> None:
    """Every row as CSV, one partition at a time."""
    out = csv.writer(sys.stdout)
    out.writerow(df.columns)
    for row in df.toLocalIterator():
        out.writerow(row)


if __name__ == "__main__":
    main()
