"""Command line: python -m cartloom IN_DIR OUT_DIR [options]; --help lists them."""

import argparse
import sys
import time

from pyspark.sql import SparkSession

from cartloom.plans.refresh import run
from cartloom.plans.sink import Database
from cartloom.plans.staging import release
from cartloom.sources.files import DEFAULT_FILES


def _pairs(texts):
    return dict(pair.split("=", 1) for pair in texts)


def main(arguments=None):
    parser = argparse.ArgumentParser(prog="cartloom", description="Rebuild all order tables.")
    parser.add_argument("in_dir")
    parser.add_argument("out_dir")
    parser.add_argument("--format", choices=["csv", "parquet"], default="csv")
    parser.add_argument("--files", nargs="*", default=[], metavar="SOURCE=PATH")
    parser.add_argument("--multiline", action="store_true", help="quoted fields hold line breaks")
    parser.add_argument("--catalogue", metavar="SCHEMA", help="also replace tables of this schema")
    parser.add_argument("--jdbc", metavar="URL", help="also replace tables of this database")
    parser.add_argument("--jdbc-properties", nargs="*", default=[], metavar="NAME=VALUE")
    args = parser.parse_args(arguments)
    database = Database(args.jdbc, _pairs(args.jdbc_properties)) if args.jdbc else None

    spark = SparkSession.builder.appName("cartloom").getOrCreate()
    started = time.monotonic()
    try:
        result = run(
            spark,
            args.in_dir,
            args.out_dir,
            DEFAULT_FILES | _pairs(args.files),
            args.format,
            multiline=args.multiline,
            catalogue=args.catalogue,
            database=database,
        )
    except Exception as error:
        print(f"failed after {time.monotonic() - started:.1f} s: {error}", file=sys.stderr)
        raise
    finally:
        release(spark)
    print(f"{result.status} after {result.duration_seconds:.1f} s")
    result.rows.show(truncate=False)


if __name__ == "__main__":
    main()
