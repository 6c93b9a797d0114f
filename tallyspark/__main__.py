"""Command line: ``python -m tallyspark`` or through spark-submit.

    list
    enrich --transactions T --profiles U --out DIR [--form csv|parquet]
    star   --transactions T --profiles U --out DIR [--form csv|parquet]
    report NAME --transactions T --profiles U --out DIR

T and U are CSV files or folders with a header row.
"""

import argparse

from tallyspark.plans.registry import BUILDERS, Tables, run_query
from tallyspark.session import build_session
from tallyspark.sources import readers, writers


def _arguments(argv=None):
    parser = argparse.ArgumentParser(prog="tallyspark")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list")
    for name in ("enrich", "star", "report"):
        command = commands.add_parser(name)
        if name == "report":
            command.add_argument("name", choices=sorted(BUILDERS), metavar="NAME")
        command.add_argument("--transactions", required=True)
        command.add_argument("--profiles", required=True)
        command.add_argument("--out", required=True)
        command.add_argument("--form", choices=("csv", "parquet"), default="parquet")
    return parser.parse_args(argv)


def main(argv=None, spark=None):
    args = _arguments(argv)
    if args.command == "list":
        print("\n".join(BUILDERS))
        return
    spark = spark or build_session()
    tables = Tables(*readers.read_raw_pair(spark, args.transactions, args.profiles))
    if args.command == "enrich":
        writers.write_enriched(tables.enriched, args.out, args.form)
    elif args.command == "star":
        writers.write_star(tables.star, args.out, args.form)
    else:
        result = run_query(args.name, tables)
        if args.form == "csv":
            writers.write_csv(result, args.out)
        else:
            result.write.mode("overwrite").parquet(args.out)


if __name__ == "__main__":
    main()
