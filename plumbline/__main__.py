"""Command line: onboard an entity, run its rules, print its reports.

    spark-submit ... -m plumbline onboard --dq-schema dq --target-table customer_gold --source raw.customer_gold
    spark-submit ... -m plumbline run     --dq-schema dq --target-table customer_gold --order-by cust_id
    spark-submit ... -m plumbline report  --dq-schema dq --target-table customer_gold --latest
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from plumbline.packs import load_pack, read_pack
from plumbline.plans.onboarding import onboard
from plumbline.plans.runs import entity_reports, run_entity
from plumbline.sources.store import Store


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="plumbline")
    steps = parser.add_subparsers(dest="step", required=True)
    for name in ("onboard", "run", "report"):
        step = steps.add_parser(name)
        step.add_argument("--catalog", default="spark_catalog")
        step.add_argument("--dq-schema", default="dq")
        step.add_argument("--target-table", default="customer_gold")
        step.add_argument("--table-format", default="parquet")
        if name == "onboard":
            step.add_argument("--source", required=True, help="table to snapshot")
            step.add_argument("--location", help="folder of the schema, if it is to be created")
            step.add_argument("--pack", help="JSON file of the entity's rules (default: the pack of that name here)")
        if name == "run":
            step.add_argument("--report-date", default=str(dt.date.today()))
            step.add_argument("--as-of", help="day the date rules compare with (default: today)")
            step.add_argument("--order-by", nargs="*", help="which duplicate comes first (default: as the pack says)")
            step.add_argument("--marker", default="NULL", choices=["NULL", "N"])
            step.add_argument("--use-templates", action="store_true")
        if name == "report":
            step.add_argument("--latest", action="store_true")
            step.add_argument("--all-entities", action="store_true")
            step.add_argument("--rows", type=int, help="rows of each report to print (default: all)")
    return parser.parse_args(argv)


def print_rows(report: DataFrame, most: int | None) -> None:
    """Print a report, a row at a time; tell how many rows a limit leaves out."""
    print(" | ".join(report.columns))
    shown = report if most is None else report.limit(most)
    for row in shown.toLocalIterator():
        print(" | ".join(str(v) for v in row))
    if most is not None and (left := report.count() - most) > 0:
        print(f"({left} more)")


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = SparkSession.builder.appName("plumbline").getOrCreate()
    store = Store(spark, args.dq_schema, args.catalog, args.table_format)
    if args.step == "onboard":
        store.create(args.location)
        pack = read_pack(args.pack) if args.pack else load_pack(args.target_table)
        onboard(store, pack, spark.table(args.source))
        print(f"tables of {args.dq_schema}: {', '.join(store.tables())}")
    elif args.step == "run":
        outcome = run_entity(
            store, args.target_table, args.as_of, None, args.report_date, args.order_by, args.marker,
            args.use_templates,
        )
        print(f"{outcome.report_date} {outcome.line()}")
    else:
        for name, report in entity_reports(
            store, None if args.all_entities else args.target_table, args.latest
        ).items():
            print(name)
            print_rows(report, args.rows)


if __name__ == "__main__":
    main()
