"""Command line: match a name, match a table, show an entity, list events."""

from __future__ import annotations

import argparse
import csv
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.api import Crosswalk, audit_report
from gazetta.sources import readers, writers


def read_table(spark: SparkSession, path: str, sheet: str | int = 0) -> DataFrame:
    """A CSV (UTF-8 or GB18030) or XLSX file given by a user."""
    raw = Path(path).read_bytes()
    if path.lower().endswith((".xlsx", ".xlsm")):
        return readers.read_xlsx(spark, path, readers.xlsx_rows(raw, sheet)[0], sheet)
    try:
        text = raw.decode("utf-8-sig")
    except UnicodeDecodeError:
        text = raw.decode("gb18030")
    return readers.read_csv_any(spark, path, next(csv.reader(text.splitlines())))


def write_table(df: DataFrame, path: str) -> None:
    writers.export_xlsx(df, path) if path.lower().endswith(".xlsx") else writers.export_csv(df, path)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="gazetta", description=__doc__)
    top.add_argument("--data", required=True, help="folder of the release tables")
    sub = top.add_subparsers(dest="command", required=True)
    m = sub.add_parser("match")
    m.add_argument("name")
    m.add_argument("--year")
    m.add_argument("--province")
    m.add_argument("--fail-on-review", action="store_true")
    b = sub.add_parser("batch")
    b.add_argument("input")
    b.add_argument("output")
    b.add_argument("--name", required=True)
    for x in ("year", "province", "rules", "issues", "audit"):
        b.add_argument(f"--{x}")
    b.add_argument("--sheet", default="0")
    b.add_argument("--fail-on-review", action="store_true")
    e = sub.add_parser("entity")
    e.add_argument("id")
    v = sub.add_parser("events")
    for x in ("entity", "province", "year", "type", "output"):
        v.add_argument(f"--{x}")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """0: done. 1: an error. 2: done, but something needs review and --fail-on-review was given."""
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("gazetta").getOrCreate()
    walk = Crosswalk(spark, args.data)
    try:
        if args.command == "match":
            out = walk.match_name(args.name, args.year, args.province)
            print(writers.export_json(out))
            return 2 if args.fail_on_review and out["match_status"] != "auto_matched" else 0
        if args.command == "batch":
            rows = read_table(spark, args.input, int(args.sheet) if args.sheet.isdigit() else args.sheet)
            rules = read_table(spark, args.rules) if args.rules else None
            matched = walk.match_dataframe(rows, args.name, args.year, args.province, rules).cache()
            write_table(matched, args.output)
            issues = matched.filter(F.col("crosswalk_match_status") != "auto_matched")
            if args.issues:
                write_table(issues, args.issues)
            if args.audit:
                writers.export_json(audit_report(matched, {"name": args.name, "year": args.year, "province": args.province}), args.audit)
            review = issues.count()
            print(writers.export_json({"rows": matched.count(), "requires_review": review, "output": args.output}))
            return 2 if args.fail_on_review and review else 0
        if args.command == "entity":
            print(writers.export_json(walk.query_entity(args.id)))
            return 0
        found = walk.query_events(args.entity, args.province, int(args.year) if args.year else None, args.type)
        if args.output:
            write_table(found, args.output)
        else:
            print(writers.export_json([r.asDict() for r in found.collect()]))
        return 0
    except (OSError, ValueError, KeyError) as e:
        print(e, file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
