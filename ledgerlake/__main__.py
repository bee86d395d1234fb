"""Command line for the end-to-end jobs (runs under spark-submit or python -m).

  python -m ledgerlake upload --kind o_payment --staged S --batch B --ledger L [--master M] [--source Oracle]
  python -m ledgerlake funder-report --sheet raw.csv --out OUT --as-of 2024-03-15
  python -m ledgerlake worklist --file worklist.xls --out OUT --as-of 2024-03-15
  python -m ledgerlake split --file pdr.xls --out OUT --as-of 2024-03-15
  python -m ledgerlake to-csv --file pdr.xls --out OUT.csv
  python -m ledgerlake payment-files --folder IN --ranges ranges.csv --out OUT [--glob '*.xls'] [--date-column 15]
  python -m ledgerlake create-ledger --ledger PLAIN --table VERSIONED
Prints the job's result as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import sys


def parse(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="ledgerlake")
    sub = p.add_subparsers(dest="job", required=True)
    up = sub.add_parser("upload")
    up.add_argument("--kind", required=True,
                    choices=["worklist", "ns_payment", "o_payment", "o_exception", "status", "patch"])
    up.add_argument("--staged", required=True)
    up.add_argument("--batch", required=True)
    up.add_argument("--ledger", required=True)
    up.add_argument("--master")
    up.add_argument("--new-ledger")
    up.add_argument("--source")
    up.add_argument("--user")
    up.add_argument("--partition-by", default="")
    fr = sub.add_parser("funder-report")
    fr.add_argument("--sheet", required=True)
    fr.add_argument("--out", required=True)
    fr.add_argument("--as-of", required=True)
    fr.add_argument("--start", default="2020-01-01")
    for name in ("worklist", "split"):
        w = sub.add_parser(name)
        w.add_argument("--file", required=True)
        w.add_argument("--out", required=True)
        w.add_argument("--as-of", required=True)
    c = sub.add_parser("to-csv")
    c.add_argument("--file", required=True)
    c.add_argument("--out", required=True)
    pf = sub.add_parser("payment-files")
    pf.add_argument("--folder", required=True)
    pf.add_argument("--ranges", required=True)
    pf.add_argument("--out", required=True)
    pf.add_argument("--glob", default="*.csv")
    pf.add_argument("--date-column", default="assignment_date")
    cl = sub.add_parser("create-ledger")
    cl.add_argument("--ledger", required=True)
    cl.add_argument("--table", required=True)
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark=None) -> dict:
    from pyspark.sql import SparkSession

    from ledgerlake import jobs
    from ledgerlake.session import tune
    args = parse(sys.argv[1:] if argv is None else argv)
    spark = spark or SparkSession.builder.appName(f"ledgerlake-{args.job}").getOrCreate()
    tune(spark)
    if args.job == "upload":
        parts = tuple(x for x in args.partition_by.split(",") if x)
        result = jobs.upload_batch(spark, args.kind, args.staged, args.batch, args.ledger, args.master,
                                   args.new_ledger, source=args.source, user=args.user, partition_by=parts)
    elif args.job == "funder-report":
        result = {"output": jobs.funder_report_job(spark, args.sheet, args.out, args.as_of, args.start)}
    elif args.job == "worklist":
        result = jobs.worklist_job(spark, args.file, args.out, args.as_of)
    elif args.job == "split":
        out = jobs.split_job(spark, args.file, args.out, args.as_of)
        result = {"rows": out.count()}
    elif args.job == "payment-files":
        from ledgerlake.sources.tables import read_ranges
        column = int(args.date_column) if args.date_column.isdigit() else args.date_column
        names = jobs.payment_files_job(spark, args.folder, read_ranges(spark, args.ranges), args.out, column, glob=args.glob)
        result = {"renamed": names.filter("status = 'renamed'").count(), "output": args.out}
    elif args.job == "create-ledger":
        result = {"version": jobs.create_ledger(spark, args.ledger, args.table)}
    else:
        result = jobs.to_csv_job(spark, args.file, args.out)
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main()
