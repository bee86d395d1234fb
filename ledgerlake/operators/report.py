"""B5 - funder aging report: filter open items, age them, label priority,
product and funder. One narrow stage; the summary is a map-side-combined
aggregate; the per-funder outputs are one partitioned write (sinks.write_by)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, functions as F

from ledgerlake.functions.dates import aging_bucket, last_day_of_next_month
from ledgerlake.functions.labels import funder_label, priority, product_type

# ---- fixed values: report filters and dropped sheet columns ---------------------
DEFAULT_START = "2020-01-01"
EXCLUDED_STATUSES = ["Funded-Fully", "Non Funded-Dupe"]
EXCLUDED_ASSOCIATION = "Future Funding"
EXCLUDED_ADMINISTERED = "No"
MIN_OPEN_AMOUNT = 10
DROP_COLUMNS = ["Schedule Type", "Administered", "YRX_ORDER", "YRX_STATUS", "Adjustment",
                "CashApps Instruction", "Paid Amount-1", "Paid Date-1", "RT Number-1", "Paid Amount-2",
                "Paid Date-2", "RT Number-2", "Comments", "Contract Num", "Remit To (NS/OCL)", "Remit From",
                "Remit Ref", "Remit Date", "Payment Posting Status", "Adjustment_Terminated"]

# column names used by the report (sheet header -> our name)
SHEET_COLUMNS = {
    "Payment Due Date": "payment_due_date", "YRX_STATUS": "yrx_status", "YRX_ASSIGNEE": "yrx_assignee",
    "Order Number": "order_number", "Deal Association Type": "deal_association_type",
    "Adjustment_Terminated": "adjustment_terminated", "Administered": "administered",
    "Funder Name": "funder_name", "Open Amt": "open_amt",
}


def _as_date(d):
    return _dt.date.fromisoformat(d) if isinstance(d, str) else d


def funder_report(raw: DataFrame, as_of, start=DEFAULT_START, drop: list[str] | None = None,
                  strict_drop: bool = False) -> DataFrame:
    """Rows of the report with `aging_bucket`, `product_type`, `priority`, `funder`.

    `raw` uses snake_case names for the columns it reads (see SHEET_COLUMNS).
    `drop` lists sheet columns to remove (DROP_COLUMNS for a full sheet); with
    `strict_drop` a missing name is an error, as in pandas."""
    as_of, start = _as_date(as_of), _as_date(start)
    c = F.col
    due = c("payment_due_date").cast("date")
    days = F.datediff(F.lit(as_of), due)
    status = c("yrx_status")
    keep = ((due >= F.lit(start)) & (due <= last_day_of_next_month(as_of))
            & ~status.eqNullSafe(EXCLUDED_STATUSES[0]) & ~status.eqNullSafe(EXCLUDED_STATUSES[1])
            & ~c("deal_association_type").eqNullSafe(EXCLUDED_ASSOCIATION)
            & c("adjustment_terminated").isNull()
            & ~c("administered").eqNullSafe(EXCLUDED_ADMINISTERED)
            # Spark sorts NaN above every number; pandas drops it
            & (c("open_amt") > MIN_OPEN_AMOUNT) & ~F.isnan(c("open_amt").cast("double")))
    out = (raw.filter(keep)
           .withColumn("aging_days", days)
           .withColumn("aging_bucket", aging_bucket("aging_days"))
           .withColumn("product_type", product_type("order_number"))
           .withColumn("priority", priority("yrx_assignee", "aging_days", "open_amt"))
           .withColumn("funder", funder_label("funder_name")))
    extra = [SHEET_COLUMNS.get(x, x) for x in (drop or [])]
    if strict_drop:
        missing = [x for x in extra if x not in raw.columns]
        if missing:
            raise KeyError(f"columns not found: {missing}")
    return out.drop(*(["yrx_status", "administered", "adjustment_terminated"] + extra))


def aging_summary(report: DataFrame) -> DataFrame:
    """Rows and open amount per funder and bucket."""
    return (report.groupBy("funder", "aging_bucket")
            .agg(F.count(F.lit(1)).alias("n_items"), F.round(F.sum("open_amt"), 2).alias("open_amt")))


def funder_counts(report: DataFrame) -> DataFrame:
    """One line per output file the reference writes: funder, rows, priorities."""
    return (report.groupBy("funder")
            .agg(F.count(F.lit(1)).alias("n_items"),
                 F.count_if(F.col("priority").startswith("P1")).alias("n_p1"),
                 F.count_if(F.col("product_type") == "NetSuite").alias("n_netsuite")))
