"""Payment-detail files: date normalisation (X23), name assignment by date range
(B4), deal exclusion (F17/Q4) and the split into halves (W4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerlake.functions.dates import normalise_date_text
from ledgerlake.operators.flags import bounded
from ledgerlake.operators.intervals import points_in_ranges
from ledgerlake.operators.rownum import with_row_number
from ledgerlake.session import cut_lineage, discard, materialise

# ---- fixed values ------------------------------------------------------------
DATE_COLUMNS = ["contract_close_date", "funding_date", "assignment_date", "payment_due_date"]
# (file, deal) pairs removed by the reference, in its order
REFERENCE_EXCLUSIONS = [
    ("PaymentDetails_NA_20230101_20230331_amend(excl 172629).xlsx", 172629),
    ("PaymentDetails_NA_20230901_20231031_amend(excl 181710).xlsx", 181710),
    ("PaymentDetails_NA_20181001_20181231_amend(excl 95885).xlsx", 95885),
    ("PaymentDetails_NA_20190401_20190531_amend(excl 98636).xlsx", 98636),
    ("PaymentDetails_NA_20200601_20200930_amend(excl 115944).xlsx", 115944),
]


def normalise_dates(df: DataFrame, columns: Sequence[str] = DATE_COLUMNS) -> DataFrame:
    """Every listed column that exists: d-Mon-yyyy text -> m/d/yyyy, '' if bad."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: normalise_date_text(c) for c in present})


def exclude_deals(df: DataFrame, pairs: DataFrame, file_col: str = "file_name", deal_col: str = "deal_id") -> DataFrame:
    """Drop rows whose (file, deal) is listed; a NULL deal is kept
    (pandas `!=` keeps NaN). `pairs` has columns (file_name, deal_id)."""
    p = bounded(pairs.select(F.col("file_name").alias("_xf"), F.col("deal_id").alias("_xd")).dropDuplicates())
    on = (F.col(file_col) == F.col("_xf")) & (F.col(deal_col) == F.col("_xd"))
    return df.join(p, on, "left_anti")


def reference_exclusions(spark) -> DataFrame:
    return spark.createDataFrame(REFERENCE_EXCLUSIONS, "file_name string, deal_id long")


def split_halves(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """`half` = 1 for the first floor(n/2) rows in `order`, else 2."""
    numbered = with_row_number(df, order, name="_rn", total="_n")
    half = F.when(F.col("_rn") <= F.floor(F.col("_n") / 2), 1).otherwise(2)
    return numbered.withColumn("half", half.cast("int")).drop("_rn", "_n")


def range_candidates(files: DataFrame, ranges: DataFrame) -> DataFrame:
    """Every (file, range) with start <= date <= end, and no other pair on the way (see `intervals`)."""
    found = points_in_ranges(files.select("file", "file_order", "cell_date"),
                             ranges.select(F.col("file_name").alias("name"), "start_date", "end_date", "range_rank"),
                             "cell_date", "start_date", "end_date")
    return found.select("file", "file_order", "name", "range_rank")


def assign_names(files: DataFrame, ranges: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Each file, in listing order, takes its first matching free name.

    files: (file, file_order, cell_date); ranges: (file_name, start_date,
    end_date, range_rank); existing: (name) already present. Result:
    (file, new_name, status) with status renamed / conflict / unmatched.

    Serial "first come, first served" with one priority order for all names is
    computed as deferred acceptance: every file proposes its best remaining
    candidate and each name keeps its earliest proposer. A name's keeper can only
    be replaced by an earlier file, so every pair of that name with a later file
    is out, proposed or not. Rounds of two aggregates and two joins go on until
    no pair is out."""
    cand = range_candidates(files, ranges)
    if existing is not None:
        cand = cand.join(existing.select(F.col("name")), "name", "left_anti")
    cand = cut_lineage(cand.select("file", "file_order", "name", "range_rank"))
    spark = files.sparkSession
    active, path, left = cand, None, None
    while True:
        best = active.groupBy("file").agg(F.min("range_rank").alias("range_rank"))
        proposals = active.join(best, ["file", "range_rank"])
        # map-side combined: a hot name is cheap
        keeper = proposals.groupBy("name").agg(F.min("file_order").alias("_keeper"))
        fewer, fewer_path = materialise(active.join(keeper, "name", "left").filter(
            F.col("_keeper").isNull() | (F.col("file_order") <= F.col("_keeper"))).drop("_keeper"), "naming")
        n = fewer.count()
        if path is not None:
            discard(spark, path)
        active, path = fewer, fewer_path
        if n == left:
            break
        left = n
    best = active.groupBy("file").agg(F.min("range_rank").alias("range_rank"))
    held = active.join(best, ["file", "range_rank"]).select("file", "name")
    matched = cand.select("file").distinct().withColumn("_has", F.lit(True))
    out = (files.select("file").join(held.select("file", F.col("name").alias("new_name")), "file", "left")
           .join(matched, "file", "left"))
    status = (F.when(F.col("new_name").isNotNull(), "renamed")
              .when(F.col("_has"), "conflict").otherwise("unmatched"))
    return out.select("file", "new_name", status.alias("status"))
