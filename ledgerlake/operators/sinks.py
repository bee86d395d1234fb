"""Sinks: partitioned report outputs, two-output splits, halves, CSV, appends.

All writes go through Spark's file commit protocol (a job either commits its
output or leaves none), so a lost executor means a retried task, not a torn
file. Excel workbooks are not written (see README); CSV/Parquet instead.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F


def _stamp(as_of, fmt: str) -> str:
    d = _dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    return d.strftime(fmt)


def write_by(df: DataFrame, column: str, base: str, as_of, fmt: str = "parquet",
             max_records_per_file: int = 5_000_000) -> str:
    """K6: one output folder per distinct value of `column`, under as_of=YYYY-MM-DD.

    No shuffle by `column`: each task writes its own slice of every value, so a
    value holding a third of the rows is written by all tasks, not by one."""
    path = f"{base.rstrip('/')}/as_of={_stamp(as_of, '%Y-%m-%d')}"
    (df.write.mode("overwrite").partitionBy(column).format(fmt)
     .option("header", True).option("maxRecordsPerFile", max_records_per_file).save(path))
    return path


def write_split(clean: DataFrame, exceptions: DataFrame, base: str, as_of, fmt: str = "parquet") -> tuple[str, str]:
    """K7: cleaned_worklist_<date> and exception_<date>."""
    stamp = _stamp(as_of, "%Y-%m-%d")
    a = f"{base.rstrip('/')}/cleaned_worklist_{stamp}"
    b = f"{base.rstrip('/')}/exception_{stamp}"
    for rows, path in ((clean, a), (exceptions, b)):
        writer = rows.write.mode("overwrite").format(fmt).option("header", True)
        (writer.options(**CSV_OPTIONS) if fmt == "csv" else writer).save(path)
    return a, b


def write_normalised(df: DataFrame, base: str, file_col: str = "file_name", fmt: str = "parquet") -> str:
    """Rewrite every payment file after date normalisation, one folder per
    source file (the caller renames folders to files if it needs single files)."""
    df.write.mode("overwrite").partitionBy(file_col).format(fmt).option("header", True).save(base)
    return base


def write_halves(df_with_half: DataFrame, base: str, as_of, fmt: str = "parquet") -> str:
    """K8: the two halves (column `half`) into a folder named YYYYMMDD."""
    path = f"{base.rstrip('/')}/{_stamp(as_of, '%Y%m%d')}"
    df_with_half.write.mode("overwrite").partitionBy("half").format(fmt).option("header", True).save(path)
    return path


# one quoting for writing and reading back, so that quotes, line breaks and outer spaces of a cell survive
CSV_OPTIONS = {"quote": '"', "escape": '"', "quoteAll": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def to_csv(df: DataFrame, path: str, header: bool = True) -> str:
    df.write.mode("overwrite").options(**CSV_OPTIONS).option("header", header).csv(path)
    return path


def read_csv(spark, path: str, header: bool = True) -> DataFrame:
    """A CSV folder written by this module, as text columns."""
    from ledgerlake.sources.tables import CSV_READ
    return spark.read.options(**CSV_READ).option("header", header).csv(path)


def clustered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows brought together by the folders they go to, so that a write makes few
    files per folder; adaptive execution splits a folder that holds too much."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def append_counted(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> int:
    """K1: append rows and return how many were written (counted by an
    observation during the write, no second pass). A ledger stored with
    `partition_by=("source",)` lets every source-filtered look-up prune whole
    folders instead of reading them."""
    obs = Observation("appended")
    writer = clustered(df, partition_by).observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return int(obs.get["rows"])


def replace_table(df: DataFrame, table: str) -> int:
    """The rows that stay become the next version of a versioned table they were
    read from (see `versions`); readers of the version before keep it. Returns the
    version's number; refused if another writer has changed the table meanwhile."""
    from ledgerlake.operators.versions import publish, replaced, version_of
    spark = df.sparkSession
    return publish(spark, table, replaced(version_of(spark, table), table, df)).number


def replace_buckets(spark, ledger_path: str, updated: DataFrame, bucket_col: str = "deal_bucket") -> list[int]:
    """K3/K4 on a bucket-partitioned ledger: rewrite only the buckets holding
    updated rows. Their new content (old rows minus the updated ids, plus the
    updated rows) is first materialised in the shared checkpoint folder, then
    those bucket folders alone are replaced (dynamic partition overwrite).
    Each folder is replaced whole; readers that open several folders during the
    replacement may see some of them old and some new.
    Returns the buckets rewritten (at most the bucket count, a bounded list)."""
    from ledgerlake.operators.flags import bounded
    from ledgerlake.session import cut_lineage
    from ledgerlake.sources.tables import read_ledger
    buckets = sorted(r[0] for r in updated.select(bucket_col).distinct().collect())
    if not buckets:
        return []
    current = read_ledger(spark, ledger_path).filter(F.col(bucket_col).isin(buckets))
    fresh = current.join(bounded(updated.select("id")), "id", "left_anti").unionByName(updated.select(*current.columns))
    fresh = cut_lineage(fresh)  # read of the old folders completes before any is replaced
    clustered(fresh, [bucket_col]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(bucket_col).parquet(ledger_path)
    return buckets
