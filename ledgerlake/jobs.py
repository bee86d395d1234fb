"""End-to-end jobs: files in, files out (the four entry points of the survey).

Each job reads its inputs with explicit schemas, runs the operators as one lazy
plan per output, writes through Spark's commit protocol, and materialises a
result used twice with a reliable checkpoint (never a local cache only).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlake.operators.flags import bounded
from ledgerlake.operators.files import assign_names, exclude_deals, normalise_dates, split_halves
from ledgerlake.operators.quality import row_count_check
from ledgerlake.operators.load import load_patch, load_payment, load_status, load_worklist, rows_written
from ledgerlake.operators.report import DROP_COLUMNS, SHEET_COLUMNS, funder_report
from ledgerlake.operators.rownum import with_row_number
from ledgerlake.operators.sinks import (append_counted, clustered, read_csv, replace_buckets, write_by, write_halves,
                                        write_normalised, write_split)
from ledgerlake.operators.validate import VALIDATORS
from ledgerlake.operators.versions import (Version, appended, changed, create_table, is_versioned, read_version, replaced,
                                           updated)
from ledgerlake.operators.worklist import clean_worklist, reconcile
from ledgerlake.schemas import conform_ledger, with_deal_bucket
from ledgerlake.session import create_exclusive, cut_lineage, path_exists
from ledgerlake.functions.text import double_column, file_name_of
from ledgerlake.sources.tables import cell_at, read_batch, read_export, read_ledger, read_master

INSERT_KINDS = ("worklist", "ns_payment", "o_payment", "o_exception")


def _validated(spark: SparkSession, kind: str, staged_path: str, batch_name: str, ledger: DataFrame,
               master: DataFrame | None, rejected_path: str) -> tuple[DataFrame, dict]:
    """The validated batch, and its counts; rejected rows are written with their error text."""
    batch = read_batch(spark.read.parquet(staged_path), kind, batch_name)
    fn = VALIDATORS[kind]
    validated = fn(batch, ledger, master) if kind in ("worklist", "o_exception") else fn(batch, ledger)
    validated = cut_lineage(validated)  # read twice: rejected report and load
    counts = validated.agg(F.count("*").alias("n"), F.count("error_msg").alias("bad")).first()
    validated.filter(F.col("error_msg").isNotNull()).write.mode("overwrite").parquet(rejected_path)
    return validated, {"batch_rows": counts["n"], "rejected": counts["bad"], "rejected_path": rejected_path}


def _new_rows(kind: str, validated: DataFrame, master: DataFrame | None, ledger: DataFrame, **how) -> DataFrame:
    rows = load_worklist(validated, master, ledger, **how) if kind == "worklist" else load_payment(validated, kind, ledger, **how)
    return rows.drop("seq_id")


def _updated_rows(kind: str, validated: DataFrame, ledger: DataFrame, **how) -> DataFrame:
    return cut_lineage(load_status(validated, ledger, **how) if kind == "status" else load_patch(validated, ledger, **how))


def upload_batch(spark: SparkSession, kind: str, staged_path: str, batch_name: str, ledger_path: str,
                 master_path: str | None = None, new_ledger_path: str | None = None, *,
                 source: str | None = None, user: str | None = None, as_of_ts=None,
                 partition_by: tuple[str, ...] = (), rejected_path: str | None = None) -> dict:
    """Validate one staged batch and load its clean rows. Rejected rows are written
    with their error text below `rejected_path` (default: next to the ledger), one
    folder per batch. A batch of a name already loaded into this ledger is refused.

    A versioned ledger (`operators.versions`) takes the rows and the batch's name
    in one published version: a rerun after a crash loads the batch exactly once,
    and of loaders at work at the same time each starts over from the version that
    another one published first, so ids are unique and every batch is validated
    against the ledger it is loaded into.

    A plain ledger is appended to; updates (status, patch) write a new ledger to
    `new_ledger_path` (the input is never overwritten while it is read), or
    rewrite the buckets concerned. `partition_by` is its stored layout: ("source",)
    and/or ("deal_bucket",) (see schemas.deal_bucket); look-ups then prune folders.
    Its batches are claimed below `<ledger>_batches` before anything is written and
    recorded there afterwards: a batch with a claim and no record was cut off, and
    is refused, as its rows may be there.

    Returns counts and the rejected rows' folder."""
    beside = ledger_path.rstrip("/")
    rejects = f"{(rejected_path or beside + '_rejected').rstrip('/')}/{kind}-{batch_name}"
    master = read_master(spark, master_path) if master_path else None
    how = {"as_of_ts": as_of_ts, "user": user}
    if is_versioned(spark, ledger_path):
        return _upload_versioned(spark, kind, staged_path, batch_name, ledger_path, master, source, rejects, **how)
    record = f"{beside}_batches/{kind}-{batch_name}"
    if path_exists(spark, record):
        raise ValueError(f"batch {batch_name!r} ({kind}) is already loaded into {ledger_path}")
    if path_exists(spark, f"{record}.claim"):
        raise ValueError(f"an earlier load of batch {batch_name!r} ({kind}) into {ledger_path} was cut off after it began to write; "
                         f"see whether its rows are there before removing {record}.claim")
    if kind not in INSERT_KINDS and new_ledger_path is None and "deal_bucket" not in partition_by:
        raise ValueError("updates need new_ledger_path (or a deal_bucket-partitioned or versioned ledger)")
    ledger = read_ledger(spark, ledger_path)
    validated, result = _validated(spark, kind, staged_path, batch_name, ledger, master, rejects)

    def claim() -> None:
        if not create_exclusive(spark, f"{record}.claim", batch_name):
            raise ValueError(f"batch {batch_name!r} ({kind}) is being loaded into {ledger_path}")

    def done() -> dict:
        spark.createDataFrame([(kind, batch_name, result["rows_written"])], "kind string, batch string, rows_written long") \
            .coalesce(1).write.mode("errorifexists").json(record)
        return result

    if kind in INSERT_KINDS:
        rows = _new_rows(kind, validated, master, ledger, source=source, **how)
        if "deal_bucket" in partition_by:
            rows = with_deal_bucket(rows)
        claim()
        result["rows_written"] = append_counted(rows, ledger_path, partition_by=partition_by)
        return done()
    rows = _updated_rows(kind, validated, ledger, **how)
    result["rows_written"] = rows_written(rows).first()["rows_written"]
    claim()
    if new_ledger_path is None:
        # bucketed ledger: replace only the buckets that hold updated rows
        result["buckets_rewritten"] = len(replace_buckets(spark, ledger_path, rows.drop("n_patches")))
        return done()
    # ids of a checked size are probed where the ledger lies; it is not dealt out for them
    keep = ledger.join(bounded(rows.select("id")), "id", "left_anti")
    writer = clustered(keep.unionByName(rows.select(*ledger.columns)), partition_by).write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(new_ledger_path)
    result["new_ledger_path"] = new_ledger_path
    return done()


def _upload_versioned(spark: SparkSession, kind: str, staged_path: str, batch_name: str, table: str,
                      master: DataFrame | None, source: str | None, rejects: str, **how) -> dict:
    result: dict = {}

    def change(base: Version) -> Version:
        if f"{kind}-{batch_name}" in base.batches:
            raise ValueError(f"batch {batch_name!r} ({kind}) is already loaded into {table}")
        ledger = conform_ledger(read_version(spark, table, base))
        validated, counts = _validated(spark, kind, staged_path, batch_name, ledger, master, rejects)
        result.update(counts)
        if kind in INSERT_KINDS:
            rows = _new_rows(kind, validated, master, ledger, source=source, **how)
            rows = with_deal_bucket(rows) if "deal_bucket" in base.partition_by else rows
            version, result["rows_written"] = appended(base, table, rows, f"{kind}-{batch_name}")
            return version
        rows = _updated_rows(kind, validated, ledger, **how)
        result["rows_written"] = rows_written(rows).first()["rows_written"]
        version, buckets = updated(base, table, rows.drop("n_patches"), batch=f"{kind}-{batch_name}")
        result["buckets_rewritten"] = len(buckets)
        return version

    result["version"] = changed(spark, table, change).number
    return result


def create_ledger(spark: SparkSession, path: str, table: str, by_bucket: bool = True) -> int:
    """A versioned ledger with the rows of the ledger at `path`, stored by deal bucket."""
    rows = read_ledger(spark, path)
    if by_bucket:
        rows = with_deal_bucket(rows)
    return create_table(rows, table, ("deal_bucket",) if by_bucket else ()).number


def exclude_job(spark: SparkSession, table: str, exclusions: DataFrame, deal_col: str = "deal_id") -> int:
    """Remove the listed (file, deal) pairs from a versioned table of payment rows; returns the version that has them removed."""
    def change(base: Version) -> Version:
        return replaced(base, table, exclude_deals(read_version(spark, table, base), exclusions, deal_col=deal_col))
    return changed(spark, table, change).number


def read_payment_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The 'Raw' sheet exported as CSV, Parquet or an HTML '.xls', with its
    header; the report's columns typed (dates ISO or m/d/yyyy)."""
    raw = read_export(spark, path)
    renamed = raw.select(*[F.col(f"`{c}`").alias(SHEET_COLUMNS.get(c, c)) for c in raw.columns])
    due = F.col("payment_due_date").cast("string")
    return (renamed.withColumn("payment_due_date", F.coalesce(F.try_to_date(due, "yyyy-MM-dd"),
                                                              F.try_to_date(due, "M/d/yyyy")))
            .withColumn("open_amt", double_column(renamed, "open_amt")))


def funder_report_job(spark: SparkSession, sheet_path: str, out_base: str, as_of, start="2020-01-01") -> str:
    """Filter, age and label the sheet; one output folder per funder."""
    report = funder_report(read_payment_sheet(spark, sheet_path), as_of, start, drop=DROP_COLUMNS).drop("_file", "_row")
    return write_by(report, "funder", out_base, as_of, fmt="csv")


def worklist_job(spark: SparkSession, path: str, out_base: str, as_of) -> dict:
    """Clean a worklist export ('.xls' HTML table, CSV or Parquet, chosen by
    extension) into clean + exception outputs and reconcile."""
    raw = read_export(spark, path).drop("_file", "_row")
    cols = {c: c.lower().replace(" ", "_") for c in raw.columns}
    df = raw.select(*[F.col(f"`{a}`").alias(b) for a, b in cols.items()])
    df = cut_lineage(df.withColumn("payment_discount", double_column(df, "payment_discount")))
    clean, exc = clean_worklist(df)
    clean_path, exc_path = write_split(clean, exc, out_base, as_of, fmt="csv")
    written = [x.withColumn("payment_discount", double_column(x, "payment_discount"))
               for x in (read_csv(spark, clean_path), read_csv(spark, exc_path))]
    rec = reconcile(df, *written).first()
    return {"clean": clean_path, "exceptions": exc_path, **rec.asDict()}


def payment_files_job(spark: SparkSession, folder: str, ranges: DataFrame, out_base: str,
                      date_column: str | int = "assignment_date", row_index: int = 1, glob: str = "*.csv",
                      exclusions: DataFrame | None = None) -> DataFrame:
    """Normalise the dates of every file in `folder` matching `glob` ('*.xls'
    for HTML exports), then name files by the date found in the
    `row_index`-th row's `date_column` (a name, or a 0-based column position:
    the reference reads row 1, column 15), first free range wins."""
    rows = read_export(spark, folder, glob)
    if isinstance(date_column, int):
        from ledgerlake.sources.tables import data_columns
        date_column = data_columns(rows)[date_column].lower().replace(" ", "_")
    rows = rows.withColumn("file_name", file_name_of(F.col("_file")))
    rows = rows.select(*[F.col(f"`{c}`").alias(c.lower().replace(" ", "_")) for c in rows.columns])
    rows = normalise_dates(rows)
    kept = rows if exclusions is None else exclude_deals(
        rows.withColumn("_deal", F.col("deal_id").try_cast("long")), exclusions, deal_col="_deal").drop("_deal")
    write_normalised(kept.drop("_file", "_row"), f"{out_base.rstrip('/')}/normalised")
    cells = cell_at(rows, "file_name", "_row", date_column, row_index)
    files_order = with_row_number(rows.select("file_name").distinct(), ["file_name"], name="file_order")
    files = files_order.join(cells, "file_name", "left").select(
        F.col("file_name").alias("file"), "file_order",
        F.try_to_date(F.col(date_column), "M/d/yyyy").alias("cell_date"))
    # a target name already taken by a file in the folder is skipped
    existing = rows.select(F.col("file_name").alias("name")).distinct()
    names = assign_names(files, ranges, existing)
    names.write.mode("overwrite").option("header", True).csv(f"{out_base.rstrip('/')}/assignments")
    return names


def split_job(spark: SparkSession, path: str, out_base: str, as_of) -> DataFrame:
    """Split one export into two halves by row position (first floor(n/2) rows
    first), written under a YYYYMMDD folder. Returns the rows with `half`."""
    rows = read_export(spark, path)
    halves = split_halves(rows.withColumn("_pos", F.col("_row")), ["_file", "_pos"]).drop("_pos")
    out = cut_lineage(halves)
    write_halves(out.drop("_file", "_row"), out_base, as_of, fmt="csv")
    return out


def to_csv_job(spark: SparkSession, path: str, csv_path: str) -> dict:
    """Convert an export to CSV, read it back and compare row counts."""
    rows = read_export(spark, path).drop("_file", "_row")
    return row_count_check(rows, csv_path).first().asDict()
