"""The registered queries: one per operator family of the survey, each reading
whole test tables through the adapters. Every callable takes (spark, sf_dir)
and returns a DataFrame whose columns match the DuckDB oracle (plans.oracle):
decimals are shown as double and dates/timestamps as ISO text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerlake.functions.oracle import is_bad_date, is_bad_number, parse_date3, to_number
from ledgerlake.functions.text import clean_invoice_text, file_dir_of, file_ext_of, file_name_of, split_pieces
from ledgerlake.jobs import exclude_job, upload_batch
from ledgerlake.operators import files as files_op
from ledgerlake.operators.load import load_patch, load_payment, load_status, load_worklist
from ledgerlake.operators.posting import ALL_ACCOUNTS, post
from ledgerlake.operators.quality import constraint_report, row_count_check
from ledgerlake.operators.report import aging_summary, funder_counts, funder_report
from ledgerlake.operators.sinks import CSV_OPTIONS, append_counted, to_csv, write_by, write_halves, write_normalised, write_split
from ledgerlake.operators.validate import VALIDATORS
from ledgerlake.operators.versions import create_table, read_version
from ledgerlake.operators.worklist import clean_worklist, reconcile
from ledgerlake.plans.adapters import adapter, load_tables
from ledgerlake.session import scratch_path, tune
from ledgerlake.schemas import conform_ledger, with_deal_bucket
from ledgerlake.sources.tables import (cell_at, preview, read_batch, read_export, read_ledger, read_master, read_ranges,
                                       to_staged)
from ledgerlake.streaming.posting_stream import start_posting_stream

# ---- fixed parameters of the registered queries (dates lie inside the data) ----
AS_OF = "2000-06-15"
START = "1996-01-01"
POST_TS = "2000-06-15 10:30:45"
USER = "ledger_loader"
BATCH = "BATCH_1"

# fx_batch column -> staged column name, per batch kind
KIND_COLUMNS: dict[str, dict[str, str]] = {
    "worklist": {"deal_id": "deal_id", "funding_model": "funding_model", "order_number": "order_number",
                 "invoice_number": "invoice_num", "outstanding_amount": "outstanding_amount",
                 "payment_discount": "payment_discount", "status": "status", "comments": "comments"},
    "ns_payment": {"status": "status", "report_date": "report_date", "deal_id": "deal_id",
                   "deal_type": "deal_type", "movement_type": "movement_type", "adjustment_amount": "amount",
                   "comments": "comments", "ofs_payment_posting": "ofs_payment_posting",
                   "payment_source": "payment_source", "invoice_number": "invoice_num",
                   "other_adjustment": "other_adjustment", "original_invoice_amount": "original_invoice_amount",
                   "payment_discount": "payment_discount",
                   "payment_applied_to_invoice": "payment_applied_to_invoice"},
    "o_exception": {"status": "status", "report_date": "report_date", "deal_id": "deal_id",
                    "invoice_num_": "invoice_num", "deal_type": "deal_type", "movement_type": "movement_type",
                    "amount": "amount", "comments": "comments", "gl_date_for_adjustment": "gl_date"},
}
KIND_COLUMNS["o_payment"] = {("invoice_num_" if k == "invoice_number" else k): v
                             for k, v in KIND_COLUMNS["ns_payment"].items()}
KIND_ADAPTER = {"status": "fx_status_batch", "patch": "fx_patch_batch"}
LOAD_SOURCE = {"worklist": "NetSuite", "ns_payment": "NetSuite", "o_payment": "Oracle", "o_exception": "Oracle"}

LEDGER_OUT = ["id", "deal_id", "source", "status", "report_date", "deal_type", "movement_type", "invoice_num_",
              "adjustment_amt", "original_invoice_amount", "payment_discount", "payment_applied_to_invoice",
              "other_adjustment", "adjustment_type", *ALL_ACCOUNTS, "created", "created_by", "updated", "updated_by"]
LOAD_EXTRA = {
    "worklist": ["customer_name", "assignee", "oce", "country__oce_", "funding_model", "order_number"],
    "ns_payment": ["comments", "ofs_payment_posting", "payment_source"],
    "o_payment": ["comments", "ofs_payment_posting", "payment_source"],
    "o_exception": ["comments", "gl_date_for_adjustment"],
    "status": ["n_patches"],
    "patch": ["comments", "n_patches"],
}


def for_compare(df: DataFrame) -> DataFrame:
    """Decimals -> double, dates/timestamps -> ISO text (how the oracle shows them)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            cols.append(F.col(f.name).cast("string").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


class Ctx:
    """Per-call access to the adapters (each table read once per query)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        tune(spark)
        self.spark, self.sf_dir = spark, sf_dir
        self.tables = load_tables(spark, sf_dir)

    def fx(self, name: str) -> DataFrame:
        return adapter(self.spark, self.sf_dir, name, self.tables)

    def batch(self, kind: str) -> DataFrame:
        """Staged (positional) batch of `kind`, read back through read_batch."""
        if kind in KIND_ADAPTER:
            named = self.fx(KIND_ADAPTER[kind])
        else:
            src = self.fx("fx_batch")
            named = src.select("seq_id", *[F.col(v).alias(k) for k, v in KIND_COLUMNS[kind].items()])
        return read_batch(to_staged(named, kind, BATCH), kind, BATCH)


# ---------------------------------------------------------------- scalars ----
def q_x_parse_dates(spark, sf):
    b = Ctx(spark, sf).fx("fx_batch")
    return for_compare(b.select(
        "seq_id", "report_date", parse_date3("report_date").alias("parsed_report_date"),
        is_bad_date("report_date").alias("report_date_bad"),
        "gl_date", parse_date3("gl_date").alias("parsed_gl_date"), is_bad_date("gl_date").alias("gl_date_bad")))


def q_x_parse_numbers(spark, sf):
    b = Ctx(spark, sf).fx("fx_batch")
    out = [F.col("seq_id")]
    for c in ("amount", "other_adjustment", "original_invoice_amount", "payment_applied_to_invoice"):
        out += [F.col(c), to_number(c).alias(f"{c}_number"), is_bad_number(c).alias(f"{c}_bad")]
    return for_compare(b.select(*out))


def q_x_invoice_clean(spark, sf):
    w = Ctx(spark, sf).fx("fx_worklist")
    clean = clean_invoice_text("invoice_number")
    return w.select("row_no", "invoice_number", clean.alias("invoice_clean"),
                    F.size(split_pieces(clean)).cast("long").alias("n_invoice_pieces"),
                    F.size(split_pieces("outstanding_amount")).cast("long").alias("n_amount_pieces"))


# ----------------------------------------------------------- funder report ----
def _report(spark, sf):
    return funder_report(Ctx(spark, sf).fx("fx_payment_detail"), AS_OF, START)


def q_funder_report(spark, sf):
    return for_compare(_report(spark, sf))


def q_funder_aging_summary(spark, sf):
    return aging_summary(_report(spark, sf))


def q_funder_counts(spark, sf):
    return funder_counts(_report(spark, sf))


# ---------------------------------------------------------------- posting ----
def _posted(spark, sf):
    return post(Ctx(spark, sf).fx("fx_ledger"), "insert", POST_TS, USER, keep_rule=True)


def q_post_derive(spark, sf):
    return for_compare(_posted(spark, sf).select("id", "source", "movement_type", "adjustment_amt"))


def q_post_lock(spark, sf):
    return for_compare(_posted(spark, sf).select(
        "id", "original_invoice_amount", "payment_discount", "payment_applied_to_invoice", "other_adjustment"))


def q_post_accounts(spark, sf):
    return for_compare(_posted(spark, sf).select(
        "id", "posting_rule", "adjustment_type", "adjustment_amt", "payment_applied_to_invoice", *ALL_ACCOUNTS,
        "created", "created_by"))


def q_post_totals_by_account(spark, sf):
    p = _posted(spark, sf)
    return for_compare(p.groupBy("source", "adjustment_type").agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.sum(a).alias(a) for a in ALL_ACCOUNTS]))


# ------------------------------------------------------------- validation ----
def _validated(ctx: Ctx, kind: str) -> DataFrame:
    fn = VALIDATORS[kind]
    batch, ledger = ctx.batch(kind), ctx.fx("fx_ledger")
    if kind in ("worklist", "o_exception"):
        return fn(batch, ledger, ctx.fx("fx_master"))
    return fn(batch, ledger)


def _validate_query(kind):
    def q(spark, sf):
        return _validated(Ctx(spark, sf), kind).select("seq_id", "deal_id", "error_msg")
    q.__name__ = f"q_validate_{kind}"
    return q


# ------------------------------------------------------------------- loads ----
def _load_query(kind):
    def q(spark, sf):
        ctx = Ctx(spark, sf)
        v = _validated(ctx, kind)
        ledger = ctx.fx("fx_ledger")
        if kind == "worklist":
            out = load_worklist(v, ctx.fx("fx_master"), ledger, source=LOAD_SOURCE[kind], as_of_ts=POST_TS, user=USER)
        elif kind in ("ns_payment", "o_payment", "o_exception"):
            out = load_payment(v, kind, ledger, source=LOAD_SOURCE[kind], as_of_ts=POST_TS, user=USER)
        elif kind == "status":
            out = load_status(v, ledger, as_of_ts=POST_TS, user=USER)
        else:
            out = load_patch(v, ledger, as_of_ts=POST_TS, user=USER)
        return for_compare(out.select(*LEDGER_OUT, *LOAD_EXTRA[kind]))
    q.__name__ = f"q_load_{kind}"
    return q


def q_patch_conflicts(spark, sf):
    from ledgerlake.operators.load import patch_conflicts
    v = _validated(Ctx(spark, sf), "patch")
    return patch_conflicts(v).select(F.col("p_deal").alias("deal_id"), F.col("p_invoice").alias("invoice_num"),
                                     F.col("p_movement").alias("movement_type"), "n_patches", "n_deal_types",
                                     F.col("p_deal_type").alias("last_deal_type"))


# ---------------------------------------------------------------- worklist ----
def _worklist(spark, sf):
    w = Ctx(spark, sf).fx("fx_worklist")
    clean, exc = clean_worklist(w)
    return w, clean, exc


def q_worklist_clean(spark, sf):
    return _worklist(spark, sf)[1]


def q_worklist_exceptions(spark, sf):
    return _worklist(spark, sf)[2]


def q_worklist_reconcile(spark, sf):
    return reconcile(*_worklist(spark, sf))


# ------------------------------------------------------------------- files ----
def q_assign_names(spark, sf):
    ctx = Ctx(spark, sf)
    rows = ctx.fx("fx_payment_files")
    cells = cell_at(rows, ["file", "file_order"], "row_no", "assignment_day", row_index=1)
    files = cells.select("file", "file_order", F.col("assignment_day").alias("cell_date"))
    all_files = rows.select("file", "file_order").distinct()
    files = all_files.join(files, ["file", "file_order"], "left")
    return files_op.assign_names(files, ctx.fx("fx_ranges"))


def exclusion_pairs(rows: DataFrame) -> DataFrame:
    """Per file its largest deal id, plus the reference's own five pairs."""
    derived = rows.groupBy("file_name").agg(F.max("deal_id").alias("deal_id"))
    return derived.unionByName(files_op.reference_exclusions(rows.sparkSession))


def q_exclude_deals(spark, sf):
    rows = Ctx(spark, sf).fx("fx_payment_files").select("file_name", "row_no", "deal_id")
    return files_op.exclude_deals(rows, exclusion_pairs(rows))


def q_split_halves(spark, sf):
    rows = Ctx(spark, sf).fx("fx_payment_files").select("row_no", "file_name")
    return files_op.split_halves(rows, ["row_no"]).select("row_no", "half")


def q_normalise_dates(spark, sf):
    rows = Ctx(spark, sf).fx("fx_payment_files")
    return files_op.normalise_dates(rows).select("row_no", *files_op.DATE_COLUMNS)


# ----------------------------------------------------------------- quality ----
def q_constraint_report(spark, sf):
    return constraint_report(_posted(spark, sf))


def q_row_count_check(spark, sf):
    src = for_compare(Ctx(spark, sf).fx("fx_payment_detail"))
    return row_count_check(src, scratch_path(spark, "csv-check"))


# ---------------------------------------------------------- tables and sinks ----
def q_ledger_append(spark, sf):
    """Posted rows appended twice to a stored ledger, counted while written and read back by the ledger scan."""
    path = scratch_path(spark, "ledger")
    rows = _posted(spark, sf).drop("posting_rule")
    n = [append_counted(rows.withColumn("id", F.col("id") * 2 + k), path, partition_by=("source",)) for k in (0, 1)]
    return for_compare(read_ledger(spark, path).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("id").alias("n_ids"), F.sum("adjustment_amt").alias("adjustment_amt"))
        .withColumn("n_appended", F.lit(sum(n)).cast("long")))


def q_master_scan(spark, sf):
    path = scratch_path(spark, "master")
    Ctx(spark, sf).fx("fx_master").write.parquet(path)
    return read_master(spark, path).groupBy("oce_country").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("deal_id").alias("n_deals"), F.count("assignee_current").alias("n_assigned"))


def q_write_by_funder(spark, sf):
    """The report written in one folder per funder, read back."""
    path = write_by(_report(spark, sf), "funder", scratch_path(spark, "report"), AS_OF)
    return for_compare(spark.read.parquet(path).withColumn("funder", F.col("funder").cast("string")))


def q_write_worklist(spark, sf):
    """Both worklist outputs written and read back."""
    _, clean, exc = _worklist(spark, sf)
    paths = write_split(clean, exc, scratch_path(spark, "worklist"), AS_OF)
    parts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("row_no").alias("sum_row_no")).withColumn("output", F.lit(o))
             for o, p in zip(("clean", "exceptions"), paths)]
    return parts[0].unionByName(parts[1])


def q_worklist_clean_v5(spark, sf):
    return clean_worklist(Ctx(spark, sf).fx("fx_worklist"), "v5")[0]


def q_write_halves(spark, sf):
    path = write_halves(q_split_halves(spark, sf), scratch_path(spark, "halves"), AS_OF)
    return spark.read.parquet(path).select("row_no", F.col("half").cast("int").alias("half"))


def q_write_normalised(spark, sf):
    """Every file rewritten after its dates are normalised, read back."""
    rows = files_op.normalise_dates(Ctx(spark, sf).fx("fx_payment_files"))
    path = write_normalised(rows.select("row_no", "file_name", *files_op.DATE_COLUMNS), scratch_path(spark, "normalised"))
    return spark.read.parquet(path).select("row_no", *files_op.DATE_COLUMNS)


def q_preview(spark, sf):
    """L1: the first five rows of a stored export."""
    path = scratch_path(spark, "export")
    Ctx(spark, sf).fx("fx_payment_files").select("row_no", "file_name").orderBy("row_no").write.parquet(path)
    return preview(spark.read.parquet(path).orderBy("row_no"), 5).select("row_no", "file_name")


def q_read_export(spark, sf):
    """A folder of CSV files of two headers and of Parquet files, read back as one export."""
    rows, path = Ctx(spark, sf).fx("fx_export"), scratch_path(spark, "exports")
    first = rows.filter("part = 0").select(F.col("row_no").alias("Row No"), F.col("deal").alias("Deal"), F.col("note").alias("Note"))
    second = rows.filter("part = 1").select(F.col("note").alias("Note"), F.col("extra").alias("Extra"), F.col("row_no").alias("row no"))
    for part in (first, second):
        part.write.mode("append").options(**CSV_OPTIONS).option("header", True).csv(path)
    rows.filter("part = 2").select(F.col("row_no").alias("Row No"), F.col("note").alias("Note"), F.col("extra").alias("Extra")) \
        .write.mode("append").parquet(path)
    return read_export(spark, path, "part-*").select(F.col("`Row No`").alias("row_no"), F.col("Deal").alias("deal"),
                                                     F.col("Note").alias("note"), F.col("Extra").alias("extra"))


def q_read_ranges(spark, sf):
    """The table of file names by date range, written as a sheet and read with its dates."""
    rows = Ctx(spark, sf).fx("fx_ranges").orderBy("range_rank").select(
        F.col("file_name").alias("File Name"), F.col("start_date").alias("Start Date"), F.col("end_date").alias("End Date"))
    return for_compare(read_ranges(spark, to_csv(rows, scratch_path(spark, "ranges"))).select("file_name", "start_date", "end_date"))


def q_file_names(spark, sf):
    """Folder, name and extension of each row's file."""
    rows = Ctx(spark, sf).fx("fx_payment_files").select("row_no", F.concat(
        F.when(F.col("row_no") % 3 == 0, F.lit("C:\\Reports\\NA\\")).when(F.col("row_no") % 3 == 1, F.lit("/data/in.d/")).otherwise(F.lit("")),
        F.col("file_name"), F.when(F.col("row_no") % 4 == 0, F.lit("")).when(F.col("row_no") % 4 == 1, F.lit(".XLS")).otherwise(F.lit(".amend.csv"))).alias("path"))
    return rows.select("row_no", file_dir_of("path").alias("folder"), file_name_of("path").alias("name"), file_ext_of("path").alias("extension"))


def q_status_versions(spark, sf):
    """K4/K11 on a versioned ledger stored by deal: the status batch published as a version, beside the version before it."""
    ctx, base = Ctx(spark, sf), scratch_path(spark, "versioned")
    ledger, staged = conform_ledger(ctx.fx("fx_ledger")), f"{base}/staged"
    to_staged(ctx.fx("fx_status_batch"), "status", BATCH).write.parquet(staged)
    create_table(with_deal_bucket(ledger), f"{base}/ledger", ("deal_bucket",))
    before = read_ledger(spark, f"{base}/ledger")
    upload_batch(spark, "status", staged, BATCH, f"{base}/ledger", user=USER, as_of_ts=POST_TS)
    shown = [x.groupBy("status", "updated_by").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("id").alias("sum_id")).withColumn("version", F.lit(n))
             for n, x in ((1, before), (2, read_ledger(spark, f"{base}/ledger")))]
    return shown[0].unionByName(shown[1])


def q_exclude_versions(spark, sf):
    """The rows that stay published as the table's next version."""
    table = scratch_path(spark, "payments")
    rows = Ctx(spark, sf).fx("fx_payment_files").select("file_name", "row_no", "deal_id")
    create_table(rows, table)
    exclude_job(spark, table, exclusion_pairs(rows))
    return read_version(spark, table)


def q_post_stream(spark, sf):
    """The ledger posted as a stream that ends with its input, read back."""
    src, out = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    conform_ledger(Ctx(spark, sf).fx("fx_ledger")).write.parquet(src)
    start_posting_stream(spark, src, out, scratch_path(spark, "stream-state"), user=USER, as_of_ts=POST_TS).awaitTermination()
    return for_compare(read_ledger(spark, out).select(
        "id", "adjustment_type", "adjustment_amt", "payment_applied_to_invoice", *ALL_ACCOUNTS, "created", "created_by"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "x_parse_dates": q_x_parse_dates,
    "x_parse_numbers": q_x_parse_numbers,
    "x_invoice_clean": q_x_invoice_clean,
    "funder_report": q_funder_report,
    "funder_aging_summary": q_funder_aging_summary,
    "funder_counts": q_funder_counts,
    "post_derive": q_post_derive,
    "post_lock": q_post_lock,
    "post_accounts": q_post_accounts,
    "post_totals_by_account": q_post_totals_by_account,
    **{f"validate_{k}": _validate_query(k) for k in VALIDATORS},
    **{f"load_{k}": _load_query(k) for k in VALIDATORS},
    "patch_conflicts": q_patch_conflicts,
    "worklist_clean": q_worklist_clean,
    "worklist_exceptions": q_worklist_exceptions,
    "worklist_reconcile": q_worklist_reconcile,
    "assign_names": q_assign_names,
    "exclude_deals": q_exclude_deals,
    "split_halves": q_split_halves,
    "normalise_dates": q_normalise_dates,
    "constraint_report": q_constraint_report,
    "row_count_check": q_row_count_check,
    "ledger_append": q_ledger_append,
    "master_scan": q_master_scan,
    "write_by_funder": q_write_by_funder,
    "write_worklist": q_write_worklist,
    "worklist_clean_v5": q_worklist_clean_v5,
    "write_halves": q_write_halves,
    "write_normalised": q_write_normalised,
    "preview": q_preview,
    "post_stream": q_post_stream,
    "read_export": q_read_export,
    "read_ranges": q_read_ranges,
    "file_names": q_file_names,
    "status_versions": q_status_versions,
    "exclude_versions": q_exclude_versions,
}
