"""Rules fixed in the second round: numbers, naming, patches in order, salting of NULL keys, uploads."""

import datetime as dt
import glob
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake import jobs
from ledgerlake.functions.text import double_column
from ledgerlake.operators import flags
from ledgerlake.operators.load import load_patch, load_payment
from ledgerlake.operators.posting import derive_amount
from ledgerlake.operators.quality import row_count_check
from ledgerlake.operators.report import funder_report
from ledgerlake.operators.sinks import append_counted, replace_buckets
from ledgerlake.schemas import conform_ledger, with_deal_bucket

TS = "2024-01-02 03:04:05"


def ledger(spark, rows):
    """Ledger rows from dicts; absent columns are NULL."""
    names = sorted({k for r in rows for k in r})
    kinds = {"id": "long", "original_invoice_amount": "decimal(38,10)", "payment_discount": "decimal(38,10)", "adjustment_amt": "decimal(38,10)",
             "payment_applied_to_invoice": "decimal(38,10)", "other_adjustment": "decimal(38,10)"}
    return conform_ledger(spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows],
                                                ", ".join(f"{n} {kinds.get(n, 'string')}" for n in names)))


PATCH = ("seq_id long, deal_type string, report_date string, movement_type string, deal_id string, invoice_num string, other_adjustment string, "
         "original_invoice_amount string, payment_discount string, payment_applied_to_invoice string, comments string, error_msg string")


def patches(spark, rows):
    names = [c.split()[0] for c in PATCH.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], PATCH)


def test_nan_amounts_are_not_reported(spark):
    cols = ("payment_due_date date, yrx_status string, yrx_assignee string, order_number string, deal_association_type string, "
            "adjustment_terminated string, administered string, funder_name string, open_amt double")
    due = dt.date(2024, 1, 5)
    raw = spark.createDataFrame([(due, "x", "a", "1", "t", None, "n", "f", v) for v in (float("nan"), 20.0, 10.0, None)], cols)
    assert [r["open_amt"] for r in funder_report(raw, "2024-01-10").collect()] == [20.0]


def test_text_amounts_are_read_as_pandas_would(spark):
    df = spark.createDataFrame([("1d",), ("NaN",), ("12.5",), (" 3 ",), (None,)], "a string")
    assert [r["v"] for r in df.select(double_column(df, "a").alias("v")).collect()] == [None, None, 12.5, 3.0, None]
    num = spark.createDataFrame([(1e12,), (float("nan"),)], "a double")
    assert [r["v"] for r in num.select(double_column(num, "a").alias("v")).collect()] == [1e12, None]


def test_derived_amount_is_exact_to_the_tenth_digit(spark):
    df = ledger(spark, [{"id": 1, "source": "NetSuite", "movement_type": "Initial movement",
                         "original_invoice_amount": Decimal("1.0000000001"), "payment_discount": Decimal("0.0000000002")}])
    assert derive_amount(df).first()["adjustment_amt"] == Decimal("0.9999999999")


def test_patches_pass_the_trigger_one_by_one(spark):
    row = {"id": 1, "source": "Oracle", "movement_type": "Initial movement", "deal_type": "7.05 Exception", "deal_id": "d", "invoice_num_": "i"}
    first = {"seq_id": 1, "movement_type": "Initial movement", "deal_id": "d", "invoice_num": "i", "original_invoice_amount": "50", "payment_discount": "5"}
    second = {"seq_id": 2, "movement_type": "Initial movement", "deal_id": "d", "invoice_num": "i", "deal_type": "Warehouse V2"}
    start = ledger(spark, [row])
    both = load_patch(patches(spark, [second, first]), start, as_of_ts=TS, user="u").first()
    once = load_patch(patches(spark, [first]), start, as_of_ts=TS, user="u").drop("n_patches")
    then = load_patch(patches(spark, [second]), once, as_of_ts=TS, user="u").first()
    for c in start.columns:
        assert both[c] == then[c], c
    assert both["n_patches"] == 2 and both["original_invoice_amount"] is None


def test_bad_number_stops_a_load_in_any_ansi_mode(spark):
    cols = ("seq_id long, status string, report_date string, deal_id string, deal_type string, movement_type string, adjustment_amount string, "
            "comments string, ofs_payment_posting string, payment_source string, invoice_num_ string, other_adjustment string, "
            "original_invoice_amount string, payment_discount string, payment_applied_to_invoice string, error_msg string")
    batch = spark.createDataFrame([(1, "WIP", None, "d", "Upfront", "m", "x1", None, None, None, "i", None, None, None, None, None)], cols)
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for mode in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", mode)
            with pytest.raises(Exception, match="adjustment_amount is not a number"):
                load_payment(batch, "o_payment", id_base=0, as_of_ts=TS, user="u").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_null_keys_are_spread_and_kept(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    right = spark.range(50).select(F.col("id").alias("k"), F.lit(True).alias("flag"))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = flags.salted_join(left, right, ["k"])
        assert joined.count() == 3000 and joined.where("k IS NULL AND flag IS NOT NULL").count() == 0
        parts = joined.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) > 3 and max(r["count"] for r in parts) < 600
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_broadcasts_are_bounded_by_measured_bytes(spark):
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"), F.lit(None).cast("string").alias("n"))
    size = flags.measured_bytes(wide)
    assert 10_000 <= size <= 12_000 and flags.measured_bytes(wide.limit(0)) == 0
    assert "broadcast" not in flags.bounded(wide, 9_999)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in flags.bounded(wide, 20_000)._jdf.queryExecution().analyzed().toString()


def test_csv_check_survives_line_breaks_and_quotes(spark, tmp_dir):
    df = spark.createDataFrame([("a\nb", 'x "y", z'), ("", None)], "a string, b string")
    r = row_count_check(df, f"{tmp_dir}/c").first()
    assert (r["source_rows"], r["written_rows"], r["ok"]) == (2, 2, True)


def test_bucketed_writes_make_few_files(spark, tmp_dir):
    rows = with_deal_bucket(conform_ledger(spark.range(1500).repartition(4).select("id", (F.col("id") % 7).cast("string").alias("deal_id"))))
    assert append_counted(rows, f"{tmp_dir}/l", partition_by=("deal_bucket",)) == 1500
    assert len(glob.glob(f"{tmp_dir}/l/deal_bucket=*/part*")) <= 7
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    one = spark.read.parquet(f"{tmp_dir}/l").where("id = 3").withColumn("comments", F.lit("new"))
    assert len(replace_buckets(spark, f"{tmp_dir}/l", one)) == 1
    assert spark.read.parquet(f"{tmp_dir}/l").count() == 1500 and spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_ten_row_patch_does_not_deal_out_the_ledger(spark):
    big = spark.range(50_000).select("id", F.lit("c").alias("comments"))
    few = flags.bounded(spark.range(10).select("id"))
    plan = big.join(few, "id", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_upload_writes_rejects_and_refuses_a_second_load(spark, tmp_dir):
    from ledgerlake.sources import to_staged
    cols = "seq_id long, deal_id string, status string"
    batch = to_staged(spark.createDataFrame([(1, "d1", "Standard"), (2, None, "WIP"), (3, "d1", "nonsense")], cols), "status", "B1")
    batch.write.parquet(f"{tmp_dir}/s")
    ledger(spark, [{"id": 1, "deal_id": "d1", "status": "WIP", "source": "Oracle"}]).write.parquet(f"{tmp_dir}/ledger")
    out = jobs.upload_batch(spark, "status", f"{tmp_dir}/s", "B1", f"{tmp_dir}/ledger", new_ledger_path=f"{tmp_dir}/v2", user="u", as_of_ts=TS)
    rejected = spark.read.parquet(out["rejected_path"])
    assert out["rejected"] == rejected.count() == rejected.where("error_msg IS NOT NULL").count() >= 1
    with pytest.raises(ValueError, match="already loaded"):
        jobs.upload_batch(spark, "status", f"{tmp_dir}/s", "B1", f"{tmp_dir}/ledger", new_ledger_path=f"{tmp_dir}/v3")


def test_every_file_is_read_by_its_own_header_and_kind(spark, tmp_dir):
    from ledgerlake.sources.tables import read_export
    import os
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a 1.csv", "w") as f:
        f.write("Deal Id,Amount,When\n1,10,05-May-2021\n2,,06-May-2021\n")
    with open(f"{tmp_dir}/in/b.csv", "w") as f:
        f.write("When,Deal Id,Amount\n07-May-2021,3,30\n")
    with open(f"{tmp_dir}/in/c.csv", "w") as f:
        f.write("Deal Id,Extra\n4,x\n")
    with open(f"{tmp_dir}/in/d.xls", "w") as f:
        f.write("<table><tr><th>Amount</th><th>Deal Id</th></tr><tr><td>50</td><td>5</td></tr><tr><td>60</td></tr></table>")
    got = read_export(spark, f"{tmp_dir}/in")
    assert set(got.columns) == {"Deal Id", "Amount", "When", "Extra", "_file", "_row"}
    rows = sorted((r["Deal Id"] or "", r["Amount"], r["When"], r["Extra"]) for r in got.collect())
    assert rows == [("", "60", None, None), ("1", "10", "05-May-2021", None), ("2", None, "06-May-2021", None),
                    ("3", "30", "07-May-2021", None), ("4", None, None, "x"), ("5", "50", None, None)]
    with open(f"{tmp_dir}/in/e.xls", "w") as f:
        f.write("<p>no table</p>")
    with pytest.raises(ValueError, match="e.xls"):
        read_export(spark, f"{tmp_dir}/in")
    with pytest.raises(FileNotFoundError):
        read_export(spark, f"{tmp_dir}/in", "*.zzz")
