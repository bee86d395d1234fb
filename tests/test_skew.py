"""One deal holding a third of the rows: results stay exact; the flag join is
either a broadcast (batch not shuffled) or, above the size bound, salted so the
hot deal is spread over many tasks."""
from pyspark.sql import functions as F

from ledgerlake.operators import flags as flag_mod
from ledgerlake.operators.validate import validate_status
from ledgerlake.schemas import conform_ledger

N = 60000


def inputs(spark):
    deal = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 5000).cast("string"))
    ledger = conform_ledger(spark.range(N).select(
        F.col("id"), deal.alias("deal_id"),
        F.when(F.col("id") % 2 == 0, "NetSuite").otherwise("Oracle").alias("source"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.current_date()).alias("report_date")))
    batch = spark.range(N).select(F.col("id").alias("seq_id"), deal.alias("deal_id"),
                                  F.when(F.col("id") % 4 == 0, "Standard").otherwise("Closed").alias("status"))
    return ledger, batch


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def check(got):
    assert len(got) == N
    assert got[0] == 'Report date cannot be null for deals with STATUS as "Standard". '
    assert got[3] == "Invalid STATUS value for Oracle deal. "
    assert sum(1 for s in got if s % 3 == 0) == N // 3


def test_hot_deal_broadcast_path(spark):
    ledger, batch = inputs(spark)
    out = validate_status(batch, ledger)
    got = {r["seq_id"]: r["error_msg"] for r in out.collect()}
    check(got)
    p = plan(out)
    assert "_salt" not in p and "BroadcastHashJoin" in p


def test_hot_deal_salted_path(spark, monkeypatch):
    monkeypatch.setattr(flag_mod, "MAX_BROADCAST_BYTES", 10)   # flags too large to broadcast
    monkeypatch.setattr(flag_mod, "HOT_KEY_SHARE", 0.05)
    ledger, batch = inputs(spark)
    out = validate_status(batch, ledger)
    got = {r["seq_id"]: r["error_msg"] for r in out.collect()}
    check(got)
    assert "_salt" in plan(out)
    # same answer as the broadcast path
    monkeypatch.setattr(flag_mod, "MAX_BROADCAST_BYTES", 64 << 20)
    assert got == {r["seq_id"]: r["error_msg"] for r in validate_status(batch, ledger).collect()}
