"""Plan shape checks: filters reach the Parquet scan, only needed columns are
read, flags need no extra shuffle, posting stays one narrow stage."""
import os

import pytest

from ledgerlake.operators.posting import post
from ledgerlake.operators.validate import validate_ns_payment, validate_status
from ledgerlake.plans.adapters import adapter
from ledgerlake.sources.tables import read_ledger

from .conftest import SF

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def plan_of(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def ledger_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ledger") / "ledger")
    adapter(spark, SF, "fx_ledger").write.parquet(path)
    return path


def test_validation_pushes_ledger_filter_and_prunes(spark, ledger_path):
    ledger = read_ledger(spark, ledger_path)
    batch = spark.createDataFrame([(1, "Standard", None, "5", "Upfront", "Apply to GL", "1")],
                                  "seq_id long, status string, report_date string, deal_id string, deal_type string, "
                                  "movement_type string, adjustment_amount string")
    for c in ["comments", "ofs_payment_posting", "payment_source", "invoice_number", "other_adjustment",
              "original_invoice_amount", "payment_discount", "payment_applied_to_invoice"]:
        batch = batch.withColumn(c, batch["status"].cast("string").substr(0, 0).cast("string"))
    plan = plan_of(validate_ns_payment(batch, ledger))
    assert "EqualTo(movement_type,Initial movement)" in plan and "EqualTo(source,NetSuite)" in plan
    schema = [line for line in plan.splitlines() if line.startswith("ReadSchema") and "movement_type" in line][0]
    assert schema == "ReadSchema: struct<source:string,status:string,deal_id:string,movement_type:string>"


def test_status_flags_one_aggregate(spark, ledger_path):
    ledger = read_ledger(spark, ledger_path)
    batch = spark.createDataFrame([(1, "5", "WIP")], "seq_id long, deal_id string, status string")
    plan = plan_of(validate_status(batch, ledger))
    # batch keys (partial + final distinct) are broadcast into the ledger scan
    # tasks as a left-semi filter; then one partial + final flag aggregate
    assert plan.count("HashAggregate (") == 4
    assert "BroadcastHashJoin LeftSemi BuildRight" in plan


def test_posting_is_narrow(spark, ledger_path):
    df = post(read_ledger(spark, ledger_path), "insert", "2024-01-01 00:00:00", "u")
    plan = plan_of(df)
    tree = plan.split("\n\n")[0]
    assert "Exchange" not in tree.replace("BroadcastExchange", "")
    assert tree.count("BroadcastHashJoin") == 1  # the fixed rule table, nothing else


def test_source_partitioned_ledger_prunes(spark, tmp_path_factory):
    from ledgerlake.operators.sinks import append_counted
    path = str(tmp_path_factory.mktemp("pledger") / "ledger")
    n = append_counted(adapter(spark, SF, "fx_ledger"), path, partition_by=("source",))
    ledger = read_ledger(spark, path)
    assert ledger.count() == n
    batch = spark.createDataFrame([(1, "Standard", None, "5", "Upfront", "Apply to GL", "1")],
                                  "seq_id long, status string, report_date string, deal_id string, deal_type string, "
                                  "movement_type string, adjustment_amount string")
    for c in ["comments", "ofs_payment_posting", "payment_source", "invoice_number", "other_adjustment",
              "original_invoice_amount", "payment_discount", "payment_applied_to_invoice"]:
        batch = batch.withColumn(c, batch["status"].substr(0, 0))
    plan = plan_of(validate_ns_payment(batch, ledger))
    assert "PartitionFilters: [isnotnull(source" in plan and "(source#" in plan and "= NetSuite)" in plan


def test_deal_bucket_layout_prunes_dynamically(spark, tmp_path_factory):
    from ledgerlake.operators.sinks import append_counted
    from ledgerlake.operators.validate import validate_status
    from ledgerlake.schemas import with_deal_bucket
    path = str(tmp_path_factory.mktemp("bledger") / "ledger")
    flat = adapter(spark, SF, "fx_ledger")
    append_counted(with_deal_bucket(flat), path, partition_by=("deal_bucket",))
    ledger = read_ledger(spark, path)
    batch = spark.createDataFrame([(1, "5", "Standard"), (2, "77", "Closed"), (3, None, "WIP")],
                                  "seq_id long, deal_id string, status string")
    out = validate_status(batch, ledger)
    plan = plan_of(out)
    # only the folders of the batch deals' buckets are read
    line = [x for x in plan.splitlines() if x.startswith("PartitionFilters") and "deal_bucket" in x][0]
    assert "deal_bucket" in line and " IN (" in line
    same = validate_status(batch, flat)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, same.collect()))
