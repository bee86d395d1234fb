"""The posting projection on a stream, exactly once into a file sink."""
import os
from decimal import Decimal

from ledgerlake.schemas import LEDGER_SCHEMA
from ledgerlake.streaming import start_posting_stream


def test_posting_stream(spark, tmp_dir):
    src, sink, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    rows = [{**{f.name: None for f in LEDGER_SCHEMA.fields}, "id": 1, "deal_id": "d", "source": "Oracle",
             "movement_type": "Initial movement", "deal_type": "Warehouse V2", "assignee": "x",
             "original_invoice_amount": Decimal("50")}]
    spark.createDataFrame(rows, LEDGER_SCHEMA).write.parquet(os.path.join(src, "part1"))
    q = start_posting_stream(spark, os.path.join(src, "*"), sink, ckpt, user="stream", as_of_ts="2024-01-01 09:09:09")
    q.awaitTermination(120)
    out = spark.read.parquet(sink).collect()
    assert len(out) == 1
    r = out[0]
    assert r["adjustment_amt"] == Decimal("50") and r["trade_ar"] == Decimal("-50") and r["ofd_whv2_xm297"] == Decimal("50")
    # rerun: nothing new arrives, nothing is written twice
    q = start_posting_stream(spark, os.path.join(src, "*"), sink, ckpt, user="stream", as_of_ts="2024-01-01 09:09:09")
    q.awaitTermination(120)
    assert spark.read.parquet(sink).count() == 1


def test_posting_stream_partitioned(spark, tmp_dir):
    src, sink, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    rows = [{**{f.name: None for f in LEDGER_SCHEMA.fields}, "id": i, "deal_id": f"d{i}", "source": "NetSuite",
             "movement_type": "Initial movement", "deal_type": "Upfront", "assignee": "cloud",
             "original_invoice_amount": Decimal("10")} for i in range(5)]
    spark.createDataFrame(rows, LEDGER_SCHEMA).write.parquet(os.path.join(src, "p"))
    q = start_posting_stream(spark, os.path.join(src, "*"), sink, ckpt, user="s", as_of_ts="2024-01-01 00:00:00",
                             partition_by=("deal_bucket",))
    q.awaitTermination(120)
    out = spark.read.parquet(sink)
    assert out.count() == 5 and "deal_bucket" in out.columns
    assert out.filter("trade_ar = -10 AND ofd_cld_14745 = 10").count() == 5
