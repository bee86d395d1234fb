"""R1 - post newly arriving ledger rows incrementally.

Posting is row-local, so the batch function runs unchanged on a stream; no
state, no watermark. Each micro-batch is appended through the file sink, whose
checkpointed commit log gives exactly-once output across restarts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.posting import post
from ledgerlake.schemas import LEDGER_SCHEMA


def post_stream(stream: DataFrame, as_of_ts=None, user: str | None = None) -> DataFrame:
    """Streaming DataFrame of posted rows (audit stamp = trigger time when
    `as_of_ts` is None)."""
    return post(stream, "insert", as_of_ts, user)


def start_posting_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                         user: str | None = None, as_of_ts=None, once: bool = True,
                         partition_by: tuple[str, ...] = ()):
    """Read new Parquet files of unposted rows from `source_dir`, post them and
    append them to `sink_dir` (optionally in the ledger's partitioned layout,
    e.g. ("deal_bucket",)). `checkpoint` must be a shared folder."""
    src = spark.readStream.schema(LEDGER_SCHEMA).parquet(source_dir)
    posted = post_stream(src, as_of_ts, user)
    if "deal_bucket" in partition_by:
        from ledgerlake.schemas import with_deal_bucket
        # few files per bucket and micro-batch; a hot bucket is spread over several tasks
        posted = with_deal_bucket(posted).repartition("deal_bucket", F.pmod(F.xxhash64("id"), F.lit(8)))
    q = (posted.writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if partition_by:
        q = q.partitionBy(*partition_by)
    q = q.trigger(availableNow=True) if once else q.trigger(processingTime="1 minute")
    return q.start(sink_dir)
