"""Dense row numbers in a total order without a single-partition window.

`Window.orderBy(...)` with no partition moves every row to one task. Here the
rows are range-sorted (many tasks), each sorted partition counts its rows, the
tiny per-partition count table gets running offsets, and each row adds its
offset to its index inside the partition - the DataFrame form of zipWithIndex.
The numbered rows are checkpointed into the shared checkpoint folder so a lost
executor cannot renumber a partition differently on recompute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlake.session import cut_lineage


def with_row_number(df: DataFrame, order: Sequence[str | Column], name: str = "row_no",
                    total: str | None = None) -> DataFrame:
    """Add `name` = 1..n in `order` (make the order total for a stable result).
    With `total`, also add the row count n as that column."""
    # a content hash after the order keys spreads many equal keys over several
    # range partitions (ties would otherwise all land in one task)
    tiebreak = F.xxhash64(*[F.col(c) for c in df.columns])
    staged = (df.sort(*order, tiebreak)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    staged = cut_lineage(staged)
    counts = staged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    if total is not None:
        offsets = offsets.withColumn(total, F.sum("_cnt").over(Window.partitionBy(F.lit(0))))
    # at most one row per input partition: a bounded broadcast
    out = staged.join(F.broadcast(offsets.drop("_cnt")), "_pid")
    idx = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return out.withColumn(name, F.col("_off") + idx + 1).drop("_pid", "_mid", "_off")
