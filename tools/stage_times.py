"""Task-time spread per stage from Spark's event log (no UI involved).

usage: python tools/stage_times.py [rows] [salted|plain]
Runs the status validator on a batch where one deal holds a third of the rows,
once with the hot key salted and once as a plain shuffled join, and prints,
per run, the stage with the slowest task: task count, max and median task ms.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


STAGE_NAMES: dict[int, str] = {}
TASK_ROWS: dict[int, list[tuple[float, int]]] = {}


def stage_spread(log_dir: str) -> list[tuple[int, int, float, float]]:
    tasks: dict[int, list[float]] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or not os.path.basename(path).startswith("events_"):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    STAGE_NAMES[info["Stage ID"]] = " / ".join(
                        sorted({r.get("Scope", "{}") and json.loads(r.get("Scope", "{}")).get("name", "")
                                for r in info.get("RDD Info", [])} - {""}))
                if ev.get("Event") == "SparkListenerTaskEnd":
                    info = ev["Task Info"]
                    ms = info["Finish Time"] - info["Launch Time"]
                    tasks.setdefault(ev["Stage ID"], []).append(ms)
                    read = ev.get("Task Metrics", {}).get("Shuffle Read Metrics", {})
                    recs = read.get("Total Records Read", 0)
                    TASK_ROWS.setdefault(ev["Stage ID"], []).append((ms, recs))
    return [(sid, len(ts), max(ts), statistics.median(ts)) for sid, ts in sorted(tasks.items())]


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    modes = sys.argv[2:] or ["salted", "plain"]
    from pyspark.sql import SparkSession, functions as F
    from ledgerlake import session as S
    from ledgerlake.operators import flags as FL
    from ledgerlake.operators.validate import validate_status
    from ledgerlake.schemas import conform_ledger

    results = {}
    for mode in modes:
        log_dir = tempfile.mkdtemp(prefix=f"events-{mode}-", dir=os.environ.get("SCRATCH", "/tmp"))
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", f"file://{log_dir}")
                 .config("spark.eventLog.compress", "false")
                 .config("spark.sql.shuffle.partitions", "32").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
        S.tune(spark)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")  # force a shuffled join
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keep partitions visible
        FL.MAX_BROADCAST_KEYS = 10
        if mode == "plain":
            FL.salted_join = lambda left, right, keys, how="left", buckets=None: left.join(right, list(keys), how)
        deal = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 100000).cast("string"))
        ledger = conform_ledger(spark.range(rows).select(
            "id", deal.alias("deal_id"), F.when(F.col("id") % 2 == 0, "NetSuite").otherwise("Oracle").alias("source"),
            F.when(F.col("id") % 7 == 0, None).otherwise(F.current_date()).alias("report_date")))
        batch = spark.range(rows).select(F.col("id").alias("seq_id"), deal.alias("deal_id"),
                                         F.lit("Closed").alias("status"))
        validate_status(batch.limit(1000), ledger.limit(1000)).write.format("noop").mode("overwrite").save()  # JIT
        validate_status(batch, ledger).write.format("noop").mode("overwrite").save()
        spark.stop()
        spread = sorted((s for s in stage_spread(log_dir) if s[1] >= 16), key=lambda s: -s[2])[:3]
        results[mode] = spread
        for sid, n, mx, med in spread:
            print(f"{mode:6s} stage {sid:3d}: {n} tasks, max task {mx:.0f} ms, median task {med:.0f} ms"
                  f"  [{STAGE_NAMES.get(sid, '')[:80]}]")
            rows_read = sorted(r for _, r in TASK_ROWS[sid])
            slowest = sorted(TASK_ROWS[sid], reverse=True)[:2]
            print(f"         shuffle rows per task: max {rows_read[-1]}, median {rows_read[len(rows_read) // 2]};"
                  f" slowest tasks (ms, rows): {slowest}")


if __name__ == "__main__":
    main()
