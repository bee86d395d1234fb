"""Q1 constraint-violation report, Q3 round-trip row-count check, master key check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# ---- fixed values: the ledger's declared CHECK constraints (all disabled) ------
# A CHECK passes on TRUE or UNKNOWN, so a row violates it only when it is FALSE.
def _checks() -> list[tuple[str, Column]]:
    c = F.col
    src, st, dt, mv = c("source"), c("status"), c("deal_type"), c("movement_type")
    return [
        ("CHK_SOURCE_STATUS", ~((src == "NetSuite") & (st == "Exceptional move"))),
        ("OMOVEDEALCOMBINATION",
         ((dt == "Upfront billing / 7.05 Standard") & ~mv.isin("7.05 Auto Reversal"))
         | (((dt == "7.05 Exception") | (dt == "7.05 Exception - Indirect")) & ~mv.isin("Move AR to GL", "Move AR from GL"))
         | ((src == "Oracle") & (dt == "Warehouse V2") & ~mv.isin("7.05 Auto Reversal"))),
        ("REPORT_DATE_MANDATORY", (st != "Standard") | ((st == "Standard") & c("report_date").isNotNull())),
        ("NSMOVEDEALCOMBINATION",
         (src == "NetSuite") & (dt == "Upfront") & ~mv.isin("Initial setup WHv2", "Payment JE reclass")),
    ]


def constraint_report(ledger: DataFrame) -> DataFrame:
    """One row per constraint: (constraint_name, violations). All counts come
    from one pass over the ledger plus one aggregate on `id` for the key."""
    checks = _checks()
    counts = ledger.agg(
        *[F.count_if(F.coalesce(pred == F.lit(False), F.lit(False))).alias(name) for name, pred in checks],
        F.count_if(F.col("deal_id").isNull()).alias("DEAL_ID_NOT_NULL"),
        F.count_if(F.col("id").isNull()).alias("_null_ids"))
    dup_ids = (ledger.filter(F.col("id").isNotNull()).groupBy("id").count()
               .agg(F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count"))), F.lit(0)).alias("_dup_ids")))
    names = [n for n, _ in checks] + ["DEAL_ID_NOT_NULL"]
    both = counts.withColumn("_j", F.lit(1)).join(dup_ids.withColumn("_j", F.lit(1)), "_j")
    pk = (F.col("_null_ids") + F.col("_dup_ids")).cast("long")
    pairs = [F.struct(F.lit(n).alias("constraint_name"), F.col(n).cast("long").alias("violations")) for n in names]
    pairs.append(F.struct(F.lit("PK_ID").alias("constraint_name"), pk.alias("violations")))
    return both.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")


def violations(ledger: DataFrame, name: str) -> DataFrame:
    """The violating rows of one constraint."""
    pred = dict(_checks())[name]
    return ledger.filter(pred == F.lit(False))


def master_key_check(master: DataFrame) -> DataFrame:
    """Deals with more than one master row (the reference aborts a batch with
    TOO_MANY_ROWS on them)."""
    return master.groupBy("deal_id").count().filter(F.col("count") > 1).withColumnRenamed("count", "n_rows")


def row_count_check(source: DataFrame, path: str, header: bool = True) -> DataFrame:
    """Q3/K9: write `source` as CSV, read it back, compare row counts.
    Returns one row (source_rows, written_rows, ok)."""
    from ledgerlake.operators.sinks import read_csv, to_csv
    to_csv(source, path, header=header)
    back = read_csv(source.sparkSession, path, header=header)
    both = source.select(F.lit(0).alias("_written")).unionAll(back.select(F.lit(1).alias("_written")))
    return both.agg(F.count_if(F.col("_written") == 0).alias("source_rows"), F.count_if(F.col("_written") == 1).alias("written_rows")) \
        .withColumn("ok", F.col("source_rows") == F.col("written_rows"))
