"""Table layouts: the ledger, the receivables master and the staged upload batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

MONEY = T.DecimalType(38, 10)

# ---- fixed values: ledger columns (name, type) in table order ----------------
LEDGER_FIELDS: list[tuple[str, T.DataType]] = [
    ("id", T.LongType()),
    ("source", T.StringType()),
    ("status", T.StringType()),
    ("assign_to", T.StringType()),
    ("exceptional_move_category", T.StringType()),
    ("report_date", T.DateType()),
    ("country__oce_", T.StringType()),
    ("customer_name", T.StringType()),
    ("deal_id", T.StringType()),
    ("ns_estimate_num_", T.StringType()),
    ("spm_om_no", T.StringType()),
    ("invoice_num_", T.StringType()),
    ("adjustment_amt", MONEY),
    ("original_invoice_amount", MONEY),
    ("payment_discount", MONEY),
    ("payment_applied_to_invoice", MONEY),
    ("gl_date_for_adjustment", T.DateType()),
    ("adjustment_type", T.StringType()),
    ("trade_ar", MONEY),
    ("unbilled", MONEY),
    ("ar_ap_netting", MONEY),
    ("ofd_cld_120604", MONEY),
    ("ofd_wh_120804", MONEY),
    ("ofd_whv2_xm232", MONEY),
    ("ofd_whv2_xm297", MONEY),
    ("ofd_cld_14745", MONEY),
    ("ofd_wh_14746", MONEY),
    ("ofd_whv2_19846", MONEY),
    ("ofd_whv2_19848", MONEY),
    ("movement_type", T.StringType()),
    ("comments", T.StringType()),
    ("ofs_payment_posting", T.StringType()),
    ("assignee", T.StringType()),
    ("payment_source", T.StringType()),
    ("deal_type", T.StringType()),
    ("other_adjustment", MONEY),
    ("order_number", T.StringType()),
    ("oce", T.StringType()),
    ("created", T.TimestampType()),
    ("created_by", T.StringType()),
    ("updated", T.TimestampType()),
    ("updated_by", T.StringType()),
    ("change_event_type", T.StringType()),
    ("funding_model", T.StringType()),
]
LEDGER_SCHEMA = T.StructType([T.StructField(n, t, n not in ("id", "deal_id")) for n, t in LEDGER_FIELDS])
LEDGER_COLUMNS = [n for n, _ in LEDGER_FIELDS]

# ---- fixed values: receivables master columns read by the packages ------------
MASTER_FIELDS: list[tuple[str, T.DataType]] = [
    ("deal_id", T.StringType()),
    ("customer_legal_name", T.StringType()),
    ("assignee_current", T.StringType()),
    ("oracle_contract_entity_oce", T.StringType()),
    ("oce_country", T.StringType()),
    ("country", T.StringType()),
    ("complete_part1", T.StringType()),
    ("complete_part2", T.StringType()),
    ("complete_part3", T.StringType()),
    ("complete_part4", T.StringType()),
    ("by_who_part3", T.StringType()),
    ("by_who_part4", T.StringType()),
    ("date_part3", T.DateType()),
    ("date_part4", T.DateType()),
]
MASTER_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in MASTER_FIELDS])

# ---- fixed values: staged batch layouts (c001, c002, ... in order) + error slot ----
BATCH_LAYOUTS: dict[str, tuple[list[str], str]] = {
    "worklist": (["deal_id", "customer_name", "funding_model", "ucm_c_at_c", "oce",
                  "legally_registered_country__oce_", "oracle_invoices__tax_", "event_type",
                  "original_event_date", "last_event_date", "order_number", "invoice_number",
                  "outstanding_amount", "payment_discount", "status", "comments"], "c017"),
    "ns_payment": (["status", "report_date", "deal_id", "deal_type", "movement_type",
                    "adjustment_amount", "comments", "ofs_payment_posting", "payment_source",
                    "invoice_number", "other_adjustment", "original_invoice_amount",
                    "payment_discount", "payment_applied_to_invoice"], "c015"),
    "o_payment": (["status", "report_date", "deal_id", "invoice_num_", "deal_type", "movement_type",
                   "adjustment_amount", "comments", "ofs_payment_posting", "payment_source",
                   "other_adjustment", "original_invoice_amount", "payment_discount",
                   "payment_applied_to_invoice"], "c015"),
    "o_exception": (["status", "report_date", "deal_id", "invoice_num_", "deal_type", "movement_type",
                     "amount", "comments", "gl_date_for_adjustment"], "c010"),
    "status": (["deal_id", "status"], "c003"),
    "patch": (["deal_type", "report_date", "movement_type", "country__oce_", "customer_name",
               "deal_id", "order_number", "invoice_num", "adjustment_amt", "other_adjustment",
               "original_invoice_amount", "payment_discount", "payment_applied_to_invoice",
               "comments", "assignee"], "c016"),
}


# ledger layout: partition folders by a hash bucket of the deal, so look-ups for
# the deals of one batch read only the buckets those deals fall in
DEAL_BUCKETS = 1024


def deal_bucket(col: str = "deal_id", buckets: int = DEAL_BUCKETS):
    """Bucket of a deal id: pmod(xxhash64(deal_id), buckets)."""
    return F.pmod(F.xxhash64(F.col(col)), F.lit(buckets)).cast("int")


def with_deal_bucket(df: DataFrame, buckets: int = DEAL_BUCKETS) -> DataFrame:
    return df.withColumn("deal_bucket", deal_bucket("deal_id", buckets))


def slot(i: int) -> str:
    return f"c{i:03d}"


def conform_ledger(df: DataFrame) -> DataFrame:
    """Add missing ledger columns as typed NULLs, cast present ones, keep table order.

    Extra columns of `df` are kept after the ledger columns.
    """
    present = set(df.columns)
    cols = []
    for name, dtype in LEDGER_FIELDS:
        if name in present:
            cols.append(F.col(name).cast(dtype).alias(name))
        else:
            cols.append(F.lit(None).cast(dtype).alias(name))
    extras = [F.col(c) for c in df.columns if c not in dict(LEDGER_FIELDS)]
    return df.select(*cols, *extras)


def conform_master(df: DataFrame) -> DataFrame:
    present = set(df.columns)
    return df.select(*[(F.col(n).cast(t) if n in present else F.lit(None).cast(t)).alias(n)
                       for n, t in MASTER_FIELDS])
