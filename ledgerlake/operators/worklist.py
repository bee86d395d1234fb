"""B6 - worklist clean-up and Q2 reconciliation.

Invoice lists and amount lists are cleaned, split in step and exploded with
`posexplode` (narrow, no shuffle: every piece keeps its parent's columns);
rows whose lists differ in length go to the exception output whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlake.functions.text import clean_invoice_text, lenient_double, split_pieces

# ---- fixed values ----------------------------------------------------------------
BLANK_FUNDING_MODEL = "OFD Warehouse V2"
RECONCILE_TOLERANCE = 0.5


def _discount(df: DataFrame):
    """pandas to_numeric(errors='coerce') of the discount: text is parsed
    leniently (no comma removal, X16), numbers are kept."""
    c = F.col("payment_discount")
    if dict(df.dtypes).get("payment_discount") == "string":
        return lenient_double(c)
    return c.cast("double")


def _split_blank(df: DataFrame, blank_rule: str):
    blank = F.col("outstanding_amount").isNull()
    if blank_rule == "v6":
        blank = blank | F.coalesce(F.col("funding_model") == BLANK_FUNDING_MODEL, F.lit(False))
    return df.withColumn("_blank", blank)


def clean_worklist(df: DataFrame, blank_rule: str = "v6") -> tuple[DataFrame, DataFrame]:
    """Returns (clean, exceptions).

    clean: one row per invoice piece with `piece_no` (0-based), the amount piece
    as a number (commas removed), the discount on the first piece only; plus the
    blank-amount rows (v6: also funding model 'OFD Warehouse V2') with their
    amount set to NULL (v5: amount coerced to a number). exceptions: rows whose
    invoice and amount lists differ in length, invoice text already cleaned.
    """
    cols = [c for c in df.columns]
    marked = _split_blank(df, blank_rule)
    blank = marked.filter(F.col("_blank"))
    if blank_rule == "v6":
        blank_amount = F.lit(None).cast("double")
    else:
        blank_amount = lenient_double("outstanding_amount")
    discount = _discount(df)
    blank_rows = blank.select(*[blank_amount.alias(c) if c == "outstanding_amount"
                                else (discount.alias(c) if c == "payment_discount" else F.col(c))
                                for c in cols], F.lit(0).alias("piece_no"))
    rest = marked.filter(~F.col("_blank")).withColumn("invoice_number", clean_invoice_text("invoice_number"))
    rest = (rest.withColumn("_amts", split_pieces("outstanding_amount"))
            .withColumn("_invs", split_pieces("invoice_number")))
    same = F.size("_amts") == F.size("_invs")
    exceptions = rest.filter(~same).select(*cols)
    exploded = (rest.filter(same)
                .select("*", F.posexplode(F.arrays_zip(F.col("_amts").alias("a"), F.col("_invs").alias("i")))
                        .alias("piece_no", "_p")))
    out_cols = []
    for c in cols:
        if c == "outstanding_amount":
            out_cols.append(lenient_double(F.col("_p.a"), strip_commas=True).alias(c))
        elif c == "invoice_number":
            out_cols.append(F.col("_p.i").alias(c))
        elif c == "payment_discount":
            out_cols.append(F.when(F.col("piece_no") == 0, discount).alias(c))
        else:
            out_cols.append(F.col(c))
    clean = exploded.select(*out_cols, F.col("piece_no").cast("int").alias("piece_no"))
    return clean.unionByName(blank_rows), exceptions


def reconcile(original: DataFrame, clean: DataFrame, exceptions: DataFrame,
              key: str = "deal_id", amount: str = "payment_discount",
              tolerance: float = RECONCILE_TOLERANCE) -> DataFrame:
    """Q2: one row - distinct key counts (NULL counts as one value, as pandas
    `unique`), key-set equality of original vs clean+exceptions, discount sums
    and whether they agree within `tolerance`.

    The three frames are read as given (frames cut from one source scan it once
    each), stacked with a tag, aggregated per key (map-side combined), then
    summed into the single result row."""
    tags = ("o", "c", "e")

    def part(df: DataFrame, tag: str) -> DataFrame:
        return df.select(F.col(key).alias("k"),
                         *[F.lit(t == tag).alias(f"in_{t}") for t in tags],
                         *[(F.col(amount).cast("double") if t == tag else F.lit(None).cast("double")).alias(f"s_{t}")
                           for t in tags])

    stacked = part(original, "o").unionByName(part(clean, "c")).unionByName(part(exceptions, "e"))
    per_key = stacked.groupBy("k").agg(*[F.bool_or(f"in_{t}").alias(f"in_{t}") for t in tags],
                                       *[F.sum(f"s_{t}").alias(f"s_{t}") for t in tags])
    res = per_key.agg(
        F.count_if("in_o").alias("n_original"),
        F.count_if("in_c").alias("n_clean"),
        F.count_if("in_e").alias("n_exceptions"),
        F.count_if(F.col("in_o") != (F.col("in_c") | F.col("in_e"))).alias("n_key_mismatch"),
        *[F.coalesce(F.sum(f"s_{t}"), F.lit(0.0)).alias(n)
          for t, n in zip(tags, ("sum_original", "sum_clean", "sum_exceptions"))])
    ok = (F.col("n_key_mismatch") == 0) & (
        F.abs(F.col("sum_clean") + F.col("sum_exceptions") - F.col("sum_original")) < tolerance)
    return res.select("n_original", "n_clean", "n_exceptions", "n_key_mismatch",
                      *[F.round(x, 2).alias(x) for x in ("sum_original", "sum_clean", "sum_exceptions")],
                      ok.alias("reconciled"))
