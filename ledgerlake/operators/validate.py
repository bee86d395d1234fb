"""B2 - validation of staged upload batches, six kinds.

Each validator returns the batch with an `error_msg` column (NULL = clean), the
text built exactly as the reference appends it. The per-row look-ups of the
reference become per-deal flags (see `flags`): one aggregate over the union of
the relevant ledger / master / batch rows, then one left join back to the batch.
Ledger rows are filtered before the aggregate so Parquet skips what no check
reads, and only the few columns the checks need are scanned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlake.functions.oracle import is_bad_date, is_bad_number, messages, not_in_guarded
from ledgerlake.operators.flags import KeyScope, any_of

INIT = "Initial movement"

# ---- fixed values: message texts ----------------------------------------------
M_DEAL_NULL = "DEAL_ID cannot be null. "
M_CRITERIA = "DEAL_ID does not meet import criteria. "
M_FM_NULL = "FUNDING_MODEL cannot be null. "
M_FM_BAD = "Invalid FUNDING_MODEL value. "
M_DUP_FOUND = "Duplicate entries found. "
M_UPFRONT = "Please use Worklist Upload for Upfront deals. "
M_NON_V2 = "Please use Worklist Upload for Non-Warehouse V2 deals. "
M_NO_INIT = "DEAL_ID with Initial movement does not exist."
M_NOT_MOVED = "Not all balance of DEAL_ID is moved. "
M_COMBO = "Invalid combination of DEAL_TYPE and MOVEMENT_TYPE."
M_RD_NULL = 'Report date cannot be null for deals with STATUS as "Standard". '
M_STATUS = "Invalid STATUS value. "
M_RD_FMT = "Report date invalid format. "
M_DEAL_TYPE = "Invalid DEAL_TYPE value. "
M_MOVEMENT = "Invalid MOVEMENT_TYPE value. "
M_OFS = "Invalid OFS_PAYMENT_POSTING value. Please provide 'Yes' or 'No'. "
M_PAY_SRC = "Invalid PAYMENT_SOURCE value. "
M_DUP = "Duplicate entries. "
M_GL_NULL = 'GL_DATE_FOR_ADJUSTMENT cannot be null for MOVEMENT_TYPE as "7.05 Auto Reversal". '
M_GL_FMT = "GL_DATE_FOR_ADJUSTMENT invalid format. "
M_NOT_IN_DB = "DEAL_ID does not exist in Database. "
M_STATUS_NULL = "Status cannot be null. "
M_STATUS_NS = "Invalid STATUS value for NetSuite deal. "
M_STATUS_ORA = "Invalid STATUS value for Oracle deal. "
M_NO_RECORD = "Record does not exist in Database. "
M_PATCH_MOVEMENT = 'Invalid MOVEMENT_TYPE value; it should only be "Initial movement" '


def m_invalid(column: str) -> str:
    return f"Invalid {column} value. "


def m_null(column: str) -> str:
    return f"{column} cannot be null. "


# ---- fixed values: allowed values ------------------------------------------------
FUNDING_MODELS = ["OFD Cloud Receivables", "OFD Warehouse", "Funded Admin", "OFD Warehouse V2"]
NS_STATUSES = ["Standard", "WIP", "Change Event", "Further Checking"]
ORA_PAY_STATUSES = ["Standard", "WIP", "Change Event", "Further Checking", "Exceptional move"]
ORA_EXC_STATUSES = ["Standard", "Change Event", "Further Checking", "Exceptional move"]
NS_DEAL_TYPES = ["Upfront", "Warehouse V2"]
NS_MOVEMENTS = ["Initial movement", "Apply to GL", "Move AR to GL", "Move AR from GL",
                "Payment JE reclass", "Initial setup WHv2"]
ORA_DEAL_TYPES = ["Upfront billing / 7.05 Standard", "7.05 Exception", "7.05 Exception - Indirect", "Warehouse V2"]
ORA_MOVEMENTS = ["Initial movement", "Payment application", "Move AR to GL", "Move AR from GL",
                 "Adjustment", "Initial setup WHv2"]
EXC_DEAL_TYPES = ["7.05 Exception", "7.05 Exception - Indirect"]
EXC_MOVEMENTS = ["Initial movement", "7.05 Auto Reversal", "Adjustment"]
OFS_VALUES = ["Yes", "No"]
NS_PAYMENT_SOURCES = ["Monthly pass-thru", "INTL instruction file", "Payment posting request", "Email"]
ORA_PAYMENT_SOURCES = ["Monthly pass-thru", "Payment posting request", "Email"]
STATUS_NS_OK = ["WIP", "Standard", "Change Event", "Further Checking"]
STATUS_ORA_OK = ["WIP", "Standard", "Change Event", "Further Checking", "Exceptional move"]
PATCH_DEAL_TYPES = ["Upfront billing / 7.05 Standard", "7.05 Exception", "7.05 Exception - Indirect",
                    "Warehouse V2", "Upfront"]
NS_BAD_COMBO_MOVEMENTS = ["Initial setup WHv2", "Payment JE reclass"]
# Oracle combination rule; note the lower-case 'v2' in the last arm is as written
ORA_COMBO_RULES: list[tuple[list[str], list[str]]] = [
    (["Upfront billing / 7.05 Standard"], ["Initial setup WHv2", "7.05 Auto Reversal"]),
    (["7.05 Exception", "7.05 Exception - Indirect"], ["Initial setup WHv2", "Move AR to GL", "Move AR from GL"]),
    (["Warehouse v2"], ["7.05 Auto Reversal"]),
]
AMOUNT_CHECKS = ["other_adjustment", "original_invoice_amount", "payment_discount", "payment_applied_to_invoice"]

_BOOL = T.BooleanType()


def _c(name: str) -> Column:
    return F.col(name)


def master_eligible(master: DataFrame) -> Column:
    """Parts 1 and 2 complete, nothing recorded for parts 3 and 4."""
    return ((_c("complete_part1") == "Y") & (_c("complete_part2") == "Y")
            & _c("complete_part3").isNull() & _c("by_who_part3").isNull() & _c("date_part3").isNull()
            & _c("complete_part4").isNull() & _c("by_who_part4").isNull() & _c("date_part4").isNull())


def _ora_combo() -> Column:
    cond = F.lit(False)
    for deal_types, movements in ORA_COMBO_RULES:
        cond = cond | (_c("deal_type").isin(deal_types) & _c("movement_type").isin(movements))
    return cond


def _amount_checks(columns: list[str]) -> list[tuple[Column, str]]:
    return [(is_bad_number(c), m_invalid(c.upper())) for c in columns]


def _required_number(column: str, label: str) -> list[tuple[Column, str]]:
    return [(_c(column).isNull(), m_null(label)), (is_bad_number(column), m_invalid(label))]


def _part(df: DataFrame, names: list[str], **cols: Column) -> DataFrame:
    """Project one input of the flag union onto the common flag columns."""
    out = [F.col("deal_id")]
    for n in names:
        c = cols.get(n)
        out.append((c if c is not None else F.lit(None)).cast("long" if n.endswith("_seq") else _BOOL).alias(n))
    return df.select(*out)


def _deal_flags(parts: list[DataFrame], names: list[str]) -> DataFrame:
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    aggs = [F.min(n).alias(n) if n.endswith("_seq") else any_of(F.col(n)).alias(n) for n in names]
    return union.groupBy("deal_id").agg(*aggs)


def _finish(batch_cols: list[str], df: DataFrame, msg: Column) -> DataFrame:
    return df.select(*[F.col(c) for c in batch_cols], msg.alias("error_msg"))


# ------------------------------------------------------------------ worklist ----
def validate_worklist(batch: DataFrame, ledger: DataFrame, master: DataFrame) -> DataFrame:
    """V1-V5. The master's assignee for a deal is its smallest non-NULL one
    (the reference takes an arbitrary first row)."""
    scope = KeyScope(batch, ["deal_id"])
    master, ledger = scope.restrict(master), scope.restrict(ledger)
    m = (master.groupBy("deal_id")
         .agg(any_of(master_eligible(master)).alias("m_eligible"),
              F.min("assignee_current").alias("m_assignee")))
    # deals whose ledger holds an initial row under the master's assignee: the
    # distinct (deal, assignee) pairs stream past the per-deal master summary
    mk = m.select(F.col("deal_id").alias("p_deal"), F.col("m_assignee").alias("p_assignee"))
    pairs = (ledger.filter((_c("movement_type") == INIT) & _c("assignee").isNotNull())
             .select(F.col("deal_id").alias("p_deal"), F.col("assignee").alias("p_assignee"))
             .dropDuplicates(["p_deal", "p_assignee"]))
    dup = (pairs.join(F.broadcast(mk) if scope.small else mk, ["p_deal", "p_assignee"], "left_semi")
           .select(F.col("p_deal").alias("deal_id")).distinct().withColumn("m_dup", F.lit(True)))
    m = m.join(dup, "deal_id", "left")
    if scope.small:
        # at most one row per batch deal (proven by the scope's count): broadcast
        # it so the batch is never shuffled for this look-up
        m = F.broadcast(m)
    b = scope.attach(batch, m, ["deal_id"], defaults={"m_assignee": None})
    deal, fm = _c("deal_id"), _c("funding_model")
    msg = messages(
        (deal.isNull(), M_DEAL_NULL),
        (deal.isNotNull() & ~_c("m_eligible"), M_CRITERIA),
        (fm.isNull(), M_FM_NULL),
        (not_in_guarded(fm, FUNDING_MODELS), M_FM_BAD),
        (deal.isNotNull() & ((fm != "OFD Warehouse V2") | fm.isNull()) & _c("m_dup"), M_DUP_FOUND),
    )
    return _finish(batch.columns, b, msg)


# ---------------------------------------------------------- NetSuite payment ----
def _ns_local() -> list[tuple[Column, str]]:
    dt, mv, st = _c("deal_type"), _c("movement_type"), _c("status")
    return [
        ((dt == "Upfront") & mv.isin(NS_BAD_COMBO_MOVEMENTS), M_COMBO),
        ((st == "Standard") & _c("report_date").isNull(), M_RD_NULL),
        (not_in_guarded(st, NS_STATUSES), M_STATUS),
        (is_bad_date("report_date"), M_RD_FMT),
        (not_in_guarded(dt, NS_DEAL_TYPES), M_DEAL_TYPE),
        (not_in_guarded(mv, NS_MOVEMENTS), M_MOVEMENT),
        *_required_number("adjustment_amount", "ADJUSTMENT_AMOUNT"),
        *_amount_checks(AMOUNT_CHECKS),
        (not_in_guarded("ofs_payment_posting", OFS_VALUES), M_OFS),
        (not_in_guarded("payment_source", NS_PAYMENT_SOURCES), M_PAY_SRC),
    ]


def validate_ns_payment(batch: DataFrame, ledger: DataFrame) -> DataFrame:
    """V6-V22. The "not all balance moved" check also reads the error slot of
    initial rows validated earlier in the same loop: an initial row with a
    smaller seq_id that failed. That is a per-deal MIN(seq_id) of failing
    initial rows, compared with the row's own seq_id."""
    deal, dt, mv = _c("deal_id"), _c("deal_type"), _c("movement_type")
    has_deal = deal.isNotNull()
    v6 = has_deal & (mv == INIT) & (dt == "Upfront")
    local = _ns_local()
    init_err = F.coalesce(v6, F.lit(False))
    for cond, _ in local:
        init_err = init_err | F.coalesce(cond, F.lit(False))
    names = ["l_init", "l_init_nonstd", "b_init", "b_init_bad", "b_init_err_seq"]
    scope = KeyScope(batch, ["deal_id"])
    ledger = scope.restrict(ledger.filter((_c("movement_type") == INIT) & (_c("source") == "NetSuite")))
    ledger_part = _part(ledger, names,
                        l_init=F.lit(True), l_init_nonstd=_c("status") != "Standard")
    batch_part = _part(batch.filter(has_deal & (mv == INIT)), names,
                       b_init=F.lit(True),
                       b_init_bad=(_c("status") != "Standard") | _c("report_date").isNull(),
                       b_init_err_seq=F.when(init_err, _c("seq_id")))
    flags = _deal_flags([ledger_part, batch_part], names)
    b = scope.attach(batch, flags, ["deal_id"], defaults={"b_init_err_seq": None})
    earlier_err = F.coalesce(_c("b_init_err_seq") < _c("seq_id"), F.lit(False))
    msg = messages(
        (v6, M_UPFRONT),
        (has_deal & (dt != "Warehouse V2") & (mv != INIT) & ~(_c("l_init") | _c("b_init")), M_NO_INIT),
        (has_deal & (mv != INIT) & (dt != "Warehouse V2")
         & (_c("l_init_nonstd") | _c("b_init_bad") | earlier_err), M_NOT_MOVED),
        (deal.isNull(), M_DEAL_NULL),
        *local,
    )
    return _finish(batch.columns, b, msg)


# ------------------------------------------------------------ Oracle payment ----
def validate_o_payment(batch: DataFrame, ledger: DataFrame) -> DataFrame:
    """V23-V36. A NULL status skips the deal checks (`STATUS <> 'Exceptional
    move'` is UNKNOWN); the four amount checks run twice, as in the reference."""
    deal, dt, mv, st = _c("deal_id"), _c("deal_type"), _c("movement_type"), _c("status")
    guard = deal.isNotNull() & (st != "Exceptional move")
    names = ["l_init", "l_init_nonstd", "b_init", "b_init_bad"]
    scope = KeyScope(batch, ["deal_id"])
    ledger = scope.restrict(ledger.filter((_c("movement_type") == INIT) & (_c("source") == "Oracle")))
    ledger_part = _part(ledger, names,
                        l_init=F.lit(True), l_init_nonstd=_c("status") != "Standard")
    batch_part = _part(batch.filter(deal.isNotNull() & (mv == INIT)), names,
                       b_init=F.lit(True), b_init_bad=(st != "Standard") | _c("report_date").isNull())
    flags = _deal_flags([ledger_part, batch_part], names)
    b = scope.attach(batch, flags, ["deal_id"])
    msg = messages(
        (guard & (mv == INIT) & (dt != "Warehouse V2"), M_NON_V2),
        (guard & (dt != "Warehouse V2") & (mv != INIT) & ~(_c("l_init") | _c("b_init")), M_NO_INIT),
        (guard & (mv != INIT) & (dt != "Warehouse V2") & (_c("l_init_nonstd") | _c("b_init_bad")), M_NOT_MOVED),
        (deal.isNull(), M_DEAL_NULL),
        ((st == "Standard") & _c("report_date").isNull(), M_RD_NULL),
        (_ora_combo(), M_COMBO),
        (not_in_guarded(st, ORA_PAY_STATUSES), M_STATUS),
        (is_bad_date("report_date"), M_RD_FMT),
        (not_in_guarded(dt, ORA_DEAL_TYPES), M_DEAL_TYPE),
        (not_in_guarded(mv, ORA_MOVEMENTS), M_MOVEMENT),
        *_required_number("adjustment_amount", "ADJUSTMENT_AMOUNT"),
        *_amount_checks(AMOUNT_CHECKS),
        *_amount_checks(AMOUNT_CHECKS),
        (not_in_guarded("ofs_payment_posting", OFS_VALUES), M_OFS),
        (not_in_guarded("payment_source", ORA_PAYMENT_SOURCES), M_PAY_SRC),
    )
    return _finish(batch.columns, b, msg)


# ---------------------------------------------------------- Oracle exception ----
def validate_o_exception(batch: DataFrame, ledger: DataFrame, master: DataFrame) -> DataFrame:
    """V37-V49. 'WIP' is reported twice, as in the reference."""
    deal, dt, mv, st = _c("deal_id"), _c("deal_type"), _c("movement_type"), _c("status")
    has_deal = deal.isNotNull()
    names = ["m_eligible", "l_any_init", "l_ora_init", "b_init"]
    scope = KeyScope(batch, ["deal_id"])
    master_part = _part(scope.restrict(master.filter(master_eligible(master))), names, m_eligible=F.lit(True))
    ledger_part = _part(scope.restrict(ledger.filter(_c("movement_type") == INIT)), names,
                        l_any_init=F.lit(True), l_ora_init=_c("source") == "Oracle")
    batch_part = _part(batch.filter(has_deal & (mv == INIT)), names, b_init=F.lit(True))
    flags = _deal_flags([master_part, ledger_part, batch_part], names)
    b = scope.attach(batch, flags, ["deal_id"])
    bad_status = not_in_guarded(st, ORA_EXC_STATUSES)
    msg = messages(
        (has_deal & (mv == INIT) & ~_c("m_eligible"), M_CRITERIA),
        (has_deal & (mv == INIT) & _c("l_any_init"), M_DUP),
        (has_deal & (mv != INIT) & ~(_c("l_ora_init") | _c("b_init")), M_NO_INIT),
        (deal.isNull(), M_DEAL_NULL),
        ((st == "Standard") & _c("report_date").isNull(), M_RD_NULL),
        ((mv == "7.05 Auto Reversal") & _c("gl_date_for_adjustment").isNull(), M_GL_NULL),
        (_ora_combo(), M_COMBO),
        (bad_status, M_STATUS),
        (bad_status & (st == "WIP"), M_STATUS),
        (is_bad_date("report_date"), M_RD_FMT),
        (not_in_guarded(dt, EXC_DEAL_TYPES), M_DEAL_TYPE),
        (not_in_guarded(mv, EXC_MOVEMENTS), M_MOVEMENT),
        *_required_number("amount", "AMOUNT"),
        (is_bad_date("gl_date_for_adjustment"), M_GL_FMT),
    )
    return _finish(batch.columns, b, msg)


# ------------------------------------------------------------- status update ----
def validate_status(batch: DataFrame, ledger: DataFrame) -> DataFrame:
    """V50-V55. Later checks replace the text, so the last firing one wins."""
    scope = KeyScope(batch, ["deal_id"])
    flags = (scope.restrict(ledger).groupBy("deal_id")
             .agg(F.lit(True).alias("l_exists"),
                  any_of(_c("source") == "NetSuite").alias("l_ns"),
                  any_of(_c("source") == "Oracle").alias("l_ora"),
                  any_of(_c("report_date").isNull()).alias("l_null_rd")))
    b = scope.attach(batch, flags, ["deal_id"])
    deal, st = _c("deal_id"), _c("status")
    base = messages((deal.isNull(), M_DEAL_NULL), (deal.isNotNull() & ~_c("l_exists"), M_NOT_IN_DB))
    msg = (F.when((st == "Standard") & _c("l_null_rd"), F.lit(M_RD_NULL))
           .when(st.isNotNull() & _c("l_ora") & ~st.isin(STATUS_ORA_OK), F.lit(M_STATUS_ORA))
           .when(st.isNotNull() & _c("l_ns") & ~st.isin(STATUS_NS_OK), F.lit(M_STATUS_NS))
           .otherwise(messages(base, (st.isNull(), M_STATUS_NULL))))
    return _finish(batch.columns, b, msg)


# --------------------------------------------------------------------- patch ----
def validate_patch(batch: DataFrame, ledger: DataFrame) -> DataFrame:
    """V56-V64. The record must exist under (deal, invoice, movement)."""
    key_cols = ["deal_id", "invoice_num", "movement_type"]
    scope = KeyScope(batch, key_cols)
    keys = (scope.restrict(ledger, {"invoice_num": "invoice_num_"})
            .select("deal_id", F.col("invoice_num_").alias("invoice_num"), "movement_type")
            .dropna().dropDuplicates(key_cols).withColumn("k_exists", F.lit(True)))
    b = scope.attach(batch, keys, key_cols)
    deal, mv = _c("deal_id"), _c("movement_type")
    msg = messages(
        (deal.isNull(), M_DEAL_NULL),
        (deal.isNotNull() & ~_c("k_exists"), M_NO_RECORD),
        (is_bad_date("report_date"), M_RD_FMT),
        (not_in_guarded("deal_type", PATCH_DEAL_TYPES), M_DEAL_TYPE),
        (mv.isNotNull() & (mv != INIT), M_PATCH_MOVEMENT),
        *_amount_checks(AMOUNT_CHECKS),
    )
    return _finish(batch.columns, b, msg)


VALIDATORS = {
    "worklist": validate_worklist,
    "ns_payment": validate_ns_payment,
    "o_payment": validate_o_payment,
    "o_exception": validate_o_exception,
    "status": validate_status,
    "patch": validate_patch,
}
