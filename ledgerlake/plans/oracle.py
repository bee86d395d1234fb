"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark operators: look-ups are correlated EXISTS
sub-queries as in the reference, posting joins a VALUES rule table, the
worklist split uses list functions. Rules, texts and allowed values are its own
(`expected`). Inputs are the same adapters (`duck`).
"""

from __future__ import annotations

from ledgerlake.plans import expected as E
from ledgerlake.plans import queries as Q
from ledgerlake.plans.adapters import duck


def s(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def inlist(values) -> str:
    return "(" + ", ".join(s(v) for v in values) + ")"


def nin(col: str, values) -> str:
    return f"({col} IS NOT NULL AND {col} NOT IN {inlist(values)})"


def num(col: str) -> str:
    return f"TRY_CAST({col} AS DECIMAL(38,10))"


def badnum(col: str) -> str:
    return f"({col} IS NOT NULL AND {num(col)} IS NULL)"


# fixed values: the three accepted date patterns
ISO = r"'^\d{4}-\d{2}-\d{2}$'"
DMY = r"'^\d{2}-[A-Za-z]{3}-\d{4}$'"
MDY = r"'^\d{2}/\d{2}/\d{4}$'"


def pdate(col: str) -> str:
    return (f"(CASE WHEN regexp_matches({col}, {ISO}) THEN CAST(try_strptime({col}, '%Y-%m-%d') AS DATE) "
            f"WHEN regexp_matches({col}, {DMY}) THEN CAST(try_strptime({col}, '%d-%b-%Y') AS DATE) "
            f"WHEN regexp_matches({col}, {MDY}) THEN CAST(try_strptime({col}, '%m/%d/%Y') AS DATE) END)")


def baddate(col: str) -> str:
    return f"({col} IS NOT NULL AND {pdate(col)} IS NULL)"


def msgs(*parts: tuple[str, str]) -> str:
    return "NULLIF(CONCAT_WS('', " + ", ".join(f"CASE WHEN {c} THEN {s(t)} END" for c, t in parts) + "), '')"


INIT = s("Initial movement")
MONEY = "DECIMAL(38,10)"
NULLM = f"CAST(NULL AS {MONEY})"
TS = s(Q.POST_TS[:16] + ":00")
USER = s(Q.USER)

# ------------------------------------------------------------------ adapters ----
LEDGER_FULL = (f"SELECT *, CAST(NULL AS VARCHAR) AS adjustment_type, "
               + ", ".join(f"{NULLM} AS {a}" for a in E.ALL_ACCOUNTS)
               + ", CAST(NULL AS VARCHAR) AS comments, CAST(NULL AS TIMESTAMP) AS created, "
                 "CAST(NULL AS VARCHAR) AS created_by, CAST(NULL AS TIMESTAMP) AS updated, "
                 "CAST(NULL AS VARCHAR) AS updated_by FROM (" + duck("fx_ledger") + ") z")


def batch_sql(kind: str) -> str:
    if kind in Q.KIND_ADAPTER:
        return duck(Q.KIND_ADAPTER[kind])
    cols = ", ".join(f"{src} AS {name}" for name, src in Q.KIND_COLUMNS[kind].items())
    return f"SELECT seq_id, {cols} FROM ({duck('fx_batch')}) x"


# ------------------------------------------------------------------- posting ----
def post_sql(src: str, op: str = "insert") -> str:
    """Trigger as SQL over `src` (a SELECT with ledger columns)."""
    derive = (f"movement_type = {INIT} AND (source = 'NetSuite' OR (source = 'Oracle' AND deal_type IN "
              f"{inlist(E.DERIVE_ORACLE_DEAL_TYPES)}))")
    calc = " - ".join(f"COALESCE({c}, 0)" for c in E.INPUTS)
    lock_all, lock_three = [], []
    for source, movements, deal_types, what in E.LOCKS:
        cond = f"(source = {s(source)} AND movement_type IN {inlist(movements)}"
        cond += f" AND deal_type IN {inlist(deal_types)})" if deal_types else ")"
        (lock_all if what == "all" else lock_three).append(cond)
    rule_case = "CASE " + " ".join(
        f"WHEN source = {s(src_)} AND movement_type = {s(mv)} AND deal_type = {s(dt)}"
        + (f" AND COALESCE(contains(upper(assignee), {s(holds)}), FALSE)" if holds else "")
        + f" THEN {rid}"
        for rid, src_, mv, dt, holds, *_ in E.RULES) + " END"
    # rule table: sign per account (+1, -1, 0 = set NULL, NULL = not this family)
    rows = []
    for rid, src_, _mv, _dt, _h, atype, plus, minus, effect in E.RULES:
        fam = E.NS_ACCOUNTS if src_ == E.NS else E.ORA_ACCOUNTS
        signs = []
        for a in E.ALL_ACCOUNTS:
            if a in plus:
                signs.append("1")
            elif a in minus:
                signs.append("-1")
            elif a in fam:
                signs.append("0")
            else:
                signs.append("NULL")
        paid_mode = {"apply": "1", "paid": "1", "null4": "0", "nullpaid": "0"}.get(effect, "NULL")
        null3 = "TRUE" if effect in ("apply", "null4") else "FALSE"
        rows.append(f"({rid}, {s(atype)}, {', '.join(signs)}, {paid_mode}, {null3})")
    rt_cols = "rt_rule, rt_type, " + ", ".join(f"rt_{a}" for a in E.ALL_ACCOUNTS) + ", rt_paid, rt_null3"
    if op == "insert":
        stamp = f"CAST({TS} AS TIMESTAMP) AS created, {USER} AS created_by, CAST(NULL AS TIMESTAMP) AS updated, CAST(NULL AS VARCHAR) AS updated_by"
    else:
        stamp = f"created, created_by, CAST({TS} AS TIMESTAMP) AS updated, {USER} AS updated_by"
    acct = ", ".join(
        f"CASE WHEN rt_rule IS NULL OR rt_{a} IS NULL THEN {a} ELSE CAST(amt * NULLIF(rt_{a}, 0) AS {MONEY}) END AS {a}"
        for a in E.ALL_ACCOUNTS)
    return f"""
WITH s0 AS ({src}),
s1 AS (SELECT * EXCLUDE (created, created_by, updated, updated_by), {stamp},
   CAST(CASE WHEN {derive} THEN {calc} ELSE adjustment_amt END AS {MONEY}) AS amt,
   COALESCE({' OR '.join(lock_all)}, FALSE) AS lock_all,
   COALESCE({' OR '.join(lock_three)}, FALSE) AS lock_three FROM s0),
s2 AS (SELECT *, {rule_case} AS posting_rule FROM s1),
rt({rt_cols}) AS (VALUES {', '.join(rows)}),
s3 AS (SELECT * FROM s2 LEFT JOIN rt ON s2.posting_rule = rt.rt_rule)
SELECT * EXCLUDE (amt, lock_all, lock_three, {rt_cols}, adjustment_amt, adjustment_type,
                  payment_applied_to_invoice, original_invoice_amount, payment_discount, other_adjustment,
                  {', '.join(E.ALL_ACCOUNTS)}),
  amt AS adjustment_amt,
  COALESCE(rt_type, adjustment_type) AS adjustment_type,
  CASE WHEN rt_paid = 1 THEN amt WHEN rt_paid = 0 THEN NULL WHEN lock_all THEN NULL
       ELSE payment_applied_to_invoice END AS payment_applied_to_invoice,
  CASE WHEN rt_null3 OR lock_all OR lock_three THEN NULL ELSE original_invoice_amount END AS original_invoice_amount,
  CASE WHEN rt_null3 OR lock_all OR lock_three THEN NULL ELSE payment_discount END AS payment_discount,
  CASE WHEN rt_null3 OR lock_all OR lock_three THEN NULL ELSE other_adjustment END AS other_adjustment,
  {acct}
FROM s3"""


def show(cols, decimals=(), dates=()) -> str:
    out = []
    for c in cols:
        if c in decimals:
            out.append(f"CAST({c} AS DOUBLE) AS {c}")
        elif c in dates:
            out.append(f"CAST({c} AS VARCHAR) AS {c}")
        else:
            out.append(c)
    return ", ".join(out)


MONEY_COLS = {"adjustment_amt", "original_invoice_amount", "payment_discount", "payment_applied_to_invoice",
              "other_adjustment", *E.ALL_ACCOUNTS}
DATE_COLS = {"report_date", "gl_date_for_adjustment", "created", "updated", "payment_due_date"}


def posted_ledger() -> str:
    return post_sql(LEDGER_FULL, "insert")


# ---------------------------------------------------------------- validation ----
def v_worklist() -> str:
    elig = ("complete_part1 = 'Y' AND complete_part2 = 'Y' AND complete_part3 IS NULL AND by_who_part3 IS NULL "
            "AND date_part3 IS NULL AND complete_part4 IS NULL AND by_who_part4 IS NULL AND date_part4 IS NULL")
    fm = "b.funding_model"
    return f"""
WITH l AS ({duck('fx_ledger')}), mst AS ({duck('fx_master')}), b AS ({batch_sql('worklist')}),
ma AS (SELECT deal_id, min(assignee_current) AS m_assignee FROM mst GROUP BY deal_id)
SELECT b.*, {msgs(
        ("b.deal_id IS NULL", E.M_DEAL_NULL),
        (f"b.deal_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM mst WHERE mst.deal_id = b.deal_id AND {elig})", E.M_CRITERIA),
        (f"{fm} IS NULL", E.M_FM_NULL),
        (nin(fm, E.FUNDING_MODELS), E.M_FM_BAD),
        (f"b.deal_id IS NOT NULL AND ({fm} <> 'OFD Warehouse V2' OR {fm} IS NULL) AND EXISTS (SELECT 1 FROM l JOIN ma "
         f"ON l.deal_id = ma.deal_id WHERE l.deal_id = b.deal_id AND l.assignee = ma.m_assignee AND l.movement_type = {INIT})",
         E.M_DUP_FOUND))} AS error_msg
FROM b"""


def _ns_local(prefix: str = "") -> list[tuple[str, str]]:
    c = lambda x: prefix + x
    return [
        (f"{c('deal_type')} = 'Upfront' AND {c('movement_type')} IN {inlist(E.NS_BAD_COMBO_MOVEMENTS)}", E.M_COMBO),
        (f"{c('status')} = 'Standard' AND {c('report_date')} IS NULL", E.M_RD_NULL),
        (nin(c("status"), E.NS_STATUSES), E.M_STATUS),
        (baddate(c("report_date")), E.M_RD_FMT),
        (nin(c("deal_type"), E.NS_DEAL_TYPES), E.M_DEAL_TYPE),
        (nin(c("movement_type"), E.NS_MOVEMENTS), E.M_MOVEMENT),
        (f"{c('adjustment_amount')} IS NULL", E.m_null("ADJUSTMENT_AMOUNT")),
        (badnum(c("adjustment_amount")), E.m_invalid("ADJUSTMENT_AMOUNT")),
        *[(badnum(c(x)), E.m_invalid(x.upper())) for x in E.AMOUNT_CHECKS],
        (nin(c("ofs_payment_posting"), E.OFS_VALUES), E.M_OFS),
        (nin(c("payment_source"), E.NS_PAYMENT_SOURCES), E.M_PAY_SRC),
    ]


def v_ns_payment() -> str:
    local = _ns_local()
    v6 = f"deal_id IS NOT NULL AND movement_type = {INIT} AND deal_type = 'Upfront'"
    err = " OR ".join(f"COALESCE({c}, FALSE)" for c, _ in [(v6, "")] + local)
    return f"""
WITH l AS ({duck('fx_ledger')}), b0 AS ({batch_sql('ns_payment')}),
b AS (SELECT *, ({err}) AS init_err FROM b0)
SELECT b.* EXCLUDE (init_err), {msgs(
        (v6, E.M_UPFRONT),
        (f"deal_id IS NOT NULL AND deal_type <> 'Warehouse V2' AND movement_type <> {INIT} "
         f"AND NOT EXISTS (SELECT 1 FROM l WHERE l.deal_id = b.deal_id AND l.movement_type = {INIT} AND l.source = 'NetSuite') "
         f"AND NOT EXISTS (SELECT 1 FROM b0 b2 WHERE b2.deal_id = b.deal_id AND b2.movement_type = {INIT})", E.M_NO_INIT),
        (f"deal_id IS NOT NULL AND movement_type <> {INIT} AND deal_type <> 'Warehouse V2' AND ("
         f"EXISTS (SELECT 1 FROM l WHERE l.deal_id = b.deal_id AND l.movement_type = {INIT} AND l.source = 'NetSuite' "
         f"AND l.status <> 'Standard') OR EXISTS (SELECT 1 FROM b b2 WHERE b2.deal_id = b.deal_id AND b2.movement_type = {INIT} "
         f"AND (b2.status <> 'Standard' OR b2.report_date IS NULL OR (b2.init_err AND b2.seq_id < b.seq_id))))", E.M_NOT_MOVED),
        ("deal_id IS NULL", E.M_DEAL_NULL),
        *local)} AS error_msg
FROM b"""


def _ora_combo() -> str:
    return " OR ".join(f"(deal_type IN {inlist(d)} AND movement_type IN {inlist(m)})" for d, m in E.ORA_COMBO_RULES)


def v_o_payment() -> str:
    g = "deal_id IS NOT NULL AND status <> 'Exceptional move'"
    return f"""
WITH l AS ({duck('fx_ledger')}), b AS ({batch_sql('o_payment')})
SELECT b.*, {msgs(
        (f"{g} AND movement_type = {INIT} AND deal_type <> 'Warehouse V2'", E.M_NON_V2),
        (f"{g} AND deal_type <> 'Warehouse V2' AND movement_type <> {INIT} "
         f"AND NOT EXISTS (SELECT 1 FROM l WHERE l.deal_id = b.deal_id AND l.movement_type = {INIT} AND l.source = 'Oracle') "
         f"AND NOT EXISTS (SELECT 1 FROM b b2 WHERE b2.deal_id = b.deal_id AND b2.movement_type = {INIT})", E.M_NO_INIT),
        (f"{g} AND movement_type <> {INIT} AND deal_type <> 'Warehouse V2' AND ("
         f"EXISTS (SELECT 1 FROM l WHERE l.deal_id = b.deal_id AND l.movement_type = {INIT} AND l.source = 'Oracle' "
         f"AND l.status <> 'Standard') OR EXISTS (SELECT 1 FROM b b2 WHERE b2.deal_id = b.deal_id AND b2.movement_type = {INIT} "
         f"AND (b2.status <> 'Standard' OR b2.report_date IS NULL)))", E.M_NOT_MOVED),
        ("deal_id IS NULL", E.M_DEAL_NULL),
        ("status = 'Standard' AND report_date IS NULL", E.M_RD_NULL),
        (_ora_combo(), E.M_COMBO),
        (nin("status", E.ORA_PAY_STATUSES), E.M_STATUS),
        (baddate("report_date"), E.M_RD_FMT),
        (nin("deal_type", E.ORA_DEAL_TYPES), E.M_DEAL_TYPE),
        (nin("movement_type", E.ORA_MOVEMENTS), E.M_MOVEMENT),
        ("adjustment_amount IS NULL", E.m_null("ADJUSTMENT_AMOUNT")),
        (badnum("adjustment_amount"), E.m_invalid("ADJUSTMENT_AMOUNT")),
        *[(badnum(x), E.m_invalid(x.upper())) for x in E.AMOUNT_CHECKS * 2],
        (nin("ofs_payment_posting", E.OFS_VALUES), E.M_OFS),
        (nin("payment_source", E.ORA_PAYMENT_SOURCES), E.M_PAY_SRC))} AS error_msg
FROM b"""


def v_o_exception() -> str:
    elig = ("m.complete_part1 = 'Y' AND m.complete_part2 = 'Y' AND m.complete_part3 IS NULL AND m.by_who_part3 IS NULL "
            "AND m.date_part3 IS NULL AND m.complete_part4 IS NULL AND m.by_who_part4 IS NULL AND m.date_part4 IS NULL")
    bad_status = nin("status", E.ORA_EXC_STATUSES)
    return f"""
WITH l AS ({duck('fx_ledger')}), mst AS ({duck('fx_master')}), b AS ({batch_sql('o_exception')})
SELECT b.*, {msgs(
        (f"deal_id IS NOT NULL AND movement_type = {INIT} AND NOT EXISTS (SELECT 1 FROM mst m WHERE m.deal_id = b.deal_id AND {elig})",
         E.M_CRITERIA),
        (f"deal_id IS NOT NULL AND movement_type = {INIT} AND EXISTS (SELECT 1 FROM l WHERE l.deal_id = b.deal_id "
         f"AND l.movement_type = {INIT})", E.M_DUP),
        (f"deal_id IS NOT NULL AND movement_type <> {INIT} "
         f"AND NOT EXISTS (SELECT 1 FROM l WHERE l.deal_id = b.deal_id AND l.movement_type = {INIT} AND l.source = 'Oracle') "
         f"AND NOT EXISTS (SELECT 1 FROM b b2 WHERE b2.deal_id = b.deal_id AND b2.movement_type = {INIT})", E.M_NO_INIT),
        ("deal_id IS NULL", E.M_DEAL_NULL),
        ("status = 'Standard' AND report_date IS NULL", E.M_RD_NULL),
        ("movement_type = '7.05 Auto Reversal' AND gl_date_for_adjustment IS NULL", E.M_GL_NULL),
        (_ora_combo(), E.M_COMBO),
        (bad_status, E.M_STATUS),
        (f"{bad_status} AND status = 'WIP'", E.M_STATUS),
        (baddate("report_date"), E.M_RD_FMT),
        (nin("deal_type", E.EXC_DEAL_TYPES), E.M_DEAL_TYPE),
        (nin("movement_type", E.EXC_MOVEMENTS), E.M_MOVEMENT),
        ("amount IS NULL", E.m_null("AMOUNT")),
        (badnum("amount"), E.m_invalid("AMOUNT")),
        (baddate("gl_date_for_adjustment"), E.M_GL_FMT))} AS error_msg
FROM b"""


def v_status() -> str:
    ex = "EXISTS (SELECT 1 FROM l WHERE l.deal_id = b.deal_id"
    base = msgs(("b.deal_id IS NULL", E.M_DEAL_NULL), (f"b.deal_id IS NOT NULL AND NOT {ex})", E.M_NOT_IN_DB),
                ("b.status IS NULL", E.M_STATUS_NULL))
    return f"""
WITH l AS ({duck('fx_ledger')}), b AS ({batch_sql('status')})
SELECT b.*, CASE
  WHEN b.status = 'Standard' AND {ex} AND l.report_date IS NULL) THEN {s(E.M_RD_NULL)}
  WHEN b.status IS NOT NULL AND {ex} AND l.source = 'Oracle') AND b.status NOT IN {inlist(E.STATUS_ORA_OK)} THEN {s(E.M_STATUS_ORA)}
  WHEN b.status IS NOT NULL AND {ex} AND l.source = 'NetSuite') AND b.status NOT IN {inlist(E.STATUS_NS_OK)} THEN {s(E.M_STATUS_NS)}
  ELSE {base} END AS error_msg
FROM b"""


def v_patch() -> str:
    return f"""
WITH l AS ({duck('fx_ledger')}), b AS ({batch_sql('patch')})
SELECT b.*, {msgs(
        ("deal_id IS NULL", E.M_DEAL_NULL),
        ("deal_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM l WHERE l.deal_id = b.deal_id AND l.invoice_num_ = b.invoice_num "
         "AND l.movement_type = b.movement_type)", E.M_NO_RECORD),
        (baddate("report_date"), E.M_RD_FMT),
        (nin("deal_type", E.PATCH_DEAL_TYPES), E.M_DEAL_TYPE),
        (f"movement_type IS NOT NULL AND movement_type <> {INIT}", E.M_PATCH_MOVEMENT),
        *[(badnum(x), E.m_invalid(x.upper())) for x in E.AMOUNT_CHECKS])} AS error_msg
FROM b"""


VALIDATION_SQL = {"worklist": v_worklist, "ns_payment": v_ns_payment, "o_payment": v_o_payment,
                  "o_exception": v_o_exception, "status": v_status, "patch": v_patch}


# --------------------------------------------------------------------- loads ----
def _ids(order: str) -> str:
    return f"(SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY {order})"


def _ledger_nulls(present: set[str]) -> str:
    from ledgerlake.schemas import LEDGER_FIELDS
    out = []
    for name, dtype in LEDGER_FIELDS:
        if name in present:
            continue
        t = {"LongType()": "BIGINT", "DateType()": "DATE", "TimestampType()": "TIMESTAMP"}.get(repr(dtype))
        t = t or (MONEY if "Decimal" in repr(dtype) else "VARCHAR")
        out.append(f"CAST(NULL AS {t}) AS {name}")
    return ", ".join(out)


def load_sql(kind: str) -> str:
    v = VALIDATION_SQL[kind]()
    if kind in ("ns_payment", "o_payment", "o_exception"):
        src = "'NetSuite'" if kind == "ns_payment" else "'Oracle'"
        inv = "invoice_number" if kind == "ns_payment" else "invoice_num_"
        cols = {"seq_id": "seq_id", "id": _ids("seq_id"), "source": src, "status": "status",
                "report_date": pdate("report_date"), "deal_id": "deal_id", "deal_type": "deal_type",
                "movement_type": "movement_type", "comments": "comments"}
        if kind == "o_exception":
            cols.update({"adjustment_amt": num("amount"), "invoice_num_": "invoice_num_",
                         "gl_date_for_adjustment": pdate("gl_date_for_adjustment")})
        else:
            cols.update({"adjustment_amt": num("adjustment_amount"), "ofs_payment_posting": "ofs_payment_posting",
                         "payment_source": "payment_source", "invoice_num_": inv,
                         **{x: num(x) for x in E.AMOUNT_CHECKS}})
        typed = ", ".join(f"{e} AS {n}" for n, e in cols.items())
        src_sql = (f"SELECT {typed}, {_ledger_nulls(set(cols))} FROM ({v}) v WHERE error_msg IS NULL")
        posted = post_sql(src_sql, "insert")
    elif kind == "worklist":
        fm = "v.funding_model"
        cols = {"seq_id": "v.seq_id", "deal_id": "m.deal_id", "customer_name": "m.customer_legal_name",
                "assignee": "m.assignee_current", "funding_model": fm, "oce": "m.oracle_contract_entity_oce",
                "country__oce_": "COALESCE(m.oce_country, m.country)", "order_number": "v.order_number",
                "invoice_num_": "v.invoice_number",
                "original_invoice_amount": f"CAST(v.outstanding_amount AS {MONEY})",
                "payment_discount": f"CAST(v.payment_discount AS {MONEY})", "status": "'WIP'",
                "movement_type": f"CASE WHEN {fm} = 'OFD Warehouse V2' THEN 'Initial setup WHv2' ELSE 'Initial movement' END",
                "deal_type": f"CASE WHEN {fm} = 'OFD Warehouse V2' THEN 'Warehouse V2' END",
                "source": "'NetSuite'", "id": _ids("v.seq_id")}
        typed = ", ".join(f"{e} AS {n}" for n, e in cols.items())
        src_sql = (f"SELECT {typed}, {_ledger_nulls(set(cols))} FROM ({v}) v JOIN ({duck('fx_master')}) m "
                   f"ON m.deal_id = v.deal_id WHERE v.error_msg IS NULL")
        posted = post_sql(src_sql, "insert")
    elif kind == "status":
        src_sql = (f"SELECT l.* REPLACE (pd.s_status AS status), pd.n_patches FROM ({LEDGER_FULL}) l JOIN "
                   f"(SELECT deal_id, arg_max(status, seq_id) AS s_status, count(*) AS n_patches FROM ({v}) v "
                   f"WHERE error_msg IS NULL AND deal_id IS NOT NULL GROUP BY deal_id) pd ON l.deal_id = pd.deal_id")
        posted = post_sql(src_sql, "update")
    else:
        posted = patch_rounds(v)
    cols = Q.LEDGER_OUT + Q.LOAD_EXTRA[kind]
    return f"SELECT {show(cols, MONEY_COLS, DATE_COLS)} FROM ({posted}) p"


# fixed values: the columns a patch may set besides the amounts
PATCHED_TEXTS = ["deal_type", "report_date", "comments"]
PATCHED_AMOUNTS = ["other_adjustment", "original_invoice_amount", "payment_discount", "payment_applied_to_invoice"]
PATCH_ROUNDS = 5  # patches of one key in the fixtures are fewer; the last round raises otherwise


def patch_rounds(v: str) -> str:
    """Patches applied one by one: each round is the whole trigger over the rows whose key has a k-th patch."""
    rep = ["COALESCE(k.deal_type, l.deal_type) AS deal_type", f"COALESCE({pdate('k.report_date')}, l.report_date) AS report_date",
           "COALESCE(k.comments, l.comments) AS comments"]
    rep += [f"COALESCE(CAST(k.{x} AS {MONEY}), l.{x}) AS {x}" for x in PATCHED_AMOUNTS]
    on = "l.deal_id = k.deal_id AND l.invoice_num_ = k.invoice_num AND l.movement_type = k.movement_type"
    patches = (f"SELECT deal_id, invoice_num, movement_type, {', '.join(PATCHED_TEXTS + PATCHED_AMOUNTS)}, "
               f"row_number() OVER w AS k, count(*) OVER (PARTITION BY deal_id, invoice_num, movement_type) AS n FROM ({v}) v "
               f"WHERE error_msg IS NULL AND deal_id IS NOT NULL WINDOW w AS (PARTITION BY deal_id, invoice_num, movement_type ORDER BY seq_id)")
    ctes = [f"patches AS MATERIALIZED ({patches})",
            f"s0 AS MATERIALIZED (SELECT l.*, k.n AS n_patches FROM ({LEDGER_FULL}) l JOIN patches k ON {on} AND k.k = 1)"]
    for r in range(1, PATCH_ROUNDS + 1):
        src = f"SELECT l.* REPLACE ({', '.join(rep)}) FROM s{r - 1} l JOIN patches k ON {on} AND k.k = {r}"
        # the trigger adds its own columns; the next round starts from the ledger's
        ctes.append(f"s{r} AS MATERIALIZED (SELECT * EXCLUDE (posting_rule) FROM ({post_sql(src, 'update')}) p)")
    done = " UNION ALL BY NAME ".join(f"SELECT * FROM s{r} WHERE n_patches = {r}" for r in range(1, PATCH_ROUNDS))
    return (f"WITH {', '.join(ctes)} SELECT * FROM ({done}) UNION ALL BY NAME SELECT * FROM s{PATCH_ROUNDS} "
            f"WHERE CASE WHEN n_patches >= {PATCH_ROUNDS} THEN error('more patches than rounds') ELSE FALSE END")


# ------------------------------------------------------------------ worklist ----
_NUMERIC = r"'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'"


def clean_invoice(col: str) -> str:
    x = f"replace({col}, '#', '')"
    x = rf"regexp_replace({x}, '[^\w\s]', ' ', 'g')"
    x = rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"
    x = f"replace(replace(replace({x}, 'CM ', 'CM'), 'DM ', 'DM'), 'NS ', 'NS')"
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def pieces(col: str) -> str:
    return f"COALESCE(string_split({col}, ' '), [''])"


def _worklist_ctes(rule: str = "v6") -> str:
    # the older rule blanks only rows without an amount and reads theirs as a number, which is none
    model = "OR COALESCE(funding_model = 'OFD Warehouse V2', FALSE)" if rule == "v6" else ""
    return f"""
w AS ({duck('fx_worklist')}),
mk AS (SELECT *, (outstanding_amount IS NULL {model}) AS blank FROM w),
r AS (SELECT * EXCLUDE (invoice_number), {clean_invoice('invoice_number')} AS invoice_number FROM mk WHERE NOT blank),
sp AS (SELECT *, {pieces('outstanding_amount')} AS amts, {pieces('invoice_number')} AS invs FROM r),
ok AS (SELECT * FROM sp WHERE len(amts) = len(invs)),
ex AS (SELECT row_no, deal_id, funding_model, invoice_number, outstanding_amount, payment_discount FROM sp WHERE len(amts) <> len(invs)),
px AS (SELECT *, unnest(range(len(amts))) AS piece FROM ok),
cl AS (
  SELECT row_no, deal_id, funding_model, invs[piece + 1] AS invoice_number,
    CASE WHEN regexp_matches(replace(amts[piece + 1], ',', ''), {_NUMERIC})
         THEN TRY_CAST(trim(replace(amts[piece + 1], ',', '')) AS DOUBLE) END AS outstanding_amount,
    CASE WHEN piece = 0 THEN payment_discount END AS payment_discount, CAST(piece AS INTEGER) AS piece_no FROM px
  UNION ALL
  SELECT row_no, deal_id, funding_model, invoice_number, CAST(NULL AS DOUBLE), payment_discount, 0 FROM mk WHERE blank)"""


def worklist_reconcile() -> str:
    return f"""
WITH {_worklist_ctes()},
k AS (SELECT deal_id AS k, TRUE AS in_o, FALSE AS in_c, FALSE AS in_e FROM w
      UNION ALL SELECT deal_id, FALSE, TRUE, FALSE FROM cl UNION ALL SELECT deal_id, FALSE, FALSE, TRUE FROM ex),
g AS (SELECT k, bool_or(in_o) AS in_o, bool_or(in_c) AS in_c, bool_or(in_e) AS in_e FROM k GROUP BY k),
c AS (SELECT CAST(count_if(in_o) AS BIGINT) AS n_original, CAST(count_if(in_c) AS BIGINT) AS n_clean,
             CAST(count_if(in_e) AS BIGINT) AS n_exceptions,
             CAST(count_if(in_o <> (in_c OR in_e)) AS BIGINT) AS n_key_mismatch FROM g),
so AS (SELECT COALESCE(SUM(payment_discount), 0) AS v FROM w),
sc AS (SELECT COALESCE(SUM(payment_discount), 0) AS v FROM cl),
se AS (SELECT COALESCE(SUM(payment_discount), 0) AS v FROM ex)
SELECT c.*, round(so.v, 2) AS sum_original, round(sc.v, 2) AS sum_clean, round(se.v, 2) AS sum_exceptions,
  (n_key_mismatch = 0 AND abs(sc.v + se.v - so.v) < 0.5) AS reconciled
FROM c, so, sc, se"""


# ------------------------------------------------------------- funder report ----
def funder_report_sql() -> str:
    as_of = f"DATE {s(Q.AS_OF)}"
    buckets = " ".join(f"WHEN aging_days <= {u} THEN {s(lab)}" for u, lab in
                       [(0, "Current"), (30, "1 to 30"), (60, "31 to 60"), (90, "61 to 90"), (180, "91 to 180")])
    from ledgerlake.functions.labels import FUNDER_RULES
    funder = "CASE " + " ".join(
        "WHEN " + " OR ".join(f"COALESCE(contains(funder_name, {s(n)}), FALSE)" for n in needles) + f" THEN {s(lab)}"
        for needles, lab in FUNDER_RULES) + " ELSE 'Others' END"
    return f"""
SELECT row_no, CAST(payment_due_date AS VARCHAR) AS payment_due_date, yrx_assignee, order_number,
  deal_association_type, funder_name, open_amt, aging_days,
  CASE {buckets} ELSE '181+' END AS aging_bucket,
  CASE WHEN COALESCE(contains(lower(order_number), 'ns'), FALSE) THEN 'NetSuite' ELSE 'Oracle' END AS product_type,
  CASE WHEN COALESCE(contains(yrx_assignee, 'OFD Cloud'), FALSE) AND aging_days > 60 THEN 'P1_C60'
       WHEN open_amt > 1000000 THEN 'P1_1M' WHEN aging_days > 90 THEN 'P1_90D' WHEN aging_days > 0 THEN 'P2'
       ELSE 'P3' END AS priority,
  {funder} AS funder
FROM (SELECT *, CAST(datediff('day', payment_due_date, {as_of}) AS INTEGER) AS aging_days
      FROM ({duck('fx_payment_detail')}) p
      WHERE payment_due_date >= DATE {s(Q.START)} AND payment_due_date <= last_day({as_of} + INTERVAL 1 MONTH)
        AND yrx_status IS DISTINCT FROM 'Funded-Fully' AND yrx_status IS DISTINCT FROM 'Non Funded-Dupe'
        AND deal_association_type IS DISTINCT FROM 'Future Funding' AND adjustment_terminated IS NULL
        AND administered IS DISTINCT FROM 'No' AND open_amt > 10) f"""


# -------------------------------------------------------------------- files ----
def assign_names_sql() -> str:
    return f"""
WITH r AS ({duck('fx_payment_files')}), g AS ({duck('fx_ranges')}),
files AS (SELECT DISTINCT file, file_order FROM r),
ranked AS (SELECT file, file_order, assignment_day, row_number() OVER (PARTITION BY file ORDER BY row_no) AS rn FROM r),
cells AS (SELECT file, file_order, assignment_day AS cell_date FROM ranked WHERE rn = 2),
cand AS (SELECT c.file, c.file_order, g.file_name AS name, g.range_rank FROM cells c
         JOIN g ON c.cell_date >= g.start_date AND c.cell_date <= g.end_date),
firstc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY range_rank) AS k FROM cand) WHERE k = 1),
win AS (SELECT name, arg_min(file, file_order) AS file FROM firstc GROUP BY name)
SELECT f.file, w.name AS new_name,
  CASE WHEN w.name IS NOT NULL THEN 'renamed'
       WHEN EXISTS (SELECT 1 FROM cand WHERE cand.file = f.file) THEN 'conflict' ELSE 'unmatched' END AS status
FROM files f LEFT JOIN win w ON f.file = w.file"""


def exclude_deals_sql() -> str:
    ref = ", ".join(f"({s(f)}, {d})" for f, d in E.REFERENCE_EXCLUSIONS)
    return f"""
WITH r AS (SELECT file_name, row_no, deal_id FROM ({duck('fx_payment_files')}) z),
pairs AS (SELECT file_name, max(deal_id) AS deal_id FROM r GROUP BY file_name
          UNION ALL SELECT * FROM (VALUES {ref}) v(file_name, deal_id))
SELECT * FROM r WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.file_name = r.file_name AND p.deal_id = r.deal_id)"""


def normalise_sql() -> str:
    cols = ", ".join(f"COALESCE(strftime(try_strptime(trim({c}), '%d-%b-%Y'), '%-m/%-d/%Y'), '') AS {c}"
                     for c in E.DATE_COLUMNS)
    return f"SELECT row_no, {cols} FROM ({duck('fx_payment_files')}) z"


# ------------------------------------------------------------------ quality ----
def constraint_sql() -> str:
    l = f"({duck('fx_ledger')}) l"  # noqa: E741
    # fixed values: the declared CHECK predicates
    checks = {
        "CHK_SOURCE_STATUS": "NOT (source = 'NetSuite' AND status = 'Exceptional move')",
        "OMOVEDEALCOMBINATION": ("(deal_type = 'Upfront billing / 7.05 Standard' AND movement_type NOT IN ('7.05 Auto Reversal')) "
                                 "OR ((deal_type = '7.05 Exception' OR deal_type = '7.05 Exception - Indirect') "
                                 "AND movement_type NOT IN ('Move AR to GL', 'Move AR from GL')) "
                                 "OR (source = 'Oracle' AND deal_type = 'Warehouse V2' AND movement_type NOT IN ('7.05 Auto Reversal'))"),
        "REPORT_DATE_MANDATORY": "status <> 'Standard' OR (status = 'Standard' AND report_date IS NOT NULL)",
        "NSMOVEDEALCOMBINATION": ("source = 'NetSuite' AND deal_type = 'Upfront' "
                                  "AND movement_type NOT IN ('Initial setup WHv2', 'Payment JE reclass')"),
    }
    parts = [f"SELECT {s(n)} AS constraint_name, CAST(count_if(({p}) = FALSE) AS BIGINT) AS violations FROM {l}"
             for n, p in checks.items()]
    parts.append(f"SELECT 'DEAL_ID_NOT_NULL', CAST(count_if(deal_id IS NULL) AS BIGINT) FROM {l}")
    parts.append(f"SELECT 'PK_ID', CAST((SELECT count_if(id IS NULL) FROM {l}) + (SELECT COALESCE(SUM(c), 0) FROM "
                 f"(SELECT id, count(*) AS c FROM {l} WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1)) AS BIGINT)")
    return "\nUNION ALL\n".join(parts)


# -------------------------------------------------------------------- all ----
def oracle_sql() -> dict[str, str]:
    num_cols = ["amount", "other_adjustment", "original_invoice_amount", "payment_applied_to_invoice"]
    out: dict[str, str] = {}
    out["x_parse_dates"] = (
        f"SELECT seq_id, report_date, CAST({pdate('report_date')} AS VARCHAR) AS parsed_report_date, "
        f"{baddate('report_date')} AS report_date_bad, gl_date, CAST({pdate('gl_date')} AS VARCHAR) AS parsed_gl_date, "
        f"{baddate('gl_date')} AS gl_date_bad FROM ({duck('fx_batch')}) b")
    out["x_parse_numbers"] = ("SELECT seq_id, " + ", ".join(
        f"{c}, CAST({num(c)} AS DOUBLE) AS {c}_number, {badnum(c)} AS {c}_bad" for c in num_cols)
        + f" FROM ({duck('fx_batch')}) b")
    ci = clean_invoice("invoice_number")
    out["x_invoice_clean"] = (
        f"SELECT row_no, invoice_number, {ci} AS invoice_clean, len({pieces(ci)}) AS n_invoice_pieces, "
        f"len({pieces('outstanding_amount')}) AS n_amount_pieces FROM ({duck('fx_worklist')}) w")
    rep = funder_report_sql()
    out["funder_report"] = rep
    out["funder_aging_summary"] = (f"SELECT funder, aging_bucket, count(*) AS n_items, round(sum(open_amt), 2) AS open_amt "
                                   f"FROM ({rep}) r GROUP BY funder, aging_bucket")
    out["funder_counts"] = (f"SELECT funder, count(*) AS n_items, CAST(count_if(priority LIKE 'P1%') AS BIGINT) AS n_p1, "
                            f"CAST(count_if(product_type = 'NetSuite') AS BIGINT) AS n_netsuite FROM ({rep}) r GROUP BY funder")
    pl = posted_ledger()
    out["post_derive"] = f"SELECT id, source, movement_type, CAST(adjustment_amt AS DOUBLE) AS adjustment_amt FROM ({pl}) p"
    out["post_lock"] = (f"SELECT id, {show(['original_invoice_amount', 'payment_discount', 'payment_applied_to_invoice', 'other_adjustment'], MONEY_COLS)} "
                        f"FROM ({pl}) p")
    out["post_accounts"] = (f"SELECT {show(['id', 'posting_rule', 'adjustment_type', 'adjustment_amt', 'payment_applied_to_invoice', *E.ALL_ACCOUNTS, 'created', 'created_by'], MONEY_COLS, DATE_COLS)} "
                            f"FROM ({pl}) p")
    out["post_totals_by_account"] = ("SELECT source, adjustment_type, count(*) AS n_rows, "
                                     + ", ".join(f"CAST(SUM({a}) AS DOUBLE) AS {a}" for a in E.ALL_ACCOUNTS)
                                     + f" FROM ({pl}) p GROUP BY source, adjustment_type")
    for kind, fn in VALIDATION_SQL.items():
        out[f"validate_{kind}"] = f"SELECT seq_id, deal_id, error_msg FROM ({fn()}) v"
    for kind in VALIDATION_SQL:
        out[f"load_{kind}"] = load_sql(kind)
    out["patch_conflicts"] = (
        f"SELECT deal_id, invoice_num, movement_type, count(*) AS n_patches, count(DISTINCT deal_type) AS n_deal_types, "
        f"arg_max(deal_type, seq_id) FILTER (WHERE deal_type IS NOT NULL) AS last_deal_type "
        f"FROM ({v_patch()}) v WHERE error_msg IS NULL AND deal_id IS NOT NULL GROUP BY 1, 2, 3 "
        f"HAVING count(*) > 1 AND count(DISTINCT deal_type) > 1")
    wl = _worklist_ctes()
    out["worklist_clean"] = f"WITH {wl} SELECT * FROM cl"
    out["worklist_exceptions"] = f"WITH {wl} SELECT * FROM ex"
    out["worklist_reconcile"] = worklist_reconcile()
    out["assign_names"] = assign_names_sql()
    out["exclude_deals"] = exclude_deals_sql()
    out["split_halves"] = (f"SELECT row_no, CAST(CASE WHEN row_number() OVER (ORDER BY row_no) <= floor(count(*) OVER () / 2) "
                           f"THEN 1 ELSE 2 END AS INTEGER) AS half FROM ({duck('fx_payment_files')}) z")
    out["normalise_dates"] = normalise_sql()
    out["constraint_report"] = constraint_sql()
    out["row_count_check"] = "SELECT count(*) AS source_rows, count(*) AS written_rows, TRUE AS ok FROM orders"
    out["ledger_append"] = (f"SELECT source, 2 * count(*) AS n_rows, 2 * count(DISTINCT id) AS n_ids, "
                            f"CAST(2 * SUM(adjustment_amt) AS DOUBLE) AS adjustment_amt, (SELECT 2 * count(*) FROM orders) AS n_appended "
                            f"FROM ({pl}) p GROUP BY source")
    out["master_scan"] = (f"SELECT oce_country, count(*) AS n_rows, count(DISTINCT deal_id) AS n_deals, count(assignee_current) AS n_assigned "
                          f"FROM ({duck('fx_master')}) m GROUP BY oce_country")
    out["write_by_funder"] = rep
    out["write_worklist"] = (f"WITH {wl} SELECT 'clean' AS output, count(*) AS n_rows, CAST(SUM(row_no) AS BIGINT) AS sum_row_no FROM cl "
                             f"UNION ALL SELECT 'exceptions', count(*), CAST(SUM(row_no) AS BIGINT) FROM ex")
    out["worklist_clean_v5"] = f"WITH {_worklist_ctes('v5')} SELECT * FROM cl"
    out["write_halves"] = out["split_halves"]
    out["write_normalised"] = out["normalise_dates"]
    out["preview"] = f"SELECT row_no, file_name FROM ({duck('fx_payment_files')}) z ORDER BY row_no LIMIT 5"
    out["post_stream"] = (f"SELECT {show(['id', 'adjustment_type', 'adjustment_amt', 'payment_applied_to_invoice', *E.ALL_ACCOUNTS, 'created', 'created_by'], MONEY_COLS, DATE_COLS)} "
                          f"FROM ({pl}) p")
    out["read_export"] = (f"SELECT row_no, CASE WHEN part = 0 THEN deal END AS deal, note, CASE WHEN part > 0 THEN extra END AS extra "
                          f"FROM ({duck('fx_export')}) e")
    out["read_ranges"] = (f"SELECT file_name, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date "
                          f"FROM ({duck('fx_ranges')}) g")
    ext = "CASE row_no % 4 WHEN 0 THEN '' WHEN 1 THEN '.XLS' ELSE '.amend.csv' END"
    out["file_names"] = (f"SELECT row_no, CASE row_no % 3 WHEN 0 THEN 'C:' || chr(92) || 'Reports' || chr(92) || 'NA' WHEN 1 THEN '/data/in.d' ELSE '' END AS folder, "
                         f"file_name || {ext} AS name, CASE row_no % 4 WHEN 0 THEN '' WHEN 1 THEN '.xls' ELSE '.csv' END AS extension "
                         f"FROM ({duck('fx_payment_files')}) z")
    before = f"SELECT id, status, CAST(updated_by AS VARCHAR) AS updated_by FROM ({LEDGER_FULL}) l"
    last = (f"SELECT deal_id, arg_max(status, seq_id) AS s FROM ({v_status()}) v WHERE error_msg IS NULL AND deal_id IS NOT NULL GROUP BY deal_id")
    after = (f"SELECT l.id, COALESCE(d.s, l.status) AS status, CASE WHEN d.s IS NULL THEN CAST(l.updated_by AS VARCHAR) ELSE {s(Q.USER)} END AS updated_by "
             f"FROM ({LEDGER_FULL}) l LEFT JOIN ({last}) d ON l.deal_id = d.deal_id")
    out["status_versions"] = " UNION ALL ".join(
        f"SELECT {n} AS version, status, updated_by, count(*) AS n_rows, CAST(SUM(id) AS BIGINT) AS sum_id FROM ({x}) x GROUP BY status, updated_by"
        for n, x in ((1, before), (2, after)))
    out["exclude_versions"] = out["exclude_deals"]
    return out
