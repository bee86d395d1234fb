"""Adapters: ledger-shaped test tables derived from the TPC-H-like test data.

Each adapter is one SQL text that Spark (`spark.sql(text, orders=df, ...)`)
and DuckDB both run, so the Spark query and its oracle read equal inputs.
Every adapter reads whole tables; the moduli only assign values, they never
drop rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


TABLES = ["orders", "customer", "nation"]

_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
_MONTHS = " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(
    ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"], start=1))


def _dmy(s: str) -> str:
    """d-Mon-yyyy text of an ISO date text (same SQL in both engines)."""
    return f"(substr({s}, 9, 2) || '-' || CASE CAST(substr({s}, 6, 2) AS INT) {_MONTHS} END || '-' || substr({s}, 1, 4))"


_LEDGER_MOVEMENT = """CASE WHEN o_orderkey % 2 = 0 THEN
    CASE o_orderkey % 7 WHEN 0 THEN 'Initial movement' WHEN 1 THEN '7.05 Auto Reversal' WHEN 2 THEN 'Payment application'
      WHEN 3 THEN 'Move AR to GL' WHEN 4 THEN 'Move AR from GL' WHEN 5 THEN 'Adjustment' ELSE 'Initial setup WHv2' END
  ELSE CASE o_orderkey % 7 WHEN 0 THEN 'Initial movement' WHEN 1 THEN 'Apply to GL' WHEN 2 THEN 'Move AR to GL'
      WHEN 3 THEN 'Move AR from GL' WHEN 4 THEN 'Payment JE reclass' WHEN 5 THEN 'Initial setup WHv2' ELSE NULL END END"""

SQL: dict[str, str] = {}

SQL["fx_ledger"] = f"""
SELECT o_orderkey AS id, CAST(o_custkey AS STRING) AS deal_id,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Oracle' ELSE 'NetSuite' END AS source,
  CASE o_orderkey % 3 WHEN 0 THEN 'Standard' WHEN 1 THEN 'WIP' ELSE 'Change Event' END AS status,
  CASE WHEN o_orderkey % 2 = 0 THEN
    CASE o_orderkey % 5 WHEN 0 THEN 'Upfront billing / 7.05 Standard' WHEN 1 THEN '7.05 Exception'
      WHEN 2 THEN '7.05 Exception - Indirect' WHEN 3 THEN 'Warehouse V2' ELSE NULL END
  ELSE CASE o_orderkey % 5 WHEN 0 THEN 'Upfront' WHEN 1 THEN 'Warehouse V2' WHEN 2 THEN 'Upfront'
      WHEN 3 THEN 'Warehouse V2' ELSE NULL END END AS deal_type,
  {_LEDGER_MOVEMENT} AS movement_type,
  CASE WHEN o_orderkey % 11 < 4 THEN 'OFD Cloud Team' WHEN o_orderkey % 11 < 8 THEN 'OFD Warehouse Team'
    WHEN o_orderkey % 11 = 8 THEN 'Cloud and Warehouse' WHEN o_orderkey % 11 = 9 THEN NULL ELSE 'Admin' END AS assignee,
  'INV' || CAST(o_orderkey % 100 AS STRING) AS invoice_num_,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS report_date,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS adjustment_amt,
  CAST(o_totalprice AS DECIMAL(18,2)) AS original_invoice_amount,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 50 AS DECIMAL(18,2)) END AS payment_discount,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(o_orderkey % 90 AS DECIMAL(18,2)) END AS payment_applied_to_invoice,
  CAST(NULL AS DECIMAL(18,2)) AS other_adjustment
FROM {{orders}}
"""

SQL["fx_master"] = """
SELECT CAST(c_custkey AS STRING) AS deal_id, c_name AS customer_legal_name,
  CASE c_custkey % 3 WHEN 0 THEN 'OFD Cloud Team' WHEN 1 THEN 'OFD Warehouse Team' ELSE NULL END AS assignee_current,
  'OCE ' || n_name AS oracle_contract_entity_oce, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE n_name END AS oce_country,
  n_name AS country,
  'Y' AS complete_part1, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE 'Y' END AS complete_part2,
  CASE WHEN c_custkey % 9 = 0 THEN 'Y' ELSE NULL END AS complete_part3,
  CAST(NULL AS STRING) AS complete_part4, CAST(NULL AS STRING) AS by_who_part3, CAST(NULL AS STRING) AS by_who_part4,
  CAST(NULL AS DATE) AS date_part3, CAST(NULL AS DATE) AS date_part4
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
"""

# staged payment / exception / worklist rows, all text
SQL["fx_batch"] = f"""
SELECT o_orderkey AS seq_id,
  CASE o_orderkey % 7 WHEN 0 THEN 'Standard' WHEN 1 THEN 'WIP' WHEN 2 THEN 'Change Event' WHEN 3 THEN 'Exceptional move'
    WHEN 4 THEN 'Bad' WHEN 5 THEN 'Standard' ELSE NULL END AS status,
  CASE o_orderkey % 11 % 5 WHEN 0 THEN {_DAY}
    WHEN 1 THEN substr({_DAY}, 9, 2) || '-Jan-' || substr({_DAY}, 1, 4)
    WHEN 2 THEN '02/28/' || substr({_DAY}, 1, 4) WHEN 3 THEN '2024/99' ELSE NULL END AS report_date,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(o_custkey + 500 AS STRING) END AS deal_id,
  CASE o_orderkey % 8 WHEN 0 THEN 'Upfront' WHEN 1 THEN 'Warehouse V2' WHEN 2 THEN '7.05 Exception'
    WHEN 3 THEN 'Upfront billing / 7.05 Standard' WHEN 4 THEN '7.05 Exception - Indirect' WHEN 5 THEN 'Other'
    WHEN 6 THEN 'Warehouse v2' ELSE NULL END AS deal_type,
  CASE o_orderkey % 9 WHEN 0 THEN 'Initial movement' WHEN 1 THEN 'Payment application' WHEN 2 THEN 'Move AR to GL'
    WHEN 3 THEN 'Apply to GL' WHEN 4 THEN '7.05 Auto Reversal' WHEN 5 THEN 'Initial setup WHv2'
    WHEN 6 THEN 'Adjustment' WHEN 7 THEN 'Bad' ELSE NULL END AS movement_type,
  CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'abc' WHEN 2 THEN '1,000'
    ELSE CAST(o_orderkey AS STRING) || '.25' END AS amount,
  'INV' || CAST(o_orderkey % 100 AS STRING) AS invoice_num,
  CASE o_orderkey % 6 WHEN 0 THEN 'OFD Cloud Receivables' WHEN 1 THEN 'OFD Warehouse' WHEN 2 THEN 'Funded Admin'
    WHEN 3 THEN 'OFD Warehouse V2' WHEN 4 THEN 'Other Model' ELSE NULL END AS funding_model,
  CASE o_orderkey % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'Maybe' ELSE NULL END AS ofs_payment_posting,
  CASE o_orderkey % 6 WHEN 0 THEN 'Monthly pass-thru' WHEN 1 THEN 'INTL instruction file'
    WHEN 2 THEN 'Payment posting request' WHEN 3 THEN 'Email' WHEN 4 THEN 'Fax' ELSE NULL END AS payment_source,
  CASE o_orderkey % 13 WHEN 0 THEN 'x1' WHEN 1 THEN NULL ELSE CAST(o_orderkey % 40 AS STRING) END AS other_adjustment,
  CASE o_orderkey % 17 WHEN 0 THEN '1,5' WHEN 1 THEN NULL
    ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS original_invoice_amount,
  CASE o_orderkey % 10 WHEN 0 THEN NULL ELSE CAST(o_orderkey % 50 AS STRING) END AS payment_discount,
  CASE o_orderkey % 12 WHEN 0 THEN '?' WHEN 1 THEN NULL ELSE CAST(o_orderkey % 90 AS STRING) END AS payment_applied_to_invoice,
  CASE o_orderkey % 5 WHEN 0 THEN {_DAY} WHEN 1 THEN '31/31/2020' ELSE NULL END AS gl_date,
  'c' || CAST(o_orderkey AS STRING) AS comments,
  CAST(o_orderkey AS STRING) AS order_number,
  CAST(o_orderkey % 1000 AS STRING) || '.50' AS outstanding_amount
FROM {{orders}}
"""

# staged patches keyed like the ledger rows they target
SQL["fx_patch_batch"] = f"""
SELECT o_orderkey AS seq_id,
  CASE o_orderkey % 6 WHEN 0 THEN 'Upfront' WHEN 1 THEN 'Warehouse V2' WHEN 2 THEN '7.05 Exception'
    WHEN 3 THEN 'Bogus' ELSE NULL END AS deal_type,
  CASE o_orderkey % 4 WHEN 0 THEN {_DAY} WHEN 1 THEN '2024/99' ELSE NULL END AS report_date,
  {_LEDGER_MOVEMENT} AS movement_type,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN CAST(o_custkey + 100000 AS STRING)
    ELSE CAST(o_custkey AS STRING) END AS deal_id,
  'INV' || CAST(o_orderkey % 100 AS STRING) AS invoice_num,
  CASE o_orderkey % 5 WHEN 0 THEN 'bad' WHEN 1 THEN NULL ELSE CAST(o_orderkey % 30 AS STRING) END AS other_adjustment,
  CASE o_orderkey % 3 WHEN 0 THEN NULL ELSE CAST(o_orderkey % 700 AS STRING) || '.5' END AS original_invoice_amount,
  CASE o_orderkey % 2 WHEN 0 THEN NULL ELSE CAST(o_orderkey % 20 AS STRING) END AS payment_discount,
  CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderkey % 15 AS STRING) ELSE NULL END AS payment_applied_to_invoice,
  'patched ' || CAST(o_orderkey AS STRING) AS comments
FROM {{orders}}
"""

SQL["fx_status_batch"] = """
SELECT o_orderkey AS seq_id,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_custkey + (o_orderkey % 4) * 400 AS STRING) END AS deal_id,
  CASE o_orderkey % 8 WHEN 0 THEN 'Standard' WHEN 1 THEN 'WIP' WHEN 2 THEN 'Exceptional move' WHEN 3 THEN 'Further Checking'
    WHEN 4 THEN 'Change Event' WHEN 5 THEN 'Closed' WHEN 6 THEN NULL ELSE 'Standard' END AS status
FROM {orders}
"""

SQL["fx_payment_detail"] = """
SELECT o_orderkey AS row_no, CAST(o_orderdate AS DATE) AS payment_due_date,
  CASE o_orderkey % 5 WHEN 0 THEN 'Funded-Fully' WHEN 1 THEN 'Non Funded-Dupe' WHEN 2 THEN NULL ELSE 'Open' END AS yrx_status,
  CASE o_orderkey % 4 WHEN 0 THEN 'OFD Cloud A' WHEN 1 THEN NULL ELSE 'Desk' END AS yrx_assignee,
  CASE o_orderkey % 3 WHEN 0 THEN 'NS-' || CAST(o_orderkey AS STRING) WHEN 1 THEN NULL ELSE CAST(o_orderkey AS STRING) END AS order_number,
  CASE o_orderkey % 7 WHEN 0 THEN 'Future Funding' WHEN 1 THEN NULL ELSE 'Base' END AS deal_association_type,
  CASE WHEN o_orderkey % 11 = 0 THEN 'Y' ELSE NULL END AS adjustment_terminated,
  CASE o_orderkey % 13 WHEN 0 THEN 'No' WHEN 1 THEN NULL ELSE 'Yes' END AS administered,
  CASE o_orderkey % 9 WHEN 0 THEN 'OFD Fund' WHEN 1 THEN 'KeyBank' WHEN 2 THEN 'Key Corp' WHEN 3 THEN 'Banc of America'
    WHEN 4 THEN 'BAL Global Finance Canada' WHEN 5 THEN 'SG Equip' WHEN 6 THEN 'Wells Fargo' WHEN 7 THEN 'Dext Capital'
    ELSE NULL END AS funder_name,
  CASE o_orderkey % 17 WHEN 0 THEN NULL WHEN 1 THEN 5.0 ELSE o_totalprice * (1 + 9 * (o_orderkey % 2)) END AS open_amt
FROM {orders}
"""

SQL["fx_worklist"] = """
SELECT o_orderkey AS row_no, o_custkey AS deal_id,
  CASE WHEN o_orderkey % 9 = 0 THEN 'OFD Warehouse V2' WHEN o_orderkey % 9 = 1 THEN NULL ELSE 'OFD Warehouse' END AS funding_model,
  CASE o_orderkey % 4 WHEN 0 THEN '#CM ' || CAST(o_orderkey AS STRING) || ', NS ' || CAST(o_orderkey + 1 AS STRING)
    WHEN 1 THEN 'INV-' || CAST(o_orderkey AS STRING) WHEN 2 THEN NULL
    ELSE '  DM ' || CAST(o_orderkey AS STRING) || '  ' END AS invoice_number,
  CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '1,200.50' WHEN 2 THEN 'n/a' ELSE '1,200.50 30' END AS outstanding_amount,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 50 AS DOUBLE) END AS payment_discount
FROM {orders}
"""

# half-year file names over the years present in the orders
SQL["fx_ranges"] = """
SELECT CAST(y AS STRING) || '_H1' AS file_name,
  CAST(CAST(y AS STRING) || '-01-01' AS DATE) AS start_date, CAST(CAST(y AS STRING) || '-06-30' AS DATE) AS end_date,
  CAST(y * 2 + 1 AS BIGINT) AS range_rank
FROM (SELECT DISTINCT CAST(substr(CAST(o_orderdate AS STRING), 1, 4) AS INT) AS y FROM {orders}) a
UNION ALL
SELECT CAST(y AS STRING) || '_H2' AS file_name,
  CAST(CAST(y AS STRING) || '-07-01' AS DATE) AS start_date, CAST(CAST(y AS STRING) || '-12-31' AS DATE) AS end_date,
  CAST(y * 2 + 2 AS BIGINT) AS range_rank
FROM (SELECT DISTINCT CAST(substr(CAST(o_orderdate AS STRING), 1, 4) AS INT) AS y FROM {orders}) b
"""

# regional payment-detail rows: one "file" per customer, dates as d-Mon-yyyy text
_DAY30 = "CAST(CAST(o_orderdate AS DATE) + 30 AS STRING)"
_DAY90 = "CAST(CAST(o_orderdate AS DATE) + 90 AS STRING)"
SQL["fx_payment_files"] = f"""
SELECT o_orderkey AS row_no, o_custkey AS file_order, 'PD_' || CAST(o_custkey AS STRING) AS file,
  substr({_DAY}, 1, 4) || CASE WHEN CAST(substr({_DAY}, 6, 2) AS INT) <= 6 THEN '_H1' ELSE '_H2' END AS file_name,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_custkey END AS deal_id,
  CAST(o_orderdate AS DATE) AS assignment_day,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 7 = 3 THEN 'n/a'
    WHEN o_orderkey % 2 = 0 THEN '  ' || {_dmy(_DAY)} || ' ' ELSE {_dmy(_DAY)} END AS contract_close_date,
  CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE {_dmy(_DAY30)} END AS funding_date,
  {_dmy(_DAY)} AS assignment_date,
  CASE WHEN o_orderkey % 5 = 0 THEN '31-Feb-2000' ELSE {_dmy(_DAY90)} END AS payment_due_date
FROM {{orders}}
"""

# sheet rows whose cells hold separators, quotes, line breaks and outer spaces
SQL["fx_export"] = """
SELECT CAST(o_orderkey AS STRING) AS row_no, 'deal, "' || CAST(o_custkey AS STRING) || '"' AS deal,
  CASE o_orderkey % 5 WHEN 0 THEN 'first line' || chr(10) || 'second "line"' || chr(13) || chr(10) || 'third' WHEN 1 THEN '"'
    WHEN 2 THEN '  spaced, out  ' WHEN 3 THEN 'back' || chr(92) || '"slash' || chr(10) || chr(10) ELSE NULL END AS note,
  'x' || substr(CAST(o_orderdate AS STRING), 1, 10) AS extra, o_orderkey % 3 AS part
FROM {orders}
"""


def load_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in TABLES}


def adapter(spark: SparkSession, sf_dir: str, name: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run adapter `name` on Spark over the parquet tables in `sf_dir`."""
    tables = tables or load_tables(spark, sf_dir)
    text = SQL[name]
    used = {t: df for t, df in tables.items() if "{" + t + "}" in text}
    df = spark.sql(text, **used)
    if name == "fx_ledger":
        from ledgerlake.schemas import conform_ledger
        df = conform_ledger(df)
    return df


def duck(name: str) -> str:
    """The same adapter as DuckDB SQL over the pre-registered views."""
    return SQL[name].format(**{t: t for t in TABLES})
