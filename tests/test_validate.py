"""B2: one staged row per check, exact message text (and the order of texts)."""
import pytest

from ledgerlake.operators import validate as V
from ledgerlake.schemas import BATCH_LAYOUTS, conform_ledger, conform_master

INIT = "Initial movement"


def ledger(spark, rows):
    cols = ["id", "deal_id", "source", "status", "movement_type", "assignee", "invoice_num_", "report_date"]
    import datetime as dt
    data = [tuple(dt.date.fromisoformat(r[c]) if c == "report_date" and r.get(c) else r.get(c) for c in cols)
            for r in rows]
    df = spark.createDataFrame(data, "id long, deal_id string, source string, status string, movement_type string, "
                                     "assignee string, invoice_num_ string, report_date date")
    return conform_ledger(df)


def master(spark, rows):
    cols = ["deal_id", "assignee_current", "complete_part1", "complete_part2", "complete_part3"]
    df = spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows],
                               ", ".join(f"{c} string" for c in cols))
    return conform_master(df)


def batch(spark, kind, rows):
    names, _ = BATCH_LAYOUTS[kind]
    data = [tuple([i + 1] + [r.get(n) for n in names]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "seq_id long, " + ", ".join(f"{n} string" for n in names))


def msgs(df):
    return [r["error_msg"] for r in df.orderBy("seq_id").collect()]


def test_worklist(spark):
    L = ledger(spark, [dict(id=1, deal_id="10", movement_type=INIT, assignee="Ann"),
                       dict(id=2, deal_id="11", movement_type=INIT, assignee="Bob")])
    M = master(spark, [dict(deal_id="10", assignee_current="Ann", complete_part1="Y", complete_part2="Y"),
                       dict(deal_id="11", assignee_current="Zed", complete_part1="Y", complete_part2="Y"),
                       dict(deal_id="12", complete_part1="Y", complete_part2="Y", complete_part3="Y")])
    B = batch(spark, "worklist", [
        dict(deal_id=None, funding_model=None),
        dict(deal_id="12", funding_model="Bad"),
        dict(deal_id="10", funding_model="OFD Warehouse"),
        dict(deal_id="10", funding_model="OFD Warehouse V2"),
        dict(deal_id="11", funding_model="Funded Admin"),
    ])
    assert msgs(V.validate_worklist(B, L, M)) == [
        "DEAL_ID cannot be null. FUNDING_MODEL cannot be null. ",
        "DEAL_ID does not meet import criteria. Invalid FUNDING_MODEL value. ",
        "Duplicate entries found. ",
        None,
        None,
    ]


def test_ns_payment(spark):
    L = ledger(spark, [dict(id=1, deal_id="5", source="NetSuite", movement_type=INIT, status="WIP"),
                       dict(id=2, deal_id="6", source="NetSuite", movement_type=INIT, status="Standard"),
                       dict(id=3, deal_id="4", source="NetSuite", movement_type=INIT, status="Standard")])
    ok = dict(status="WIP", adjustment_amount="1", deal_type="Warehouse V2")
    B = batch(spark, "ns_payment", [
        dict(ok, deal_id="1", movement_type=INIT, deal_type="Upfront"),                          # V6
        dict(ok, deal_id="2", movement_type="Apply to GL", deal_type="Upfront"),                 # V7
        dict(ok, deal_id="5", movement_type="Apply to GL", deal_type="Upfront"),                 # V8 (ledger)
        dict(ok, deal_id=None, movement_type="Apply to GL"),                                     # V9
        dict(ok, deal_id="4", movement_type="Payment JE reclass", deal_type="Upfront"),          # V10
        dict(ok, deal_id="6", movement_type=INIT, status="Standard"),                            # V11
        dict(ok, deal_id="6", movement_type=INIT, status="Closed", report_date="2024/99"),       # V12, V13
        dict(ok, deal_id="4", movement_type="Nope", deal_type="Odd"),                            # V14, V15
        dict(ok, deal_id="6", movement_type=INIT, adjustment_amount=None, other_adjustment="x",
             original_invoice_amount="1,0", payment_discount="NaN", payment_applied_to_invoice="1d",
             ofs_payment_posting="Maybe", payment_source="Fax"),                                 # V16-V22
        dict(ok, deal_id="6", movement_type=INIT, adjustment_amount="abc"),
    ])
    assert msgs(V.validate_ns_payment(B, L)) == [
        "Please use Worklist Upload for Upfront deals. ",
        "DEAL_ID with Initial movement does not exist.",
        "Not all balance of DEAL_ID is moved. ",
        "DEAL_ID cannot be null. ",
        "Invalid combination of DEAL_TYPE and MOVEMENT_TYPE.",
        'Report date cannot be null for deals with STATUS as "Standard". ',
        "Invalid STATUS value. Report date invalid format. ",
        "Invalid DEAL_TYPE value. Invalid MOVEMENT_TYPE value. ",
        "ADJUSTMENT_AMOUNT cannot be null. Invalid OTHER_ADJUSTMENT value. Invalid ORIGINAL_INVOICE_AMOUNT value. "
        "Invalid PAYMENT_DISCOUNT value. Invalid PAYMENT_APPLIED_TO_INVOICE value. "
        "Invalid OFS_PAYMENT_POSTING value. Please provide 'Yes' or 'No'. Invalid PAYMENT_SOURCE value. ",
        "Invalid ADJUSTMENT_AMOUNT value. ",
    ]


def test_ns_payment_reads_earlier_errors(spark):
    """V8's batch arm sees initial rows that failed earlier in the loop only."""
    L = ledger(spark, [])
    ok = dict(status="Standard", report_date="2024-01-31", adjustment_amount="1", deal_type="Warehouse V2")
    B = batch(spark, "ns_payment", [
        dict(ok, deal_id="9", movement_type="Apply to GL", deal_type="Upfront"),   # seq 1: before the bad initial
        dict(ok, deal_id="9", movement_type=INIT, payment_source="Fax"),          # seq 2: initial, fails
        dict(ok, deal_id="9", movement_type="Apply to GL", deal_type="Upfront"),   # seq 3: after it
    ])
    assert msgs(V.validate_ns_payment(B, L)) == [None, "Invalid PAYMENT_SOURCE value. ",
                                                 "Not all balance of DEAL_ID is moved. "]


def test_o_payment(spark):
    L = ledger(spark, [dict(id=1, deal_id="5", source="Oracle", movement_type=INIT, status="WIP")])
    ok = dict(status="WIP", adjustment_amount="1")
    B = batch(spark, "o_payment", [
        dict(ok, deal_id="1", movement_type=INIT, deal_type="7.05 Exception"),                   # V23
        dict(ok, deal_id="2", movement_type="Adjustment", deal_type="7.05 Exception"),           # V24
        dict(ok, deal_id="5", movement_type="Adjustment", deal_type="7.05 Exception"),           # V25
        dict(ok, deal_id="5", status=None, movement_type="Adjustment", deal_type="7.05 Exception"),  # NULL status
        dict(ok, deal_id=None),                                                                  # V26
        dict(ok, deal_id="5", movement_type="7.05 Auto Reversal", deal_type="Warehouse v2"),     # V28 + V31
        dict(ok, deal_id="5", movement_type=INIT, deal_type="Warehouse V2", other_adjustment="z"),  # V34 twice
    ])
    assert msgs(V.validate_o_payment(B, L)) == [
        "Please use Worklist Upload for Non-Warehouse V2 deals. ",
        "DEAL_ID with Initial movement does not exist.",
        "Not all balance of DEAL_ID is moved. ",
        None,
        "DEAL_ID cannot be null. ",
        "Not all balance of DEAL_ID is moved. "
        "Invalid combination of DEAL_TYPE and MOVEMENT_TYPE.Invalid DEAL_TYPE value. Invalid MOVEMENT_TYPE value. ",
        "Invalid OTHER_ADJUSTMENT value. Invalid OTHER_ADJUSTMENT value. ",
    ]


def test_o_exception(spark):
    L = ledger(spark, [dict(id=1, deal_id="7", source="NetSuite", movement_type=INIT),
                       dict(id=2, deal_id="8", source="Oracle", movement_type=INIT),
                       dict(id=3, deal_id="10", source="NetSuite", movement_type=INIT)])
    M = master(spark, [dict(deal_id="7", complete_part1="Y", complete_part2="Y"),
                       dict(deal_id="9", complete_part1="Y", complete_part2="Y")])
    ok = dict(status="Standard", report_date="2024-01-01", amount="1", deal_type="7.05 Exception")
    B = batch(spark, "o_exception", [
        dict(ok, deal_id="1", movement_type=INIT),                                    # V37
        dict(ok, deal_id="7", movement_type=INIT),                                    # V38
        dict(ok, deal_id="10", movement_type="Adjustment"),                           # V39 (NetSuite initial only)
        dict(ok, deal_id="8", movement_type="7.05 Auto Reversal"),                    # V42
        dict(ok, deal_id="9", movement_type=INIT, status="WIP", amount=None,
             gl_date_for_adjustment="31/31/2020"),                                    # V44 twice, V48, V49
        dict(ok, deal_id=None, movement_type=INIT),                                   # V40
    ])
    assert msgs(V.validate_o_exception(B, L, M)) == [
        "DEAL_ID does not meet import criteria. ",
        "Duplicate entries. ",
        "DEAL_ID with Initial movement does not exist.",
        'GL_DATE_FOR_ADJUSTMENT cannot be null for MOVEMENT_TYPE as "7.05 Auto Reversal". ',
        "Invalid STATUS value. Invalid STATUS value. AMOUNT cannot be null. GL_DATE_FOR_ADJUSTMENT invalid format. ",
        "DEAL_ID cannot be null. ",
    ]


def test_status(spark):
    L = ledger(spark, [dict(id=1, deal_id="1", source="NetSuite", report_date=None),
                       dict(id=2, deal_id="2", source="Oracle", report_date="2024-01-01"),
                       dict(id=3, deal_id="3", source="NetSuite", report_date="2024-01-01")])
    B = batch(spark, "status", [
        dict(deal_id=None, status=None),
        dict(deal_id="99", status="WIP"),
        dict(deal_id="1", status="Standard"),
        dict(deal_id="2", status="Closed"),
        dict(deal_id="3", status="Exceptional move"),
        dict(deal_id="3", status="WIP"),
    ])
    assert msgs(V.validate_status(B, L)) == [
        "DEAL_ID cannot be null. Status cannot be null. ",
        "DEAL_ID does not exist in Database. ",
        'Report date cannot be null for deals with STATUS as "Standard". ',
        "Invalid STATUS value for Oracle deal. ",
        "Invalid STATUS value for NetSuite deal. ",
        None,
    ]


def test_patch(spark):
    L = ledger(spark, [dict(id=1, deal_id="1", invoice_num_="A", movement_type=INIT)])
    B = batch(spark, "patch", [
        dict(deal_id="1", invoice_num="A", movement_type=INIT),
        dict(deal_id="1", invoice_num=None, movement_type=INIT),
        dict(deal_id=None, movement_type="Adjustment", deal_type="X", report_date="1-1-2020", other_adjustment="q"),
    ])
    assert msgs(V.validate_patch(B, L)) == [
        None,
        "Record does not exist in Database. ",
        "DEAL_ID cannot be null. Report date invalid format. Invalid DEAL_TYPE value. "
        'Invalid MOVEMENT_TYPE value; it should only be "Initial movement" Invalid OTHER_ADJUSTMENT value. ',
    ]
