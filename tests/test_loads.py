"""B3 loads: ids, fan-out, patches collapsed == applied one by one, status, counts."""
from decimal import Decimal

from ledgerlake.operators.load import (collapse_patches, load_patch, load_payment, load_status, load_worklist,
                                       patch_conflicts, rows_written)
from ledgerlake.schemas import BATCH_LAYOUTS, conform_ledger, conform_master

D = Decimal


def batch(spark, kind, rows, errors=None):
    names, _ = BATCH_LAYOUTS[kind]
    data = [tuple([i + 1] + [r.get(n) for n in names] + [(errors or {}).get(i + 1)]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "seq_id long, " + ", ".join(f"{n} string" for n in names) + ", error_msg string")


def ledger(spark, rows):
    df = spark.createDataFrame(rows, "id long, deal_id string, invoice_num_ string, movement_type string, "
                                     "other_adjustment decimal(38,10), comments string, deal_type string")
    return conform_ledger(df)


def test_patch_collapse_equals_sequential(spark):
    L = ledger(spark, [(1, "d1", "A", "Initial movement", D(1), "old", "Upfront"),
                       (2, "d1", "A", "Initial movement", D(2), "old", "Upfront"),
                       (3, "d2", "B", "Initial movement", D(3), None, None)])
    patches = [dict(deal_id="d1", invoice_num="A", movement_type="Initial movement", other_adjustment="10",
                    comments=None),
               dict(deal_id="d1", invoice_num="A", movement_type="Initial movement", other_adjustment=None,
                    comments="c2"),
               dict(deal_id="d1", invoice_num="A", movement_type="Initial movement", other_adjustment="30",
                    comments=None),
               dict(deal_id="d2", invoice_num="B", movement_type="Initial movement", comments="x"),
               dict(deal_id="d2", invoice_num="B", movement_type="Initial movement", comments="bad")]
    B = batch(spark, "patch", patches, errors={5: "Invalid ..."})
    # brute force: apply clean patches one by one in seq order
    state = {1: {"other_adjustment": D(1), "comments": "old"}, 2: {"other_adjustment": D(2), "comments": "old"},
             3: {"other_adjustment": D(3), "comments": None}}
    keys = {1: ("d1", "A"), 2: ("d1", "A"), 3: ("d2", "B")}
    hits = 0
    for i, p in enumerate(patches, start=1):
        if i == 5:
            continue
        for rid, k in keys.items():
            if k == (p["deal_id"], p["invoice_num"]):
                hits += 1
                if p.get("other_adjustment") is not None:
                    state[rid]["other_adjustment"] = D(p["other_adjustment"])
                if p.get("comments") is not None:
                    state[rid]["comments"] = p["comments"]
    out = load_patch(B, L, as_of_ts="2024-01-01 00:00:00", user="u")
    got = {r["id"]: {"other_adjustment": r["other_adjustment"], "comments": r["comments"]} for r in out.collect()}
    assert got == state
    assert rows_written(out).first()["rows_written"] == hits == 7
    assert collapse_patches(B).count() == 2
    assert patch_conflicts(B).count() == 0


def test_status_load_last_clean_status(spark):
    L = ledger(spark, [(1, "d1", "A", "Initial movement", None, None, None),
                       (2, "d1", "B", "Adjustment", None, None, None),
                       (3, "d2", "C", "Initial movement", None, None, None)])
    B = batch(spark, "status", [dict(deal_id="d1", status="WIP"), dict(deal_id="d1", status="Standard"),
                                dict(deal_id="d1", status="Closed"), dict(deal_id="d2", status="WIP")],
              errors={3: "Invalid ..."})
    out = load_status(B, L, as_of_ts="2024-01-01 00:00:00", user="u")
    assert {r["id"]: r["status"] for r in out.collect()} == {1: "Standard", 2: "Standard", 3: "WIP"}
    assert rows_written(out).first()["rows_written"] == 5  # 2 updates x 2 rows + 1


def test_payment_load_ids_and_posting(spark):
    B = batch(spark, "ns_payment", [
        dict(status="WIP", deal_id="7", deal_type="Upfront", movement_type="Initial movement",
             adjustment_amount="5", original_invoice_amount="100", payment_discount="10"),
        dict(status="WIP", deal_id="8", deal_type="Upfront", movement_type="Apply to GL", adjustment_amount="x"),
        dict(status="WIP", deal_id="9", deal_type="Upfront", movement_type="Apply to GL", adjustment_amount="4",
             report_date="05-Jan-2024")], errors={2: "Invalid ADJUSTMENT_AMOUNT value. "})
    out = load_payment(B, "ns_payment", None, id_base=100, source="NetSuite", as_of_ts="2024-01-01 00:00:00",
                       user="u")
    rows = {r["deal_id"]: r for r in out.collect()}
    assert sorted(r["id"] for r in rows.values()) == [101, 102]
    assert rows["7"]["adjustment_amt"] == D(90)  # derived: 100 - 10
    assert str(rows["9"]["report_date"]) == "2024-01-05"
    assert rows_written(out).first()["rows_written"] == 2


def test_worklist_load_fans_out_over_master(spark):
    M = conform_master(spark.createDataFrame(
        [("7", "Cust A", "OFD Cloud", "OCE 1", None, "US"), ("7", "Cust A2", "OFD Cloud", "OCE 2", "CA", "US")],
        "deal_id string, customer_legal_name string, assignee_current string, oracle_contract_entity_oce string, "
        "oce_country string, country string"))
    B = batch(spark, "worklist", [dict(deal_id="7", funding_model="OFD Warehouse V2", outstanding_amount="12.5"),
                                  dict(deal_id="8", funding_model="OFD Warehouse")])
    out = load_worklist(B, M, None, id_base=0, source="NetSuite", as_of_ts="2024-01-01 00:00:00", user="u")
    rows = sorted((r["id"], r["customer_name"], r["country__oce_"], r["movement_type"], r["deal_type"])
                  for r in out.collect())
    assert rows == [(1, "Cust A", "US", "Initial setup WHv2", "Warehouse V2"),
                    (2, "Cust A2", "CA", "Initial setup WHv2", "Warehouse V2")]
