"""Scalar rules: aging boundaries, month arithmetic, date/number parsing, text cleaning."""
import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.functions import (aging_bucket, clean_invoice_text, funder_label, is_bad_date, is_bad_number,
                                  last_day_of_next_month, lenient_double, normalise_date_text, parse_date3,
                                  priority, product_type, split_pieces)


def one(spark, rows, schema, *exprs):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*exprs).collect()]


def test_aging_boundaries(spark):
    days = [-5, 0, 1, 30, 31, 60, 61, 90, 91, 180, 181, None]
    got = one(spark, [(d,) for d in days], "d int", aging_bucket("d"))
    assert [g[0] for g in got] == ["Current", "Current", "1 to 30", "1 to 30", "31 to 60", "31 to 60", "61 to 90",
                                   "61 to 90", "91 to 180", "91 to 180", "181+", None]


def test_last_day_of_next_month(spark):
    df = spark.createDataFrame([(dt.date(2023, 11, 20),), (dt.date(2023, 12, 3),), (dt.date(2024, 1, 31),)], "d date")
    got = [r[0] for r in df.select(last_day_of_next_month(F.col("d"))).collect()]
    assert got == [dt.date(2023, 12, 31), dt.date(2024, 1, 31), dt.date(2024, 2, 29)]


def test_parse_date3(spark):
    vals = ["2024-02-29", "2023-02-29", "05-Jan-2024", "05-jan-2024", "5-Jan-2024", "02/28/2024", "13/01/2024",
            "2024/99", None]
    got = one(spark, [(v,) for v in vals], "v string", parse_date3("v"), is_bad_date("v"))
    assert got == [(dt.date(2024, 2, 29), False), (None, True), (dt.date(2024, 1, 5), False),
                   (dt.date(2024, 1, 5), False), (None, True), (dt.date(2024, 2, 28), False), (None, True),
                   (None, True), (None, False)]


def test_to_number(spark):
    vals = ["12.5", " 7 ", "1e3", "1,000", "abc", "NaN", "1d", None]
    got = [g[0] for g in one(spark, [(v,) for v in vals], "v string", is_bad_number("v"))]
    assert got == [False, False, False, True, True, True, True, False]


def test_invoice_cleaning(spark):
    vals = ["#CM 12, NS 13", "  DM\t7  ", "INV-é1", "CM NS 12", None, "a  b"]
    got = one(spark, [(v,) for v in vals], "v string", clean_invoice_text("v"))
    assert [g[0] for g in got] == ["CM12 NS13", "DM7", "INV é1", "CMNS12", None, "a b"]


def test_split_pieces_keeps_empties(spark):
    got = one(spark, [("a  b",), (None,), ("",)], "v string", split_pieces("v"))
    assert [g[0] for g in got] == [["a", "", "b"], [""], [""]]


def test_lenient_double(spark):
    vals = ["1,200.50", "30", "n/a", "", "1d", ".5"]
    got = [g[0] for g in one(spark, [(v,) for v in vals], "v string", lenient_double("v", strip_commas=True))]
    assert got == [1200.5, 30.0, None, None, None, 0.5]


def test_normalise_date_text(spark):
    vals = [" 05-Jan-2024 ", "5-Jan-2024", "31-Feb-2024", "", None, "n/a"]
    got = [g[0] for g in one(spark, [(v,) for v in vals], "v string", normalise_date_text("v"))]
    assert got == ["1/5/2024", "1/5/2024", "", "", "", ""]


def test_labels(spark):
    rows = [("OFD Cloud X", 61, 5.0), ("OFD Cloud X", 60, 2e6), (None, 91, 5.0), ("x", 1, None), ("x", 0, 5.0)]
    got = [g[0] for g in one(spark, rows, "a string, d int, amt double", priority("a", "d", "amt"))]
    assert got == ["P1_C60", "P1_1M", "P1_90D", "P2", "P3"]
    names = ["OFD Servicer", "KeyBank", "Bank of America", "BAL Global Finance Canada", "SG Equip", "Wells Fargo",
             "Dext", "Other Co", None]
    got = [g[0] for g in one(spark, [(n,) for n in names], "n string", funder_label("n"))]
    assert got == ["OFD", "Key", "BAL_US", "BAL_CA", "SG", "WF", "DEXT", "Others", "Others"]
    got = [g[0] for g in one(spark, [("NS-1",), ("xNs",), ("123",), (None,)], "o string", product_type("o"))]
    assert got == ["NetSuite", "NetSuite", "Oracle", "Oracle"]
