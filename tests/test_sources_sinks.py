"""Scans (positional batches, HTML tables, format sniffing) and sinks."""
import os

from pyspark.sql import functions as F

from ledgerlake.operators.quality import constraint_report, row_count_check
from ledgerlake.operators.sinks import append_counted, write_by
from ledgerlake.sources import read_batch, read_html_tables, sniff_format, to_staged
from ledgerlake.sources.html import first_table, html_table_rows, parse_tables

HTML = """<html><body><p>x</p><table><tr><th>Deal Id</th><th>Amount</th></tr>
<tr><td>1</td><td> 1,200 </td></tr><tr><td>2</td><td>3</td></tr></table>
<table><tr><td>other</td></tr></table></body></html>"""


def test_read_batch_positional(spark):
    staged = spark.createDataFrame([("B", 1, "10", "WIP"), ("B", 2, "", "Standard"), ("C", 3, "11", "WIP")],
                                   "collection_name string, seq_id long, c001 string, c002 string")
    got = [tuple(r) for r in read_batch(staged, "status", "B").orderBy("seq_id").collect()]
    assert got == [(1, "10", "WIP"), (2, None, "Standard")]
    back = read_batch(to_staged(read_batch(staged, "status", "B"), "status", "B"), "status", "B")
    assert [tuple(r) for r in back.orderBy("seq_id").collect()] == got


def test_parse_tables():
    rows = parse_tables(HTML)
    assert rows[0] == (0, 0, ["Deal Id", "Amount"]) and rows[1] == (0, 1, ["1", "1,200"])
    assert rows[-1] == (1, 0, ["other"])


def test_html_files_and_sniff(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "Report.XLS"), "w") as f:
        f.write(HTML)
    with open(os.path.join(tmp_dir, "real.xls"), "wb") as f:
        f.write(bytes.fromhex("D0CF11E0A1B11AE1") + b"\0" * 16)
    with open(os.path.join(tmp_dir, "t.csv"), "w") as f:
        f.write("a,b\n1,2\n")
    fmt = {os.path.basename(r["path"]): r["format"] for r in sniff_format(spark, tmp_dir).collect()}
    assert fmt == {"Report.XLS": "html", "real.xls": "xls", "t.csv": "csv"}
    rows = read_html_tables(spark, tmp_dir, glob="*.XLS")
    table = first_table(rows, ["deal_id", "amount"]).orderBy("row_no").collect()
    assert [(r["deal_id"], r["amount"]) for r in table] == [("1", "1,200"), ("2", "3")]


def test_html_column(spark):
    df = spark.createDataFrame([(1, HTML), (2, "<p>no table</p>"), (3, None)], "id long, html string")
    assert html_table_rows(df, "id", "html").count() == 4


def test_sinks_and_checks(spark, tmp_dir):
    df = spark.createDataFrame([("OFD", 1), ("Key", 2), ("OFD", 3)], "funder string, n long")
    path = write_by(df, "funder", tmp_dir + "/report", "2024-05-01")
    assert sorted(p for p in os.listdir(path) if p.startswith("funder=")) == ["funder=Key", "funder=OFD"]
    assert append_counted(df, tmp_dir + "/ledger") == 3
    assert append_counted(df, tmp_dir + "/ledger") == 3
    assert spark.read.parquet(tmp_dir + "/ledger").count() == 6
    chk = row_count_check(df, tmp_dir + "/csv").first()
    assert chk["ok"] and chk["source_rows"] == 3


def test_constraint_report(spark):
    from ledgerlake.schemas import conform_ledger
    rows = spark.createDataFrame([
        (1, "a", "NetSuite", "Exceptional move", "Upfront", "Initial movement", None),
        (1, "b", "Oracle", "Standard", "Warehouse V2", "7.05 Auto Reversal", None),
        (2, None, None, None, None, None, None)],
        "id long, deal_id string, source string, status string, deal_type string, movement_type string, "
        "report_date date")
    got = {r["constraint_name"]: r["violations"] for r in constraint_report(conform_ledger(rows)).collect()}
    assert got == {"CHK_SOURCE_STATUS": 1, "OMOVEDEALCOMBINATION": 2, "REPORT_DATE_MANDATORY": 1,
                   "NSMOVEDEALCOMBINATION": 1, "DEAL_ID_NOT_NULL": 1, "PK_ID": 2}


def test_file_name_pieces_and_preview(spark, tmp_dir):
    from ledgerlake.functions.text import file_dir_of, file_ext_of, file_name_of
    from ledgerlake.sources.tables import preview, read_sheet_export
    df = spark.createDataFrame([("/a/b/Report.XLSX",), ("C:\\x\\y.csv",), ("noext",)], "p string")
    got = [tuple(r) for r in df.select(file_dir_of("p"), file_name_of("p"), file_ext_of("p")).collect()]
    assert got == [("/a/b", "Report.XLSX", ".xlsx"), ("C:\\x", "y.csv", ".csv"), ("", "noext", "")]
    path = os.path.join(tmp_dir, "s.csv")
    with open(path, "w") as f:
        f.write("a,b\n" + "".join(f"{i},x{i}\n" for i in range(20)))
    assert [r["a"] for r in preview(read_sheet_export(spark, path)).collect()] == ["0", "1", "2", "3", "4"]


def test_parse_tables_spans():
    html = ("<table><tr><th colspan=2>Deal</th><th rowspan=3>Due</th></tr>"
            "<tr><td>Id</td><td>Name</td></tr><tr><td>1</td><td>A</td></tr></table>")
    assert [r[2] for r in parse_tables(html)] == [["Deal", "Deal", "Due"], ["Id", "Name", "Due"], ["1", "A", "Due"]]
    nested = "<table><tr><td>a<table><tr><td>in</td></tr></table></td><td>b</td></tr></table>"
    rows = parse_tables(nested)
    assert (1, 0, ["in"]) in rows and (0, 0, ["a", "b"]) in rows
