"""End-to-end jobs on small files."""
import datetime as dt
import os

from ledgerlake import jobs
from ledgerlake.plans.adapters import adapter
from ledgerlake.sources.tables import to_staged

from .conftest import SF


def write_csv(path, header, rows):
    with open(path, "w") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join("" if v is None else str(v) for v in r) + "\n")


def test_funder_report_job(spark, tmp_dir):
    header = ["Payment Due Date", "YRX_STATUS", "YRX_ASSIGNEE", "Order Number", "Deal Association Type",
              "Adjustment_Terminated", "Administered", "Funder Name", "Open Amt", "Comments"]
    rows = [["2024-01-10", "Open", "OFD Cloud A", "NS-1", "Base", None, "Yes", "KeyBank", "100", "x"],
            ["2024-01-10", "Funded-Fully", "", "2", "Base", None, "Yes", "KeyBank", "100", "x"],
            ["2024-02-20", None, "Desk", "3", None, None, None, "Wells Fargo", "2000000", "y"]]
    write_csv(os.path.join(tmp_dir, "raw.csv"), header, rows)
    out = jobs.funder_report_job(spark, os.path.join(tmp_dir, "raw.csv"), tmp_dir + "/out", "2024-03-15")
    assert sorted(d for d in os.listdir(out) if d.startswith("funder=")) == ["funder=Key", "funder=WF"]
    back = spark.read.option("header", True).csv(out)
    assert "Comments" not in back.columns and "priority" in back.columns  # named sheet columns dropped


def test_worklist_job(spark, tmp_dir):
    write_csv(os.path.join(tmp_dir, "wl.csv"), ["Deal Id", "Funding Model", "Invoice Number", "Outstanding Amount",
                                                "Payment Discount"],
              [[1, "OFD Warehouse", "CM 1 NS 2", "10 20", 5], [2, "OFD Warehouse", "A B", "1", 3],
               [3, "OFD Warehouse V2", "X", "9", 1]])
    res = jobs.worklist_job(spark, os.path.join(tmp_dir, "wl.csv"), tmp_dir + "/wl", "2024-03-15")
    assert res["reconciled"] and res["n_exceptions"] == 1 and res["n_clean"] == 2


def test_payment_files_job(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "files")
    os.makedirs(folder)
    header = ["Deal Id", "Assignment Date", "Funding Date"]
    write_csv(os.path.join(folder, "a.csv"), header, [[1, "01-Feb-2024", "x"], [2, "05-Mar-2024", ""]])
    write_csv(os.path.join(folder, "b.csv"), header, [[3, "01-Feb-2024", ""], [4, "10-Mar-2024", ""]])
    write_csv(os.path.join(folder, "c.csv"), header, [[5, "01-Aug-2024", ""]])
    ranges = spark.createDataFrame([("Q1", dt.date(2024, 1, 1), dt.date(2024, 3, 31), 1)],
                                   "file_name string, start_date date, end_date date, range_rank long")
    got = {r["file"]: (r["new_name"], r["status"]) for r in
           jobs.payment_files_job(spark, folder, ranges, tmp_dir + "/pd").collect()}
    assert got == {"a.csv": ("Q1", "renamed"), "b.csv": (None, "conflict"), "c.csv": (None, "unmatched")}


def test_upload_batch_insert_and_update(spark, tmp_dir):
    ledger_path = tmp_dir + "/ledger"
    adapter(spark, SF, "fx_ledger").write.parquet(ledger_path)
    n0 = spark.read.parquet(ledger_path).count()
    b = adapter(spark, SF, "fx_batch").selectExpr(
        "seq_id", "status", "report_date", "deal_id", "deal_type", "movement_type", "amount AS adjustment_amount",
        "invoice_num AS invoice_number")
    to_staged(b, "ns_payment", "B1").write.parquet(tmp_dir + "/staged")
    res = jobs.upload_batch(spark, "ns_payment", tmp_dir + "/staged", "B1", ledger_path, source="NetSuite",
                            user="u", as_of_ts="2024-01-01 00:00:00")
    assert res["rows_written"] == res["batch_rows"] - res["rejected"] > 0
    assert spark.read.parquet(ledger_path).count() == n0 + res["rows_written"]
    st = adapter(spark, SF, "fx_status_batch")
    to_staged(st, "status", "S1").write.parquet(tmp_dir + "/staged_status")
    res2 = jobs.upload_batch(spark, "status", tmp_dir + "/staged_status", "S1", ledger_path,
                             new_ledger_path=tmp_dir + "/ledger_v2", user="u", as_of_ts="2024-01-02 00:00:00")
    assert spark.read.parquet(tmp_dir + "/ledger_v2").count() == n0 + res["rows_written"]
    assert res2["rows_written"] > 0


def html_table(header, rows):
    cells = lambda r, tag: "".join(f"<{tag}>{'' if v is None else v}</{tag}>" for v in r)
    return ("<html><body><table><tr>" + cells(header, "th") + "</tr>"
            + "".join("<tr>" + cells(r, "td") + "</tr>" for r in rows) + "</table></body></html>")


def test_worklist_job_from_html_xls(spark, tmp_dir):
    path = os.path.join(tmp_dir, "worklist.xls")
    with open(path, "w") as f:
        f.write(html_table(["Deal Id", "Funding Model", "Invoice Number", "Outstanding Amount", "Payment Discount"],
                           [[1, "OFD Warehouse", "#CM 1, NS 2", "1,000.50 20", 5], [2, "OFD Warehouse", "A B", "1", 3]]))
    res = jobs.worklist_job(spark, path, tmp_dir + "/wl", "2024-03-15")
    assert res["reconciled"] and res["n_exceptions"] == 1 and res["n_clean"] == 1


def test_payment_files_job_from_html(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "xls")
    os.makedirs(folder)
    header = ["Deal Id", "Assignment Date"]
    for name, rows in {"a.xls": [[1, "01-Feb-2024"], [2, "05-Mar-2024"]], "b.xls": [[3, "09-Sep-2024"]]}.items():
        with open(os.path.join(folder, name), "w") as f:
            f.write(html_table(header, rows))
    ranges = spark.createDataFrame([("Q1", dt.date(2024, 1, 1), dt.date(2024, 3, 31), 1)],
                                   "file_name string, start_date date, end_date date, range_rank long")
    got = {r["file"]: (r["new_name"], r["status"]) for r in
           jobs.payment_files_job(spark, folder, ranges, tmp_dir + "/pd", glob="*.xls").collect()}
    assert got == {"a.xls": ("Q1", "renamed"), "b.xls": (None, "unmatched")}


def test_funder_report_job_from_html(spark, tmp_dir):
    header = ["Payment Due Date", "YRX_STATUS", "YRX_ASSIGNEE", "Order Number", "Deal Association Type",
              "Adjustment_Terminated", "Administered", "Funder Name", "Open Amt"]
    path = os.path.join(tmp_dir, "raw.xls")
    with open(path, "w") as f:
        f.write(html_table(header, [["1/10/2024", "Open", "OFD Cloud A", "NS-1", "Base", None, "Yes", "Dext Co", "100"]]))
    out = jobs.funder_report_job(spark, path, tmp_dir + "/out", "2024-03-15")
    assert [d for d in os.listdir(out) if d.startswith("funder=")] == ["funder=DEXT"]


def test_split_and_csv_jobs(spark, tmp_dir):
    path = os.path.join(tmp_dir, "pdr.xls")
    with open(path, "w") as f:
        f.write(html_table(["Deal Id", "Amount"], [[i, i * 10] for i in range(7)]))
    out = jobs.split_job(spark, path, tmp_dir + "/split", "2024-03-15")
    got = sorted((int(r["Deal Id"]), r["half"]) for r in out.collect())
    assert got == [(0, 1), (1, 1), (2, 1), (3, 2), (4, 2), (5, 2), (6, 2)]
    assert sorted(os.listdir(tmp_dir + "/split/20240315"))[-2:] == ["half=1", "half=2"]
    res = jobs.to_csv_job(spark, path, tmp_dir + "/pdr_csv")
    assert res == {"source_rows": 7, "written_rows": 7, "ok": True}


def test_payment_files_job_exclusions(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "ex")
    os.makedirs(folder)
    write_csv(os.path.join(folder, "f.csv"), ["Deal Id", "Assignment Date"],
              [[1, "01-Feb-2024"], [2, "02-Feb-2024"], [None, "03-Feb-2024"]])
    ranges = spark.createDataFrame([], "file_name string, start_date date, end_date date, range_rank long")
    excl = spark.createDataFrame([("f.csv", 2)], "file_name string, deal_id long")
    jobs.payment_files_job(spark, folder, ranges, tmp_dir + "/out", exclusions=excl)
    back = spark.read.parquet(tmp_dir + "/out/normalised")
    assert sorted((r["deal_id"] or "-") for r in back.collect()) == ["-", "1"]


def test_upload_batch_into_bucketed_ledger(spark, tmp_dir):
    from ledgerlake.operators.sinks import append_counted
    from ledgerlake.schemas import with_deal_bucket
    ledger_path = tmp_dir + "/bledger"
    n0 = append_counted(with_deal_bucket(adapter(spark, SF, "fx_ledger")), ledger_path, partition_by=("deal_bucket",))
    b = adapter(spark, SF, "fx_batch").selectExpr(
        "seq_id", "status", "report_date", "deal_id", "deal_type", "movement_type", "amount AS adjustment_amount")
    to_staged(b, "o_payment", "B9").write.parquet(tmp_dir + "/st9")
    res = jobs.upload_batch(spark, "o_payment", tmp_dir + "/st9", "B9", ledger_path, source="Oracle", user="u",
                            as_of_ts="2024-01-01 00:00:00", partition_by=("deal_bucket",))
    back = spark.read.parquet(ledger_path)
    assert back.count() == n0 + res["rows_written"] and res["rows_written"] > 0
    assert back.filter("deal_bucket IS NULL").count() == 0
    st = adapter(spark, SF, "fx_status_batch")
    to_staged(st, "status", "S9").write.parquet(tmp_dir + "/sst9")
    res2 = jobs.upload_batch(spark, "status", tmp_dir + "/sst9", "S9", ledger_path, new_ledger_path=tmp_dir + "/v2",
                             user="u", as_of_ts="2024-01-02 00:00:00", partition_by=("deal_bucket",))
    assert spark.read.parquet(tmp_dir + "/v2").count() == back.count() and res2["rows_written"] > 0


def test_status_update_rewrites_only_touched_buckets(spark, tmp_dir):
    from ledgerlake.operators.sinks import append_counted
    from ledgerlake.schemas import with_deal_bucket
    ledger_path = tmp_dir + "/bl"
    n0 = append_counted(with_deal_bucket(adapter(spark, SF, "fx_ledger")), ledger_path, partition_by=("deal_bucket",))
    before = {r["id"]: r["status"] for r in spark.read.parquet(ledger_path).collect()}
    st = spark.createDataFrame([(1, "5", "Further Checking")], "seq_id long, deal_id string, status string")
    to_staged(st, "status", "S").write.parquet(tmp_dir + "/s")
    res = jobs.upload_batch(spark, "status", tmp_dir + "/s", "S", ledger_path, user="u",
                            as_of_ts="2024-01-02 00:00:00", partition_by=("deal_bucket",))
    after = spark.read.parquet(ledger_path)
    assert after.count() == n0 and res["buckets_rewritten"] == 1
    changed = {r["id"]: r["status"] for r in after.collect() if before[r["id"]] != r["status"]}
    deal5 = {r["id"] for r in after.filter("deal_id = '5'").collect()}
    assert set(changed) <= deal5 and all(v == "Further Checking" for v in changed.values())
    assert after.filter("deal_id = '5'").filter("status <> 'Further Checking'").count() == 0


def test_command_line(spark, tmp_dir, capsys):
    from ledgerlake.__main__ import main
    path = os.path.join(tmp_dir, "p.csv")
    write_csv(path, ["Deal Id", "Amount"], [[1, 2], [3, 4], [5, 6]])
    res = main(["to-csv", "--file", path, "--out", tmp_dir + "/p_out"], spark=spark)
    assert res == {"source_rows": 3, "written_rows": 3, "ok": True}
    assert '"ok": true' in capsys.readouterr().out


def test_payment_files_job_skips_names_present_in_folder(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "taken")
    os.makedirs(folder)
    header = ["Deal Id", "Assignment Date"]
    write_csv(os.path.join(folder, "a.csv"), header, [[1, "01-Feb-2024"], [2, "05-Mar-2024"]])
    write_csv(os.path.join(folder, "Q1.csv"), header, [[3, "01-Jan-2020"], [4, "01-Jan-2020"]])
    ranges = spark.createDataFrame([("Q1.csv", dt.date(2024, 1, 1), dt.date(2024, 3, 31), 1),
                                    ("Q1b.csv", dt.date(2024, 1, 1), dt.date(2024, 3, 31), 2)],
                                   "file_name string, start_date date, end_date date, range_rank long")
    got = {r["file"]: (r["new_name"], r["status"]) for r in
           jobs.payment_files_job(spark, folder, ranges, tmp_dir + "/pt").collect()}
    assert got == {"a.csv": ("Q1b.csv", "renamed"), "Q1.csv": (None, "unmatched")}


def test_payment_files_job_bad_cell_date_is_unmatched(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "bad")
    os.makedirs(folder)
    write_csv(os.path.join(folder, "a.csv"), ["Deal Id", "Assignment Date"], [[1, "01-Feb-2024"], [2, "31-Feb-2024"]])
    ranges = spark.createDataFrame([("Q1", dt.date(2024, 1, 1), dt.date(2024, 3, 31), 1)],
                                   "file_name string, start_date date, end_date date, range_rank long")
    got = {r["file"]: r["status"] for r in jobs.payment_files_job(spark, folder, ranges, tmp_dir + "/pb").collect()}
    assert got == {"a.csv": "unmatched"}
