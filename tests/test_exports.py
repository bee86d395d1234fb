"""Exports of any header and kind, told by content, records with quoted cells."""
import csv
import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.sinks import CSV_OPTIONS, to_csv
from ledgerlake.sources.sniff import header_of, kind_of, sniff_format
from ledgerlake.sources.tables import read_export, read_ranges, read_sheet_export


def write(path, rows, **kw):
    with open(path, "w", newline="", **kw) as f:
        csv.writer(f).writerows(rows)


def shown(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_own_csv_with_line_breaks_quotes_and_spaces_comes_back(spark, tmp_dir):
    rows = [("a\nb", 'x "y", z', "1"), ('"', ",", "\\"), ('a\\"b', "c\\", '"\n"'), ("  out ", "\r\n q", "\n"), ('""', "a,b\n\n,c", "'")]
    df = spark.createDataFrame(rows, "a string, `b b` string, c string").repartition(3)
    to_csv(df, f"{tmp_dir}/out")
    assert shown(read_export(spark, f"{tmp_dir}/out", "*.csv"), "a", "b b", "c") == sorted(rows)
    assert shown(read_sheet_export(spark, f"{tmp_dir}/out"), "a", "b b", "c") == sorted(rows)


def test_a_thousand_files_of_two_hundred_headers_are_one_scan(spark, tmp_dir):
    rng, want = random.Random(3), []
    for k in range(1000):
        names = ["Deal Id", *[f"Col {(k % 200 + j) % 40}" for j in range(k % 5)]]
        rng.shuffle(names)
        cells = {n: f"{n}\n{k}" if rng.random() < 0.3 else f"v{k}" for n in names}
        cells["Deal Id"] = str(k)
        write(f"{tmp_dir}/f{k:04d}.csv", [names, [cells[n] for n in names]])
        want.append((str(k), cells.get("Col 7"), cells.get("Col 39")))
    out = read_export(spark, tmp_dir)
    assert shown(out, "Deal Id", "Col 7", "Col 39") == sorted(want, key=lambda r: r[0])
    assert out._jdf.queryExecution().sparkPlan().toString().count("FileScan csv") == 1


def test_files_are_told_by_content(spark, tmp_dir):
    table = "<table><tr><th>A</th></tr><tr><td>html</td></tr></table>"
    for name, data in {"page.csv": f"<!DOCTYPE html><html><body>{table}</body></html>".encode(), "sheet.xls": b"A,B\n1,2\n",
                       "bom.txt": "﻿a,B\r\n\r\n3,4\r\n".encode(), "none.csv": b"", "only.csv": b"A\n", "half.csv": b"\n\nA,B"}.items():
        with open(f"{tmp_dir}/{name}", "wb") as f:
            f.write(data)
    with gzip.open(f"{tmp_dir}/z.csv.gz", "wt") as f:
        f.write("B\nzipped\n")
    spark.createDataFrame([("p", 7)], "A string, N int").coalesce(1).write.parquet(f"{tmp_dir}/q")
    part = next(n for n in os.listdir(f"{tmp_dir}/q") if n.endswith(".parquet"))
    os.replace(f"{tmp_dir}/q/{part}", f"{tmp_dir}/stored.dat")
    kinds = {os.path.basename(r["path"]): r["format"] for r in sniff_format(spark, tmp_dir).collect()}
    assert kinds == {"page.csv": "html", "sheet.xls": "csv", "bom.txt": "csv", "only.csv": "csv", "half.csv": "csv",
                     "z.csv.gz": "csv", "stored.dat": "parquet"}
    got = shown(read_export(spark, tmp_dir).select(*[F.coalesce(c, F.lit("-")).alias(c) for c in ("A", "B", "N")]), "A", "B", "N")
    assert got == sorted([("html", "-", "-"), ("1", "2", "-"), ("3", "4", "-"), ("-", "zipped", "-"), ("p", "-", "7")])


def test_binary_files_are_refused_by_name(spark, tmp_dir):
    write(f"{tmp_dir}/ok.csv", [["A"], ["1"]])
    for name, data in {"real.xls": bytes.fromhex("D0CF11E0A1B11AE1") + b"\0" * 64, "book.csv": b"PK\x03\x04" + b"x" * 9, "b.csv": b"a\0b"}.items():
        with open(f"{tmp_dir}/{name}", "wb") as f:
            f.write(data)
        with pytest.raises(ValueError, match=name):
            read_export(spark, f"{tmp_dir}/{name}")
    assert read_export(spark, tmp_dir, "ok*").count() == 1


def test_headers_with_quotes_repeats_gaps_and_odd_file_names(spark, tmp_dir):
    write(f"{tmp_dir}/a [1] {{x}}.csv", [["Deal\nId", "", "X", "x", 'q"q'], ["1", "2", "3", "4", "5"], ["6"]])
    with open(f"{tmp_dir}/b.xls", "w") as f:
        f.write("<table><tr><td>X</td></tr><tr><td>h</td></tr></table>")
    out = read_export(spark, tmp_dir)
    assert out.columns == ["Deal\nId", "_c1", "X2", "x3", 'q"q', "X", "_file", "_row"]
    rows = sorted((tuple(r)[:6] for r in out.collect()), key=str)
    assert rows == [("1", "2", "3", "4", "5", None), ("6", None, None, None, None, None), (None, None, None, None, None, "h")]


def test_header_of_a_prefix():
    assert header_of(b'a,"b\n,""c"\n1', True, "f") == (["a", 'b\n,"c'], False)
    assert header_of(b"a,b", True, "f") == (["a", "b"], False) and header_of(b"\n\n", True, "f") == (None, False)
    assert header_of(b'"a\n",b\r\n1', True, "f") == (["a\n", "b"], True)
    with pytest.raises(ValueError, match="carriage"):
        header_of(b"a,b\r1,2\r", True, "f")
    with pytest.raises(ValueError, match="longer"):
        header_of(b"a,b", False, "f")
    assert kind_of(b"  <TABLE>", "x.csv") == "html" and kind_of(b"<a>,b", "x.csv") == "csv" and kind_of(b"<p>", "x.xls") == "html"


def test_an_empty_folder_file_and_ranges(spark, tmp_dir):
    open(f"{tmp_dir}/e.csv", "w").close()
    with pytest.raises(FileNotFoundError):
        read_export(spark, tmp_dir)
    with open(f"{tmp_dir}/crlf.csv", "wb") as f:
        f.write(b'a,"b\r\nc"\r\n1,\r\n2,"x\r\ny"\r\n3\r\n4,z\r\n')
    out = read_export(spark, tmp_dir, "*.csv")
    assert out.columns[:2] == ["a", "b\r\nc"]
    assert sorted((tuple(r)[:2] for r in out.collect()), key=str) == [("1", None), ("2", "x\r\ny"), ("3", None), ("4", "z")]
    rows = spark.createDataFrame([("N, \"1\"", "2024-01-01", "2024-03-31")], "`File Name` string, `Start Date` string, `End Date` string")
    rows.coalesce(1).write.options(**CSV_OPTIONS).option("header", True).csv(f"{tmp_dir}/r")
    got = read_ranges(spark, f"{tmp_dir}/r").first()
    assert got["file_name"] == 'N, "1"' and str(got["end_date"]) == "2024-03-31"
