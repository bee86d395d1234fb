"""B4 naming (against a brute-force serial walk), W4 halves, F17 exclusion, S10 cell_at."""
import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerlake.operators.files import assign_names, exclude_deals, split_halves
from ledgerlake.sources.tables import cell_at


def serial_names(files, ranges, existing):
    """The reference's loop: files in listing order, ranges in table order,
    skip a taken name and go on, take the first free one."""
    taken = set(existing)
    out = {}
    for f, _order, d in sorted(files, key=lambda x: x[1]):
        out[f] = (None, "unmatched")
        matched = False
        for name, start, end, _rank in sorted(ranges, key=lambda r: r[3]):
            if d is not None and start <= d <= end:
                matched = True
                if name in taken:
                    continue
                taken.add(name)
                out[f] = (name, "renamed")
                break
        if matched and out[f][0] is None:
            out[f] = (None, "conflict")
    return out


def run(spark, files, ranges, existing=()):
    fdf = spark.createDataFrame(files, "file string, file_order long, cell_date date")
    rdf = spark.createDataFrame(ranges, "file_name string, start_date date, end_date date, range_rank long")
    edf = spark.createDataFrame([(e,) for e in existing], "name string") if existing else None
    return {r["file"]: (r["new_name"], r["status"]) for r in assign_names(fdf, rdf, edf).collect()}


def test_overlapping_ranges_match_serial_walk(spark):
    rnd = random.Random(7)
    base = dt.date(2020, 1, 1)
    ranges = []
    for i in range(12):
        s = base + dt.timedelta(days=rnd.randint(0, 300))
        ranges.append((f"N{i % 8}", s, s + dt.timedelta(days=rnd.randint(10, 120)), i))
    files = [(f"f{i:03d}", i, base + dt.timedelta(days=rnd.randint(0, 400)) if i % 17 else None) for i in range(60)]
    existing = ["N3"]
    assert run(spark, files, ranges, existing) == serial_names(files, ranges, existing)


def test_non_overlapping_one_pass(spark):
    d = dt.date
    ranges = [("H1", d(2020, 1, 1), d(2020, 6, 30), 1), ("H2", d(2020, 7, 1), d(2020, 12, 31), 2)]
    files = [("b", 2, d(2020, 2, 1)), ("a", 1, d(2020, 3, 1)), ("c", 3, d(2021, 1, 1)), ("e", 5, d(2020, 8, 1))]
    assert run(spark, files, ranges) == serial_names(files, ranges, [])


def test_split_halves(spark):
    for n in (1, 2, 7, 100):
        df = spark.range(n).withColumn("k", (F.col("id") * 7919) % 10007).repartition(5)
        got = {r["k"]: r["half"] for r in split_halves(df, ["k"]).collect()}
        keys = sorted(got)
        assert [got[k] for k in keys] == [1] * (n // 2) + [2] * (n - n // 2)


def test_exclude_deals_keeps_null(spark):
    rows = spark.createDataFrame([("f1", 1, 5), ("f1", 2, None), ("f2", 3, 5), ("f1", 4, 6)],
                                 "file_name string, row_no long, deal_id long")
    pairs = spark.createDataFrame([("f1", 5)], "file_name string, deal_id long")
    assert sorted(r["row_no"] for r in exclude_deals(rows, pairs).collect()) == [2, 3, 4]


def test_cell_at_second_row(spark):
    rows = spark.createDataFrame([("a", 3, "x3"), ("a", 1, "x1"), ("a", 2, "x2"), ("b", 9, "y9")],
                                 "f string, r long, v string")
    got = {r["f"]: r["v"] for r in cell_at(rows, "f", "r", "v", 1).collect()}
    assert got == {"a": "x2"}
    got0 = {r["f"]: r["v"] for r in cell_at(rows, "f", "r", "v", 0).collect()}
    assert got0 == {"a": "x1", "b": "y9"}


def test_split_halves_with_one_hot_key(spark):
    """A third of the rows share one order key: sizes are still exact."""
    df = spark.range(3000).withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")))
    got = split_halves(df, ["k"]).groupBy("half").count().collect()
    assert {r["half"]: r["count"] for r in got} == {1: 1500, 2: 1500}
    # ordering respected: every half-1 key <= every half-2 key
    h = split_halves(df, ["k"])
    assert h.filter("half = 1").agg(F.max("k")).first()[0] <= h.filter("half = 2").agg(F.min("k")).first()[0]


def test_cell_at_with_hot_file_ranks_before_the_shuffle(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 200).cast("string")).alias("f"),
        F.col("id").alias("r"), (F.col("id") * 10).cast("string").alias("v"))
    cells = cell_at(rows, "f", "r", "v", 1)
    got = {r["f"]: r["v"] for r in cells.collect()}
    assert got["hot"] == "30" and len(got) == 201
    assert "WindowGroupLimit" in cells._jdf.queryExecution().executedPlan().toString()


def test_naming_settles_on_long_chains(spark):
    # every range overlaps the next: a file that loses its name takes the next one, 150 times
    n = 150
    ranges = spark.createDataFrame([(f"n{k}", f"2020-01-{1 + k // 28 % 2:02d}", "2020-12-31", k) for k in range(n)],
                                   "file_name string, s string, e string, range_rank int").select(
        "file_name", F.to_date("s").alias("start_date"), F.to_date("e").alias("end_date"), "range_rank")
    files = spark.createDataFrame([(f"f{k:03d}", k) for k in range(n + 5)], "file string, file_order long").select(
        "file", "file_order", F.to_date(F.lit("2020-06-15")).alias("cell_date"))
    got = {r["file"]: (r["new_name"], r["status"]) for r in assign_names(files.where("file_order < 12"), ranges.where("range_rank < 10")).collect()}
    assert got == {f"f{k:03d}": (f"n{k}", "renamed") if k < 10 else (None, "conflict") for k in range(12)}


def test_cell_at_by_position(spark):
    rows = spark.createDataFrame([("a", 1, "x", "p"), ("a", 2, "y", "q")], "f string, r long, c1 string, c2 string")
    assert cell_at(rows, "f", "r", 3, 1).first()["c2"] == "q"
