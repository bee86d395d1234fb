"""Dates in ranges, matches only."""
import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerlake.operators import intervals as I

DAY = dt.timedelta(days=1)
BASE = dt.date(2015, 1, 1)


def joined(spark, points, ranges):
    p = spark.createDataFrame(points, "id long, at date")
    r = spark.createDataFrame(ranges, "name string, s date, e date")
    return I.points_in_ranges(p, r, "at", "s", "e")


def brute(points, ranges):
    return sorted((i, n) for i, d in points for n, s, e in ranges if None not in (d, s, e) and s <= d <= e)


def test_equals_all_pairs_on_random_ranges_and_edges(spark):
    rng = random.Random(3)
    day = lambda: BASE + DAY * rng.randrange(4000)
    ranges = [(f"r{k}", s, s + DAY * rng.choice([0, 0, 1, 6, 30, 365, 2000, -1, -40])) for k in range(150) for s in [day()]]
    ranges += [("all", dt.date(1, 1, 1), dt.date(9999, 12, 31)), ("first", dt.date(1, 1, 1), dt.date(1, 1, 1)),
               ("last", dt.date(9999, 12, 31), dt.date(9999, 12, 31)), ("n1", None, BASE), ("n2", BASE, None)]
    points = [(k, day()) for k in range(300)] + [(900, None), (901, dt.date(1, 1, 1)), (902, dt.date(9999, 12, 31)), (903, dt.date(1969, 12, 31))]
    got = sorted((r["id"], r["name"]) for r in joined(spark, points, ranges).collect())
    assert got == brute(points, ranges)


def test_daily_ranges_over_ten_years_and_a_hot_day(spark):
    ranges = [(f"d{k}", BASE + DAY * k, BASE + DAY * k) for k in range(3650)]
    points = [(k, BASE + DAY * 17) for k in range(2000)] + [(5000 + k, BASE + DAY * k) for k in range(3700)]
    out = joined(spark, points, ranges)
    assert out.count() == 2000 + 3650
    # one level of blocks: nothing but matches comes out of the join, and no filter follows it
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Filter")


def test_blocks_are_disjoint_few_and_cover_the_range(spark):
    rows = spark.range(400).select(F.expr("date_add(DATE'2015-01-01', CAST(id * 7 % 97 AS INT))").alias("s"), (F.col("id") % 211).cast("int").alias("n")) \
        .withColumn("e", F.expr("date_add(s, n)")).withColumn("b", I.blocks_of_range(F.col("s"), F.col("e")))
    for r in rows.collect():
        days = sorted(d for x in r["b"] for d in range((x & 0xFFFFFFFF) << (x >> 32), ((x & 0xFFFFFFFF) + 1) << (x >> 32)))
        first = r["s"].toordinal() - 1
        assert days == list(range(first, first + r["n"] + 1)) and len(r["b"]) <= 2 * (r["n"] + 1).bit_length()


def test_empty_sides(spark):
    assert joined(spark, [], [("a", BASE, BASE)]).count() == 0 and joined(spark, [(1, BASE)], []).count() == 0
