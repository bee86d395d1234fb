from pyspark.sql import functions as F

from ledgerlake.llm import urls as U


def test_entries_are_evaluated_as_of_the_fetch(spark):
    log = spark.createDataFrame([
        ("bad.example", "spam", "block", "add", 10), ("bad.example", "spam", "block", "remove", 20), ("bad.example", "spam", "block", "add", 30),
        ("ok.bad.example", "news", "allow", "add", 0), ("bad.example/a/b", "spam", "block", "add", 0),
        ("tie.example", "x", "allow", "add", 5), ("tie.example", "y", "block", "add", 5)],
        "key string, category string, action string, change string, changed_at long")
    captures = spark.createDataFrame([
        (1, "http://bad.example/", 9), (2, "http://bad.example/", 10), (3, "http://www.bad.example/", 19), (4, "http://bad.example/", 20),
        (5, "http://BAD.example:80/x", 31), (6, "https://ok.bad.example/a", 31), (7, "http://bad.example/a/b/c?q", 25),
        (8, None, 31), (9, "not a url", 31), (10, "http://bad.example/", None), (11, "http://tie.example/", 5), (2, "http://bad.example/", 10)],
        "id long, url string, fetched_at long").withColumn("verdict", F.lit("z"))
    rows = U.evaluate(captures, U.intervals(log)).collect()
    assert len(rows) == 12
    got = {r["id"]: (r["verdict"], r["matched_key"]) for r in rows}
    assert got == {1: ("keep", None), 2: ("block", "bad.example"), 3: ("block", "bad.example"), 4: ("keep", None),
                   5: ("block", "bad.example"), 6: ("allow", "ok.bad.example"), 7: ("block", "bad.example/a/b"), 8: ("keep", None),
                   9: ("keep", None), 10: ("keep", None), 11: ("block", "tie.example")}
    assert U.evaluate(captures.limit(0), U.intervals(log)).count() == 0
    assert {r["verdict"] for r in U.evaluate(captures, U.intervals(log.limit(0))).collect()} == {"keep"}


def test_hot_host_keeps_every_capture(spark):
    log = spark.createDataFrame([("h.example", "s", "block", "add", 3)], "key string, category string, action string, change string, changed_at long")
    captures = spark.range(500).select("id", F.lit("http://h.example/p").alias("url"), (F.col("id") % 5).alias("fetched_at"))
    assert U.evaluate(captures, U.intervals(log)).where("verdict = 'block'").count() == 200


def test_deep_keys_and_unusual_urls(spark):
    log = spark.createDataFrame([("h.example/a/b/c", "s", "block", "add", 0), ("bad.example", "s", "block", "add", 0),
                                 ("x.a.b.c.d.e.f.g.h.i.example", "s", "block", "add", 0)],
                                "key string, category string, action string, change string, changed_at long")
    urls = {"http://h.example/a/b/c/d": "block", "http://h.example/a/b": "keep", "http://user:pw@bad.example/": "block",
            "http://bad.example./": "block", "//bad.example/x": "block", "svn+ssh2://bad.example:22/": "block", "http://bad.example": "block",
            "http://bad.example:80": "block", "http://bad.example./?q": "block", "http://[::1]:80/": "keep", "bad.example/x": "keep",
            "http://notbad.example/": "keep", "http://x.a.b.c.d.e.f.g.h.i.example/": "block", "http:///p": "keep", "http://a@b@bad.example/": "block"}
    rows = U.evaluate(spark.createDataFrame([(k, u, 1) for k, u in enumerate(urls)], "id long, url string, fetched_at long"), U.intervals(log)).collect()
    assert {r["url"]: r["verdict"] for r in rows} == urls
