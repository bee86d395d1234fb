import zlib

from pyspark.sql import functions as F

from ledgerlake.llm import sharding as S
from tests.llm.helpers import docs, edge_texts, prose


def collected(spark, df, shards=7, **kw):
    placed, versions = S.shard_by_bytes(df, shards, slots=256, **kw)
    return placed.collect(), versions


def test_places_are_gapless_and_sizes_exact(spark):
    texts = edge_texts() + [prose(n, n) for n in range(5, 200)]
    rows, versions = collected(spark, docs(spark, texts))
    by_id = {r["id"]: r for r in rows}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        data = (t or "").encode()
        assert by_id[i]["size"] == len(data) + 16 and by_id[i]["text_crc32"] == zlib.crc32(data)
    for k in range(7):
        places = sorted(r["slot"] for r in rows if r["shard"] == k)
        assert places == list(range(len(places)))
    assert sorted(r["version"] for r in versions.select("version").distinct().collect()) == [0, 1, 2]


def test_bytes_are_near_equal_with_skewed_sizes(spark):
    rows, _ = collected(spark, docs(spark, [prose(n % 300 + 5, n) for n in range(1500)]))
    loads = [sum(r["size"] for r in rows if r["shard"] == k) for k in range(7)]
    assert max(loads) - min(loads) <= 2 * max(r["size"] for r in rows)


def test_records_keep_their_slot_and_only_edited_slots_move(spark):
    df = docs(spark, [prose(n % 90 + 5, n) for n in range(400)])
    recs = S.records(df, slots=64)
    totals = S.slot_totals(recs)
    old = S.initial_map(spark, 5, 64)
    grown = S.grow(old, totals, 5)
    moved = old.join(grown.withColumnRenamed("shard", "to"), "vslot").where("shard <> to").collect()
    assert moved and {r["to"] for r in moved} == {5}
    assert {r["version"] for r in grown.collect()} == {1}


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows, _ = collected(spark, docs(spark, [(None, "a"), (None, "a"), (1, "b"), (1, "b")]))
    assert len(rows) == 4 and len({(r["shard"], r["slot"]) for r in rows}) == 4
    rows, _ = collected(spark, docs(spark, []))
    assert rows == []


def test_clashing_columns_are_not_read(spark):
    df = docs(spark, ["a", "b"]).withColumn("slot", F.lit("x")).withColumn("shard", F.lit(9)).withColumn("cell", F.lit(1))
    rows, _ = collected(spark, df)
    assert sorted(r["id"] for r in rows) == [0, 1]


def test_native_plan(spark):
    from tests.llm.plans import plan_of
    placed, _ = S.shard_by_bytes(docs(spark, ["a", "b"]), 3, slots=16)
    assert not any(x in plan_of(placed) for x in ("Python", "Pandas", "Arrow"))
