"""Sharding by fixed virtual slots.

Every record is hashed into one of a fixed number of virtual slots (thousands,
never changed later). The bytes of each slot are aggregated, and a versioned
slot-to-shard map says where each slot lives. Rebalancing edits the map and
adds a version; records never change their slot, so only the records of moved
slots move.

All of it is DataFrame and SQL functions. The only things held whole are the
per-slot totals and the map, whose size is the fixed number of slots.

Defined results: a NULL text has no bytes (size 16, CRC-32 of the empty text);
a NULL id is hashed like any other value; repeated rows each get a place of
their own; an empty table gives an empty result and a map without edits;
columns of the input other than the id and the text are not read, so clashing
names do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.llm.common import table, utf8
from ledgerlake.session import materialise

SLOTS = 8192
# places within a slot are dealt over this many cells, so that numbering the
# rows of a slot is not one task's work
CELLS_PER_SLOT = 16
ROW_OVERHEAD = 16  # bytes counted for a record besides its text


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            slots: int = SLOTS, cells: int = CELLS_PER_SLOT) -> DataFrame:
    """(id, size, text_crc32, cell, vslot) of each record. The text is read once and not passed on."""
    data = utf8(F.col(text_col))
    return docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(data) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
    ).withColumn("cell", F.pmod(F.xxhash64("id", "text_crc32"), F.lit(slots * cells))) \
     .withColumn("vslot", (F.col("cell") % F.lit(slots)).cast("int"))


def slot_totals(recs: DataFrame) -> DataFrame:
    """Rows and bytes per slot that has any."""
    return recs.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n_rows"))


def initial_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 0: slots dealt round-robin. One row per slot."""
    return spark.range(slots).select(F.lit(0).alias("version"), F.col("id").cast("int").alias("vslot"),
                                     (F.col("id") % F.lit(shards)).cast("int").alias("shard"))


def _edit(steps: Column, loads: Column) -> Column:
    """Fold the slots, largest first, over the shards' loads: a slot moves to the
    least loaded shard where that lowers the larger of the two loads."""
    def step(acc: Column, s: Column) -> Column:
        least = F.array_min(acc["loads"])
        to = F.array_position(acc["loads"], least).cast("int") - F.lit(1)
        held = F.element_at(acc["loads"], s["shard"] + F.lit(1))
        moves = (held - least) > s["bytes"]
        edited = F.struct(
            F.transform(acc["loads"], lambda x, i: F.when(i == s["shard"], x - s["bytes"])
                        .when(i == to, x + s["bytes"]).otherwise(x)).alias("loads"),
            F.concat(acc["moved"], F.array(F.struct(s["vslot"].alias("vslot"), to.alias("shard")))).alias("moved"))
        return F.when(moves, edited).otherwise(acc)

    start = F.struct(loads.alias("loads"),
                     F.array().cast("array<struct<vslot:int,shard:int>>").alias("moved"))
    return F.aggregate(steps, start, step, lambda acc: acc["moved"])


def rebalance(slot_map: DataFrame, totals: DataFrame, shards: int) -> DataFrame:
    """The next version of the map: the same slots, those moved that even out the bytes."""
    placed = slot_map.join(totals, "vslot", "left").select(
        "version", "vslot", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes"))
    # one row per slot: sizes fixed by the number of slots
    gathered = placed.agg(
        F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("neg"), "vslot", "shard", "bytes"))).alias("steps"),
        *[F.coalesce(F.sum(F.when(F.col("shard") == k, F.col("bytes"))), F.lit(0)).alias(f"l{k}")
          for k in range(shards)])
    moved = gathered.select(F.explode(_edit(
        F.col("steps"), F.array(*[F.col(f"l{k}") for k in range(shards)]))).alias("m")).select(
        F.col("m.vslot").alias("vslot"), F.col("m.shard").alias("new_shard"))
    return slot_map.join(moved, "vslot", "left").select(
        (F.col("version") + F.lit(1)).alias("version"), "vslot", F.coalesce("new_shard", "shard").alias("shard"))


def grow(slot_map: DataFrame, totals: DataFrame, shards: int) -> DataFrame:
    """The next version with one more shard (number `shards`): it only receives
    slots, one in `shards` + 1 of each old shard's slots in order of size."""
    ranked = slot_map.join(totals, "vslot", "left").withColumn(
        "r", F.row_number().over(W.partitionBy("shard").orderBy(F.col("bytes").desc_nulls_last(), "vslot")))
    takes = (F.col("r") % F.lit(shards + 1)) == F.lit((shards + 1) // 2)
    return ranked.select((F.col("version") + F.lit(1)).alias("version"), "vslot",
                         F.when(takes, F.lit(shards)).otherwise(F.col("shard")).cast("int").alias("shard"))


def place(recs: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Each record with its shard and its place there (gapless from 0 in each shard).

    Places are numbered cell by cell: a row number within the cell plus the rows
    of the shard's earlier cells. A cell holds one in slots x cells of the rows,
    so no task ever sorts a whole shard.
    """
    cells = recs.groupBy("cell", "vslot").agg(F.count("*").alias("n")).join(
        F.broadcast(slot_map.select("vslot", "shard")), "vslot")
    # slots x cells rows at most
    starts = cells.withColumn("start", F.sum("n").over(
        W.partitionBy("shard").orderBy("cell").rowsBetween(W.unboundedPreceding, -1))).select(
        "cell", "shard", F.coalesce("start", F.lit(0)).alias("start"))
    within = F.row_number().over(W.partitionBy("cell").orderBy("id", "size", "text_crc32")) - F.lit(1)
    numbered = recs.withColumn("within", within)
    return numbered.join(starts, "cell").select(
        "id", "size", "text_crc32", "vslot", "shard", (F.col("start") + F.col("within")).cast("long").alias("slot"))


def shard_by_bytes(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
                   slots: int = SLOTS, edits: int = 2) -> tuple[DataFrame, DataFrame]:
    """(placed records, all versions of the slot map).

    Version 0 deals slots round-robin, each edit evens out the bytes. The map is
    stored as a table, one row per version and slot.
    """
    spark = docs.sparkSession
    recs = records(docs, id_col, text_col, slots)
    totals, _ = materialise(slot_totals(recs), "slot-totals")
    newest, _ = materialise(initial_map(spark, shards, slots), "slot-map")
    stored = newest
    for _ in range(edits):
        newest, _ = materialise(rebalance(newest, totals, shards), "slot-map")
        stored = stored.unionByName(newest)
    return place(recs, newest), stored


def op9_sharding(spark: SparkSession, sf_dir: str, shards: int = 40) -> DataFrame:
    """All documents in shards of near equal bytes (law `bytes`)."""
    placed, _ = shard_by_bytes(table(spark, sf_dir, "documents"), shards)
    return placed.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.col("vslot").alias("virtual_slot"))
