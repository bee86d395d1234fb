"""Exact duplicates by two-pass Bloom filtering.

Texts are equal when they are identical after every run of ASCII white space is
read as one space; the SHA-256 of that form stands for the text. The hashes are
written once, with the ids and without the texts.

The first pass enters each hash into `HASHES` cells of a Bloom filter and keeps
the cells that were entered more than once, as a bitmap. Entries combine on the
map side, so a text that fills a third of the table costs one entry per task.
The second pass looks every hash up in that bitmap: a hash with a cell entered
once occurs once, and its row passes straight through. Only the others are
shuffled, to count their groups and find the row that stays; groups holding more
than one row in `HOT` (at most `HOT` groups) meet their rows by a broadcast
join, so no task gathers them.

The filter has `CELLS` cells for each row, up to `max_cells`; the bitmap, which
every task gets, therefore has at most max_cells / 8 bytes. Beyond
max_cells / CELLS rows more single hashes are taken for repeated ones, and more
(hash, id) rows are shuffled; the result is the same. All of it is DataFrame and
SQL functions.

Defined results: a NULL text counts as empty; a NULL id is larger than any other
(`keep_id` is NULL only if the whole group has none); of rows equal in id and
text one stays; an empty table gives an empty result; other columns are not read
by `exact_duplicates` and pass through `deduplicated`, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import table
from ledgerlake.session import materialise

HASHES = 2
CELLS = 16  # cells of the filter for each row
MAX_CELLS = 1 << 31  # a bitmap of 256 MB
PAGE = 1 << 15  # cells of one page of the bitmap, the size bitmap_construct_agg works on
HOT = 1024


def normal(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; NULL is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def hashed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, doc_id, h): a number for each row, its id, and the SHA-256 of its text."""
    return docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"),
                       F.unhex(F.sha2(normal(F.col(text_col)).cast("binary"), 256)).alias("h"))


def cells_for(rows: int, max_cells: int = MAX_CELLS) -> int:
    """Cells of the filter: a power of two, `CELLS` for each row, within one page and `max_cells`."""
    return max(PAGE, min(max_cells, 1 << max(0, CELLS * rows - 1).bit_length()))


def cell_of(h: Column, number: int, cells: int) -> Column:
    return F.xxhash64(F.lit(number), h).bitwiseAND(F.lit(cells - 1))


def repeated_cells(hashes: DataFrame, cells: int) -> DataFrame:
    """First pass: (page, bits) of the cells that more than one row was entered into."""
    entries = hashes.select(F.explode(F.array(*[cell_of(F.col("h"), i, cells) for i in range(HASHES)])).alias("cell"))
    again = entries.groupBy("cell").count().where("count > 1").select(
        F.shiftright("cell", 15).cast("int").alias("page"), F.col("cell").bitwiseAND(F.lit(PAGE - 1)).alias("bit"))
    # cells are single now, so pages are dealt evenly
    return again.repartition("page").groupBy("page").agg(F.expr("bitmap_construct_agg(bit)").alias("bits"))


def _is_set(bits: Column, bit: Column) -> Column:
    octet = F.ascii(F.decode(F.substring(bits, F.shiftright(bit, 3).cast("int") + 1, F.lit(1)), "ISO-8859-1"))
    return F.coalesce(F.getbit(octet, bit.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))


def with_maybe(hashes: DataFrame, pages: DataFrame, cells: int) -> DataFrame:
    """Second pass: `hashes` with `maybe`, true where every cell of the hash was entered more than once."""
    out, maybe = hashes, F.lit(True)
    for i in range(HASHES):
        side = F.broadcast(pages.select(F.col("page").alias(f"page{i}"), F.col("bits").alias(f"bits{i}")))  # cells / 8 bytes
        cell = cell_of(F.col("h"), i, cells)
        out = out.withColumn(f"bit{i}", cell.bitwiseAND(F.lit(PAGE - 1))).withColumn(
            f"page{i}", F.shiftright(cell, 15).cast("int")).join(side, f"page{i}", "left")
        maybe = maybe & _is_set(F.col(f"bits{i}"), F.col(f"bit{i}"))
    return out.select(*[F.col(c) for c in hashes.columns], maybe.alias("maybe"))


def groups_of(flagged: DataFrame) -> DataFrame:
    """(h, keep_id, keep_rid, group_size) of the hashes that may be repeated; combines on the map side."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid"))
    return flagged.where("maybe").groupBy("h").agg(first.alias("k"), F.count("*").alias("group_size")).select(
        "h", F.col("k.doc_id").alias("keep_id"), F.col("k.rid").alias("keep_rid"), "group_size")


def _found(docs: DataFrame, id_col: str, text_col: str, max_cells: int) -> tuple[DataFrame, DataFrame, DataFrame, int, int]:
    """(hash rows with `maybe`, groups, pages of the filter, rows, cells)."""
    hashes, _ = materialise(hashed(docs, id_col, text_col), "hashes")
    rows = hashes.count()
    cells = cells_for(rows, max_cells)
    pages, _ = materialise(repeated_cells(hashes, cells), "repeated-cells")
    flagged = with_maybe(hashes, pages, cells)
    groups, _ = materialise(groups_of(flagged), "repeated-groups")
    return flagged, groups, pages, rows, cells


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     max_cells: int = MAX_CELLS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of each row."""
    flagged, groups, _, rows, _ = _found(docs, id_col, text_col, max_cells)
    is_hot = F.col("group_size") * HOT > rows
    hot = groups.where(is_hot).select("h", F.col("keep_id").alias("hot_id"), F.col("keep_rid").alias("hot_rid"),
                                      F.col("group_size").alias("hot_size"))
    marked = flagged.join(F.broadcast(hot), "h", "left")  # fewer than HOT rows
    single = ~F.col("maybe")
    through = marked.where(single | F.col("hot_size").isNotNull()).select(
        "doc_id", "h", "rid", F.when(single, F.col("doc_id")).otherwise(F.col("hot_id")).alias("keep_id"),
        F.when(single, F.col("rid")).otherwise(F.col("hot_rid")).alias("keep_rid"),
        F.when(single, F.lit(1).cast("long")).otherwise(F.col("hot_size")).alias("group_size"))
    shuffled = marked.where(F.col("maybe") & F.col("hot_size").isNull()).select("doc_id", "h", "rid").join(
        groups.where(~is_hot), "h").select(*through.columns)
    return through.unionByName(shuffled).select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), (F.col("rid") == F.col("keep_rid")).alias("kept"),
        F.lower(F.hex("h")).alias("text_sha256"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_cells: int = MAX_CELLS) -> DataFrame:
    """The rows of `docs` that stay, with all their columns. Texts that occur once are not shuffled."""
    _, groups, pages, _, cells = _found(docs, id_col, text_col, max_cells)
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"),
                       F.unhex(F.sha2(normal(F.col(text_col)).cast("binary"), 256)).alias("h"))
    flagged = with_maybe(rows, pages, cells)
    keys = groups.select(F.col("h").alias("kh"), F.col("keep_id"))
    stay = flagged.where("maybe").join(keys, (F.col("h") == F.col("kh")) & F.col("id").eqNullSafe(F.col("keep_id")), "left_semi") \
        .dropDuplicates(["h"])
    return flagged.where(~F.col("maybe")).select("row.*").unionByName(stay.select("row.*"))


def op11_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their group of equal texts and the row of it that stays."""
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op11_sql() -> str:
    return r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), g AS (
  SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)"""
