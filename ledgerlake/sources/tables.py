"""Table scans with explicit schemas (no inference) and an explicit row position."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql import Window

from ledgerlake.functions.oracle import blank_to_null
from ledgerlake.functions.text import file_name_of
from ledgerlake.schemas import BATCH_LAYOUTS, conform_master, slot
from ledgerlake.sources.sniff import file_heads

# quoted cells may hold separators, doubled quotes and line breaks: records are read, not lines
CSV_READ = {"quote": '"', "escape": '"', "multiLine": True}


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger table (Parquet, or the newest version of a versioned table),
    conformed to the ledger schema. Partition columns of the stored layout
    (`source`, `deal_bucket`) are kept, so filters and joins on them prune folders."""
    from ledgerlake.operators.versions import is_versioned, read_version
    from ledgerlake.schemas import conform_ledger
    if is_versioned(spark, path):
        return conform_ledger(read_version(spark, path))
    return conform_ledger(spark.read.parquet(path))


def read_master(spark: SparkSession, path: str) -> DataFrame:
    """S3: the receivables master, conformed to the columns the packages read."""
    return conform_master(spark.read.parquet(path))


def read_batch(staged: DataFrame, kind: str, batch_name: str | None = None) -> DataFrame:
    """One staged batch. Filters the collection, renames the positional text
    columns for `kind`, and turns '' into NULL (Oracle semantics)."""
    names, _error_slot = BATCH_LAYOUTS[kind]
    df = staged
    if batch_name is not None:
        df = df.filter(F.col("collection_name") == batch_name)
    cols = [F.col("seq_id").cast("long").alias("seq_id")]
    for i, name in enumerate(names, start=1):
        src = slot(i)
        c = blank_to_null(F.col(src).cast("string")) if src in staged.columns else F.lit(None).cast("string")
        cols.append(c.alias(name))
    return df.select(*cols)


def to_staged(named: DataFrame, kind: str, batch_name: str) -> DataFrame:
    """Inverse of `read_batch`: put named columns into positional text slots."""
    names, error_slot = BATCH_LAYOUTS[kind]
    cols = [F.lit(batch_name).alias("collection_name"), F.col("seq_id").cast("long").alias("seq_id")]
    for i, name in enumerate(names, start=1):
        c = F.col(name).cast("string") if name in named.columns else F.lit(None).cast("string")
        cols.append(c.alias(slot(i)))
    cols.append(F.lit(None).cast("string").alias(error_slot))
    return named.select(*cols)


def read_ranges(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """File-name ranges `File Name, Start Date, End Date` with their row order
    kept as `range_rank` (the first matching range wins)."""
    schema = T.StructType([T.StructField("file_name", T.StringType()),
                           T.StructField("start_date", T.DateType()),
                           T.StructField("end_date", T.DateType())])
    reader = spark.read.schema(schema)
    df = reader.options(**CSV_READ).option("header", True).csv(path) if fmt == "csv" else reader.parquet(path)
    return with_file_position(df).withColumnRenamed("_row", "range_rank").drop("_file")


def with_file_position(df: DataFrame) -> DataFrame:
    """Add `_file` (path) and `_row`, a key ordered like the rows inside each
    file: (split start, position within the split's task)."""
    return (df.withColumn("_file", F.col("_metadata.file_path"))
            .withColumn("_row", F.struct(F.col("_metadata.file_block_start").alias("block"),
                                         F.monotonically_increasing_id().alias("pos"))))


def read_sheet_export(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
                      fmt: str = "csv") -> DataFrame:
    """A worksheet exported as CSV (header row) or Parquet, all text.

    With `columns`, the header must hold them; they are read as strings, so no
    value is re-typed by inference. Adds `_file` and `_row` (file order)."""
    reader = spark.read
    if fmt == "csv":
        reader = reader.options(**CSV_READ).option("header", True).option("inferSchema", False)
        if columns is not None:
            reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
        df = reader.csv(path)
    else:
        df = reader.parquet(path)
    return with_file_position(df)


def read_folder(spark: SparkSession, directory: str, suffixes: Sequence[str] = (".csv",),
                fmt: str = "csv", columns: Sequence[str] | None = None) -> DataFrame:
    """Every matching file in a folder, each row tagged with its file name."""
    glob = "*{" + ",".join(s.lstrip("*") for s in suffixes) + "}"
    reader = spark.read.option("pathGlobFilter", glob)
    if fmt == "csv":
        reader = reader.options(**CSV_READ).option("header", True)
        if columns is not None:
            reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
        df = reader.csv(directory)
    else:
        df = reader.parquet(directory)
    df = with_file_position(df)
    return df.withColumn("file_name", file_name_of(F.col("_file")))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """L1: the first `n` rows in file order (a sample to look at: the limit is the feature)."""
    if "_row" in df.columns:
        return df.orderBy("_file", "_row").limit(n)
    return df.limit(n)


def data_columns(df: DataFrame) -> list[str]:
    """Sheet columns in file order (without the `_file` / `_row` bookkeeping)."""
    return [c for c in df.columns if c not in ("_file", "_row")]


def cell_at(df: DataFrame, file_cols: str | Sequence[str], order_col: str | Column, value_col: str | int,
            row_index: int = 1) -> DataFrame:
    """Value of `value_col` in the `row_index`-th row (0-based, file order)
    of every file (`file_cols` identify a file), in one pass: Spark limits the
    ranks to `row_index` + 1 per file before the shuffle, so one huge file does
    not land in a single task. Files with fewer rows are absent from the result."""
    keys = [file_cols] if isinstance(file_cols, str) else list(file_cols)
    if isinstance(value_col, int):  # a 0-based column position, as iloc[row, col]
        value_col = data_columns(df)[value_col]
    order = F.col(order_col) if isinstance(order_col, str) else order_col
    rows = df.select(*keys, order.alias("_o"), F.col(value_col).alias("_v"))
    ranked = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("_o"))) \
        .filter(F.col("_n") <= row_index + 1)
    return ranked.filter(F.col("_n") == row_index + 1).select(*keys, F.col("_v").alias(value_col))


def _literal(path: str) -> str:
    """A file's path with the characters escaped that a path pattern gives a meaning."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def safe_header(cells: Column) -> Column:
    """Column names of a header record: an empty one is named `_c<position>`, a repeated
    one (in any case) gets its position appended."""
    def name(h: Column, i: Column) -> Column:
        same = F.filter(cells, lambda x: F.lower(x) == F.lower(h))
        return F.when(F.coalesce(h, F.lit("")) == "", F.concat(F.lit("_c"), i.cast("string"))) \
            .when(F.size(same) > 1, F.concat(h, i.cast("string"))).otherwise(h)
    return F.transform(cells, name)


def by_header(rows: DataFrame, heads: DataFrame, doc: str) -> DataFrame:
    """`rows` (`doc`, `cells`, and others) with a column for every name in `heads` (`doc`, `header`, `crlf`),
    each cell under the name that its own file's header gives its position; names match in any case,
    and a column that a file lacks is NULL.

    The header map has a row per file; it meets the rows by a join that adaptive
    execution broadcasts while it is small. The driver sees each distinct header once."""
    heads = heads.select(F.col(doc), safe_header(F.col("header")).alias("header"), "crlf")
    names: dict[str, str] = {}
    for r in sorted(heads.groupBy("header").agg(F.min(doc).alias("first")).collect(), key=lambda r: r["first"]):
        for h in r["header"]:
            names.setdefault(h.lower(), h)
    at = F.transform(F.array(*[F.lit(n) for n in names]), lambda n: F.array_position(
        F.transform("header", lambda h: F.lower(h)), n).cast("int") - 1)
    placed = rows.join(heads.select(doc, at.alias("_at"), F.col("crlf").alias("_crlf")), doc)
    # records end at line feeds: a carriage return before it is not part of the last cell
    last = F.array_max(F.transform("cells", lambda c, i: F.when(c.isNotNull(), i)))
    blank = F.col("_crlf") & (last == 0) & (F.get("cells", F.lit(0)) == "\r")
    placed = placed.filter(~F.coalesce(blank, F.lit(False))).withColumn("cells", F.when(F.col("_crlf"), F.transform("cells", lambda c, i: F.when(
        i == last, F.nullif(F.regexp_replace(c, "\r$", ""), F.lit(""))).otherwise(c))).otherwise(F.col("cells")))
    return placed.select(*[F.get("cells", F.get("_at", F.lit(i))).alias(n) for i, n in enumerate(names.values())],
                         *[F.col(c) for c in rows.columns if c not in (doc, "cells")])


def _csv_export(spark: SparkSession, where: str | list[str], glob: str | None, heads: DataFrame) -> DataFrame:
    """CSV files of any headers in one scan: cells by position, named by each file's header."""
    width = heads.agg(F.max(F.size("header"))).first()[0]
    reader = spark.read.schema(T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)]))
    raw = with_file_position((reader.option("pathGlobFilter", glob) if glob else reader)
                             .options(**CSV_READ).option("lineSep", "\n").option("header", True).csv(where))
    cells = raw.select(F.col("_file").alias("file"), F.array(*[F.col(f"_c{i}") for i in range(width)]).alias("cells"), "_file", "_row")
    return by_header(cells, heads.select("file", "header", "crlf"), "file")


def _html_export(spark: SparkSession, where: str | list[str], glob: str | None, files: DataFrame) -> DataFrame:
    """The first table of each file; its cells are named by the file's own first row."""
    from ledgerlake.sources.html import read_html_tables

    rows = read_html_tables(spark, where, glob or "*").filter(F.col("table_no") == 0)
    heads = rows.filter(F.col("row_no") == 0).select("doc", F.col("cells").alias("header"), F.lit(False).alias("crlf"))
    without = files.select(F.col("path").alias("doc")).join(heads, "doc", "left_anti").limit(5).collect()
    if without:
        raise ValueError(f"no table found in {sorted(r['doc'] for r in without)}")
    # an empty cell is a missing value (as pandas.read_html and the CSV reader give); short rows end with missing ones
    body = rows.filter(F.col("row_no") > 0).select(
        "doc", F.transform("cells", lambda c: F.nullif(c, F.lit(""))).alias("cells"), F.col("doc").alias("_file"),
        F.struct(F.lit(0).cast("long").alias("block"), F.col("row_no").cast("long").alias("pos")).alias("_row"))
    return by_header(body, heads, "doc")


def read_export(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Sheet exports as text columns, with `_file` (path) and `_row`
    (position in the file). `path` may be a file or a folder (+ `glob`).

    Every file is read by what it holds (its leading bytes, not its name) and by
    its own header: HTML (the first table of the file), Parquet, or CSV, where
    quoted cells may hold separators, quotes and line breaks. Columns are matched
    by name; a column a file lacks is NULL. Binary Excel and other binary files
    are rejected by name; empty files are passed over. A CSV file is one task's
    work, read as a stream; its records end at line feeds."""
    files = file_heads(spark, path, glob)
    kinds = {r["kind"]: r for r in files.groupBy("kind").agg(F.count("*").alias("n"), F.slice(F.sort_array(
        F.collect_set(F.when(F.col("kind").isin("xls", "xlsx", "unknown"), F.col("path")))), 1, 5).alias("some")).collect()}
    if not kinds:
        raise FileNotFoundError(f"no file under {path}" + (f" matches {glob}" if glob else ""))
    refused = [f for k in ("xls", "xlsx", "unknown") if k in kinds for f in kinds[k]["some"]]
    if refused:
        raise ValueError(f"binary files cannot be read as exports: {refused}")
    mixed = len(kinds) > 1

    def of(kind: str) -> tuple[str | list[str], str | None, DataFrame]:
        mine = files.filter(F.col("kind") == kind)
        # beside files of other kinds, the files of one kind are named one by one (the listing, as Spark's own file index holds it)
        return ([_literal(r["path"]) for r in mine.select("path").collect()], None, mine) if mixed else (path, glob, mine)

    parts: list[DataFrame] = []
    if "csv" in kinds:
        where, pattern, mine = of("csv")
        parts.append(_csv_export(spark, where, pattern, mine.filter(F.col("header").isNotNull())))
    if "html" in kinds:
        parts.append(_html_export(spark, *of("html")))
    if "parquet" in kinds:
        where, pattern, _ = of("parquet")
        reader = spark.read.option("mergeSchema", True)
        where = [where] if isinstance(where, str) else where
        stored = with_file_position((reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(*where))
        # beside text exports, stored values are shown as text
        parts.append(stored if not parts else stored.select(
            *[F.col(f"`{c}`") if c in ("_file", "_row") else F.col(f"`{c}`").cast("string").alias(c) for c in stored.columns]))
    if not parts:
        return spark.createDataFrame([], "_file string, _row struct<block: bigint, pos: bigint>")
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    names = data_columns(out)
    return out.select(*[F.col(f"`{c}`") for c in names], "_file", "_row")
