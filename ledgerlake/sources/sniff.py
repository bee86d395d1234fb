"""What each file holds, told from a bounded prefix of its bytes.

Spark lists the files (a row each, no content); tasks read the first
`PREFIX_BYTES` of their files and no more.
"""

from __future__ import annotations

import csv
import re
import sys
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlake.functions.text import file_ext_of

# ship this module with the task, so executors need no install of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PREFIX_BYTES = 1 << 16
HTML_SUFFIXES = (".xls", ".htm", ".html")

# ---- fixed values: leading-byte signatures -------------------------------------
OLE2_MAGIC = bytes.fromhex("D0CF11E0A1B11AE1")  # legacy binary Excel
ZIP_MAGIC = bytes.fromhex("504B0304")  # xlsx (zip container)
PARQUET_MAGIC = b"PAR1"
GZIP_MAGIC = bytes.fromhex("1F8B")

_MARKUP = re.compile(r"\s*<[a-z!?]", re.I)
_DOCUMENT = re.compile(r"\s*<(!doctype|html|head|body|table|\?xml|!--)", re.I)


def kind_of(head: bytes, name: str) -> str:
    """'xls', 'xlsx', 'parquet', 'html', 'csv' or 'unknown' (binary of no known kind)."""
    if head.startswith(OLE2_MAGIC):
        return "xls"
    if head.startswith(ZIP_MAGIC):
        return "xlsx"
    if head.startswith(PARQUET_MAGIC):
        return "parquet"
    if b"\0" in head:
        return "unknown"
    text = head.decode("utf-8-sig", "replace")
    if _DOCUMENT.match(text) or (_MARKUP.match(text) and name.lower().endswith(HTML_SUFFIXES)):
        return "html"
    return "csv"


def header_of(head: bytes, whole: bool, name: str) -> tuple[list[str] | None, bool]:
    """(cells of the first record of a CSV text, which may hold quoted line breaks, None if there is none; whether records
    end with a carriage return and a line feed). Records end at line feeds."""
    text = head.decode("utf-8-sig", "replace")
    if "\r" in text and "\n" not in text:
        raise ValueError(f"the lines of {name} end with carriage returns only")
    lines = [x for x in re.split(r"(?<=\n)", text) if x]
    records = csv.reader(iter(lines))
    first = next((r for r in records if r), None)
    if not whole and records.line_num >= len(lines):
        raise ValueError(f"the header of {name} is longer than {len(head)} bytes")
    return first, first is not None and lines[records.line_num - 1].endswith("\r\n")


def _prefix(path: str, uri: str) -> bytes:
    if path.startswith("file:"):
        with open("/" + path[len("file:"):].lstrip("/"), "rb") as f:
            return f.read(PREFIX_BYTES)
    from pyarrow import fs
    store, at = fs.FileSystem.from_uri(uri)
    with store.open_input_stream(at) as f:
        return f.read(PREFIX_BYTES)


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kinds, headers, ends = [], [], []
        for path, uri, length in zip(*(batch.column(c).to_pylist() for c in ("path", "file", "length"))):
            head, whole = _prefix(path, uri), length <= PREFIX_BYTES
            if head.startswith(GZIP_MAGIC):
                head, whole, path = zlib.decompressobj(31).decompress(head, PREFIX_BYTES), False, path.removesuffix(".gz")
            kinds.append(kind_of(head, path))
            header, crlf = header_of(head, whole, path) if kinds[-1] == "csv" else (None, False)
            headers.append(header)
            ends.append(crlf)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("path", "file", "length")), pa.array(kinds, pa.string()),
             pa.array(headers, pa.list_(pa.string())), pa.array(ends, pa.bool_())],
            names=["path", "file", "length", "kind", "header", "crlf"])


def file_heads(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, file, length, kind, header, crlf) of each file with content at or below `path`; `file` is the
    address as the scans' `_metadata.file_path` gives it, `header` the first record of a CSV file."""
    reader = spark.read.format("binaryFile")
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(path)
    return files.select("path", F.col("_metadata.file_path").alias("file"), "length").mapInArrow(
        _told, "path string, file string, length long, kind string, header array<string>, crlf boolean")


def sniff_format(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, extension, format, length): the kind each file's content shows, whatever its name."""
    return file_heads(spark, path, glob).select("path", file_ext_of("path").alias("extension"), F.col("kind").alias("format"), "length")
