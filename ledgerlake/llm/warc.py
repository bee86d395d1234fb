"""WARC archives as seekable Zstandard bundles.

A bundle is one file of independent Zstandard frames, each holding whole WARC
records, followed by a skippable frame with the record index and by the seek
table of the public seekable format (a skippable frame whose footer ends the
file). A record is addressed by its bundle, its frame and its offset within the
decompressed frame, so one record is read by decompressing one frame.

Bundles are written by Spark's text sink, so they land in any store Spark can
write, through its commit protocol (a lost executor's half-written file is
never seen). The sink ends every row with a separator; the separator chosen is
the last three bytes of the seek table's magic number (EA 92 8F, the UTF-8 form
of U+A48F). After a data frame those bytes are the payload of a skippable
frame, after the seek table they complete it.

Records with equal payloads: the one with the largest id is the response, the
others are revisit records that refer to it and hold no payload.

Defined results: NULL payloads are empty; NULL URLs have no target header; a
NULL id is never the one referred to unless all ids of the group are NULL
(all are responses then); rows repeated with the id that is referred to are
responses too; an empty table gives an archive without records; extra columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import table, utf8
from ledgerlake.session import materialise, scratch_path

BUNDLE_BYTES = 32 << 20  # payload bytes of a bundle, on average
FRAME_BYTES = 256 << 10  # a frame is closed once its records reach this size
LEVEL = 3
# fixed values of the Zstandard and seekable formats
SKIPPABLE = 0x184D2A50
INDEX_MAGIC = 0x184D2A51
SEEK_TABLE_MAGIC = 0x184D2A5E
SEEK_FOOTER_MAGIC = 0x8F92EAB1
SEPARATOR = "꒏"  # EA 92 8F in UTF-8: the end of the footer's magic number
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_SCHEMA = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
                 "payload_digest string, bundle string, frame int, frame_offset long, length long, payload binary")


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _id_of(uri: str) -> int | None:
    text = uri.strip("<>").rpartition(":")[2]
    return int(text) if text else None


def warc_record(page_id, url, payload: bytes, digest: str, refers_to, is_revisit: bool, date: str) -> bytes:
    """One WARC 1.1 record; a revisit keeps the HTTP head and leaves out the payload."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = head if is_revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
             f"WARC-Date: {date}"]
    if url is not None:
        safe = "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
        lines.append(f"WARC-Target-URI: {safe}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if is_revisit:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _skippable(magic: int, payload: bytes) -> bytes:
    import struct
    return struct.pack("<II", magic, len(payload)) + payload


def _filler() -> bytes:
    """Header of the skippable frame whose payload is the row separator."""
    import struct
    return struct.pack("<II", SKIPPABLE, len(SEPARATOR.encode()))


def bundle_rows(records: Iterator[tuple[str, bytes]], frame_bytes: int = FRAME_BYTES) -> Iterator[bytes]:
    """The rows (without their separators) of one bundle of (identifier, record bytes)."""
    import struct

    import zstandard
    compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
    seek: list[tuple[int, int]] = []
    index: list[str] = []
    held: list[bytes] = []
    size = 0
    gap = len(_filler()) + len(SEPARATOR.encode())

    def close() -> bytes:
        nonlocal size
        raw = b"".join(held)
        held.clear()
        size = 0
        frame = compressor.compress(raw)
        seek.extend([(len(frame), len(raw)), (gap, 0)])
        return frame + _filler()

    for ident, record in records:
        # frame number counts the data frames; every second entry of the seek table is one
        index.append(f"{ident}\t{len(seek) // 2}\t{size}\t{len(record)}")
        held.append(record)
        size += len(record)
        if size >= frame_bytes:
            yield close()
    if held:
        yield close()
    listing = _skippable(INDEX_MAGIC, compressor.compress("\n".join(index).encode()))
    seek.extend([(len(listing), 0), (gap, 0)])
    yield listing + _filler()
    entries = b"".join(struct.pack("<II", *e) for e in seek)
    footer = struct.pack("<IBI", len(seek), 0, SEEK_FOOTER_MAGIC)
    whole = _skippable(SEEK_TABLE_MAGIC, entries + footer)
    yield whole[:-len(SEPARATOR.encode())]


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, decompressed size) of each data frame, from the footer."""
    import struct
    n, _, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEK_FOOTER_MAGIC:
        raise ValueError("the file does not end with a seek table")
    at, out = 0, []
    for c, d in struct.iter_unpack("<II", bundle[-9 - 8 * n:-9]):
        if d:
            out.append((at, c, d))
        at += c
    return out


def read_frame(bundle: bytes, entry: tuple[int, int, int]) -> bytes:
    import zstandard
    at, c, d = entry
    return zstandard.ZstdDecompressor().decompress(bundle[at:at + c], max_output_size=d)


def parse_records(frame: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of the records of a frame."""
    at = 0
    while at < len(frame):
        end = frame.index(b"\r\n\r\n", at)
        head = frame[at:end].decode().split("\r\n")
        fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in head[1:])}
        stop = end + 4 + int(fields["content-length"])
        yield at, stop + 4 - at, fields, frame[end + 4:stop]
        at = stop + 4


def _row(bundle: str, frame_no: int, at: int, length: int, fields: dict[str, str], block: bytes, payload: bool) -> tuple:
    import base64
    import hashlib
    head, _, body = block.partition(b"\r\n\r\n")
    said = int(head.rpartition(b"Content-Length: ")[2])
    digest = fields["warc-payload-digest"].partition(":")[2]
    kind = fields["warc-type"]
    if kind == "response":
        found = base64.b32encode(hashlib.sha1(body).digest()).decode()
        if found != digest or len(body) != said:
            raise ValueError(f"{fields['warc-record-id']} in {bundle}: the payload does not match its digest")
    refers = _id_of(fields["warc-refers-to"]) if kind == "revisit" else None
    return (_id_of(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, refers, said, digest, bundle,
            frame_no, at, length, body if payload and kind == "response" else None)


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_bytes: int = 0, bundle_bytes: int = BUNDLE_BYTES, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write one record per row into bundles below `path`; payloads of at least
    `min_bytes` equal to that of a larger id become revisits."""
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                       utf8(F.col(payload_col)).alias("payload")).withColumn("sha", F.sha1("payload"))
    narrow, _ = materialise(src.select("page_id", "sha", F.octet_length("payload").cast("long").alias("n")), "warc-digests")
    total = narrow.agg(F.coalesce(F.sum("n"), F.lit(0)) + F.count("*") * 512).first()[0]
    bundles = max(1, math.ceil(total / bundle_bytes))
    # one row per digest that several rows share, combined on the map side
    groups = narrow.where(F.col("n") >= min_bytes).groupBy("sha").agg(
        F.max("page_id").alias("keeper"), F.count("*").alias("copies")).where("copies > 1 AND keeper IS NOT NULL")
    key = F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("")), "sha")
    revisits, _ = materialise(narrow.join(groups, "sha").where(~F.col("page_id").eqNullSafe(F.col("keeper")))
                              .select(key.alias("key"), "keeper").distinct(), "warc-revisits")
    # the payloads move once, to the bundles; both sides are dealt by the row's own key
    dealt = src.withColumn("key", key).repartition(bundles, "key")
    if revisits.isEmpty():  # a join that adaptive execution finds empty would deal the payloads again
        joined = dealt.withColumn("keeper", F.lit(None).cast("long"))
    else:
        joined = dealt.join(revisits.repartition(bundles, "key"), "key", "left")
    joined = joined.select("page_id", "url", "payload", "sha", "keeper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64

        def records():
            for batch in batches:
                ids, urls, loads, shas, keepers = (c.to_pylist() for c in batch.columns)
                for i, url, load, sha, keeper in zip(ids, urls, loads, shas, keepers):
                    digest = base64.b32encode(bytes.fromhex(sha)).decode()
                    yield record_id(i), warc_record(i, url, load, digest, keeper, keeper is not None, date)

        for row in bundle_rows(records()):
            yield pa.RecordBatch.from_arrays([pa.array([row], pa.binary())], names=["row"])

    joined.mapInArrow(run, "row binary").select(F.col("row").cast("string").alias("value")) \
        .write.option("lineSep", SEPARATOR).text(path)


def _bundles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record, found through the seek tables; responses are checked against their digests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(*(c.to_pylist() for c in batch.columns)):
                for no, entry in enumerate(seek_table(content)):
                    rows = [_row(name, no, at, n, fields, block, payload)
                            for at, n, fields, block in parse_records(read_frame(content, entry))]
                    yield _batch(rows)

    return _bundles(spark, path).mapInArrow(run, RECORD_SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(),
             pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else
                                      [pa.array([], k) for k in kinds], names=names)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, bundle, frame, frame_offset, length) from the bundles' own index frames."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import struct

        import zstandard
        for batch in batches:
            for name, content in zip(*(c.to_pylist() for c in batch.columns)):
                n = struct.unpack("<I", content[-9:-5])[0]
                table_at = len(content) - 17 - 8 * n
                at = 0
                for c, _ in struct.iter_unpack("<II", content[-9 - 8 * n:-9]):
                    if struct.unpack("<I", content[at:at + 4])[0] == INDEX_MAGIC:
                        text = zstandard.ZstdDecompressor().decompress(content[at + 8:at + c]).decode()
                        rows = [line.split("\t") for line in text.split("\n") if line]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([r[0] for r in rows], pa.string()), pa.array([name] * len(rows), pa.string()),
                             *[pa.array([int(r[i]) for r in rows], pa.int64()) for i in (1, 2, 3)]],
                            names=["record_id", "bundle", "frame", "frame_offset", "length"])
                    at += c
                assert at == table_at

    return _bundles(spark, path).mapInArrow(
        run, "record_id string, bundle string, frame long, frame_offset long, length long")


def fetch(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The records whose `record_id` is in `wanted`, decompressing only the frames that hold them."""
    places = read_index(spark, path).join(wanted.select("record_id").distinct(), "record_id", "left_semi")
    per_bundle = places.groupBy("bundle").agg(F.collect_list(F.struct("frame", "frame_offset")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content, places in zip(*(c.to_pylist() for c in batch.columns)):
                seek = seek_table(content)
                want: dict[int, set[int]] = {}
                for p in places:
                    want.setdefault(p["frame"], set()).add(p["frame_offset"])
                for no, offsets in sorted(want.items()):
                    yield _batch([_row(name, no, at, n, fields, block, True)
                                  for at, n, fields, block in parse_records(read_frame(content, seek[no]))
                                  if at in offsets])

    # a bundle's places are as many as its records at most
    return _bundles(spark, path).join(per_bundle, F.col("path") == F.col("bundle")) \
        .select("path", "content", "places").mapInArrow(run, RECORD_SCHEMA)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive in the shared folder and read back."""
    path = scratch_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_sql() -> str:
    """DuckDB form: SHA-1 in base 32 from its bits; of equal payloads the largest id is the response."""
    bit = "CAST(substr(bits, 5 * i + {}, 1) AS INTEGER) * {}"
    value = " + ".join(bit.format(k + 1, 16 >> k) for k in range(5))
    return f"""
WITH p AS (SELECT page_id, COALESCE(html, '') AS payload, sha1(COALESCE(html, '')) AS h FROM pages),
b AS (SELECT *, list_aggregate(list_transform(range(1, 41), lambda i: substr(
        '0000000100100011010001010110011110001001101010111100110111101111', strpos('0123456789abcdef', substr(h, i, 1)) * 4 - 3, 4)),
        'string_agg', '') AS bits FROM p),
d AS (SELECT *, list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {value}, 1)),
        'string_agg', '') AS payload_digest, max(page_id) OVER (PARTITION BY payload) AS keeper FROM b)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to FROM d"""
