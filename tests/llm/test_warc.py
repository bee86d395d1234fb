import base64
import glob
import hashlib
import io

import zstandard
from pyspark.sql import functions as F

from ledgerlake.llm import warc as W

SCHEMA = "page_id long, url string, html string"


def rows_of():
    return [(1, "http://a/", "same"), (7, None, "same"), (3, "http://b c/\r\nX: y", "other"), (4, "u", None), (5, "v", ""),
            (6, "http://é/", "é" * 200), (8, "w", "z" * 700_000), (9, "w", "l1\r\n\r\nl2"), (None, "n", "same"), (7, None, "same")]


def test_round_trip(spark, tmp_dir):
    W.write_archive(spark.createDataFrame(rows_of(), SCHEMA).withColumn("sha", F.lit(1)), f"{tmp_dir}/w", bundle_bytes=400_000)
    got = W.read_archive(spark, f"{tmp_dir}/w").collect()
    assert len(got) == len(rows_of())
    text = {(i, u): (h or "").encode() for i, u, h in rows_of()}
    largest = {}
    for i, _, h in rows_of():
        largest[h or ""] = max(largest.get(h or "", -1), -1 if i is None else i)
    for i, u, h in rows_of():
        r = next(x for x in got if x["page_id"] == i)
        data = text[i, u]
        assert r["payload_bytes"] == len(data)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        if i == largest[h or ""]:
            assert r["record_type"] == "response" and r["refers_to"] is None and bytes(r["payload"]) == data
        else:
            assert r["record_type"] == "revisit" and r["refers_to"] == largest[h or ""] and r["payload"] is None


def test_small_payloads_are_never_revisits(spark, tmp_dir):
    W.write_archive(spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long enough"), (4, "d", "long enough")], SCHEMA),
                    f"{tmp_dir}/w", min_bytes=5)
    kinds = {r["page_id"]: r["record_type"] for r in W.read_archive(spark, f"{tmp_dir}/w").collect()}
    assert kinds == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_bundles_are_plain_zstandard_with_a_seek_table(spark, tmp_dir):
    W.write_archive(spark.createDataFrame(rows_of(), SCHEMA), f"{tmp_dir}/w", bundle_bytes=300_000)
    found = 0
    for f in glob.glob(f"{tmp_dir}/w/part*"):
        raw = open(f, "rb").read()
        assert raw[-4:] == (0x8F92EAB1).to_bytes(4, "little")
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
        frames = [W.read_frame(raw, e) for e in W.seek_table(raw)]
        assert b"".join(frames) == whole
        found += whole.count(b"WARC/1.1\r\n")
    assert found == len(rows_of())


def test_index_gives_each_record(spark, tmp_dir):
    W.write_archive(spark.createDataFrame(rows_of(), SCHEMA), f"{tmp_dir}/w", bundle_bytes=300_000)
    index = W.read_index(spark, f"{tmp_dir}/w")
    assert index.count() == len(rows_of())
    got = W.fetch(spark, f"{tmp_dir}/w", spark.createDataFrame([("<urn:page:8>",), ("<urn:page:3>",)], "record_id string")).collect()
    assert {r["page_id"]: r["payload_bytes"] for r in got} == {8: 700_000, 3: 5}


def test_empty_table(spark, tmp_dir):
    W.write_archive(spark.createDataFrame([], SCHEMA), f"{tmp_dir}/w")
    assert W.read_archive(spark, f"{tmp_dir}/w").count() == 0
