import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.llm import bpe
from tests.llm.helpers import docs, edge_texts, prose

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def enc():
    return bpe.load_encoding(PATH, PATTERN)


def test_round_trip_equals_the_library(spark, enc):
    texts = edge_texts() + ["it's 12ab 34  don't\n\n x", "<|endoftext|>", "a" * 40_000 + "1" * 40_000]
    df = docs(spark, texts)
    rows = {r["doc_id"]: r for r in bpe.decode(bpe.encode(df, PATH, PATTERN), PATH, PATTERN).collect()}
    at_once = {r["doc_id"]: r for r in bpe.encode(df.withColumn("decoded", F.lit(1)), PATH, PATTERN, decoded=True).collect()}
    for i, t in enumerate(texts):
        ids = np.array(enc.encode_ordinary(t or ""), "<u4")
        assert at_once[i]["decoded"] == rows[i]["decoded"] and at_once[i]["ids"] == rows[i]["ids"]
        assert bytes(rows[i]["ids"]) == ids.tobytes() and rows[i]["n_tokens"] == len(ids)
        assert bytes(rows[i]["decoded"]) == (t or "").encode()


def test_query_digests(spark, enc, tmp_dir):
    docs(spark, edge_texts()).write.parquet(f"{tmp_dir}/documents.parquet")
    rows = {r["doc_id"]: r for r in bpe.op5_bpe(spark, tmp_dir).collect()}
    for i, t in enumerate(edge_texts()):
        ids = np.array(enc.encode_ordinary(t or ""), "<u4").tobytes()
        assert rows[i]["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab1 \n\t'sé. \u001c", max_size=300), st.integers(1, 20))
def test_safe_boundaries_keep_the_tokens(text, limit):
    enc = bpe.load_encoding(PATH, PATTERN) if not hasattr(test_safe_boundaries_keep_the_tokens, "e") else test_safe_boundaries_keep_the_tokens.e
    test_safe_boundaries_keep_the_tokens.e = enc
    parts = bpe.pieces(text, limit)
    assert "".join(parts) == text
    assert [i for p in parts for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def test_long_text_is_cut():
    text = prose(20_000, 3)
    parts = bpe.pieces(text)
    assert len(parts) > 3 and max(map(len, parts)) < 2 * bpe.PIECE_CHARS


def test_extra_and_clashing_columns(spark):
    df = docs(spark, ["a b"]).withColumn("ids", F.lit("old")).withColumn("extra", F.lit(3))
    out = bpe.encode(df, PATH, PATTERN)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "extra", "ids", "n_tokens"]
    assert out.first()["n_tokens"] == 2 and out.first()["extra"] == 3
    assert bpe.encode(docs(spark, []), PATH, PATTERN).count() == 0


def test_long_runs_of_white_space(enc, monkeypatch):
    """Runs over which the library would run out of stack; short ones by the same path equal the library."""
    for t in [" " * 3_000_000, "a" + " " * 3_000_000 + "b", "x\n" + "\n" * 1_500_000 + " y"]:
        ids = [i for part in bpe.encoded(enc, t) for i in part]
        assert enc.decode_bytes(ids) == t.encode()
    monkeypatch.setattr(bpe, "SPACE_RUN", 4)
    spaces = [" ", "\n", "\t", "\r", "\u00a0", "\u3000", "\x85", "\x1c", "\u200b"]
    for n in range(4000):
        rng = np.random.RandomState(n)
        t = "".join(str(rng.choice(["a", "é", "7", "'s", "-"])) if rng.rand() < 0.4 else str(rng.choice(spaces)) * int(rng.choice([1, 1, 3, 4, 5, 9]))
                    for _ in range(rng.randint(1, 12)))
        assert [i for part in bpe.encoded(enc, t) for i in part] == enc.encode_ordinary(t)
