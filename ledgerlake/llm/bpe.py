"""Byte-level BPE encoding and decoding with the tiktoken library.

Ranks come from a local rank file, whose path is a parameter. Each match of the
split pattern is merged separately and special tokens are never produced.

Long texts are cut at safe boundaries before they reach the library: between a
letter or digit and a following space or line feed, and, where a stretch has
none, between a letter and a digit or the other way round. No match of the
pattern spans such a place and no match looks back over it, so the tokens are
those of the whole text. A very long run of white space, over which the library's
pattern matcher would run out of stack, is one match of the pattern by itself (all
of it at the end of a text, else all but its last character) and is merged as one.

Defined results: NULL and empty texts encode to no ids and decode to no bytes;
ids outside the vocabulary make the decoding fail; other columns pass through
untouched, but for those named like a result column, which the result replaces;
empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import kept_fields, named, table, with_columns

PIECE_CHARS = 1 << 14  # texts longer than this are cut
SPACE_RUN = 1 << 14  # runs of white space from this length on are merged without the pattern
BATCH_BYTES = 4 << 20  # output batches are closed at about this size


def load_encoding(rank_path: str, pattern: str):
    """The tiktoken encoding of a rank file (base64 token and rank per line)."""
    import base64

    import tiktoken
    with open(rank_path, "rb") as f:
        ranks = {base64.b64decode(tok): int(rank) for tok, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("ledgerlake", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, limit: int = PIECE_CHARS) -> list[str]:
    """The text cut at safe boundaries into pieces of about `limit` characters (longer where none is safe)."""
    import regex
    if len(text) <= limit:
        return [text]
    safe = regex.compile(r"(?<=[A-Za-z0-9])(?=[ \n])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
    out, start = [], 0
    while len(text) - start > limit:
        m = safe.search(text, start + limit)
        if m is None or m.start() >= len(text):
            break
        out.append(text[start:m.start()])
        start = m.start()
    out.append(text[start:])
    return out


def encoded(enc, text: str) -> Iterator[list[int]]:
    """The token ids of a text, in parts."""
    import regex
    start = 0
    if len(text) >= SPACE_RUN:
        for run in regex.finditer(r"\p{White_Space}{%d,}+" % SPACE_RUN, text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            for piece in pieces(text[start:run.start()]):
                yield enc.encode_ordinary(piece)
            yield enc._encode_single_piece(text[run.start():end])
            start = end
    for piece in pieces(text[start:]):
        yield enc.encode_ordinary(piece)


def _slices(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose text is about `most` bytes."""
    import pyarrow.compute as pc
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def encode(docs: DataFrame, rank_path: str, pattern: str, text_col: str = "text", decoded: bool = False) -> DataFrame:
    """The input without its text, with `ids` (token ids packed as little-endian
    unsigned 32-bit integers, binary) and `n_tokens`; with `decoded` also the raw
    bytes that the packed ids give back, as `decode` does, from the same worker."""
    kept = kept_fields(docs, text_col, "ids", "n_tokens", *["decoded"] * decoded)
    schema = T.StructType([*kept, T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()),
                           *[T.StructField("decoded", T.BinaryType())] * decoded])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from array import array
        enc = load_encoding(rank_path, pattern)
        for whole in batches:
            for batch in _slices(whole, text_col):
                packed, counts = [], []
                for text in batch.column(text_col).to_pylist():
                    ids = array("I")
                    for part in encoded(enc, text) if text else ():
                        ids.extend(part)
                    packed.append(_le_bytes(ids))
                    counts.append(len(ids))
                out = {"ids": pa.array(packed, pa.binary()), "n_tokens": pa.array(counts, pa.int64())}
                if decoded:
                    out["decoded"] = pa.array([_decoded(enc, b) for b in packed], pa.binary())
                yield with_columns(batch.select([f.name for f in kept]), out)

    return docs.select(*named(kept), F.col(f"`{text_col}`")).mapInArrow(run, schema)


def _decoded(enc, packed: bytes | None) -> bytes:
    """The raw bytes of packed ids, which need not be valid UTF-8."""
    import numpy as np
    return enc.decode_bytes(np.frombuffer(packed, "<u4").tolist()) if packed else b""


def _le_bytes(ids) -> bytes:
    import sys
    if ids.itemsize != 4:
        from array import array
        ids = array("L", ids)
    if sys.byteorder != "little":
        ids = ids[:]
        ids.byteswap()
    return ids.tobytes()


def decode(tokens: DataFrame, rank_path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """The input with `decoded`: the raw bytes of each row's ids, which need not be valid UTF-8."""
    kept = kept_fields(tokens, "decoded")
    schema = T.StructType([*kept, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load_encoding(rank_path, pattern)
        for whole in batches:
            for batch in _slices(whole, ids_col):
                out = [_decoded(enc, b) for b in batch.column(ids_col).to_pylist()]
                yield with_columns(batch, {"decoded": pa.array(out, pa.binary())})

    return tokens.select(*named(kept)).mapInArrow(run, schema)


def op5_bpe(spark: SparkSession, sf_dir: str, rank_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Every whole document encoded and decoded again; digests of the ids and of the decoded bytes."""
    import public_tokenizers
    rank_path = rank_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern = pattern or public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = encode(docs, rank_path, pattern, decoded=True)
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
