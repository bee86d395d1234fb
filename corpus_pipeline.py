"""Corpus pipeline: documents through four of the training-data operators.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a DataFrame; all but the last return the columns of `documents`.
Between stages `run` writes the rows as Parquet to the shared folder, so a lost
executor costs its tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import bpe, decontaminate, near, quality
from ledgerlake.llm.common import table
from ledgerlake.session import discard, materialise


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, packed, with the digest of the bytes they decode to."""
    import public_tokenizers
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    back = bpe.encode(docs, path, pattern, decoded=True)
    return back.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", tokenised),
]

# a trained classifier, a sketch join and an edit distance have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of `documents` after all stages."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs, path = materialise(stage(spark, docs, sf_dir), "stage")
        if before is not None:
            discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
