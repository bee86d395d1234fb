"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(col: Column) -> Column:
    """The UTF-8 bytes of a text column; NULL counts as empty."""
    return F.coalesce(col, F.lit("")).cast("binary")


def crc32_of_id(col: Column) -> Column:
    """Unsigned CRC-32 of an id written as decimal text (NULL: of the empty text)."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def held_out(col: Column, folds: int) -> Column:
    """True for the rows of the held-out fold, remainder 0 of `folds`."""
    return (crc32_of_id(col) % F.lit(folds)) == 0


def kept_fields(df: DataFrame, *replaced: str) -> list[T.StructField]:
    """The fields an operator passes through: all but those its own result columns replace."""
    gone = {c.lower() for c in replaced}
    return [f for f in df.schema.fields if f.name.lower() not in gone]


def named(fields: list[T.StructField]) -> list[Column]:
    return [F.col(f"`{f.name}`") for f in fields]


def with_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], names=[*batch.schema.names, *columns])
