"""Tables whose every change is one new version.

A versioned table is a folder of data folders and of manifests. A change writes
its rows to a data folder of its own, which nothing refers to yet, and then
publishes the next manifest: one small file that must not exist before and that
appears whole. A crash before that leaves a folder no version names; a rerun
publishes the change once. A second writer that started from the same version
finds the next number taken and starts over from the newer version. Readers open
the folders of one manifest, so they see a version whole, also while the next
one is written; old data folders stay until `vacuum`.

A manifest lists data folders and the names of the batches loaded, a line each.
A data folder of a table stored by bucket (`deal_bucket`) keeps the list of its
buckets that later changes rewrote; readers prune those folders.

The store must create a name exclusively: HDFS and POSIX file systems do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerlake.operators.flags import bounded
from ledgerlake.operators.sinks import clustered
from ledgerlake.session import create_exclusive, discard, list_names, path_exists, read_text

BUCKET = "deal_bucket"


class Conflict(Exception):
    """Another writer has published the next version."""


@dataclass(frozen=True)
class Version:
    number: int
    schema: StructType
    partition_by: tuple[str, ...]
    parts: list[tuple[str, tuple[int, ...]]] = field(default_factory=list)  # (folder, buckets rewritten since)
    batches: tuple[str, ...] = ()

    def text(self) -> str:
        return json.dumps({"version": self.number, "schema": json.loads(self.schema.json()), "partition_by": self.partition_by,
                           "parts": self.parts, "batches": self.batches})


def _manifest(table: str, number: int) -> str:
    return f"{table.rstrip('/')}/_versions/{number:012d}.json"


def is_versioned(spark: SparkSession, table: str) -> bool:
    return path_exists(spark, f"{table.rstrip('/')}/_versions")


def version_numbers(spark: SparkSession, table: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in list_names(spark, f"{table.rstrip('/')}/_versions") if n.endswith(".json")
                  and not n.startswith("."))


def version_of(spark: SparkSession, table: str, number: int | None = None) -> Version:
    """The newest version, or the one of this number."""
    if number is None:
        number = version_numbers(spark, table)[-1]
    d = json.loads(read_text(spark, _manifest(table, number)))
    return Version(d["version"], StructType.fromJson(d["schema"]), tuple(d["partition_by"]),
                   [(f, tuple(b)) for f, b in d["parts"]], tuple(d["batches"]))


def read_version(spark: SparkSession, table: str, version: Version | None = None) -> DataFrame:
    """The rows of a version (the newest)."""
    v = version or version_of(spark, table)
    groups: dict[tuple[int, ...], list[str]] = {}
    for folder, without in v.parts:
        groups.setdefault(without, []).append(f"{table.rstrip('/')}/{folder}")
    out = None
    for without, folders in groups.items():  # as many as there were updates since the table was last rewritten whole
        part = spark.read.schema(v.schema).option("basePath", f"{table.rstrip('/')}/data").parquet(*folders).select(*v.schema.names)
        if without:
            part = part.filter(F.col(BUCKET).isNull() | ~F.col(BUCKET).isin(list(without)))
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], v.schema) if out is None else out


def write_part(rows: DataFrame, table: str, schema: StructType, partition_by: tuple[str, ...]) -> tuple[str, int]:
    """(data folder, rows): written, but part of no version yet."""
    folder, seen = f"data/written_in={uuid.uuid4().hex}", Observation("written")
    shaped = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    writer = clustered(shaped, partition_by).observe(seen, F.count(F.lit(1)).alias("rows")).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{table.rstrip('/')}/{folder}")
    return folder, int(seen.get["rows"])


def publish(spark: SparkSession, table: str, version: Version) -> Version:
    """Make this the table's next version, whole or not at all."""
    if not create_exclusive(spark, _manifest(table, version.number), version.text()):
        raise Conflict(f"version {version.number} of {table} is already published")
    return version


def create_table(df: DataFrame, table: str, partition_by: tuple[str, ...] = ()) -> Version:
    """Version 1 with the rows of `df`. Refused where the table exists."""
    spark, columns = df.sparkSession, [c for c in df.columns if c not in partition_by] + list(partition_by)
    schema = StructType.fromJson(json.loads(df.select(*columns).schema.json().replace('"nullable":false', '"nullable":true')))
    folder, _ = write_part(df, table, schema, partition_by)
    return publish(spark, table, Version(1, schema, tuple(partition_by), [(folder, ())]))


def changed(spark: SparkSession, table: str, change: Callable[[Version], Version], attempts: int = 20) -> Version:
    """Publish `change` of the newest version; where another writer was faster, make the change again from the newer one."""
    for _ in range(attempts):
        try:
            return publish(spark, table, change(version_of(spark, table)))
        except Conflict:
            continue
    raise Conflict(f"{table} was changed by other writers {attempts} times in a row")


def appended(base: Version, table: str, rows: DataFrame, batch: str | None = None) -> tuple[Version, int]:
    """The version after `base` with more rows, and their number; publish it to make it so."""
    folder, n = write_part(rows, table, base.schema, base.partition_by)
    return Version(base.number + 1, base.schema, base.partition_by, [*base.parts, (folder, ())],
                   base.batches + ((batch,) if batch else ())), n


def replaced(base: Version, table: str, rows: DataFrame, batch: str | None = None) -> Version:
    """The version after `base` with these rows only."""
    folder, _ = write_part(rows, table, base.schema, base.partition_by)
    return Version(base.number + 1, base.schema, base.partition_by, [(folder, ())], base.batches + ((batch,) if batch else ()))


def updated(base: Version, table: str, rows: DataFrame, key: str = "id", batch: str | None = None) -> tuple[Version, list[int]]:
    """The version after `base` in which `rows` take the place of those with their `key`, and the buckets
    rewritten: of a table stored by bucket only those that hold such rows, else the whole table."""
    spark = rows.sparkSession
    current = read_version(spark, table, base)
    buckets = sorted(r[0] for r in rows.select(BUCKET).distinct().collect()) if BUCKET in base.partition_by else []
    if BUCKET in base.partition_by:  # at most the bucket count
        if not buckets:
            return Version(base.number + 1, base.schema, base.partition_by, base.parts, base.batches + ((batch,) if batch else ())), []
        current = current.filter(F.col(BUCKET).isin(buckets))
    # keys of a checked size are probed where the table lies
    fresh = current.join(bounded(rows.select(key)), key, "left_anti").unionByName(rows.select(*current.columns))
    if not buckets:
        return replaced(base, table, fresh, batch), []
    folder, _ = write_part(fresh, table, base.schema, base.partition_by)
    parts = [(f, tuple(sorted({*without, *buckets}))) for f, without in base.parts]
    return Version(base.number + 1, base.schema, base.partition_by, [*parts, (folder, ())], base.batches + ((batch,) if batch else ())), buckets


def vacuum(spark: SparkSession, table: str, keep: int = 1) -> list[str]:
    """Delete the manifests but the newest `keep`, and the data folders that no kept one names. Run it when
    no writer is at work and no reader needs an older version. Returns the folders deleted."""
    numbers = version_numbers(spark, table)
    kept = {f for n in numbers[-keep:] for f, _ in version_of(spark, table, n).parts}
    gone = [f"data/{n}" for n in list_names(spark, f"{table.rstrip('/')}/data") if f"data/{n}" not in kept]
    for number in numbers[:-keep]:
        discard(spark, _manifest(table, number))
    for folder in gone:
        discard(spark, f"{table.rstrip('/')}/{folder}")
    return gone
