"""Centroid clustering of vectors on bit planes.

Components are read as integers floor(scale * x) and stored as bit planes: bit b
of the 64 components is one unsigned 64-bit word, the last plane carries the
sign (two's complement). With the planes of a vector v and a centroid c,

    v . c = sum over planes i, j of weight(i) * weight(j) * popcount(v_i AND c_j)

so that |v - c|^2 = v . v - 2 v . c + c . c is exact in integers. The number of
planes follows the largest component of the table.

The packed vectors are written once. Each round is one narrow pass over them:
tasks assign their vectors and add up the components of each cluster (from the
planes too), and only these sums, a fixed number for each task, are combined.
The driver holds the centroids and nothing else.

Defined results: vectors that are NULL, of another length than 64, or hold NULL
or non-finite components are left out; of vectors with equal hashes the smaller
components come first; equally near centroids go by the smaller number; an empty
cluster keeps its centroid; fewer vectors than centroids give as many centroids
as vectors; repeated rows are vectors of their own; a vector with a component of
2**17 or more in size (squared distances beyond 64 bits) takes no part and keeps
a row with NULL in all columns but its id; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import table
from ledgerlake.session import materialise

DIM = 64
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
SEED = 3
LARGEST = 1 << 17  # components from this size on have no 64-bit distances
ROWS = 4096  # vectors handled at once


def kept(col: Column) -> Column:
    """True for vectors of 64 finite components."""
    finite = F.forall(col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce((F.size(col) == DIM) & finite, F.lit(False))


def packed_planes(values: np.ndarray, planes: int) -> np.ndarray:
    """(rows x planes) words: bit k of word b is bit b of component k; the last plane is the sign."""
    bits = (values[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<u8")[:, :, 0]


def weights(planes: int) -> np.ndarray:
    """What a bit of each plane counts."""
    w = np.left_shift(np.int64(1), np.arange(planes, dtype=np.int64))
    w[-1] = -w[-1]
    return w


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(rows of a x rows of b) dot products of packed vectors."""
    wa, wb = weights(a.shape[1]), weights(b.shape[1])
    out = np.zeros((len(a), len(b)), np.int64)
    for i, x in enumerate(wa):
        for j, y in enumerate(wb):
            out += np.int64(x * y) * np.bitwise_count(a[:, i, None] & b[None, :, j])
    return out


def own_products(a: np.ndarray) -> np.ndarray:
    """|v|^2 of each packed vector."""
    w = weights(a.shape[1])
    out = np.zeros(len(a), np.int64)
    for i, x in enumerate(w):
        for j, y in enumerate(w):
            out += np.int64(x * y) * np.bitwise_count(a[:, i] & a[:, j])
    return out


def assigned(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance to it) of each packed vector."""
    d = own_products(vectors)[:, None] - 2 * dots(vectors, centroids) + own_products(centroids)[None, :]
    near = d.argmin(axis=1)
    return near, d[np.arange(len(d)), near]


def component_sums(vectors: np.ndarray) -> np.ndarray:
    """Sum of each component: how often its bit is set in each plane, weighted."""
    bits = np.unpackbits(np.ascontiguousarray(vectors).view(np.uint8).reshape(*vectors.shape, 8), axis=2, bitorder="little")
    return (bits.sum(axis=0, dtype=np.int64) * weights(vectors.shape[1])[:, None]).sum(axis=0)


def _words(column: pa.Array, planes: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(len(column), planes)


def pack(vectors: DataFrame, planes: int) -> DataFrame:
    """(vec_id, planes) of (vec_id, v); `v` holds the integer components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS):
                batch = whole.slice(lo, ROWS)
                values = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, DIM)
                words = packed_planes(values, planes)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([w.tobytes() for w in words], pa.binary())],
                                                 names=["vec_id", "planes"])
    return vectors.select("vec_id", "v").mapInArrow(run, "vec_id long, planes binary")


def _round(packed: DataFrame, centroids: list[list[int]], planes: int) -> dict[int, tuple[int, list[int]]]:
    """cluster -> (vectors, component sums) after assigning every vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = packed_planes(np.array(centroids, np.int64), planes)
        n, sums = np.zeros(len(c), np.int64), np.zeros((len(c), DIM), np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                v = _words(batch.column("planes").slice(lo, ROWS), planes)
                near, _ = assigned(v, c)
                for k in np.unique(near):
                    mine = v[near == k]
                    n[k] += len(mine)
                    sums[k] += component_sums(mine)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(n[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"])

    parts = packed.mapInArrow(run, "cluster int, n long, sums array<long>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("at", "s"))
    rows = each.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    out = {r["cluster"]: (r["n"], [0] * DIM) for r in rows}  # 64 rows for each centroid
    for r in rows:
        out[r["cluster"]][1][r["at"]] = int(r["s"])
    return out


def _assign(packed: DataFrame, centroids: list[list[int]], planes: int) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = packed_planes(np.array(centroids, np.int64), planes)
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS):
                batch = whole.slice(lo, ROWS)
                near, d = assigned(_words(batch.column("planes"), planes), c)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(near.astype(np.int32)), pa.array(d)],
                                                 names=["vec_id", "cluster", "distance"])
    return packed.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, id_col: str = "vec_id",
            vector_col: str = "embedding", scale: int = SCALE) -> tuple[DataFrame, list[list[int]]]:
    """(rows of vec_id, cluster, distance; centroids) after `rounds` rounds and a last assignment."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).where(kept(F.col("x")))
    fits = F.forall("x", lambda c: F.abs(c) < F.lit(float(LARGEST)))
    numbers = src.where(fits).select("vec_id", F.transform("x", lambda c: F.floor(c * F.lit(float(scale)))).alias("v"))
    low, high = numbers.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    left_out = src.where(~fits).select("vec_id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance"))
    if low is None:
        return left_out, []
    planes = max(int(low).bit_length(), int(high).bit_length(), 1) + 1
    packed, _ = materialise(pack(numbers, planes), "planes")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = numbers.select(name.alias("h"), "v").orderBy("h", "v").limit(k).collect()  # k rows
    centroids = [[int(c) for c in r["v"]] for r in first]
    for _ in range(rounds):
        for number, (n, sums) in _round(packed, centroids, planes).items():
            centroids[number] = [s // n for s in sums]
    rows, _ = materialise(_assign(packed, centroids, planes), "assigned")
    return rows.unionByName(left_out), centroids


def op13_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings of 64 components in 8 clusters after 10 rounds."""
    rows, centroids = cluster(table(spark, sf_dir, "embeddings"))
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    about = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).where("cluster IS NOT NULL").collect()
    inertia = {r["cluster"]: int(r["d"]) for r in about}  # one row for each centroid
    by_cluster = spark.createDataFrame(
        [(c, d, sum(inertia.values()), names[c]) for c, d in inertia.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(by_cluster), "cluster", "left").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_sql(rounds: int = ROUNDS, k: int = CENTROIDS, seed: int = SEED, scale: int = SCALE) -> str:
    """The same in DuckDB SQL: every round a nearest centroid by plain differences and floored means."""
    distance = "list_sum(list_transform(list_zip(v.v, c.v), lambda p: ((p[1] - p[2]) * (p[1] - p[2]))::HUGEINT))"
    out = [f"""
WITH kept AS (
  SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS n, v FROM kept
  ORDER BY sha256('{seed}:' || vec_id), v LIMIT {k}
)"""]
    for r in range(rounds + 1):
        out.append(f"""a{r} AS MATERIALIZED (
  SELECT rid, min_by(n, (d, n)) AS n, min(d) AS d
  FROM (SELECT v.rid, c.n, {distance} AS d FROM kept v, c{r} c) GROUP BY rid
)""")
        if r < rounds:
            out.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.n, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
    SELECT n, list(((s - ((s % t) + t) % t) // t)::BIGINT ORDER BY i) AS v FROM (
      SELECT a.n, i, sum(k.v[i]) AS s, count(*) AS t FROM kept k JOIN a{r} a USING (rid), range(1, 65) g(i) GROUP BY a.n, i) GROUP BY n
  ) m USING (n)
)""")
    return ", ".join(out) + f"""
SELECT k.vec_id, a.n::INT AS cluster, a.d::BIGINT AS distance, (sum(a.d) OVER (PARTITION BY a.n))::BIGINT AS cluster_inertia,
  (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM kept k JOIN a{rounds} a USING (rid) JOIN c{rounds} c ON c.n = a.n"""
