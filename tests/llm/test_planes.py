import hashlib
import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.llm import planes as P

SCHEMA = "vec_id long, embedding array<double>"


def vector(seed, scale=1.0):
    return [float(x) for x in np.random.RandomState(seed).standard_normal(64) * scale]


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute(rows, k=8, rounds=10):
    """(vec_id, cluster, distance) by plain integer differences, and the centroids."""
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(good, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        mine = [near(v)[1] for _, v in good]
        for n in set(mine):
            members = [v for (_, v), m in zip(good, mine) if m == n]
            centroids[n] = [sum(c) // len(members) for c in zip(*members)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in good), key=str), centroids


def found(df):
    rows, centroids = P.cluster(df)
    return sorted((tuple(r) for r in rows.collect()), key=str), centroids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-(1 << 27), (1 << 27) - 1), min_size=64, max_size=64), min_size=1, max_size=6))
def test_plane_products_and_sums_are_exact(rows):
    values = np.array(rows, np.int64)
    words = P.packed_planes(values, 28)
    assert (P.dots(words, words) == values @ values.T).all()
    assert (P.own_products(words) == (values * values).sum(axis=1)).all()
    assert (P.component_sums(words) == values.sum(axis=0)).all()


def test_equals_brute_force(spark):
    rows = [(i, vector(i, 0.1 + i % 3)) for i in range(150)]
    assert found(table(spark, rows).repartition(5)) == brute(rows)


def test_odd_vectors_are_left_out_and_columns_may_clash(spark):
    good = [(i, vector(i)) for i in range(30)]
    odd = [(100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [None] + [0.0] * 63),
           (105, [float("nan")] + [0.0] * 63), (106, [float("inf")] * 64), (107, [float("-inf")] + [0.0] * 63)]
    df = table(spark, good + odd).withColumn("planes", F.lit("x")).withColumn("cluster", F.lit(9)).withColumn("v", F.lit(1))
    assert found(df) == brute(good)


def test_ties_repeated_rows_null_ids_and_few_vectors(spark):
    zero, one = [0.0] * 64, [1.0] + [0.0] * 63
    rows = [(1, zero), (1, zero), (2, zero), (None, one), (None, one), (4, [-0.0001] * 64)]
    assert found(table(spark, rows)) == brute(rows)
    rows = [(5, one)]
    assert found(table(spark, rows)) == brute(rows)
    same = [(i, one) for i in range(40)]
    assert found(table(spark, same)) == brute(same)
    assert found(table(spark, [])) == ([], [])


def test_components_beyond_64_bit_distances_keep_a_row(spark):
    rows = [(i, vector(i)) for i in range(12)]
    out, centroids = found(table(spark, rows + [(50, [1e200] + [0.0] * 63), (51, [2.0 ** 17] * 64)]))
    assert (sorted(r for r in out if r[1] is not None), centroids) == (sorted(brute(rows)[0]), brute(rows)[1])
    assert [r for r in out if r[1] is None] == [(50, None, None), (51, None, None)]
    big = [(i, vector(i, 30000.0)) for i in range(20)]
    assert found(table(spark, big)) == brute(big)


def test_query_on_float_vectors(spark, tmp_dir):
    rows = [(i, vector(i)) for i in range(60)]
    table(spark, rows).select("vec_id", F.col("embedding").cast("array<float>").alias("embedding")).write.parquet(f"{tmp_dir}/embeddings.parquet")
    expected, centroids = brute([(i, [float(np.float32(x)) for x in v]) for i, v in rows])
    out = sorted((tuple(r) for r in P.op13_planes(spark, tmp_dir).collect()), key=str)
    total = sum(d for _, _, d in expected)
    own = {c: sum(d for _, m, d in expected if m == c) for _, c, _ in expected}
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    assert out == [(i, c, d, own[c], total, name[c]) for i, c, d in expected]
