import math

import numpy as np
from pyspark.sql import functions as F

from ledgerlake.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in vectors], SCHEMA)


def brute(vectors, every, k=5):
    ok = {i: np.array(np.float32(v), np.float64) for i, v in vectors
          if v is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all() and any(x != 0 for x in v)}
    out = {}
    for q, a in ok.items():
        if q % every == 0:
            s = sorted((-(a @ b) / math.sqrt(a @ a) / math.sqrt(b @ b), i) for i, b in ok.items() if i != q and len(a) == len(b))
            out[q] = [(i, -c) for c, i in s[:k]]
    return out


def found(df, every, **kw):
    out = {}
    for r in ann.nearest(df, F.col("vec_id") % every == 0, **kw).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def random_vectors(n, dim=16, seed=3):
    rng = np.random.RandomState(seed)
    return [(i, rng.randn(dim).tolist()) for i in range(n)]


def test_a_query_with_few_in_its_buckets_meets_all_vectors(spark):
    base = random_vectors(60)
    vectors = base + [(100, None), (101, []), (102, [0.0] * 16), (103, [float("nan")] + [1.0] * 15), (104, [None] + [1.0] * 15),
                      (105, [float("inf")] + [1.0] * 15), (106, [1.0, 2.0])] + [(200 + k, base[10][1]) for k in range(12)]
    # one table of narrow cells and the home bucket only: next to nothing is found there
    want, got = brute(vectors, 10), found(frame(spark, vectors), 10, tables=1, probes=1, width=0.05)
    want = {q: r for q, r in want.items() if r}
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-12)


def test_recall_through_buckets_with_a_hot_vector(spark):
    vectors = random_vectors(900, 24) + [(1000 + k, [1.0] * 24) for k in range(450)]
    want, got = brute(vectors, 30), found(frame(spark, vectors), 30, chunk=100)
    hits = sum(len({round(s, 9) for _, s in want[q]} & {round(s, 9) for _, s in got.get(q, [])}) for q in want)
    assert hits >= 0.9 * sum(len({round(s, 9) for _, s in r}) for r in want.values())
    assert [i for i, _ in got[1020]] == [1000, 1001, 1002, 1003, 1004]


def test_fewer_candidates_and_empty(spark):
    got = found(frame(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0])]), 10)
    assert got.keys() == {0} and got[0][0][0] == 1 and math.isclose(got[0][0][1], 1 / math.sqrt(2), rel_tol=1e-12)
    got = found(frame(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (0, [1.0, 0.0])]), 10)
    assert [i for i, _ in got[0]] == [1]
    assert found(frame(spark, [(0, [1.0, 0.0])]), 10) == {}
    assert found(frame(spark, []), 10) == {}


def test_probe_order_is_by_cost():
    rng = np.random.RandomState(1)
    fraction = rng.rand(5, 6)
    steps = ann.probe_steps(fraction, ann.template_of(6, 160), 40)
    for row, f in zip(steps, fraction):
        cost = [sum((f[i] if s < 0 else 1 - f[i]) ** 2 for i, s in enumerate(p) if s) for p in row]
        assert cost == sorted(cost) and cost[0] == 0 and len({tuple(p) for p in row}) == 40


def test_recall_of_the_query_on_a_small_table(spark):
    path = "/root/testdata/sf0.001"
    got = {}
    for r in ann.op10_ann(spark, path).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    want = {q: {i for i, _ in r} for q, r in brute(rows, 50).items()}
    assert all(len(x) == 5 for x in got.values()) and got.keys() == want.keys()
    assert sum(len(want[q] & got[q]) for q in want) >= 0.9 * 5 * len(want)


def test_large_and_small_components(spark):
    df = spark.createDataFrame([(0, [1e200, 0.0], 0), (1, [1e200, 1e200], 0), (2, [1e-200, 0.0], 0), (3, [3e-310, 4e-310], 0)],
                               "vec_id long, embedding array<double>, label int")
    got = dict(found(df, 10)[0])
    assert got[2] == 1.0 and math.isclose(got[1], 1 / math.sqrt(2), rel_tol=1e-12) and math.isclose(got[3], 0.6, rel_tol=1e-6)
