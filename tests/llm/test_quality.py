import numpy as np
from pyspark.sql import functions as F

from ledgerlake.llm import quality as Q
from tests.llm.helpers import docs, edge_texts, prose


def good_and_bad(spark, n=300):
    texts = [prose(40 + k % 50, k) if k % 3 else " ".join(f"{w.upper()}!!" for w in prose(10 + k % 9, k).split()) * 2 for k in range(n)]
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(n)], "doc_id long, quality int, toxic int")
    return docs(spark, texts), labels


def test_held_out_accuracy_and_labels_are_not_inputs(spark):
    df, labels = good_and_bad(spark)
    model = Q.train(df, labels)
    rows = Q.score(df, model).select("doc_id", "score", Q.held_out(F.col("doc_id"), Q.FOLDS).alias("held")).collect()
    held = [r for r in rows if r["held"]]
    assert len(held) > 30 and np.mean([(r["score"] >= Q.THRESHOLD) == (r["doc_id"] % 3 > 0) for r in held]) > 0.95
    # labels of held-out rows, languages, sources and ids leave every score as it is
    flipped = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id"), Q.FOLDS), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = df.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    again = {r["doc_id"]: r["score"] for r in Q.score(other, Q.train(other, flipped)).collect()}
    assert all(again[r["doc_id"]] == r["score"] for r in rows)


def test_pairs_by_the_sum_of_squares_identity():
    rng = np.random.RandomState(1)
    m = Q.Model(0.3, rng.randn(50).astype(np.float32), rng.randn(50, 4).astype(np.float32), np.zeros((0, 0)))
    idx, val = np.array([3, 7, 20, 41, 5, 9]), rng.rand(6)
    starts = np.array([0, 4])
    z = Q._margin(m, idx, val, starts)[0]
    for k, part in enumerate((slice(0, 4), slice(4, 6))):
        i, x = idx[part], val[part]
        want = 0.3 + (m.linear[i] * x).sum() + sum(
            (m.factors[i[a]] @ m.factors[i[b]]) * x[a] * x[b] for a in range(len(i)) for b in range(a))
        assert abs(z[k] - want) < 1e-4


def test_edges(spark):
    df, labels = good_and_bad(spark, 60)
    odd = docs(spark, edge_texts() + [(None, "a")]).withColumn("score", F.lit("old")).withColumn("n_chars", F.lit(None).cast("long"))
    out = Q.score(odd, Q.train(df, labels))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
    rows = out.collect()
    assert len(rows) == len(edge_texts()) + 1 and all(0 <= r["score"] <= 1 for r in rows)
    scores = {r["doc_id"]: r["score"] for r in rows}
    assert scores[3] == scores[4] and scores[0] == scores[1]


def test_without_labels_or_rows(spark):
    df, labels = good_and_bad(spark, 30)
    none = labels.limit(0)
    assert {r["score"] for r in Q.score(df, Q.train(df, none)).collect()} == {0.5}
    ones = labels.withColumn("quality", F.lit(1))
    assert len({r["score"] for r in Q.score(df, Q.train(df, ones)).collect()}) == 1
    assert Q.score(docs(spark, []), Q.train(docs(spark, []), labels)).count() == 0
    twice = labels.unionByName(labels).unionByName(labels.withColumn("quality", F.lit(None).cast("int")))
    assert Q.keep_good(df, twice).columns == df.columns


def test_the_sample_is_bounded(spark):
    df, labels = good_and_bad(spark, 120)
    model = Q.train(df, labels, max_train=40)
    assert np.isfinite(model.factors).all()
