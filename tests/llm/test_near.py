import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import near as N
from ledgerlake.llm.components import components
from tests.llm.helpers import docs, edge_texts, prose


def sets(text):
    words = (text or "").lower().split()
    n = min(5, len(words))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if n else frozenset()


def brute(texts):
    """(class, links) of each position by comparing all pairs."""
    s = [sets(t) for t in texts]
    parent = list(range(len(s)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(s)
    for i in range(len(s)):
        for j in range(i):
            if s[i] and s[j] and 5 * len(s[i] & s[j]) >= 4 * len(s[i] | s[j]):
                links[i] += 1
                links[j] += 1
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [(root(i), links[i]) for i in range(len(s))]


def edited(text, edits, seed):
    rng = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def corpus():
    base = [prose(n, 100 + n) for n in range(60, 100)]
    out = list(base)
    for k, t in enumerate(base[:20]):
        out += [t, t.upper(), edited(t, 1, k), edited(t, 2, k + 50), edited(t, 9, k + 90)]
    # a shared first line, and one large group of near copies
    line = "all of these texts start with this one very common line of words"
    out += [f"{line}\n{prose(60, 500 + k)}" for k in range(60)]
    big = prose(300, 9)
    out += [edited(big, 3, 700 + k) for k in range(90)]
    return out + edge_texts()


def check(got, texts):
    want = brute(texts)
    assert [(got[i]["class_id"], got[i]["n_links"]) for i in range(len(texts))] == want


def test_equals_brute_force(spark):
    texts = corpus()
    check({r["doc_id"]: r for r in N.near_duplicates(docs(spark, texts)).collect()}, texts)


def test_deep_splits_and_blocks_equal_brute_force(spark):
    texts = corpus()
    got = N.near_duplicates(docs(spark, texts), node_limit=12, depth=3, leaf_block=40, block=25)
    check({r["doc_id"]: r for r in got.collect()}, texts)


def test_blocks_bounded_by_bytes_equal_brute_force(spark):
    texts = corpus()
    check({r["doc_id"]: r for r in N.near_duplicates(docs(spark, texts), block_bytes=20_000).collect()}, texts)


def near_copies(spark, g, seed=3):
    """Sets of one group: g different ones that share 40 of 41 shingles, and one that is linked to none."""
    rng = np.random.RandomState(seed)
    base = rng.randint(0, 2**62, 40).astype(np.uint64)
    rows = [(1, k, 1, np.unique(np.append(base, np.uint64(2**63 + k))).tobytes()) for k in range(g)]
    rows.append((1, g, 1, np.unique(rng.randint(0, 2**62, 40).astype(np.uint64)).tobytes()))
    return spark.createDataFrame(rows, "label long, class_key long, copies long, shingles binary")


@pytest.mark.parametrize("g", [256, 512, 1024, 4096])
def test_links_grow_with_the_members_of_a_group(spark, g):
    blocks = -(-g // 256)
    sets = near_copies(spark, g).withColumn("blocks", F.lit(blocks)) \
        .withColumn("own", F.pmod(F.xxhash64("class_key"), F.lit(blocks)).cast("int"))
    links, _ = N.exact_links(sets)
    tree = [(r["u"], r["v"]) for r in links.where("kind = 0").collect()]
    assert len(tree) <= g + blocks * blocks / 2 < 1.2 * g
    label = {r["node"]: r["label"] for r in components(spark.createDataFrame(tree, "u long, v long")).collect()}
    assert len(label) == g and set(label.values()) == {0}
    counts = {r["u"]: r["n"] for r in links.where("kind = 1").groupBy("u").agg(F.sum("v").alias("n")).collect()}
    assert counts == {k: g - 1 for k in range(g)}


def test_null_ids_repeated_ids_and_empty(spark):
    t = prose(50, 1)
    rows = N.near_duplicates(docs(spark, [(None, t), (5, t), (5, t), (5, prose(50, 2)), (9, edited(t, 1, 1)), (None, None)])).collect()
    assert sorted((r["doc_id"] or 0, r["class_id"], r["n_links"]) for r in rows if r["class_id"] is not None) == \
        [(0, 5, 3), (5, 5, 0), (5, 5, 3), (5, 5, 3), (9, 5, 3)]
    assert [(r["doc_id"], r["n_links"]) for r in rows if r["class_id"] is None] == [(None, 0)]
    rows = N.near_duplicates(docs(spark, [(None, t), (None, t), (None, edited(t, 1, 1))])).collect()
    assert [(r["doc_id"], r["class_id"], r["n_links"]) for r in rows] == [(None, None, 2)] * 3
    assert N.near_duplicates(docs(spark, [])).count() == 0


def test_keep_one(spark):
    t = prose(50, 1)
    df = docs(spark, [(7, t), (3, t), (3, t), (None, t), (4, None), (6, None), (8, edited(t, 1, 2)), (9, prose(50, 3)),
                      (None, prose(50, 8)), (None, edited(prose(50, 8), 1, 1)), (None, None), (None, None)])
    df = df.withColumn("class_id", F.lit("mine"))
    kept = N.keep_one(df)
    assert kept.columns == df.columns
    rows = kept.collect()
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == [3, 4, 6, 9]
    assert sorted(r["text"] is None for r in rows if r["doc_id"] is None) == [False, True]


def test_keep_one_of_an_id_on_different_texts(spark):
    a, b, c = prose(50, 1), prose(50, 2), prose(50, 3)
    # 5 stands on a, on a near copy of a and on b; 2 on c and on a copy of b; 4 on no words and on words
    rows = [(5, a), (5, edited(a, 1, 2)), (5, a), (9, a), (5, b), (2, b), (2, c), (4, None), (4, prose(50, 4))]
    kept = sorted((r["doc_id"], r["text"] or "") for r in N.keep_one(docs(spark, rows).repartition(5)).collect())
    near = [t for i, t in kept if i == 5]
    assert len(near) == 1 and near[0] in (a, edited(a, 1, 2))
    assert [k for k in kept if k[0] != 5] == sorted([(2, b), (2, c), (4, ""), (4, prose(50, 4))])


def test_runs_reach_the_recall():
    assert N.runs_for(0.9999) >= N.runs_for(0.99) >= 1
    with pytest.raises(ValueError):
        N.near_duplicates(None, threshold=0.5)


def test_sketch_estimates_similarity():
    rng = np.random.RandomState(2)
    a, b = N.places(512)
    x = rng.randint(0, 2**62, 1000).astype(np.uint64)
    y = np.concatenate([x[:900], rng.randint(0, 2**62, 100).astype(np.uint64)])
    assert abs((N.sketch(x, a, b) == N.sketch(y, a, b)).mean() - 900 / 1100) < 0.07


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 440)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for x in parent}


def test_members_of_nodes_are_not_joined_with_counts(spark, monkeypatch):
    """One large group and many small ones: rows meet crowded nodes only, which are few, and the counts of none."""
    texts = [edited(prose(80, 9), 2, k) for k in range(120)] + [t for k in range(30) for t in (prose(60, 300 + k), edited(prose(60, 300 + k), 1, k))]
    rows = N.sketched(docs(spark, texts)).where("class_key IS NOT NULL")
    classes, _ = N.materialise(rows.groupBy("class_key").agg(F.max("n_shingles").alias("n_shingles"), F.max("sketch").alias("sketch")), "classes")
    tables = {}
    stored = N.materialise
    monkeypatch.setattr(N, "materialise", lambda df, name="cut": tables.setdefault(name, []).append(stored(df, name)) or tables[name][-1])
    links, _ = N.candidate_links(classes, node_limit=16, depth=2)
    assert links.count() and len(tables["crowded-nodes"]) == 2
    for (nodes, _), (crowded, _), (large, _) in zip(tables["nodes"], tables["crowded-nodes"], tables["large-nodes"]):
        sizes = {r["node"]: r["count"] for r in nodes.groupBy("node").count().collect()}
        assert {r["node"]: r["count"] for r in crowded.collect()} == {k: n for k, n in sizes.items() if n > 16}
        assert large.columns == nodes.columns and large.count() == sum(n for n in sizes.values() if n > 16)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    with N.small_batches(spark):
        assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= N.TEXTS
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
