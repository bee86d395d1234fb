import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import ranked as R
from tests.llm.helpers import WORDS, docs, edge_texts, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, k=10):
    """Every document scored for every item."""
    counts = [(i, Counter(terms(t))) for i, t in rows]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in counts:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in terms(text) if t in c)
            if s > 0:
                scored.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def items_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def found(spark, rows, items, **kw):
    return sorted((tuple(r) for r in R.search(docs(spark, rows).repartition(3), items_of(spark, items), **kw).collect()), key=str)


def zipf(n, seed):
    rng = random.Random(seed)
    return " ".join(WORDS[min(int(rng.paretovariate(0.7)) - 1, len(WORDS) - 1)] + rng.choice(["", "", "x", "Y9"]) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    return [(k, zipf(5 + k % 90, k % 230)) for k in range(400)]


@pytest.mark.parametrize("block", [{}, {"block_docs": 7}, {"block_postings": 50}])
def test_equals_brute_force(spark, corpus, block):
    items = [(k, zipf(3 + 2 * k, 1000 + k)) for k in range(12)] + [(90, corpus[17][1]), (91, "ta ta ta rox"), (92, "nowhere")]
    assert found(spark, corpus, items, **block) == brute(corpus, items)


def test_edges_of_texts_items_and_ids(spark):
    texts = edge_texts() + ["É é ß E", "a-b_c", "x1 X1", "中文 中文", "..."]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "one rare"), (None, "one rare"), (3, "one")]
    items = [(1, "one"), (2, None), (3, ""), (4, "É X1 中文 A"), (5, prose(40, 1)), (6, "!!"), (6, "rare"), (7, "one"), (8, prose(3000, 5))]
    assert found(spark, rows, items) == brute(rows, items)
    # items equal in id and text count once
    assert found(spark, rows, items + [(1, "one")]) == brute(rows, items)


def test_ties_go_by_id_even_at_the_last_place(spark):
    rows = [(k, "same words here") for k in range(50, 0, -1)] + [(100 + k, "other") for k in range(200)]
    for block in ({}, {"block_docs": 4}):
        out = found(spark, rows, [(1, "words"), (2, "same here")], **block)
        assert out == brute(rows, [(1, "words"), (2, "same here")])
        assert sorted(r[2] for r in out if r[0] == 1) == list(range(1, 11))


def test_empty_tables_and_clashing_columns(spark, corpus):
    assert found(spark, [], [(1, "ta")]) == [] and found(spark, corpus, []) == [] and found(spark, [(1, None)], [(1, "ta")]) == []
    df = docs(spark, corpus[:40]).withColumn("terms", F.lit("x")).withColumn("id", F.lit(1)).withColumn("n", F.lit(2))
    items = items_of(spark, [(1, "ta tan rox")]).withColumn("t", F.lit("no")).withColumn("item", F.lit(5))
    assert sorted((tuple(r) for r in R.search(df, items).collect()), key=str) == brute(corpus[:40], [(1, "ta tan rox")])


def test_reading_stops_before_the_lists_end():
    rng = np.random.RandomState(4)
    n, v = 4000, 6
    impacts = (rng.pareto(1.2, (n, v)) * 1000).astype(np.int64) + 1
    block = R.Block(np.arange(n), np.full(n, v), np.tile(np.arange(v), n), impacts.ravel(), v)
    docs_found, scores, read = block.search(np.arange(v), np.ones(v, np.int64), 10, 1)
    order = np.lexsort((np.arange(n), -impacts.sum(axis=1)))[:10]
    assert docs_found.tolist() == order.tolist() and scores.tolist() == impacts.sum(axis=1)[order].tolist()
    assert read < n * v / 4
    # a floor from an earlier block ends it sooner
    assert block.search(np.arange(v), np.ones(v, np.int64), 10, int(scores[0]) * 2)[2] < read


def test_lengths_are_exact_beyond_64_bits():
    n = np.array([10**9, 5], np.int64)
    assert R.length_norms(n, 10**11, 10**13).tolist() == [25 + 75 * 10**9 * 10**11 // 10**13, 25 + 75 * 5 * 10**11 // 10**13]


def test_a_long_text_is_counted_in_windows(monkeypatch):
    monkeypatch.setattr(R, "WINDOW", 16)
    text = prose(500, 3) + " " + "y" * 100 + "É"
    assert R.term_counts(text) == (len(terms(text)), Counter(t.encode() for t in terms(text)))
