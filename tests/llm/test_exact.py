import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from ledgerlake.llm import exact as X
from tests.llm.helpers import docs, edge_texts, prose
from tests.llm.plans import plan_of


def brute(rows):
    """(doc_id, keep_id, group_size, kept, text_sha256) of each (doc_id, text), by a dictionary of whole texts."""
    groups, out, stays = defaultdict(list), [], set()
    normal = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    for i, t in rows:
        groups[normal(t)].append(i)
    for i, t in rows:
        n = normal(t)
        ids = [x for x in groups[n] if x is not None]
        keep = min(ids) if ids else None
        kept = i == keep and n not in stays
        if kept:
            stays.add(n)
        out.append((i, keep, len(groups[n]), kept, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df, **kw):
    return sorted((tuple(r) for r in X.exact_duplicates(df, **kw).collect()), key=str)


def numbered(texts):
    return [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]


def test_equals_brute_force_on_copies_and_edges(spark):
    texts = edge_texts() + [prose(20, n % 37) for n in range(120)] + ["a b", "a\tb", "a \n b", " a b", "a b ", "a b", "A b"]
    assert found(docs(spark, texts)) == brute(numbered(texts))


def test_a_third_of_the_rows_are_one_text(spark):
    texts = ["the same text"] * 400 + [f"text {k}" for k in range(800)] + ["pair", "pair"]
    df = docs(spark, texts).repartition(8)
    assert found(df) == brute(numbered(texts))
    # the group meets its rows by a broadcast, and copies combine before the shuffle
    hashes = X.hashed(df)
    assert X.groups_of(hashes.withColumn("maybe", F.lit(True))).where("group_size = 400").count() == 1


def test_a_full_filter_gives_the_same_result(spark):
    texts = [prose(6, n % 2500) for n in range(4000)]
    df = docs(spark, texts)
    assert found(df, max_cells=1) == found(df) == brute(numbered(texts))


def test_the_filter_misses_no_repeated_hash_and_passes_most_single_ones(spark):
    hashes = X.hashed(docs(spark, [f"text {k}" for k in range(5000)] + ["text 7", "text 9"]))
    cells = X.cells_for(5002)
    assert cells == 1 << 17 and X.cells_for(0) == X.PAGE and X.cells_for(10**12) == X.MAX_CELLS
    maybe = X.with_maybe(hashes, X.repeated_cells(hashes, cells), cells).where("maybe")
    ids = {r["doc_id"] for r in maybe.collect()}
    assert {7, 9, 5000, 5001} <= ids and len(ids) < 5002 * 0.05


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = [(None, "a"), (None, "a"), (3, "a"), (3, "a"), (2, "b"), (None, "c"), (None, "c"), (5, None), (4, "")]
    out = found(docs(spark, rows))
    assert out == brute(rows)
    assert sum(r[3] for r in out) == 4
    assert found(docs(spark, [])) == []


def test_deduplicated_keeps_the_rows_that_stay_with_clashing_columns(spark):
    texts = [(5, "x  y"), (4, "x y"), (4, "x\ny"), (9, "z"), (None, "z"), (7, None), (1, prose(50, 3)), (2, prose(50, 3))]
    df = docs(spark, texts).withColumn("h", F.lit("own")).withColumn("row", F.lit(1)).withColumn("maybe", F.lit(2)) \
        .withColumn("page0", F.lit(3)).withColumn("id", F.lit(4))
    out = X.deduplicated(df)
    assert out.columns == df.columns
    rows = out.collect()
    assert sorted(r["doc_id"] for r in rows) == [1, 4, 7, 9] and all(r["h"] == "own" and r["maybe"] == 2 for r in rows)
    assert len(found(df)) == len(texts)


def test_native_plan(spark):
    plan = plan_of(X.exact_duplicates(docs(spark, ["a", "b", "a"])))
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
