import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.llm import decontaminate as D
from tests.llm.helpers import docs, edge_texts, prose


def bench(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def distance(item, text):
    """Edits of the best alignment of the whole item with a part of the text."""
    prev = [0] * (len(text) + 1)
    for a in item:
        cur = [prev[0] + 1]
        for j, b in enumerate(text, 1):
            cur.append(min(prev[j - 1] + (a != b), prev[j] + 1, cur[-1] + 1))
        prev = cur
    return min(prev)


def mutate(text, edits, rng):
    s = list(text)
    for _ in range(edits):
        p, kind = rng.randrange(len(s)), rng.randrange(3)
        s[p:p + 1] = {0: ["#"], 1: [], 2: [s[p], "%"]}[kind]
    return "".join(s)


def test_equals_brute_force(spark):
    rng = random.Random(8)
    items = [prose(n, n) for n in (5, 9, 14, 22, 30, 12)] + ["", None, "short", prose(14, 14)]
    items += ["one", "x  Short"]
    texts = ["a SHORT one", "ones shortone", "x short", "one", "y x\nshort one x short"] + edge_texts()[:6] + [prose(60, 200 + k) for k in range(10)]
    for k in range(40):
        item = D.normal(items[k % 6])
        a, b = prose(20, 300 + k), prose(20, 400 + k)
        texts.append(f"{a}\n {mutate(item, rng.randrange(0, 2 * D.budget(len(item)) + 1), rng)}  {b.upper()}")
    texts.append(prose(20_000, 77) + " " + items[3] + " " + prose(10, 3))
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in D.matches(docs(spark, texts), bench(spark, items)).collect()}
    for i, t in enumerate(texts[:-1]):
        for j, item in enumerate(items):
            norm = D.normal(item)
            if len(norm) < D.MIN_CHARS:  # whole words, without edits
                assert ((i, j) in got) == (bool(norm) and f" {norm} " in f" {D.normal(t)} ")
                continue
            d = distance(norm, D.normal(t))
            assert ((i, j) in got) == (d <= D.budget(len(norm))), (i, j, d)
            if (i, j) in got:
                assert got[i, j] == d
    assert got[len(texts) - 1, 3] == 0


def test_filter_keeps_clean_rows_and_columns(spark):
    item = prose(25, 1)
    df = docs(spark, edge_texts() + [f"a b {item} c", (None, item), "clean"]).withColumn("edits", F.lit("x"))
    out = D.decontaminate(df, bench(spark, [item]))
    assert out.columns == df.columns
    # the item's words come in its own order elsewhere: only rows that hold the passage go
    dirty = [t for t in edge_texts() if D.normal(item) in D.normal(t)]
    assert out.count() == len(edge_texts()) - len(dirty) + 1


def test_empty_tables_and_blocks(spark, monkeypatch):
    items = [prose(20, k) for k in range(12)]
    texts = [f"x {t} y" for t in items] * 2
    one = D.matches(docs(spark, texts), bench(spark, items)).select("doc_id", "item_id", "edits").collect()
    monkeypatch.setattr(D, "BLOCK_CHARS", 300)
    many = D.matches(docs(spark, texts), bench(spark, items)).select("doc_id", "item_id", "edits").collect()
    assert sorted(one) == sorted(many) and len(one) == 24
    assert D.matches(docs(spark, []), bench(spark, items)).count() == 0
    assert D.matches(docs(spark, texts), bench(spark, [])).count() == 0
    assert D.decontaminate(docs(spark, texts), bench(spark, [])).count() == 24


def test_runs_of_one_empty_text(spark):
    item = prose(25, 1)
    for empty in (None, "", " "):
        one = docs(spark, [empty]).coalesce(1)
        assert D.matches(one, bench(spark, [item])).count() == 0
        assert [r["text"] for r in D.decontaminate(one, bench(spark, [item])).collect()] == [empty]
        # the long text closes a run, so the empty one makes up its own
        both = docs(spark, ["x" * D.SCAN_CHARS + f" {item}", empty]).coalesce(1)
        assert [(r["doc_id"], r["edits"]) for r in D.matches(both, bench(spark, [item])).collect()] == [(0, 0)]
        assert [r["doc_id"] for r in D.decontaminate(both, bench(spark, [item])).collect()] == [1]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abc", min_size=1, max_size=14), st.text(alphabet="abc", max_size=30))
def test_alignment_over_all_diagonals_is_the_edit_distance(item, text):
    edits, start, end = D.align(D.codes_of(item), D.codes_of(text), -20, 40)
    assert edits == distance(item, text)
    assert 0 <= start <= end <= len(text)


OPENING = "all of these questions begin with one and the same long phrase "


def shared_by_hits(index, norm, i):
    """Band counts of an item by plain loops."""
    m, k = int(index.lengths[i]), int(index.budgets[i])
    item, step, bands = index.texts[i], int(index.budgets[i]) + 1, {}
    at = {}
    for a in range(len(norm) - D.Q + 1):
        at.setdefault(norm[a:a + D.Q], []).append(a)
    for p in range(m - D.Q + 1):
        for a in at.get(item[p:p + D.Q], []):
            for b in ((a - p) // step, (a - p) // step - 1):
                bands.setdefault(b, set()).add(p)
    return {b * step: len(ps) for b, ps in bands.items() if len(ps) >= m - D.Q + 1 - k * D.Q}


def test_bands_are_exact_with_phrases_that_items_share(monkeypatch):
    monkeypatch.setattr(D, "HOT_PAIRS", 20)
    monkeypatch.setattr(D, "SLICE", 50)
    rng = random.Random(5)
    items = [(k, OPENING + prose(4 + 6 * (k % 4), k)) for k in range(12)] + [(50, OPENING * 2), (51, "ab" * 30)]
    index = D.build_index(items)
    for n in range(12):
        parts = [rng.choice([OPENING, items[rng.randrange(14)][1], mutate(items[rng.randrange(14)][1], 4, rng), prose(5, n), "ab" * 20])
                 for _ in range(8)]
        norm = D.normal(" ".join(parts))
        h = D.grams(D.codes_of(norm))
        key = D.np.searchsorted(index.keys, h)
        key[key == len(index.keys)] = 0
        at = D.np.flatnonzero(index.keys[key] == h)
        got = {}
        for i, first, shared in D._regions(index, at, key[at]):
            got.setdefault(i, {})[first] = shared
        assert got == {i: b for i in range(len(index.texts)) if (b := shared_by_hits(index, norm, i))}


def test_a_repeated_phrase_that_a_thousand_items_share_is_cheap():
    import time
    items = [(k, OPENING + prose(25, k)) for k in range(1000)] + [(5000, OPENING + prose(25, 7))]
    index, t = D.build_index(items), time.time()
    assert D.scan([OPENING * 2000], index) == []
    assert {f[1] for f in D.scan([OPENING * 1000 + items[7][1], "a " * 30_000], index)} == {7, 5000}
    every = D.scan([" ".join(x for _, x in items) + OPENING * 500], index)
    assert {f[1] for f in every} == {k for k, _ in items} and time.time() - t < 60
