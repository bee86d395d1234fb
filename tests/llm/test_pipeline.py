import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline as P
from tests.conftest import SF
from tests.llm.helpers import docs, edge_texts, prose


def test_stages_work_on_what_their_predecessor_kept(spark):
    assert [n for n, _ in P.STAGES] == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "byte-level BPE"]
    df, sizes = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(P.STAGES):
        before = df
        df = stage(spark, df, SF)
        rows = df.collect()
        sizes.append(len(rows))
        if k < 3:
            assert df.columns == before.columns
            df = spark.createDataFrame(rows, before.schema)
    assert sizes[0] < 200 and sizes[1] < sizes[0] and sizes[2] <= sizes[1] and sizes[3] == sizes[2]
    assert len(P.run(spark, SF).collect()) == sizes[-1]


def test_edges_pass_through_every_stage(spark):
    df = docs(spark, edge_texts() + [(None, prose(30, 3))])
    for _, stage in P.STAGES[1:3]:
        df = stage(spark, df, SF)
    assert df.where("doc_id IS NULL").count() == 1
    assert P.STAGES[3][1](spark, df, SF).count() == df.count()
    empty = docs(spark, [])
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF).count() == 0


@pytest.mark.parametrize("name", ["op1_urls", "op6_warc"])
def test_oracle(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    sql = con.execute(entry.oracle_sql()[name])
    cols = sorted(d[0] for d in sql.description)
    order = [[d[0] for d in sql.description].index(c) for c in cols]
    want = sorted(tuple(str(r[i]) for i in order) for r in sql.fetchall())
    got = entry.queries()[name](spark, SF)
    assert sorted(got.columns) == cols
    assert sorted(tuple(str(r[c]) for c in cols) for r in got.collect()) == want


def test_every_operator_has_one_query():
    names = [n for n in entry.queries() if n.startswith("op") and n[2:3].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
