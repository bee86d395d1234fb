"""Registry of this subpackage's queries and their DuckDB oracle."""

from __future__ import annotations

import corpus_pipeline
from ledgerlake.llm.ann import op10_ann
from ledgerlake.llm.bpe import op5_bpe
from ledgerlake.llm.decontaminate import op4_decontaminate
from ledgerlake.llm.exact import op11_exact, op11_sql
from ledgerlake.llm.html import op7_html
from ledgerlake.llm.lm import op3_lm
from ledgerlake.llm.near import op2_near
from ledgerlake.llm.planes import op13_planes, op13_sql
from ledgerlake.llm.quality import op8_quality
from ledgerlake.llm.ranked import op12_ranked, op12_sql
from ledgerlake.llm.sharding import op9_sharding
from ledgerlake.llm.urls import op1_sql, op1_urls
from ledgerlake.llm.warc import op6_sql, op6_warc

QUERIES = {
    "op1_urls": op1_urls,
    "op2_near": op2_near,
    "op3_lm": op3_lm,
    "op4_decontaminate": op4_decontaminate,
    "op5_bpe": op5_bpe,
    "op6_warc": op6_warc,
    "op7_html": op7_html,
    "op8_quality": op8_quality,
    "op9_sharding": op9_sharding,
    "op10_ann": op10_ann,
    "op11_exact": op11_exact,
    "op12_ranked": op12_ranked,
    "op13_planes": op13_planes,
    "pipeline": corpus_pipeline.run,
}


def oracle_sql() -> dict[str, str]:
    out = {"op1_urls": op1_sql(), "op6_warc": op6_sql(), "op11_exact": op11_sql(), "op12_ranked": op12_sql(),
           "op13_planes": op13_sql()}
    if corpus_pipeline.ORACLE_SQL is not None:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
