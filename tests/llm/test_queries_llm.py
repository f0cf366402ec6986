"""Registered queries against their SQL, and the pipeline stage by stage."""

import math
import subprocess
import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from conftest import DATA
from synthcurate.llm import decontaminate_wm, line_dedup, simhash_vp
from synthcurate.llm.queries import ORACLE, QUERIES

TABLES = "documents pages benchmark labels".split()
COLUMNS = {
    1: "doc_id held_out score predicted", 2: "doc_id n_words n_hit n_items items_sha256 contaminated",
    3: "page_id payload_bytes payload_digest record_type refers_to", 4: "doc_id piece start length ids_crc32 sequence_id offset",
    5: "doc_id held_out n_tokens n_known train_tokens base_score score", 6: "doc_id n_tokens", 7: "doc_id fingerprint component_id",
    8: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept", 9: "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    10: "doc_id n_lines removed",
}


def cells(df):
    def cell(v):
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return None
        return v.item() if hasattr(v, "item") else v

    columns = sorted(df.columns)
    return columns, sorted(([cell(v) for v in row] for row in df[columns].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/sf0.001/{t}.parquet'")
    assert cells(QUERIES[name](spark, f"{DATA}/sf0.001").toPandas()) == cells(con.execute(ORACLE[name]).df())


@pytest.mark.parametrize("n", range(1, 11))
def test_every_operator_has_a_query(spark, n):
    (name,) = [k for k in entry_module.queries() if k.startswith(f"op{n}_")]
    rows = QUERIES[name](spark, f"{DATA}/sf0.001")
    assert set(COLUMNS[n].split()) <= set(rows.columns)
    table = "pages" if n == 3 else "documents"
    ids = spark.read.parquet(f"{DATA}/sf0.001/{table}.parquet").select(rows.columns[0])
    assert rows.select(rows.columns[0]).distinct().count() == ids.distinct().count()


def test_stages_hand_on_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, f"{DATA}/sf0.001")
            assert kept.schema.names == docs.schema.names and [f.dataType for f in kept.schema] == [f.dataType for f in docs.schema]
            assert kept.count() <= docs.count(), name
        assert corpus_pipeline.packing(spark, docs, f"{DATA}/sf0.001").count() >= docs.count()


def test_pipeline_decisions_take_effect(spark):
    from synthcurate.llm.common import stored, table

    sf = f"{DATA}/sf0.001"
    docs, after = table(spark, sf, "documents"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf), "test-stage")
        after.append(docs)
    good, lines, single, clean = after
    scores = {r.doc_id: r.predicted for r in QUERIES["op1_quality_classifier"](spark, sf).collect()}
    assert {r.doc_id for r in good.collect()} == {k for k, v in scores.items() if v == 1}
    assert sum(len(r.equal) + len(r.near) for r in line_dedup.decisions(lines).collect()) == 0
    assert all(r.n_chars == len(r.text) for r in lines.collect() if r.text is not None)
    assert simhash_vp.near_duplicates(single, simhash_vp.EXACT).select("root").distinct().count() == single.count()
    bench = table(spark, sf, "benchmark")
    assert clean.select(decontaminate_wm.contamination(clean, bench)["n_hit"].alias("n")).filter("n > 0").count() == 0
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()} == {r.doc_id for r in clean.collect()}


def test_the_rest_does_not_import_it():
    root = Path(__file__).resolve().parents[2]
    code = (
        "import sys, importlib.util as u; real = u.find_spec\n"
        "u.find_spec = lambda n, *a: None if n in ('synthcurate.llm', 'corpus_pipeline') else real(n, *a)\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not any(k.startswith('op1_') or k == 'pipeline' for k in e.queries())\n"
        "assert not any(m.startswith('synthcurate.llm') for m in sys.modules)\n"
    )
    assert subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True).stderr == ""
