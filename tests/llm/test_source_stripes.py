import duckdb
import pytest
from pyspark.sql import functions as F

from synthcurate.llm import source_stripes as st
from synthcurate.llm.oracle import ORACLE

COLS = ["lang", "source", "part", "item", "value", "rank"]


def oracle(df):
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "text", "lang", "source").toArrow())
    return sorted(tuple(r) for r in con.execute(f"select {', '.join(COLS)} from ({ORACLE['op13_source_divergence']})").fetchall())


def spark_rows(df):
    return sorted(tuple(r) for r in st.audit(df).select(*COLS).collect())


def test_equals_sql_on_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = spark_rows(docs)
    assert got == oracle(docs)
    assert {r[2] for r in got} == {"pair", "term"}


def test_spills_give_the_same_rows(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    whole = spark_rows(docs)
    monkeypatch.setattr(st, "STRIPE_ENTRIES", 7)
    assert spark_rows(docs.repartition(5)) == whole


def test_odd_rows(spark, odd_docs, no_docs):
    # NULL lang and source read as '', clashing columns are ignored; few documents keep no term
    docs = odd_docs.unionByName(odd_docs.limit(0))
    rows = spark_rows(docs)
    assert rows == oracle(docs)
    assert all(r[2] == "pair" and r[4] == 0 for r in rows)
    assert spark_rows(no_docs) == []


def test_terms_kept_in_thirty_documents(spark):
    text = "Alpha beta gamma9delta é中"
    rows = [(i, text if i < 30 else "beta only", "xx", f"s{i % 3}", 1) for i in range(40)] + [(99, None, "xx", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = spark_rows(docs)
    assert got == oracle(docs)
    assert {r[1] for r in got} == {"s0", "s1", "s2", ""}
