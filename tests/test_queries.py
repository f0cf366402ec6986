"""Every registered query against its SQL, and rules every plan must keep."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module
from conftest import DATA
from synthcurate.plans.inputs import Inputs
from synthcurate.plans.oracle import ORACLE
from synthcurate.plans.queries import QUERIES

TABLES = "documents labels conversations events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/sf0.001/{t}.parquet'")
    return con


def comparable(df):
    def cell(v):
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return None
        return v.item() if hasattr(v, "item") else v

    columns = sorted(df.columns)
    return columns, sorted(([cell(v) for v in row] for row in df[columns].itertuples(index=False)), key=repr)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry_module.queries().keys() and ORACLE.keys() <= entry_module.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, f"{DATA}/sf0.001")
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert comparable(result.toPandas()) == comparable(duck.execute(ORACLE[name]).df())


def test_entry(spark):
    rows = entry_module.entry(spark)
    assert set(rows.columns) == {"prompt_id", "attempt", "pos", "headline", "sentiment", "model", "prompt"}
    assert rows.count() > 0


@pytest.mark.parametrize("name", ["dedup_headline", "sample_per_dataset", "curate_e2e", "quota_take", "first_valid", "fewshot_draw"])
def test_hot_conversation(spark, duck, tmp_path, name):
    """A third of all turns in one conversation changes nothing but the speed."""
    source = spark.read.parquet(f"{DATA}/sf0.001/conversations.parquet")
    hot = source.selectExpr("7L as conv_id", "turn + 8 * conv_id as turn", "role", "text").filter("turn > 7")
    source.union(hot).write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    for t in ("documents", "labels", "events"):
        spark.read.parquet(f"{DATA}/sf0.001/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
        con.execute(f"create view {t} as select * from '{DATA}/sf0.001/{t}.parquet'")
    assert comparable(QUERIES[name](spark, str(tmp_path)).toPandas()) == comparable(con.execute(ORACLE[name]).df())


def test_scan_is_pruned_and_filtered(spark):
    plan = Inputs(spark, f"{DATA}/sf0.001").completions().select("prompt_id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(role), EqualTo(role,assistant)]" in plan
    assert "ReadSchema: struct<conv_id:bigint,role:string>" in plan
