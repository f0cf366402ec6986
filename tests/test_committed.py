from pyspark.sql import functions as F

from synthcurate.session import scratch_path
from synthcurate.sources import committed

SCHEMA = "model string, prompt string, prompt_id bigint, headline string"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def read(spark, root):
    return sorted(tuple(r) for r in committed.read_committed(spark, root, SCHEMA).collect())


def test_two_writers_leave_a_dataset_once(spark):
    root = scratch_path(spark, "two-writers")
    a = rows(spark, [("m", "p", 1, "a1"), ("m", "q", 2, "a2")])
    b = rows(spark, [("m", "p", 1, "b1"), ("m", "p", 3, "b3"), ("n", None, 4, "b4")])
    first = {r["_ds"]: r["committed"] for r in committed.write_committed(a, root, writer="A").collect()}
    second = {r["_ds"]: r["committed"] for r in committed.write_committed(b, root, writer="B").collect()}
    assert all(first.values()) and sorted(second.values()) == [False, True]
    assert read(spark, root) == [("m", "p", 1, "a1"), ("m", "q", 2, "a2"), ("n", None, 4, "b4")]
    # the same writer again commits nothing new and changes nothing
    committed.write_committed(a, root, writer="A")
    assert read(spark, root) == [("m", "p", 1, "a1"), ("m", "q", 2, "a2"), ("n", None, 4, "b4")]


def test_a_killed_writer_leaves_nothing_visible(spark):
    root = scratch_path(spark, "killed")
    committed.stage(rows(spark, [("m", "p", 1, "x")]), root, "K")  # staged, never committed
    assert read(spark, root) == []
    committed.write_committed(rows(spark, [("m", "p", 2, "y")]), root, writer="L")
    assert read(spark, root) == [("m", "p", 2, "y")]


def test_null_keys_do_not_meet(spark):
    keys = spark.createDataFrame([(None, "a"), ("", "a"), ("n", None), ("n", "")], "model string, prompt string")
    assert keys.select(committed.dataset_key(["model", "prompt"])).distinct().count() == 4


def test_query_equals_sql(spark):
    import duckdb

    from synthcurate.plans.oracle import ORACLE
    from synthcurate.plans.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = sorted(map(tuple, QUERIES["committed_writes"](spark, sf).collect()))
    con = duckdb.connect()
    for name in ("documents", "labels", "conversations", "events"):
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    cols = "model, prompt, prompt_id, attempt, pos, headline, sentiment"
    want = sorted(con.execute(f"select {cols} from ({ORACLE['committed_writes']})").fetchall())
    assert got == want and got
