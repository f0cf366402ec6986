import random

from pyspark.sql import functions as F

from synthcurate.operators import schedule
from synthcurate.operators.ordinals import running_max


def recurrence(rows, gap):
    """start = max(ready, previous start + gap), lane by lane, by (ready, key)."""
    out, lanes = {}, {}
    for lane, ready, key in sorted((r for r in rows if r[1] is not None), key=lambda r: (str(r[0]), r[1], r[2])):
        prev = lanes.get(lane)
        start = ready if prev is None else max(ready, prev + gap)
        lanes[lane] = start
        out[key] = start
    return out


def test_equals_the_recurrence_across_partitions(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None] + list(range(0, 300, 3))), k) for k in range(600)]
    rows += [("hot", rnd.randrange(1000), 1000 + k) for k in range(3000)]  # a lane of most rows
    df = spark.createDataFrame(rows, "lane string, ready long, key long").repartition(7)
    got = {r.key: r.start for r in schedule.schedule(df, ["lane"], "ready", "key", 5).collect()}
    assert got == recurrence(rows, 5)


def test_running_max_with_nulls(spark):
    rows = [("g", i, v) for i, v in enumerate([None, 3, 1, None, 7, 2])] + [("h", 0, -5)]
    df = spark.createDataFrame(rows, "g string, o long, v long").repartition(3)
    got = {(r.g, r.o): r.upto for r in running_max(df, ["g"], ["o"], "v").collect()}
    assert [got[("g", i)] for i in range(6)] == [None, 3, 3, 3, 7, 7] and got[("h", 0)] == -5


def test_query_equals_sql(spark):
    import duckdb

    from synthcurate.plans.oracle import ORACLE
    from synthcurate.plans.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    got = sorted(map(tuple, QUERIES["schedule_requests"](spark, sf).collect()))
    con = duckdb.connect()
    for name in ("documents", "labels", "conversations", "events"):
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    want = sorted(con.execute(f"select event_id, event_type, place, ready, start, wait from ({ORACLE['schedule_requests']})").fetchall())
    assert got == want and any(r[5] > 0 for r in got)
