import json
import random

import pytest
from pyspark.sql import types as T

from synthcurate.sources import array_scan, readers

ITEM = T.StructType([T.StructField("headline", T.StringType()), T.StructField("sentiment", T.StringType()), T.StructField("n", T.LongType())])


def write(folder, name, text):
    path = folder / name
    path.write_bytes(text.encode() if isinstance(text, str) else text)
    return path


def rows(df):
    return sorted((r.file, r.pos, r.headline, r.sentiment, r.n) for r in df.collect())


@pytest.mark.parametrize("seed", range(3))
def test_equals_whole_file_reader_at_any_cut(spark, tmp_path, seed):
    rnd = random.Random(seed)
    bits = ['a', '"', '\\', '\\"', ',', '[', ']', '{', '}', 'é', '中', '😀', ' ', '\n', '\\\\']
    items = [{"headline": "".join(rnd.choice(bits) for _ in range(rnd.randrange(30))), "sentiment": rnd.choice(["0", "1", None]), "n": i}
             for i in range(rnd.randrange(1, 60))]
    write(tmp_path, "a.json", "[\n" + ",\n".join(json.dumps(x, ensure_ascii=rnd.random() < 0.5) for x in items) + "\n]")
    write(tmp_path, "b.json", " [ ]  ")
    write(tmp_path, "c.json", json.dumps([{"headline": "x,]\\\"[", "n": 1}, {"n": 2, "headline": None}], indent=3))
    want = rows(readers.read_json_arrays(spark, str(tmp_path), ITEM))
    for step in (1, 2, 3, 7, 64, 1 << 20):
        assert rows(array_scan.scan_arrays(spark, str(tmp_path), ITEM, step)) == want, step


def test_state_summaries_compose():
    text = b'[{"a": "x\\\\\\"y,]"}, ["z", {"b": [1, 2]}], "q\\\\"]'
    for cut in range(len(text) + 1):
        state, depth = array_scan.walk(text[:cut], array_scan.OUT, 0)
        assert array_scan.walk(text[cut:], state, depth) == array_scan.walk(text, array_scan.OUT, 0)


@pytest.mark.parametrize("body", ['{"n": 1}', '[{"n": 1}] x', '[{"n": 1}][{"n": 2}]', '[{"n": 1}, ]', '[{"n": "1]'])
def test_broken_files_are_errors(spark, tmp_path, body):
    write(tmp_path, "x.json", body)
    with pytest.raises(Exception):
        array_scan.scan_arrays(spark, str(tmp_path / "x.json"), ITEM, 3).collect()


def test_ranges_are_tasks(spark, tmp_path):
    items = [{"headline": "h" * 50, "sentiment": "1", "n": i} for i in range(400)]
    write(tmp_path, "big.json", json.dumps(items))
    found = array_scan.scan_arrays(spark, str(tmp_path), ITEM, 1024)
    assert found.count() == 400
    assert sorted(r.pos for r in found.collect()) == list(range(400))


def test_query_equals_sql(spark):
    import duckdb

    from synthcurate.plans.inputs import Inputs
    from synthcurate.plans.oracle import ORACLE
    from synthcurate.plans.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = sorted(tuple(r) for r in QUERIES["scan_array_split"](spark, sf).select("split", "row_id", "label", "text").collect())
    con = duckdb.connect()
    for name in ("documents", "labels", "conversations", "events"):
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    want = sorted(tuple(r) for r in con.execute(f"select split, row_id, label, text from ({ORACLE['scan_array_split']})").fetchall())
    assert got == want and got
