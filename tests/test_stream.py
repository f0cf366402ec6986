from synthcurate.operators.gate import flatten, gate
from synthcurate.plans.curate import CurationSpec, curate
from synthcurate.streaming import curate as streaming

SCHEMA = "prompt_id long, attempt long, raw string"


def completions(rows, start, n):
    return rows([(i, 1, f'[{{"headline": "head {i % 7}", "sentiment": "1"}}, {{"headline": "own {i}", "sentiment": 0}}]'
                  if i % 3 else "broken") for i in range(start, start + n)], SCHEMA)


def test_stream_equals_batch_and_resumes(spark, rows, tmp_path):
    landing, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for start in (0, 20, 40):  # each start goes on from the checkpoint
        completions(rows, start, 20).write.mode("append").parquet(landing)
        landed = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(landing)
        streaming.start(streaming.curate_stream(landed), out, state).awaitTermination()
    got = spark.read.parquet(out)
    batch = curate(spark.read.schema(SCHEMA).parquet(landing), CurationSpec())
    assert sorted(r.headline for r in got.collect()) == sorted(r.headline for r in batch.collect())


def test_bounded_memory(spark, rows, tmp_path):
    timed = completions(rows, 0, 20).selectExpr("*", "timestamp'2024-01-01' + make_interval(0,0,0,0,0,prompt_id) as ts")
    landing = str(tmp_path / "in")
    timed.write.parquet(landing)
    landed = spark.readStream.schema(timed.schema).parquet(landing)
    stream = streaming.curate_stream(landed, time="ts", within="1 hour")
    streaming.start(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    expected = flatten(gate(timed)).select("headline").distinct().count()
    assert spark.read.parquet(str(tmp_path / "out")).count() == expected
