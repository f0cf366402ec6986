import json

import pytest
from pyspark.sql import functions as F

from synthcurate import schemas
from synthcurate.functions import text as tx
from synthcurate.sources import readers, sinks

EXAMPLES = "model string, prompt string, prompt_id long, attempt long, pos long, headline string, sentiment string"


def examples(rows):
    return rows([("m", "zero-shot_v1", i, 1, 0, f'h "{i}" é', None if i == 3 else "1") for i in range(25)]
                + [("m", "few-shot_v1", 0, 1, 0, "only", "2")], EXAMPLES)


def dump(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(value, indent=2, ensure_ascii=False), encoding="utf-8")


def test_read_labeled(spark, tmp_path):
    dump(tmp_path / "t.json", [{"text": "a\nb", "label": 0}, {"text": "$A", "label": 2}])
    dump(tmp_path / "v.json", [{"text": "c", "label": 1, "other": 1}])
    out = readers.read_labeled(spark, str(tmp_path / "t.json"), str(tmp_path / "v.json"))
    assert sorted(map(tuple, out.collect())) == [("$A", 2, "train"), ("a\nb", 0, "train"), ("c", 1, "validation")]
    (tmp_path / "v.json").write_text("[{")
    with pytest.raises(Exception):
        readers.read_labeled(spark, str(tmp_path / "t.json"), str(tmp_path / "v.json")).collect()


def test_json_arrays_keep_order_and_are_valid(spark, rows, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_json_arrays(examples(rows), path, ["model", "prompt"], ["prompt_id", "attempt", "pos"], bytes_per_file=600)
    files = sorted((tmp_path / "out" / "model=m" / "prompt=zero-shot_v1").glob("part-*"))
    arrays = sorted((json.loads(f.read_text("utf-8")) for f in files), key=lambda a: int(a[0]["headline"].split('"')[1]))
    assert len(arrays) == 3 and all(len(a) <= 13 for a in arrays)
    flat = [x for a in arrays for x in a]
    assert flat == [{"headline": f'h "{i}" é', "sentiment": None if i == 3 else "1"} for i in range(25)]
    assert files[0].read_text("utf-8").rstrip("\n") == json.dumps(json.loads(files[0].read_text("utf-8")), indent=2, ensure_ascii=False)
    back = readers.read_json_arrays(spark, f"{path}/model=m/prompt=zero-shot_v1", schemas.EXAMPLE)
    assert back.count() == 25 and back.select("file").distinct().count() == 3


def test_broken_array_is_an_error(spark, tmp_path):
    (tmp_path / "x.json").write_text('[{"headline": "a"')
    with pytest.raises(Exception):
        readers.read_json_arrays(spark, str(tmp_path / "x.json"), schemas.EXAMPLE).collect()


def test_aux(spark, tmp_path):
    dump(tmp_path / "aux.json", [{"idx": 0, "topic": "x"}, {"idx": 1, "topic": "y"}])
    item = schemas.T.StructType([schemas.T.StructField("idx", schemas.T.LongType()), schemas.T.StructField("topic", schemas.T.StringType())])
    out = readers.read_aux(spark, str(tmp_path / "aux.json"), item, lambda df: df.withColumn("topic", F.upper("topic")))
    assert sorted(map(tuple, out.collect())) == [(0, "X"), (1, "Y")]


def test_named_datasets_and_resume(spark, tmp_path):
    name = "llama3.1-8b_2_prompt=zero-shot_v1.json"
    dump(tmp_path / "full" / name, [{"headline": "a", "sentiment": "1"}, {"headline": "b", "sentiment": 2}])
    dump(tmp_path / "full" / "metadata.json", {"MODEL": "x"})
    out = readers.read_named_datasets(spark, str(tmp_path / "full")).collect()
    assert sorted((r.dataset, r.headline, r.sentiment) for r in out) == [(name, "a", "1"), (name, "b", "2")]
    path = str(tmp_path / "full" / name)
    resumed = readers.read_resume(spark, path, "zero-shot_v1").orderBy("pos").collect()
    assert [(r.pos, r.headline) for r in resumed] == [(0, "a"), (1, "b")]
    with pytest.raises(Exception, match="does not belong to template few-shot_v1"):
        readers.read_resume(spark, path, "few-shot_v1").collect()


def test_templates_from_folder(spark, tmp_path):
    (tmp_path / "zero-shot_v9.txt").write_text("line\n\n{stock_ticker}\n", encoding="utf-8")
    (tmp_path / "notes.md").write_text("x")
    assert [tuple(r) for r in readers.read_templates(spark, str(tmp_path)).collect()] == [("zero-shot_v9", "line\n\n{stock_ticker}\n")]


def test_runs_take_their_time_from_the_name(spark, tmp_path):
    dump(tmp_path / "batched_inference_benchmarking_2024-03-02_01-02-03.json", {"total_time": 2.0, "throughput": 5.0, "num_examples": 10})
    dump(tmp_path / "benchmarking_results_20230102_235959.json", {"total_time": 1.0, "throughput": 10.0, "num_examples": 10, "service": "s"})
    out = readers.read_runs(spark, str(tmp_path)).orderBy("finished_at").collect()
    assert [str(r.finished_at) for r in out] == ["2023-01-02 23:59:59", "2024-03-02 01:02:03"]
    assert [r.service for r in out] == ["s", None]


def test_store_and_missing(spark, rows, tmp_path):
    path = str(tmp_path / "store")
    sinks.write_examples(examples(rows).filter("prompt = 'few-shot_v1'"), path)
    todo = sinks.missing_datasets(examples(rows), readers.read_examples(spark, path))
    assert todo.count() == 25
    sinks.write_examples(todo, path)
    stored = readers.read_examples(spark, path)
    assert stored.count() == 26 and sinks.missing_datasets(examples(rows), stored).count() == 0
    pruned = stored.filter("prompt = 'few-shot_v1'")
    assert "PartitionFilters: [isnotnull(prompt" in pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.count() == 1


def test_run_settings(spark, rows, tmp_path):
    runs = rows([("f", {"TEMPERATURE": "0", "MODEL": "m"})], "file string, settings map<string,string>")
    merged = sinks.run_settings(runs, {"TEMPERATURE": 1.0, "TOP_P": 0.95})
    sinks.write_runs(merged, str(tmp_path / "runs"))
    sinks.write_runs(merged, str(tmp_path / "runs"))
    stored = spark.read.parquet(str(tmp_path / "runs"))
    assert stored.count() == 2 and stored.first().settings == {"TEMPERATURE": "1.0", "MODEL": "m", "TOP_P": "0.95"}
    assert sinks.run_settings(runs, {}).first().settings == {"TEMPERATURE": "0", "MODEL": "m"}


def test_summary_and_benchmark_files(spark, rows, tmp_path):
    table = rows([("1 GPU", 2.5)], "gpu_config string, throughput_mean double")
    sinks.write_summary(table, str(tmp_path / "csv"))
    (part,) = (tmp_path / "csv").glob("part-*.csv")
    assert part.read_text() == "gpu_config,throughput_mean\n1 GPU,2.5\n"
    sinks.write_benchmarks(rows([(1.0, 2.0, 2)], "total_time double, throughput double, num_examples long"), str(tmp_path / "b"))
    assert spark.read.schema(schemas.BENCHMARK).json(str(tmp_path / "b")).first().num_examples == 2


def test_example_json_of_null(rows):
    df = rows([("a", None)], "h string, s string")
    assert json.loads(df.select(tx.example_json(F.col("h"), F.col("s"))).first()[0]) == {"headline": "a", "sentiment": None}


def test_missing_datasets_without_a_name(rows):
    df = rows([(None, "p", 1), ("m", "p", 2)], "model string, prompt string, x long")
    assert [r.x for r in sinks.missing_datasets(df, df.filter("model is null")).collect()] == [2]
