"""Cases in which rows, values or errors could get lost without notice."""

import json

import pytest
from pyspark.sql import functions as F

from synthcurate.functions.completion import Field, Gate
from synthcurate.operators import gate, metrics, prompts, rounds
from synthcurate.operators.ordinals import running_totals
from synthcurate.plans.curate import CurationSpec, curate
from synthcurate.sources import readers, sinks
from synthcurate.streaming import curate as streaming


def test_running_totals_keep_nulls_and_large_ids(rows):
    big = 2**53 + 1
    df = rows([(big, None, 2, "a"), (None, 1, 3, None), (big, big, 5, "c"), (None, None, None, "d")], "g long, k long, v long, t string")
    out = sorted(map(tuple, running_totals(df.coalesce(1), ["g"], ["k"], "v").collect()), key=repr)
    assert out == sorted([(big, None, 2, "a", 0), (big, big, 5, "c", 2), (None, None, None, "d", 0), (None, 1, 3, None, 0)], key=repr)


@pytest.mark.parametrize("text", [
    json.dumps([{"headline": "h" * (20 << 20), "sentiment": "1"}]),
    json.dumps([{"headline": "h" * (1 << 20), "sentiment": "1"}] * 17)[:-1] + ' , {"a":' + "[" * 1100 + "]" * 1100 + "}]",
    "[" * 1100 + "]" * 1100,
])
def test_json_beyond_the_limits_is_no_reject(rows, text):
    with pytest.raises(Exception, match="too large or too deep"):
        gate.gate(rows([(1, text)], "prompt_id long, raw string"), strict=False).collect()


def test_broken_json_with_many_brackets_is_a_reject(rows):
    text = "[" + '{"headline": "a", "sentiment": "1"},' * 600
    assert gate.reasons(rows([(1, text)], "prompt_id long, raw string")).first().reason == "not_json"


def test_broken_datasets_and_runs_are_errors(spark, tmp_path):
    (tmp_path / "m_1_prompt=t.json").write_text('[{"headline": "a"')
    with pytest.raises(Exception):
        readers.read_named_datasets(spark, str(tmp_path)).collect()
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "r_2024-01-01_00-00-00.json").write_text('{"total_time": ')
    with pytest.raises(Exception):
        readers.read_runs(spark, str(tmp_path / "b")).collect()


def test_settings_are_no_examples(spark, tmp_path):
    (tmp_path / "metadata").mkdir()
    (tmp_path / "metadata" / "m_1_prompt=t.json").write_text('{"MODEL": "m"}')
    (tmp_path / "m_1_prompt=t.json").write_text('[{"headline": "a", "sentiment": "1"}]')
    assert [tuple(r) for r in readers.read_named_datasets(spark, str(tmp_path)).collect()] == [("a", "1", "m_1_prompt=t.json")]


def test_unknown_template_is_an_error(spark, rows):
    catalog = prompts.catalog(readers.default_templates(spark))
    asked = rows([(1, "zero-shot_v1", None, ""), (2, "zero-shot_v9", None, "")], "prompt_id long, template string, examples string, stock_ticker string")
    assert prompts.with_prompt(asked.filter("prompt_id = 1"), catalog).count() == 1
    with pytest.raises(Exception, match="no such template: zero-shot_v9"):
        prompts.with_prompt(asked, catalog).collect()


def test_packaged_templates_differ_by_ticker_only():
    bodies = readers.packaged_templates()
    assert len(bodies) == 8
    for mode in ("zero-shot", "few-shot"):
        assert bodies[f"{mode}_bg_train-time-info_v1"] == bodies[f"{mode}_bg_test-time-info_v1"]
        assert bodies[f"{mode}_bg_train-time-info_v1"].replace("about {stock_ticker}, ", "") == bodies[f"{mode}_bg_v1"]
        assert "{stock_ticker}" not in bodies[f"{mode}_v1"]


def test_benchmark_files_round_trip(spark, rows, tmp_path):
    path = str(tmp_path / "b")
    runs = rows([(i, f"2024-01-0{i + 1} 01:02:03.00000{i}", 1.5 * i, 10) for i in range(5)], "run_id long, at string, total_time double, num_examples long")
    sinks.write_benchmarks(runs.withColumn("finished_at", F.col("at").cast("timestamp_ntz")).coalesce(1), path)
    (tmp_path / "b" / "m_2024-03-01_04-05-06.json").write_text(json.dumps({"total_time": 9.0, "throughput": 1.0, "num_examples": 7}, indent=2))
    got = sorted((r.total_time, r.num_examples, str(r.finished_at), r.run_id) for r in readers.read_runs(spark, path).collect())
    assert len(got) == 6 and got[1] == (1.5, 10, "2024-01-02 01:02:03.000001", "1")
    assert got[5] == (9.0, 7, "2024-03-01 04:05:06", "m_2024-03-01_04-05-06.json")
    sinks.write_benchmarks(rows([(1.0,)], "total_time double"), str(tmp_path / "c"))
    row = readers.read_runs(spark, str(tmp_path / "c")).first()
    assert row.run_id and row.finished_at is not None


def test_nan_runs_count_nowhere(rows):
    nan = float("nan")
    runs = rows([(i, "g", float(v), float(v)) for i, v in enumerate([1, 2, 3, nan])] + [(9, "g", None, 5.0)], "run_id long, gpu_config string, throughput double, total_time double")
    box, outliers = metrics.box_figures(runs)
    got = {r.measure: (r.n, r.n_outliers) for r in box.collect()}
    assert got == {"throughput": (3, 0), "total_time": (4, 0)} and outliers.count() == 0


def test_no_rounds_leave_all_prompts_open(rows):
    asked = rows([(1,), (2,)], "prompt_id long")
    done, left = rounds.run_rounds(asked, lambda *a: None, max_rounds=0)
    assert done.columns == ["prompt_id", "attempt", "items", "n_items"] and done.count() == 0 and left.count() == 2


REVIEW = Gate((Field("stars", ("BIGINT",), allowed=("1", "2", "3"), type="int"), Field("text", ("STRING",), "[a-z]"), Field("tags", ("ARRAY",), type="array<string>")))


def test_a_gate_of_your_own(rows):
    good = {"stars": 2, "text": "it's fine", "tags": ["a", "b"]}
    cases = [
        ([good], "accepted"), (good, "wrong_shape"), ([good | {"stars": 9}], "bad_stars"), ([good | {"stars": "2"}], "bad_stars"),
        ([good | {"text": "NO"}], "bad_text"), ([good | {"tags": "a"}], "bad_tags"), ([good | {"more": 1}], "wrong_keys"), ([3], "item_not_object"), ([], "accepted"),
    ]
    df = rows([(i, 1, json.dumps(v)) for i, (v, _) in enumerate(cases)], "prompt_id long, attempt long, raw string")
    assert [r.reason for r in gate.reasons(df, REVIEW).orderBy("prompt_id").collect()] == [reason for _, reason in cases]
    examples = curate(df, CurationSpec(strict=REVIEW, unique="text"))
    assert [tuple(r) for r in examples.select("prompt_id", "stars", "text", "tags").collect()] == [(0, 2, "it's fine", ["a", "b"])]
    assert json.dumps({"stars": "int", "text": "string", "tags": "array<string>"}) in prompts.format_instructions(REVIEW)
    lenient = gate.reason_counts(df, {"own": REVIEW, "strict": True})
    assert {(r.gate, r.reason): r.n for r in lenient.collect()}[("own", "accepted")] == 2


def test_no_gate_takes_every_value(rows):
    df = rows([(1, "[1, 2]"), (2, '{"a": null}'), (3, "x"), (4, None)], "prompt_id long, raw string")
    got = {r.prompt_id: r["items"] for r in gate.gate(df, None).collect()}
    assert {k: v and v[0].value for k, v in got.items()} == {1: "[1,2]", 2: '{"a":null}', 3: None, 4: None}


def test_stream_equals_batch_by_dataset(spark, rows, tmp_path):
    same = json.dumps([{"headline": "a", "sentiment": "1"}])
    df = rows([(i, 1, "mn"[i % 2], same) for i in range(10)], "prompt_id long, attempt long, model string, raw string")
    landing, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    df.write.parquet(landing)
    spec = CurationSpec(by=("model",), checks={"few": F.size("items") < 2}, all_results=lambda d: d.withColumn("seen", F.lit(True)))
    stream = streaming.curate_stream(spark.readStream.schema(df.schema).parquet(landing), spec)
    streaming.start(stream.select("model", "headline", "seen"), out, state).awaitTermination()
    batch = curate(df, spec).select("model", "headline", "seen")
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, batch.collect())) == [("m", "a", True), ("n", "a", True)]


def test_dataset_names_need_no_join(spark):
    from conftest import DATA
    from synthcurate.plans.inputs import Inputs
    from synthcurate.plans.queries import curated

    plan = curated(Inputs(spark, f"{DATA}/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
