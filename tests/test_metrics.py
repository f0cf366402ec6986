import math
import random

import numpy as np
from pyspark.sql import functions as F

from synthcurate.operators import metrics as m


def table(rows, groups):
    data = [(f"{g}{i}", g, float(v)) for g, values in groups.items() for i, v in enumerate(values)]
    return rows(data, "run_id string, gpu_config string, total_time double").repartition(7).withColumn(
        "throughput", F.lit(1000) / F.col("total_time")
    )


def test_box_figures_match_numpy(rows):
    rng = random.Random(1)
    groups = {
        "hot": [rng.lognormvariate(3, 1) for _ in range(900)], "ties": [5.0] * 50 + [7.0] * 3 + [100.0],
        "one": [4.0], "two": [1.0, 2.0], "four": [1.0, 2.0, 4.0, 9.0],
    }
    box, outliers = m.box_figures(table(rows, groups))
    assert box.count() == 2 * len(groups)
    got = {r.gpu_config: r for r in box.filter("measure = 'total_time'").collect()}
    out = {}
    for r in outliers.filter("measure = 'total_time'").collect():
        out.setdefault(r.gpu_config, []).append(r.figure)
    assert got.keys() == groups.keys()
    for name, values in groups.items():
        q1, q2, q3 = np.percentile(values, [25, 50, 75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = [v for v in values if low <= v <= high]
        r = got[name]
        assert np.allclose([r.q1, r.median, r.q3], [q1, q2, q3]) and r.n == len(values)
        assert (r.whisker_low, r.whisker_high) == (min(inside), max(inside))
        assert r.n_outliers == len(values) - len(inside)
        assert sorted(out.get(name, [])) == sorted(v for v in values if not low <= v <= high)


def test_summary(rows):
    r = m.summary(table(rows, {"a": [1.0, 2.0, 4.0], "b": [3.0]})).filter("gpu_config = 'a'").first()
    assert math.isclose(r.total_time_mean, 7 / 3) and math.isclose(r.total_time_std, np.std([1, 2, 4], ddof=1))
    assert (r.throughput_min, r.throughput_max) == (250.0, 1000.0)


def test_runs_in_order(rows):
    df = rows([("x", "a", 3), ("y", "a", 1), ("z", "b", 2)], "run_id string, gpu_config string, finished_at long")
    assert {r.run_id: r.run_no for r in m.runs_in_order(df).collect()} == {"y": 1, "x": 2, "z": 1}


def test_union_groups_and_throughput(rows):
    one = rows([(1, 2.0)], "num_examples long, total_time double")
    two = rows([(4, 2.0, 2)], "num_examples long, total_time double, rows_written long")
    out = m.union_groups({"1 GPU": m.with_throughput(one), "2 GPUs": m.with_throughput(two)})
    assert sorted((r.gpu_config, r.throughput, r.written_per_second) for r in out.collect()) == [
        ("1 GPU", 0.5, None), ("2 GPUs", 2.0, 1.0)
    ]


def test_dataset_counts(rows):
    df = rows([("a", "p"), ("a", "p"), ("b", "p")], "model string, prompt string")
    assert {tuple(r) for r in m.dataset_counts(df, ["model", "prompt"]).collect()} == {("a", "p", 2), ("b", "p", 1)}


def test_bracketed_quartiles_match_numpy(spark, rows):
    """Groups too large to be taken whole, one of them mostly ties."""
    rng = random.Random(2)
    groups = {"a": [rng.gauss(0, 1) for _ in range(30000)], "b": [1.0] * 9000 + [rng.random() for _ in range(6001)]}
    out = m.quartiles(table(rows, groups), ["gpu_config"], "total_time", whole_below=1000)
    got = {r.gpu_config: (r.n, r.q1, r.median, r.q3) for r in out.collect()}
    for name, values in groups.items():
        assert got[name][0] == len(values) and np.allclose(got[name][1:], np.percentile(values, [25, 50, 75]), rtol=1e-12)
