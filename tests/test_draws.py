import math

import pytest
from pyspark.sql import functions as F

from synthcurate.operators import draws as d


def pool(spark, sizes, parts=4):
    data = [(f"{label}-{n}", label, i * 100000 + n) for i, (label, size) in enumerate(sizes.items()) for n in range(size)]
    return spark.createDataFrame(data, "text string, label int, row_id long").repartition(parts)


def requests(spark, n, parts=4):
    return spark.range(n).select(F.col("id").alias("prompt_id")).repartition(parts)


def shots(spark, sizes, n, k=3, parts=4):
    out = d.draw_fewshot(requests(spark, n, parts), pool(spark, sizes, parts), k).collect()
    return {r.prompt_id: [(s.label, s.text) for s in r.shots] for r in out}


def test_fewshot_labels_differ_and_partitioning_does_not_matter(spark):
    sizes = {0: 40, 1: 245, 2: 38, 3: 1}
    one = shots(spark, sizes, 300, parts=1)
    assert len(one) == 300
    for picked in one.values():
        assert len(picked) == 3 and len({label for label, _ in picked}) == 3
    assert one == shots(spark, sizes, 300, parts=32)


def test_fewshot_distribution(spark):
    sizes = {0: 40, 1: 240, 2: 40}
    n = 4000
    drawn = shots(spark, sizes, n)
    first = [picked[0][0] for picked in drawn.values()]
    for label, size in sizes.items():
        p = size / 320
        assert abs(first.count(label) - n * p) < 5 * math.sqrt(n * p * (1 - p))
    rows = [text for picked in drawn.values() for label, text in picked if label == 0]
    assert len(rows) == n
    for i in range(40):
        assert abs(rows.count(f"0-{i}") - n / 40) < 5 * math.sqrt(n / 40)


def test_more_shots_than_labels_is_an_error(spark):
    with pytest.raises(Exception, match="exceeds the number of labels"):
        shots(spark, {0: 5, 1: 5}, 3)


def tickers(spark, sizes, n, k, replace, parts=4):
    data = [(p, f"{p}{i}", i) for p, size in sizes.items() for i in range(size)]
    bag = spark.createDataFrame(data, "pool string, ticker string, row_id long").repartition(parts)
    asked = requests(spark, n, parts).withColumn("pool", F.when(F.col("prompt_id") % 3 == 0, "train").when(F.col("prompt_id") % 3 == 1, "validation"))
    return {r.prompt_id: r.tickers for r in d.draw_tickers(asked, bag, k, replace).collect()}


@pytest.mark.parametrize("replace", [False, True])
def test_ticker_draws(spark, replace):
    drawn = tickers(spark, {"train": 10, "validation": 3}, 6000, 3, replace)
    assert len(drawn) == 4000
    for prompt_id, picked in drawn.items():
        assert len(picked) == 3
        assert all(t.startswith("train" if prompt_id % 3 == 0 else "validation") for t in picked)
        if not replace:
            assert len(set(picked)) == 3
    train = [p for i, p in drawn.items() if i % 3 == 0]
    for slot in range(3):  # every slot is uniform, so the order is no giveaway
        column = [p[slot] for p in train]
        for i in range(10):
            assert abs(column.count(f"train{i}") - 200) < 5 * math.sqrt(200 * 0.9)
    assert drawn == tickers(spark, {"train": 10, "validation": 3}, 6000, 3, replace, parts=32)


def test_empty_pool_gives_no_tickers_and_small_pool_is_an_error(spark):
    assert set(tickers(spark, {"train": 5}, 9, 2, False)) == {0, 3, 6}
    with pytest.raises(Exception, match="cannot draw 2 tickers from 1"):
        tickers(spark, {"train": 1}, 9, 2, False)


def test_pool_keeps_duplicates(rows):
    df = rows([(1, "train", 0, "$A up"), (2, "train", 1, "$A down"), (3, "validation", 1, "none")],
              "row_id long, split string, label int, text string")
    bag = d.ticker_pool(df)
    assert sorted((r.row_id, r.pool, r.ticker) for r in bag.collect()) == [(1, "train", "A"), (2, "train", "A")]
    assert [tuple(r) for r in d.ticker_counts(bag).collect()] == [("train", "A", 2)]
