import hashlib

import pytest
from pyspark.sql import functions as F

from synthcurate import session
from synthcurate.operators import ordinals as o
from synthcurate.operators import select as s


def h60(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:15], 16)


def skewed(spark, n=2000, parts=4):
    """Group 0 holds more than a third of the rows."""
    return spark.range(n).repartition(parts).select(
        F.col("id").alias("k"), F.when(F.col("id") % 5 < 2, 0).otherwise(F.col("id") % 7).cast("int").alias("g"),
        (F.col("id") % 4).alias("v"),
    )


@pytest.mark.parametrize("parts", [1, 4, 32])
def test_seeded_ordinals(spark, parts):
    out = o.seeded_ordinals(skewed(spark, parts=parts), ["g"], ["k"], 42).collect()
    assert len(out) == 2000
    groups = {}
    for r in out:
        groups.setdefault(r.g, []).append(r)
    for members in groups.values():
        members.sort(key=lambda r: r.ord)
        assert [r.ord for r in members] == list(range(len(members)))
        assert {r.total for r in members} == {len(members)}
        assert [r.k for r in members] == sorted((r.k for r in members), key=lambda k: h60(42, "row", k))


@pytest.mark.parametrize("parts", [1, 4, 32])
@pytest.mark.parametrize("value", [None, "v"])
def test_running_totals(spark, parts, value):
    out = o.running_totals(skewed(spark, parts=parts), ["g"], ["k"], value, total="all").orderBy("g", "k").collect()
    assert len(out) == 2000
    sums = {}
    for r in out:
        assert r.before == sums.get(r.g, 0)
        sums[r.g] = r.before + (r.v if value else 1)
    assert {r.g: r["all"] for r in out} == sums


def test_running_totals_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        test_running_totals(spark, 4, "v")
        test_running_totals(spark, 4, None)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("n", [1, 10, 100, 5000])
def test_sample_is_the_seeded_prefix(spark, n):
    df = skewed(spark).withColumn("headline", F.col("k").cast("string"))
    out = s.sample_exact(df, ["g"], ["k"], n, on_short="keep").collect()
    everything = {}
    for r in df.collect():
        everything.setdefault(r.g, []).append(r.k)
    for g, ks in everything.items():
        expected = sorted(ks, key=lambda k: h60(42, "sample", k))[:n]
        assert sorted(r.k for r in out if r.g == g) == sorted(expected)


def test_summaries_too_large_to_broadcast(spark, monkeypatch):
    """Beyond the bounds the same results come from shuffle joins."""
    monkeypatch.setattr(session, "BROADCAST_ROWS", 1)
    large = spark.range(5)
    assert session.broadcast_if_small(large) is large
    test_sample_is_the_seeded_prefix(spark, 10)
    test_running_totals(spark, 4, "v")
    test_running_totals(spark, 4, None)
    monkeypatch.setattr(session, "BROADCAST_ROWS", 100)
    monkeypatch.setattr(session, "BROADCAST_BYTES", 8)
    test_sample_is_the_seeded_prefix(spark, 10)


def test_sample_short_dataset_is_an_error(spark):
    df = skewed(spark, 20)
    with pytest.raises(Exception, match="cannot sample 15 rows"):
        s.sample_exact(df, ["g"], ["k"], 15).collect()
    assert s.sample_exact(df, ["g"], ["k"], 1).count() == df.select("g").distinct().count()


def test_sample_is_uniform(spark):
    """Each of 20 rows is drawn about equally often over many datasets."""
    df = spark.range(20 * 400).select((F.col("id") % 20).alias("k"), F.floor(F.col("id") / 20).alias("g"))
    df = df.withColumn("key", F.col("g") * 20 + F.col("k"))
    counts = s.sample_exact(df, ["g"], ["key"], 5).groupBy("k").count().collect()
    assert sum(r["count"] for r in counts) == 2000
    for r in counts:
        assert abs(r["count"] - 100) < 5 * (400 * 0.25 * 0.75) ** 0.5


def test_first_headlines(spark):
    df = spark.createDataFrame(
        [(2, 1, 0, "a", "1"), (1, 1, 1, "a", "0"), (1, 2, 0, "a", "2"), (3, 1, 0, "A", "1"), (4, 1, 0, "b", None)],
        "prompt_id long, attempt long, pos long, headline string, sentiment string",
    )
    out = s.first_headlines(df, ["prompt_id", "attempt", "pos"])
    assert out.columns == df.columns
    assert sorted(tuple(r)[:5] for r in out.collect()) == [(1, 1, 1, "a", "0"), (3, 1, 0, "A", "1"), (4, 1, 0, "b", None)]
    per = s.first_headlines(df, ["attempt", "pos"], by=["prompt_id"])
    assert per.count() == 4


def test_letter_filter(rows):
    df = rows([("1a",), ("12",), ("é",), (None,)], "headline string")
    assert [r.headline for r in s.with_letter(df).collect()] == ["1a"]


def test_unnamed_group_is_kept(spark):
    df = skewed(spark, 60).withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    n = df.filter("g is null").count()
    assert o.running_totals(df, ["g"], ["k"]).filter("g is null").count() == n > 20
    assert s.sample_exact(df, ["g"], ["k"], 3, on_short="keep").filter("g is null").count() == 3
