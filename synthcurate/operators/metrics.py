"""Counts and run statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from synthcurate.operators.ordinals import running_totals
from synthcurate.session import broadcast_if_small, join_on, materialize

MEASURES = ("throughput", "total_time")


def dataset_counts(examples: DataFrame, by: list[str]) -> DataFrame:
    return examples.groupBy(*by).agg(F.count("*").alias("n"))


def with_throughput(runs: DataFrame) -> DataFrame:
    """``throughput`` divides the requested number by the elapsed seconds;
    ``written_per_second`` the rows really written, where known."""
    out = runs.withColumn("throughput", F.col("num_examples") / F.col("total_time"))
    if "rows_written" in runs.columns:
        out = out.withColumn("written_per_second", F.col("rows_written") / F.col("total_time"))
    return out


def union_groups(groups: dict[str, DataFrame], column: str = "gpu_config") -> DataFrame:
    """Stack run groups under their names; columns one group lacks are NULL."""
    named = [df.withColumn(column, F.lit(name)) for name, df in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def runs_in_order(runs: DataFrame, by: str = "gpu_config", time: str = "finished_at", key: str = "run_id") -> DataFrame:
    """Number the runs of each group by finishing time, from 1."""
    return running_totals(runs, [by], [time, key]).withColumn("run_no", F.col("before") + 1).drop("before")


def summary(runs: DataFrame, by: str = "gpu_config") -> DataFrame:
    stats = []
    for m in MEASURES:
        stats += [F.avg(m).alias(f"{m}_mean"), F.stddev_samp(m).alias(f"{m}_std"),
                  F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max")]
    return runs.groupBy(by).agg(*stats)


QUARTILES = (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
ACCURACY = 10_000  # the sketch is off by at most 1/ACCURACY of the rows


def quartiles(values: DataFrame, by: list[str], value: str, whole_below: int = 10_000) -> DataFrame:
    """Exact quartiles of ``value`` per group, interpolated linearly.

    The exact ``percentile`` aggregate would hold all values of a group in one
    task. Here a sketch brackets each quartile, everything below a bracket is
    only counted, and the few distinct values inside are sorted across tasks.
    Groups of up to ``whole_below`` rows are not worth a bracket.
    """
    v = F.col(value)
    values = values.select(*by, v.alias("_v")).filter(v.isNotNull() & ~F.isnan(v))
    margin = 5 / ACCURACY
    edges = [q + side * margin for _, q in QUARTILES for side in (-1, 1)]
    sketched = values.groupBy(*by).agg(
        F.count("*").alias("n"), F.percentile_approx("_v", edges, ACCURACY).alias("_e"),
    )
    whole = F.col("n") <= whole_below
    low = [F.when(whole, F.lit(float("-inf"))).otherwise(F.col("_e")[2 * i]) for i in range(len(QUARTILES))]
    high = [F.when(whole, F.lit(float("inf"))).otherwise(F.col("_e")[2 * i + 1]) for i in range(len(QUARTILES))]
    bounds = broadcast_if_small(sketched.select(*by, "n", F.array(*low).alias("_low"), F.array(*high).alias("_high")))
    bracketed = values.join(bounds, by)
    # One pass: values inside a bracket by themselves, those below it as one NULL.
    each = bracketed.select("*", F.explode(F.array(*map(F.lit, range(len(QUARTILES))))).alias("_q")).filter(F.col("_v") <= F.col("_high")[F.col("_q")])
    pieces = each.select(*by, "n", "_q", F.when(F.col("_v") >= F.col("_low")[F.col("_q")], F.col("_v")).alias("_v"))
    pieces = materialize(pieces.groupBy(*by, "n", "_q", "_v").agg(F.count("*").alias("_rows")))
    keys = [*by, "_q"]
    ranked = running_totals(pieces.filter("_v is not null"), keys, ["_v"], "_rows", before="_inside_before")
    below = broadcast_if_small(pieces.filter("_v is null").select(*keys, F.col("_rows").alias("_below")))
    placed = join_on(ranked, below, keys, "left").select(
        *by, "n", "_q", "_v", "_rows",
        (F.col("_inside_before") + F.coalesce("_below", F.lit(0))).alias("_pos"),
        ((F.col("n") - 1) * F.array(*[F.lit(q) for _, q in QUARTILES])[F.col("_q")]).alias("_place"),
    )
    first = F.floor("_place")

    def at(position: Column) -> Column:
        return F.max(F.when((F.col("_pos") <= position) & (position < F.col("_pos") + F.col("_rows")), F.col("_v")))

    found = placed.groupBy(*by, "n", "_q", "_place").agg(
        at(first).alias("_at"), at(F.least(first + 1, F.col("n") - 1)).alias("_next")
    )
    value = F.col("_at") + (F.col("_next") - F.col("_at")) * (F.col("_place") - first)
    sure = F.when(value.isNotNull(), value).otherwise(F.raise_error(F.lit("quartile outside its bracket")))
    return found.groupBy(*by, "n").agg(
        *[F.max(F.when(F.col("_q") == i, sure)).alias(name) for i, (name, _) in enumerate(QUARTILES)]
    )


def box_figures(
    runs: DataFrame, measures: tuple[str, ...] = MEASURES, by: str = "gpu_config", key: str = "run_id",
) -> tuple[DataFrame, DataFrame]:
    """Box-plot figures per measure and group (quartiles, whiskers within 1.5
    IQR, number of outliers), and the outlying runs with their ``figure``. Runs
    without a figure, or with NaN, count nowhere."""
    groups = ["measure", by]
    # Both measures in one pass, as rows.
    figures = runs.select(by, key, F.inline(F.array(
        *[F.struct(F.lit(m).alias("measure"), F.col(m).alias("figure")) for m in measures]
    ))).filter(F.col("figure").isNotNull() & ~F.isnan("figure"))
    q = broadcast_if_small(quartiles(figures, groups, "figure"))
    iqr = F.col("q3") - F.col("q1")
    inside = F.col("figure").between(F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr)
    fenced = figures.join(q, groups)
    box = fenced.groupBy(*groups, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("figure"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("figure"))).alias("whisker_high"),
        F.count(F.when(~inside, True)).alias("n_outliers"),
    )
    return box, fenced.filter(~inside).select(*groups, key, "figure")
