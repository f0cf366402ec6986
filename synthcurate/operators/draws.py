"""Seeded draws of few-shot examples and tickers for many prompts at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from synthcurate.functions.hashing import HASH_BITS, hash60
from synthcurate.functions.text import first_ticker
from synthcurate.operators.ordinals import seeded_ordinals
from synthcurate.session import broadcast_if_small, materialize

# Copies of a small group are joined under this many distinct keys.
SPREAD = 1024


def _copies(total: Column) -> Column:
    """How often rows of a group are repeated so that the group offers SPREAD
    join keys; 1 for groups that are large anyway. A group gains at most
    SPREAD rows."""
    return F.ceil(F.lit(SPREAD) / total).cast("bigint")


def _join_drawn(draws: DataFrame, rows: DataFrame, group: str) -> DataFrame:
    """Join draws with rows on (group, ord).

    A group of few rows is drawn by very many prompts, so each of its rows is
    repeated under several salts and every prompt looks at one of them.
    """
    salted = rows.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), _copies(F.col("_total")) - 1)))
    picks = draws.withColumn("_salt", F.pmod(F.xxhash64("prompt_id"), _copies(F.col("_total"))))
    return picks.drop("_total").join(salted.drop("_total"), [group, "ord", "_salt"]).drop("_salt")


def draw_fewshot(
    requests: DataFrame, pool: DataFrame, num_shots: int = 3, seed: int = 42,
    key: list[str] | None = None,
) -> DataFrame:
    """``(prompt_id, shots)``: ``num_shots`` rows with different labels.

    Labels come in the order of the race -ln(u)/n_label (Efraimidis and
    Spirakis 2006), which is the order in which labels first show up when rows
    are drawn one after the other; the row within a label is uniform. More
    shots than labels is an error. Rows without a label are left out.
    """
    keys = key or ["row_id"]
    texts = pool
    # Numbers and labels are read three times, texts once, for drawn rows.
    pool = materialize(pool.select("label", *keys).filter(F.col("label").isNotNull()))
    sizes = pool.groupBy("label").agg(F.count("*").alias("n"))
    table = F.array_sort(F.collect_list(F.struct("label", "n")))
    stats = sizes.agg(
        F.when(F.count("*") >= num_shots, table)
        .otherwise(F.raise_error(F.lit(f"num_shots={num_shots} exceeds the number of labels")))
        .alias("stats")
    )
    prompt = F.col("prompt_id")

    def entry(s: Column) -> Column:
        u = (hash60(seed, prompt, s["label"], "race") + 1) / F.lit(float((1 << HASH_BITS) + 1))
        return F.struct(
            (-F.ln(u) / s["n"]).alias("race"),
            s["label"].alias("label"),
            F.pmod(hash60(seed, prompt, s["label"], "row"), s["n"]).alias("ord"),
            s["n"].alias("_total"),
        )

    # The label table is one value, computed once and used by every task.
    raced = requests.select("prompt_id", stats.scalar().alias("_stats"))
    picks = F.slice(F.array_sort(F.transform("_stats", entry)), 1, num_shots)
    draws = raced.select("prompt_id", F.posexplode(picks).alias("pos", "d")).select(
        "prompt_id", "pos", "d.label", "d.ord", "d._total"
    )
    rows = seeded_ordinals(pool, ["label"], keys, seed, total="_total").select("label", "ord", *keys, "_total")
    drawn = _join_drawn(draws, rows, "label")
    # A row drawn very often is one key of this join, with plain shuffles on both sides.
    return (
        drawn.join(texts.select(*keys, "text"), keys)
        .groupBy("prompt_id")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "text", "label"))).alias("shots"))
    )


def ticker_pool(labeled: DataFrame) -> DataFrame:
    """Add ``pool`` (the split) and ``ticker``; rows without one are dropped.
    Duplicates stay: the pool is a bag, and draws are frequency-weighted."""
    return (
        labeled.withColumn("ticker", first_ticker(F.col("text")))
        .filter(F.col("ticker").isNotNull())
        .withColumnRenamed("split", "pool")
        .drop("text", "label")
    )


def ticker_counts(pool: DataFrame) -> DataFrame:
    return pool.groupBy("pool", "ticker").agg(F.count("*").alias("n"))


def positions_without_replacement(n: Column, k: int, seed: int, prompt: Column) -> Column:
    """``k`` distinct positions of ``0..n-1``, any subset equally likely
    (Bentley and Floyd 1987), then put into seeded order."""

    def step(acc: Column, i: Column) -> Column:
        t = F.pmod(hash60(seed, prompt, i, "ticker"), i + 1)
        return F.array_append(acc, F.when(F.array_contains(acc, t), i).otherwise(t))

    picks = F.aggregate(F.sequence(n - k, n - 1), F.array().cast("array<bigint>"), step)
    ordered = F.array_sort(F.transform(
        picks, lambda t: F.struct(hash60(seed, prompt, t, "order").alias("h"), t.alias("t"))
    ))
    enough = F.when(n >= k, True).otherwise(
        F.raise_error(F.concat(F.lit(f"cannot draw {k} tickers from "), n.cast("string")))
    )
    return F.when(enough, F.transform(ordered, lambda s: s["t"]))


def positions_with_replacement(n: Column, k: int, seed: int, prompt: Column) -> Column:
    slots = F.sequence(F.lit(0), F.lit(k - 1))
    return F.transform(slots, lambda j: F.pmod(hash60(seed, prompt, j, "ticker"), n))


def draw_tickers(
    requests: DataFrame, pool: DataFrame, num_tickers: int = 1, replace: bool = False, seed: int = 42,
    key: list[str] | None = None,
) -> DataFrame:
    """``(prompt_id, tickers)`` for requests with a ``pool``; a request whose
    pool has no ticker gets none.

    The pool is read three times below and usually comes out of whole texts,
    so its few narrow columns are materialised first.
    """
    keys = key or ["row_id"]
    pool = materialize(pool.select("pool", "ticker", *keys).filter(F.col("pool").isNotNull()))
    sizes = pool.groupBy("pool").agg(F.count("*").alias("_total"))
    sized = requests.select("prompt_id", "pool").join(broadcast_if_small(sizes), "pool")
    positions = positions_with_replacement if replace else positions_without_replacement
    picks = positions(F.col("_total"), num_tickers, seed, F.col("prompt_id"))
    draws = sized.select("prompt_id", "pool", "_total", F.posexplode(picks).alias("pos", "ord"))
    rows = seeded_ordinals(pool, ["pool"], keys, seed, total="_total").select("pool", "ord", "ticker", "_total")
    drawn = _join_drawn(draws, rows, "pool").groupBy("prompt_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "ticker"))).alias("picks")
    )
    return drawn.select("prompt_id", F.transform("picks", lambda p: p["ticker"]).alias("tickers"))
