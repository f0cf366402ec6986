"""Choosing rows: letter filter, first of equal headlines, exact-size samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synthcurate.functions.text import has_letter
from synthcurate.operators.ordinals import first_in_hash_order


def with_letter(examples: DataFrame) -> DataFrame:
    """Stored rows whose headline has an ASCII letter."""
    return examples.filter(has_letter(F.col("headline")))


def first_headlines(examples: DataFrame, order: list[str], by: list[str] | None = None, field: str = "headline") -> DataFrame:
    """Keep the first row (by ``order``) of each exact ``field``, per ``by``.

    ``min_by`` keeps one candidate per headline and map task, so a headline
    repeated by a third of all rows reaches its reducer as one row per task.
    The hash leads the grouping key only to make sorting cheap; the headline
    itself decides equality.
    """
    keys = [*(by or []), field]
    rest = [c for c in examples.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return (
        examples.groupBy(F.xxhash64(*keys).alias("_h"), *keys)
        .agg(first)
        .select(*[F.col(c) if c in keys else F.col(f"_first.{c}") for c in examples.columns])
    )


def sample_exact(
    examples: DataFrame, by: list[str], key: list[str], n: int, seed: int = 42, on_short: str = "error",
) -> DataFrame:
    """Exactly ``n`` rows of each dataset without replacement.

    Which rows is a pure function of seed and row key. A dataset with fewer
    than ``n`` rows is an error, or kept whole with ``on_short="keep"``.
    """
    if on_short not in ("error", "keep"):
        raise ValueError(f"on_short must be 'error' or 'keep', not {on_short!r}")
    picked = first_in_hash_order(examples, by, key, n, seed, "sample", total="_size")
    if on_short == "error":
        picked = picked.filter(
            F.when(F.col("_size") >= n, True).otherwise(
                F.raise_error(F.concat(F.lit(f"cannot sample {n} rows from "), F.col("_size").cast("string")))
            )
        )
    return picked.drop("_size")
