"""Dense positions and running totals without a window over a whole group.

A window partitioned by dataset, label or pool would sort its largest group in
one task. Both operators here cut groups into slices, sum the slices, and add
the slice offset to a position found inside the slice; a group holding a third
of all rows is spread like any other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from synthcurate.functions.hashing import bucket_of, hash60
from synthcurate.session import broadcast_if_small, join_on, materialize


def slice_bits(df: DataFrame) -> int:
    """Hash slices per group as a power of two: a few per shuffle partition."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(20, max(6, (4 * parts - 1).bit_length()))


def _with_slices(df: DataFrame, key: list[str], seed: int, slot: str, bits: int) -> DataFrame:
    h = hash60(seed, slot, *[F.col(c) for c in key])
    return df.withColumn("_h", h).withColumn("_slice", bucket_of(F.col("_h"), bits))


def _slice_offsets(sliced: DataFrame, group: list[str]) -> DataFrame:
    """Rows before each slice and rows in its group: at most 2^bits rows per
    group, summed map-side first."""
    sizes = sliced.groupBy(*group, "_slice").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        *group,
        "_slice",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(Window.partitionBy(*group)).alias("_total"),
    )


def _rank_in_slice(group: list[str], key: list[str]) -> Column:
    return F.row_number().over(Window.partitionBy(*group, "_slice").orderBy("_h", *key)).cast("bigint")


def seeded_ordinals(
    df: DataFrame, group: list[str], key: list[str], seed: int, slot: str = "row",
    ordinal: str = "ord", total: str = "total",
) -> DataFrame:
    """Number the rows of each group 0..n-1 in seeded hash order.

    ``key`` identifies a row within its group. The result does not depend on
    partitioning, slice count or session. The group columns must not be NULL.
    """
    sliced = _with_slices(df, key, seed, slot, slice_bits(df))
    ranked = sliced.withColumn("_rank", _rank_in_slice(group, key))
    return (
        ranked.join(_slice_offsets(sliced, group), [*group, "_slice"])
        .withColumn(ordinal, F.col("_offset") + F.col("_rank") - 1)
        .withColumnRenamed("_total", total)
        .drop("_h", "_slice", "_rank", "_offset")
    )


def first_in_hash_order(
    df: DataFrame, group: list[str], key: list[str], n: int, seed: int, slot: str,
    total: str = "total",
) -> DataFrame:
    """The ``n`` rows of each group that come first in seeded hash order.

    Whole slices decide most rows: the slice counts tell the last slice that
    can still hold a wanted row, later slices are dropped in the scan, and
    only the rest (about ``n`` plus one slice per group) is shuffled and ranked.
    """
    # Finer slices would only lengthen the list of slices a small group needs.
    sliced = _with_slices(df, key, seed, slot, min(14, slice_bits(df)))
    needed = _slice_offsets(sliced, group).filter(F.col("_offset") < n)
    kept = join_on(sliced, broadcast_if_small(needed), [*group, "_slice"])
    return (
        kept.withColumn("_rank", _rank_in_slice(group, key))
        .filter(F.col("_offset") + F.col("_rank") <= n)
        .withColumnRenamed("_total", total)
        .drop("_h", "_slice", "_rank", "_offset")
    )


def running_totals(
    df: DataFrame, group: list[str], order: list[str], value: str | None = None,
    before: str = "before", total: str | None = None,
) -> DataFrame:
    """Sum of ``value`` over the earlier rows of the group (their number if
    ``value`` is None), in ``order``, which must be unique within a group.

    One distributed sort gives each row its total within its sort partition.
    That is stored, because a range shuffle run twice may cut elsewhere;
    the totals of whole partitions then shift each row. Nothing is shuffled a
    second time, and a group of any size is spread over many partitions.
    """
    rows = df.sort(*group, *order)
    if value is None:
        # Partition number and row number within it, in the upper and lower bits.
        place = F.monotonically_increasing_id()
        rows = rows.withColumn("_place", place).select(
            *df.columns,
            F.shiftright("_place", 33).alias("_part"),
            F.col("_place").bitwiseAND((1 << 33) - 1).alias("_inside"),
        )
        amount = F.lit(1).cast("bigint")
    else:
        schema = T.StructType([*df.schema.fields, T.StructField("_inside", T.LongType())])
        rows = rows.mapInArrow(_cumulate(df.columns.index(value)), schema).withColumn("_part", F.spark_partition_id())
        amount = F.col(value).cast("bigint")
    rows = materialize(rows)
    # One row per partition and group that share rows: partitions + groups.
    parts = rows.groupBy(*group, "_part").agg(F.sum(amount).alias("_sum"), F.min("_inside").alias("_first"))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.select(
        *group, "_part",
        (F.coalesce(F.sum("_sum").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_sum").over(whole).alias("_total"),
    )
    placed = join_on(rows, broadcast_if_small(shift), [*group, "_part"])
    extra = [F.col("_total").alias(total)] if total else []
    return placed.select(*df.columns, (F.col("_inside") + F.col("_shift")).alias(before), *extra)


def _cumulate(at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Running total of column ``at`` before each row of a sorted partition. All
    columns pass through as Arrow has them, NULLs and large numbers included."""

    def cumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far = 0
        for batch in batches:
            amounts = np.asarray(pc.fill_null(batch.column(at).cast(pa.int64()), 0))
            upto = amounts.cumsum() + so_far
            if len(amounts):
                so_far = int(upto[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(upto - amounts)], names=[*batch.schema.names, "_inside"])

    return cumulate


def running_max(df: DataFrame, group: list[str], order: list[str], value: str, upto: str = "upto") -> DataFrame:
    """Largest ``value`` of the group up to and including each row, in ``order``
    (unique within a group). NULL values count as absent.

    As ``running_totals``: one distributed sort; each sorted partition keeps a
    running maximum per group run; the maxima of whole partitions (one row per
    partition and group) are carried forward by a small window; a group of any
    size is spread over many partitions.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("_inside", T.LongType())])
    rows = df.sort(*group, *order).mapInArrow(_cummax([df.columns.index(c) for c in group], df.columns.index(value)), schema)
    rows = materialize(rows.withColumn("_part", F.spark_partition_id()))
    parts = rows.groupBy(*group, "_part").agg(F.max(value).alias("_max"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = parts.select(*group, "_part", F.max("_max").over(earlier).alias("_carry"))
    placed = join_on(rows, broadcast_if_small(carry), [*group, "_part"])
    return placed.select(*df.columns, F.greatest("_inside", "_carry").alias(upto))


def _cummax(keys: list[int], at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Running maximum of column ``at`` within runs of equal ``keys`` of a sorted partition."""

    def cummax(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, best = object(), None
        for batch in batches:
            key_rows = list(zip(*[batch.column(k).to_pylist() for k in keys])) if keys else [()] * batch.num_rows
            values = batch.column(at).to_pylist()
            out = []
            for key, v in zip(key_rows, values):
                if key != last_key:
                    last_key, best = key, None
                if v is not None and (best is None or v > best):
                    best = v
                out.append(best)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=[*batch.schema.names, "_inside"])

    return cummax
