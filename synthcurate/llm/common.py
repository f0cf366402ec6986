"""Helpers shared by the operators on training text.

Text rules used by several operators: bytes of the UTF-8 text are lower-cased
in A-Z only (``bytes.lower``) and split at space and tab to carriage return
(``bytes.split``), which is the word pattern ``[^\\x20\\x09-\\x0D]+``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from synthcurate.session import configure, scratch_path

# Rows of an Arrow batch, which a task holds on both sides; texts may be long.
BATCH_ROWS = 1000
# Rows of one slice of an Arrow batch: bounds what a task holds as Python objects.
SLICE = 256


def session(spark: SparkSession) -> SparkSession:
    """The session with the settings the operators rely on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return configure(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a table below the shared folder and read it back: later steps
    start from the files, also when an executor is lost."""
    path = scratch_path(session(df.sparkSession), name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def in_fold(key: Column, folds: int, fold: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a NULL key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds == fold


def texts(array: pa.Array) -> Iterator[list[bytes | None]]:
    """The UTF-8 bytes of an Arrow text column, a slice at a time."""
    raw = array.cast(pa.large_binary()) if pa.types.is_large_string(array.type) else array.cast(pa.binary())
    for at in range(0, len(raw), SLICE):
        yield raw.slice(at, SLICE).to_pylist()


def slice_udf(each: Callable[[list[bytes]], list], kind: pa.DataType, spark_type: str) -> Callable[..., Column]:
    """An Arrow function that applies ``each`` to slices of whole texts; NULL counts as empty."""

    @F.arrow_udf(spark_type)
    def apply(text: pa.Array) -> pa.Array:
        out = [pa.array(each([b or b"" for b in part]), kind) for part in texts(text)]
        return pa.concat_arrays(out) if out else pa.array([], kind)

    return apply


def text_udf(each: Callable[[bytes], object], kind: pa.DataType, spark_type: str) -> Callable[..., Column]:
    """As ``slice_udf``, for a function of one text."""
    return slice_udf(lambda part: list(map(each, part)), kind, spark_type)
