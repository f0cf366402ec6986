"""Fixed schemas at the edges; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# JSON writers keep milliseconds only unless told.
MICROS = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"

LABELED = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("label", T.IntegerType()),
])

EXAMPLE = T.StructType([
    T.StructField("headline", T.StringType()),
    T.StructField("sentiment", T.StringType()),
])

BENCHMARK = T.StructType([
    T.StructField("total_time", T.DoubleType()),
    T.StructField("throughput", T.DoubleType()),
    T.StructField("num_examples", T.LongType()),
    T.StructField("model", T.StringType()),
    T.StructField("prompt", T.StringType()),
    T.StructField("service", T.StringType()),
])

ACCEPTED = T.StructType([
    T.StructField("prompt_id", T.LongType()),
    T.StructField("attempt", T.LongType()),
    T.StructField("items", T.ArrayType(EXAMPLE)),
    T.StructField("n_items", T.LongType()),
])

ATTEMPT = T.StructType([
    T.StructField("prompt_id", T.LongType()),
    T.StructField("raw", T.StringType()),
    T.StructField("error", T.StringType()),
])
