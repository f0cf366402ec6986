"""Readers for JSON-array datasets, templates, stored examples and runs."""

from __future__ import annotations

from collections.abc import Callable
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from synthcurate import schemas


def read_labeled(spark: SparkSession, train: str, validation: str) -> DataFrame:
    """Labelled headlines of both splits from JSON-array files."""

    def one(path: str, split: str) -> DataFrame:
        # An array may span lines, hence multiLine; one file is one task.
        rows = spark.read.schema(schemas.LABELED).option("multiLine", True).option("mode", "FAILFAST").json(path)
        return rows.withColumn("split", F.lit(split))

    return one(train, "train").unionByName(one(validation, "validation"))


def read_json_arrays(spark: SparkSession, path: str, item: T.StructType) -> DataFrame:
    """Elements of JSON-array files with their ``file`` and position ``pos``,
    which the multi-line reader does not give. A broken file is an error."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("body")
    )
    items = F.from_json("body", T.ArrayType(item), {"mode": "FAILFAST"})
    return files.select("file", F.posexplode(items).alias("pos", "item")).select(
        "file", F.col("pos").cast("bigint").alias("pos"), "item.*"
    )


def read_aux(
    spark: SparkSession, path: str, item: T.StructType,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Auxiliary rows keyed by ``prompt_id`` (their ``idx`` field)."""
    rows = read_json_arrays(spark, path, item).drop("file", "pos").withColumnRenamed("idx", "prompt_id")
    return rows.transform(prepare) if prepare else rows


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    """``(template, body)`` of the text files in a folder."""
    files = spark.read.option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    return files.select(
        F.regexp_replace(F.col("_metadata.file_name"), r"\.txt$", "").alias("template"),
        F.col("value").alias("body"),
    )


def packaged_templates() -> dict[str, str]:
    """The templates that come with this package, by name.

    A ``_bg_`` template also has a form with a ticker, under two names: the
    name chooses the ticker pool, the body is the same.
    """
    folder = resources.files("synthcurate") / "templates"
    bodies = {f.name.removesuffix(".txt"): f.read_text("utf-8") for f in folder.iterdir() if f.name.endswith(".txt")}
    timed = {
        name.replace("_bg_", f"_bg_{pool}-time-info_"): body.replace("Task: one", "Task: about {stock_ticker}, one")
        for name, body in bodies.items() if "_bg_" in name for pool in ("train", "test")
    }
    return bodies | timed


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(packaged_templates().items()), "template string, body string")


def template_in_name(name: Column) -> Column:
    """The template part of a dataset name: what follows the last ``prompt=``."""
    return F.regexp_extract(name, r"prompt=((?:(?!prompt=).)*?)\.json$", 1)


def read_named_datasets(spark: SparkSession, folder: str) -> DataFrame:
    """Stored examples of every ``*prompt=*.json`` file of the folder itself,
    with its dataset name. Settings in folders below have names of that form
    too and are not read. A broken file is an error."""
    rows = (
        spark.read.schema(schemas.EXAMPLE).option("multiLine", True).option("mode", "FAILFAST")
        .option("pathGlobFilter", "*prompt=*.json").json(folder)
    )
    return rows.withColumn("dataset", F.col("_metadata.file_name"))


def read_examples(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The native store: folders ``model=../prompt=..``; filters on these two
    columns prune folders."""
    partitions = [T.StructField("model", T.StringType()), T.StructField("prompt", T.StringType())]
    lineage = [T.StructField(c, T.LongType()) for c in ("prompt_id", "attempt", "pos")]
    schema = T.StructType(lineage + schemas.EXAMPLE.fields + partitions)
    return spark.read.schema(schema).format(fmt).load(path)


def read_resume(spark: SparkSession, path: str, template: str) -> DataFrame:
    """Examples of an earlier run. Its name must carry the same template."""
    rows = read_json_arrays(spark, path, schemas.EXAMPLE)
    name = F.element_at(F.split("file", "/"), -1)
    found = template_in_name(name)
    return rows.filter(
        F.when(found == template, True).otherwise(
            F.raise_error(F.concat(F.lit(f"dataset does not belong to template {template}: "), name))
        )
    )


def stamp_in_name(name: Column) -> Column:
    """The time in a benchmark file name, in either of its two formats."""
    digits = F.regexp_replace(
        F.regexp_extract(name, r"(\d{4}-?\d{2}-?\d{2}_\d{2}-?\d{2}-?\d{2})\.json$", 1), "[-_]", ""
    )
    return F.try_to_timestamp(digits, F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Benchmark records of a folder: files that are one record each, with the
    time in their name, and files with a record per line, which hold its
    ``run_id`` and ``finished_at``. A broken file is an error."""
    stored = T.StructType([*schemas.BENCHMARK.fields, T.StructField("run_id", T.StringType()), T.StructField("finished_at", T.TimestampNTZType())])
    reader = spark.read.option("mode", "FAILFAST")
    lines = reader.schema(stored).option("timestampNTZFormat", schemas.MICROS).option("pathGlobFilter", "part-*.json").json(path)
    single = reader.schema(schemas.BENCHMARK).option("multiLine", True).option("pathGlobFilter", "*.json").json(path)
    name = F.col("_metadata.file_name")
    single = single.filter(~name.startswith("part-")).withColumn("run_id", name).withColumn("finished_at", stamp_in_name(name))
    return single.unionByName(lines)
