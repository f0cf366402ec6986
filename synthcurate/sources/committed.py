"""Writes that several writers may run at once: staged files, then one manifest
per dataset put only if absent.

A writer first writes all its rows below ``_staging/<writer>/``, a folder per
dataset (``_ds=<key>``, the SHA-256 of the dataset columns); nobody reads
there. It then commits each dataset by creating ``_committed/<key>`` with
create-without-overwrite of the Hadoop file system, which fails when the file
exists (atomic on HDFS; on object stores as atomic as their conditional put).
The manifest holds the writer's name. A dataset that another writer committed
first is skipped whole, so two writers of one dataset leave it once, with the
rows of the first, and a writer killed before its commit leaves nothing that
readers see. A retried write of the same writer name commits what is missing.

Readers list the manifests (one small file per dataset) and read only the
staged folders they name; an empty manifest, one still being written, counts as
absent. The datasets of one write are few (models times templates), so their
keys and commits pass the driver; the rows never do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DATASET = ["model", "prompt"]


def dataset_key(by: list[str]) -> F.Column:
    """A key per dataset that NULLs and separators cannot make equal."""
    parts = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in by]
    return F.sha2(F.to_json(F.array(*parts)), 256)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _put_if_absent(spark: SparkSession, path: str, body: str) -> bool:
    fs, p, jvm = _fs(spark, path)
    try:
        out = fs.create(p, False)
    except Exception as e:  # FileAlreadyExistsException and kin, through py4j
        if "AlreadyExists" in str(e) or "already exists" in str(e):
            return False
        raise
    try:
        out.write(bytearray(body.encode()))
    finally:
        out.close()
    return True


def stage(rows: DataFrame, root: str, writer: str, by: list[str] | None = None) -> DataFrame:
    """Write ``rows`` below the writer's staging folder; returns the datasets
    staged, (key, by...). Readers do not see staged rows."""
    keys = by or DATASET
    staged = rows.withColumn("_ds", dataset_key(keys))
    staged.hint("rebalance", "_ds").write.mode("overwrite").partitionBy("_ds").parquet(f"{root}/_staging/{writer}")
    return staged.select("_ds", *keys).distinct()


def commit(spark: SparkSession, datasets: DataFrame, root: str, writer: str) -> DataFrame:
    """Commit each staged dataset unless another writer did; returns (key, committed)."""
    outcome = []
    for row in datasets.select("_ds").collect():  # a row per dataset
        key = row["_ds"]
        mine = _put_if_absent(spark, f"{root}/_committed/{key}", writer)
        outcome.append((key, mine or _owner(spark, root, key) == writer))
    return spark.createDataFrame(outcome, "_ds string, committed boolean")


def _owner(spark: SparkSession, root: str, key: str) -> str | None:
    fs, p, _ = _fs(spark, f"{root}/_committed/{key}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        data = bytearray()
        buf = bytearray(4096)
        while (n := stream.read(buf)) > 0:
            data += buf[:n]
    finally:
        stream.close()
    return data.decode() or None


def write_committed(rows: DataFrame, root: str, by: list[str] | None = None, writer: str | None = None) -> DataFrame:
    """Stage and commit; returns (key, committed) for each dataset of ``rows``."""
    name = writer or uuid.uuid4().hex
    return commit(rows.sparkSession, stage(rows, root, name, by), root, name)


def read_committed(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The rows of committed datasets only; ``schema`` gives the columns written."""
    fs, p, jvm = _fs(spark, f"{root}/_committed")
    if not fs.exists(p):
        return spark.createDataFrame([], schema)
    manifests = spark.read.text(f"{root}/_committed", wholetext=True).select(
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("key"), F.trim("value").alias("writer"),
    ).filter(F.col("writer") != "")
    paths = [f"{root}/_staging/{r['writer']}/_ds={r['key']}" for r in manifests.collect()]  # a row per dataset
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)
