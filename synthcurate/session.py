"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the semantics depend on; all can be changed on a running session.
REQUIRED_CONF = {
    # The last of several equal JSON keys wins, as in a Python dict.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Run settings merge like dicts: the right-hand value wins.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesced shuffles, split skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

# Summaries (counts per dataset, slice offsets, template catalogs) are
# broadcast up to this size and joined by shuffle beyond it.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024


def build_session(app: str = "synthcurate", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the required settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required settings to a session somebody else created."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a temporary folder; a
    cluster without it is an error, since a machine-local path would be lost
    with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if root is None:
        root = sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="synthcurate-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table below the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage with a written table: columnar,
    compressed, and read back column by column."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Compute a summary and mark it for broadcast if it keeps within both
    bounds; otherwise return it as it was, so that Spark shuffles the join.

    At most ``max_rows`` + 1 rows reach the driver, where a broadcast has to
    pass anyway.
    """
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    max_bytes = BROADCAST_BYTES if max_bytes is None else max_bytes
    head = df.limit(max_rows + 1).toArrow()
    if head.num_rows > max_rows or head.nbytes > max_bytes:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(head, schema=df.schema))


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL, so that rows of an unnamed
    group are not lost. Keeps the left keys only."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys]
    return left.join(renamed, reduce(lambda a, b: a & b, same), how).drop(*[f"_right_{k}" for k in keys])
