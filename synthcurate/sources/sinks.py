"""Writers: examples, run settings, benchmark records, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from synthcurate import schemas
from synthcurate.functions.text import example_json
from synthcurate.operators.ordinals import running_totals
from synthcurate.session import broadcast_if_small, join_on, materialize

DATASET = ["model", "prompt"]


def write_examples(examples: DataFrame, path: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Store examples below ``model=../prompt=..``.

    The rebalance hint groups rows by dataset so that a dataset gets few
    files, and splits a dataset too large for one task.
    """
    examples.hint("rebalance", *DATASET).write.mode(mode).partitionBy(*DATASET).format(fmt).save(path)


def write_json_arrays(
    rows: DataFrame, path: str, by: list[str], order: list[str], element: Column | None = None,
    bytes_per_file: int = 64 << 20,
) -> None:
    """Store rows as files that are each one indented JSON array.

    ``element`` renders a row, by default as an example. A dataset of up to
    ``bytes_per_file`` bytes is one file; larger ones become several, in order,
    each of that size and the row that reaches it. No task holds more than one
    array, and only the order columns and sizes go through the sort.
    """
    body = example_json(F.col("headline"), F.col("sentiment")) if element is None else element
    rendered = rows.select(*by, *order, body.alias("_json"))
    sizes = rendered.select(*by, *order, F.octet_length("_json").cast("bigint").alias("_bytes"))
    placed = running_totals(sizes, by, order, "_bytes", before="_at").drop("_bytes")
    chunks = join_on(rendered, placed, [*by, *order]).groupBy(*by, F.floor(F.col("_at") / bytes_per_file).alias("_chunk")).agg(
        F.array_sort(F.collect_list(F.struct("_at", "_json"))).alias("_rows")
    )
    text = F.concat(F.lit("[\n"), F.array_join(F.transform("_rows", lambda r: r["_json"]), ",\n"), F.lit("\n]"))
    chunks.select(*by, text.alias("value")).write.partitionBy(*by).option("maxRecordsPerFile", 1).text(path)


def write_named_arrays(rows: DataFrame, folder: str, file: Column, order: list[str], element: Column | None = None) -> DataFrame:
    """Store rows as one indented JSON array per ``file`` name, in ``order``;
    returns the stored names with their number of rows.

    The format wants a dataset in one file, so one task writes it; it streams
    the sorted rows and holds one batch of them. A file that a repeated task
    writes again has the same content.
    """
    body = example_json(F.col("headline"), F.col("sentiment")) if element is None else element
    named = rows.select(file.alias("_file"), *order, body.alias("_json"))
    sorted_rows = named.repartition("_file").sortWithinPartitions("_file", *order).select("_file", "_json")

    # Local to this call, so that executors need no copy of this package.
    def write(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder.removeprefix('file:')}")
        store.create_dir(root, recursive=True)
        name = out = None
        names, counts = [], []
        for batch in batches:
            for this, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if this != name:
                    if out is not None:
                        out.write(b"\n]")
                        out.close()
                    name, out = this, store.open_output_stream(f"{root}/{this}")
                    out.write(b"[\n")
                    names.append(this)
                    counts.append(0)
                out.write((",\n" if counts[-1] else "").encode() + text.encode())
                counts[-1] += 1
        if out is not None:
            out.write(b"\n]")
            out.close()
        yield pa.record_batch({"file": pa.array(names, pa.string()), "n": pa.array(counts, pa.int64())})

    return materialize(sorted_rows.mapInArrow(write, "file string, n bigint"))


def write_named_texts(rows: DataFrame, folder: str, file: Column, body: Column) -> DataFrame:
    """Store each row's ``body`` as a text file of its own; returns the names."""

    def write(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder.removeprefix('file:')}")
        store.create_dir(root, recursive=True)
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_output_stream(f"{root}/{name}") as out:
                    out.write(text.encode())
            yield pa.record_batch({"file": batch.column(0)})

    return materialize(rows.select(file.alias("file"), body.alias("body")).mapInArrow(write, "file string"))


def missing_datasets(examples: DataFrame, existing: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows whose dataset is not among the existing ones.

    The names of existing datasets are few, so the rows are usually tested in
    place; a dataset holding most rows would otherwise be one join key.
    """
    keys = by or DATASET
    return join_on(examples, broadcast_if_small(existing.select(*keys).distinct()), keys, "left_anti")


def run_settings(runs: DataFrame, options: dict[str, object]) -> DataFrame:
    """Merge provider options into each run's ``settings``; options win."""
    if not options:
        return runs
    extra = F.create_map(*[F.lit(str(part)) for pair in options.items() for part in pair])
    return runs.withColumn("settings", F.map_concat("settings", extra))


def write_runs(runs: DataFrame, path: str) -> None:
    """Append run settings; ``settings`` is a map<string,string>."""
    runs.write.mode("append").parquet(path)


def write_benchmarks(runs: DataFrame, path: str) -> None:
    """Append benchmark records, one per line, with ``run_id`` and
    ``finished_at``; a run without them gets a name of its own and the present time."""
    kept = [f.name for f in schemas.BENCHMARK if f.name in runs.columns]
    run_id = F.col("run_id").cast("string") if "run_id" in runs.columns else F.uuid()
    finished = F.col("finished_at") if "finished_at" in runs.columns else F.current_timestamp()
    runs.select(
        run_id.alias("run_id"), finished.cast("timestamp_ntz").alias("finished_at"), *kept
    ).write.mode("append").option("timestampNTZFormat", schemas.MICROS).json(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """The summary as CSV with a header; it has one row per run group."""
    summary.repartition(1).write.mode("overwrite").option("header", True).csv(path)
