"""Curating completions as they land."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from synthcurate.operators.gate import flatten, gate
from synthcurate.plans.curate import CurationSpec


def curate_stream(
    landed: DataFrame, spec: CurationSpec = CurationSpec(), time: str | None = None, within: str | None = None,
) -> DataFrame:
    """The batch job on a stream: the gate, checks and hooks of ``spec``, and
    equal values of its ``unique`` field kept once per ``by``.

    Which of equal rows comes first depends on arrival. With ``time`` and
    ``within`` values are remembered for that long; without, for the whole
    stream, as the batch job does. The state then grows with the number of
    distinct values, so use the RocksDB state store. Hooks must be such as a
    stream allows.
    """
    rows = flatten(gate(landed, spec.strict, spec.clean, spec.checks).transform(spec.each_output))
    if spec.deduplicate:
        keys = [*spec.by, spec.unique]
        if time and within:
            rows = rows.withWatermark(time, within).dropDuplicatesWithinWatermark(keys)
        else:
            rows = rows.dropDuplicates(keys)
    return rows.transform(spec.all_results)


def start(examples: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write the stream to a Parquet folder. The checkpoint is what resumes an
    interrupted run."""
    writer = (
        examples.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
