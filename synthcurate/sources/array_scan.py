"""JSON-array files read by many tasks: a structural prefix scan.

A file that is one JSON array is cut into byte ranges of ``RANGE_BYTES``. Where
a range starts, a reader does not know whether it is inside a string (perhaps
just after a backslash) or how deep it is in brackets. So the scan has three
passes, each a Spark job over ranges:

1. Every range is walked under each of the three states it may start in
   (outside a string, inside one, inside one after a backslash). For each it
   keeps the state at its end and the change of bracket depth. Ranges are
   walked on their own, in parallel.
2. A prefix over the ranges of a file, in order, composes these summaries and
   picks each range's true starting state and depth. Only the summaries, a few
   numbers a range, meet in one group per file.
3. Each range, with its true state, cuts out the elements of the top-level
   array that start in it: from the first byte after ``[`` or a comma at depth
   one outside strings, to the byte before the next such comma or the closing
   ``]``. An element that runs past the range's end is read on by the range it
   starts in, as a line reader does with a line. A prefix sum of the elements
   per range gives each its position.

Structural bytes are ASCII and never occur inside a multi-byte UTF-8 character,
so cuts may fall anywhere. Elements are parsed by Spark (``from_json``). A file
that is not one array (other bytes before ``[`` or after ``]``, brackets that
do not close, a string that does not end) is an error naming the file. An empty
array gives no rows; an empty folder gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from synthcurate.session import broadcast_if_small, materialize

# Bytes of a range; a file of n bytes is read by ceil(n / RANGE_BYTES) tasks.
RANGE_BYTES = 32 << 20

OUT, IN, ESC = 0, 1, 2
_SPECIAL = np.frombuffer(b'"\\[]{},', dtype=np.uint8)
_WS = b" \t\r\n"


def _open(path: str):
    from pyarrow import fs

    store, local = fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")
    return store.open_input_file(local)


def _specials(data: bytes) -> np.ndarray:
    arr = np.frombuffer(data, dtype=np.uint8)
    return np.flatnonzero(np.isin(arr, _SPECIAL))


def walk(data: bytes, state: int, depth: int, on_byte=None) -> tuple[int, int]:
    """State and depth after ``data``, starting from ``state`` and ``depth``.
    ``on_byte(position, byte, depth_before)`` sees each structural byte outside strings."""
    skip = -1
    if state == ESC and data:
        state, skip = IN, 0  # the byte after a backslash is taken as it is
    for p in _specials(data).tolist():
        if p <= skip:
            continue
        c = data[p]
        if state == IN:
            if c == 0x5C:  # backslash: the next byte is taken as it is
                if p + 1 >= len(data):
                    state = ESC
                skip = p + 1
            elif c == 0x22:
                state = OUT
            continue
        if c == 0x22:
            state = IN
            continue
        if on_byte is not None:
            on_byte(p, c, depth)
        if c in (0x5B, 0x7B):
            depth += 1
        elif c in (0x5D, 0x7D):
            depth -= 1
    return state, depth


def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pass 1: for each range, end state and depth change under each start state."""
    for batch in batches:
        rows = batch.to_pylist()
        out = {k: [] for k in ("file", "k", "end_out", "end_in", "end_esc", "d_out", "d_in", "d_esc")}
        for r in rows:
            with _open(r["file"]) as f:
                data = f.read_at(r["stop"] - r["start"], r["start"])
            out["file"].append(r["file"])
            out["k"].append(r["k"])
            for name, state in (("out", OUT), ("in", IN), ("esc", ESC)):
                end, d = walk(data, state, 0)
                out[f"end_{name}"].append(end)
                out[f"d_{name}"].append(d)
        yield pa.RecordBatch.from_pydict(out)


def _prefix(pdf: pd.DataFrame) -> pd.DataFrame:
    """Pass 2: start state and depth of each range of one file, in order."""
    pdf = pdf.sort_values("k")
    state, depth, states, depths = OUT, 0, [], []
    for r in pdf.itertuples():
        states.append(state)
        depths.append(depth)
        name = ("out", "in", "esc")[state]
        depth += getattr(r, f"d_{name}")
        state = getattr(r, f"end_{name}")
    if state != OUT or depth != 0:
        raise ValueError(f"not one JSON array: {pdf['file'].iloc[0]} ends inside a string or a bracket")
    return pd.DataFrame({"file": pdf["file"], "k": pdf["k"], "state": states, "depth": depths})


def _cut(path: str, start: int, stop: int, size: int, state: int, depth: int) -> list[tuple[int, bytes]]:
    """Pass 3: (offset, bytes) of each element whose opening '[' or comma lies in [start, stop)."""
    found: list[tuple[int, bytes]] = []
    with _open(path) as f:
        data = f.read_at(stop - start, start)
        first = _first(f, size)
        if start <= first < stop and data[first - start] != 0x5B:
            raise ValueError(f"not one JSON array: {path} does not start with '['")
        seps: list[tuple[int, int]] = []  # (offset, byte) of '[' and of commas at depth one
        ends: list[tuple[int, int]] = []  # (offset, byte) of commas and ']' at depth one

        def on_byte(p: int, c: int, before: int) -> None:
            at = start + p
            if before == 0 and c in (0x5B, 0x7B) and at != first:
                raise ValueError(f"not one JSON array: {path} has a second value at byte {at}")
            if c == 0x5B and before == 0:
                seps.append((at, c))
            elif c == 0x2C and before == 1:
                ends.append((at, c))
                seps.append((at, c))
            elif c == 0x5D and before == 1:
                ends.append((at, c))
                if f.read_at(size - at - 1, at + 1).strip(_WS):
                    raise ValueError(f"not one JSON array: {path} has bytes after ']'")

        state, depth = walk(data, state, depth, on_byte)
        at = start + len(data)
        j = 0
        for sep, sep_byte in seps:
            while j < len(ends) and ends[j][0] <= sep:
                j += 1
            if j < len(ends):
                end, end_byte = ends[j]
            else:
                end, at, state, depth = _read_on(f, path, size, at, state, depth)
                end_byte = f.read_at(1, end)[0]
                ends.append((end, end_byte))
            body = f.read_at(end - sep - 1, sep + 1)
            if not body.strip(_WS):
                if sep_byte == 0x5B and end_byte == 0x5D:
                    continue  # the empty array
                raise ValueError(f"not one JSON array: {path} has an empty element at byte {sep + 1}")
            found.append((sep + 1, body))
    return found


def _first(f, size: int, step: int = 1 << 16) -> int:
    """Offset of the first byte that is not white space (``size`` if none)."""
    at = 0
    while at < size:
        data = f.read_at(min(step, size - at), at)
        rest = data.lstrip(_WS)
        if rest:
            return at + len(data) - len(rest)
        at += len(data)
    return size


def _read_on(f, path: str, size: int, at: int, state: int, depth: int, step: int = 1 << 20):
    """Read past the range until the element closes; (end, where reading stopped, state, depth)."""
    end = None
    while end is None:
        if at >= size:
            raise ValueError(f"not one JSON array: {path} ends inside an element")
        data = f.read_at(min(step, size - at), at)
        hit: list[int] = []

        def on_byte(p: int, c: int, before: int) -> None:
            if not hit and before == 1 and c in (0x2C, 0x5D):
                hit.append(at + p)

        state, depth = walk(data, state, depth, on_byte)
        if hit:
            end = hit[0]
        at += len(data)
    return end, at, state, depth


def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        files, ks, locals_, offsets, bodies = [], [], [], [], []
        for r in batch.to_pylist():
            for i, (offset, piece) in enumerate(_cut(r["file"], r["start"], r["stop"], r["size"], r["state"], r["depth"])):
                files.append(r["file"])
                ks.append(r["k"])
                locals_.append(i)
                offsets.append(offset)
                bodies.append(piece)
        yield pa.RecordBatch.from_pydict({
            "file": pa.array(files, pa.string()), "k": pa.array(ks, pa.int64()), "local": pa.array(locals_, pa.int64()),
            "offset": pa.array(offsets, pa.int64()), "body": pa.array(bodies, pa.binary()),
        })


def scan_arrays(spark: SparkSession, path: str, item: T.StructType, range_bytes: int | None = None) -> DataFrame:
    """Elements of the JSON-array files at ``path`` with ``file`` and ``pos``, as
    ``read_json_arrays`` gives them, each file read by many tasks."""
    step = range_bytes or RANGE_BYTES
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("length").alias("size"))
    ranges = files.select(
        "file", "size", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("size") / step) - 1, F.lit(0)).cast("bigint"))).alias("k"),
    ).select("file", "size", "k", (F.col("k") * step).alias("start"), F.least(F.col("size"), (F.col("k") + 1) * step).alias("stop"))
    ranges = materialize(ranges.repartition(F.col("file"), F.col("k")))
    summary = ranges.mapInArrow(summaries, "file string, k bigint, end_out bigint, end_in bigint, end_esc bigint, d_out bigint, d_in bigint, d_esc bigint")
    starts = summary.groupBy("file").applyInPandas(_prefix, "file string, k bigint, state bigint, depth bigint")
    located = ranges.join(broadcast_if_small(starts), ["file", "k"])
    found = materialize(located.mapInArrow(elements, "file string, k bigint, local bigint, offset bigint, body binary"))
    per_range = found.groupBy("file", "k").agg(F.count("*").alias("n"))
    before = per_range.withColumn("base", F.sum("n").over(Window.partitionBy("file").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)))
    placed = found.join(broadcast_if_small(before.select("file", "k", F.coalesce("base", F.lit(0)).alias("base"))), ["file", "k"])
    parsed = F.from_json(F.decode("body", "UTF-8"), item, {"mode": "FAILFAST"})
    return placed.select("file", (F.col("base") + F.col("local")).cast("bigint").alias("pos"), parsed.alias("item")).select("file", "pos", "item.*")
