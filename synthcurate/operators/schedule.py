"""Start times of requests under a rate limit.

Requests of a lane (a provider or a key) wait until they are ready and at
least ``gap`` after the previous start of their lane, in order of readiness:
start_i = max(ready_i, start_(i-1) + gap). That recurrence is a prefix scan
in the (max, +) semiring; unrolled, start_i = i * gap + max over j <= i of
(ready_j - j * gap), with i the request's place in its lane. So the schedule is
two distributed scans, a running count and a running maximum, each spread over
many partitions whatever the size of a lane; no window holds a whole lane.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synthcurate.operators.ordinals import running_max, running_totals


def schedule(requests: DataFrame, lane: list[str], ready: str, key: str, gap: int) -> DataFrame:
    """``requests`` with ``place`` in the lane, ``start`` and ``wait`` (same unit as
    the integer column ``ready``). Order within a lane: ``ready``, then ``key``,
    which must be unique in a lane. Rows with NULL ``ready`` are not scheduled."""
    timed = requests.filter(F.col(ready).isNotNull())
    placed = running_totals(timed, lane, [ready, key], before="place")
    shifted = placed.withColumn("_shifted", F.col(ready) - F.col("place") * F.lit(gap))
    best = running_max(shifted, lane, [ready, key], "_shifted", "_best")
    start = F.col("place") * F.lit(gap) + F.col("_best")
    return best.select(*requests.columns, "place", start.alias("start"), (start - F.col(ready)).alias("wait"))
