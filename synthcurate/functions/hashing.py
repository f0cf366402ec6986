"""Seeded draws as pure functions of (seed, identity, slot).

The same row gets the same number on every retry, on every partitioning and
on every engine with md5, which ``rand()`` does not give.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60  # 15 hex digits fit a positive bigint


def hash60(*parts: Column | str | int) -> Column:
    """Uniform integer in [0, 2^60) from the ``:``-joined parts.

    Strings and integers are constants, columns are read per row.
    """
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    text = F.concat_ws(":", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def bucket_of(h: Column, bits: int) -> Column:
    """The leading ``bits`` bits of a 60-bit hash: equal slices of hash order."""
    return F.shiftright(h, HASH_BITS - bits)
