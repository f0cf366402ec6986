"""Benchmark decontamination by Wu-Manber search over words.

Texts are lower-cased in A-Z and cut into the words of the pattern
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. Test strings are all runs of ten words
of the items (an item of fewer words is one shorter string). For every length
of string there is one machine: a shift table of word pairs says how far the
search may jump, strings are kept in buckets by their last pair and, within, by
their first, and a direct comparison confirms an occurrence.

The items go through the driver in blocks of bounded size; a block is one
broadcast value and one search over all documents.

Defined results: a NULL or empty text has no words; an item without words never
occurs; equal items all count; a NULL item id is left out of the item list.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_udf

WINDOW = 10
#: Text bytes of the items in one block, and items of one block.
BLOCK_BYTES = 4 << 20
BLOCK_ITEMS = 20_000

_TO_SPACE = bytes(b if b >= 128 or 48 <= b < 58 or 97 <= b < 123 else 32 for b in range(256))
HITS = "struct<n_words:bigint,spans:array<struct<start:bigint,end:bigint>>,items:array<string>>"
_KIND = pa.struct([
    ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string())),
])


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_TO_SPACE).split()


class Machine:
    """Wu-Manber tables for strings of one length."""

    def __init__(self, length: int, strings: dict[tuple[bytes, ...], list[str]]) -> None:
        self.length, self.block = length, min(2, length)
        self.jump = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list]] = {}
        for string, items in strings.items():
            for end in range(self.block, length + 1):
                key = string[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.jump), length - end)
            by_start = self.buckets.setdefault(string[-self.block :], {})
            by_start.setdefault(string[: self.block], []).append((string, items))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        length, block, jump, n = self.length, self.block, self.jump, len(words)
        shift, end = self.shift.get, self.length
        while end <= n:
            key = tuple(words[end - block : end])
            step = shift(key, jump)
            if step:
                end += step
                continue
            start = end - length
            for string, items in self.buckets[key].get(tuple(words[start : start + block]), ()):
                if tuple(words[start:end]) == string:
                    yield start, end, items
            end += 1


def machines(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> list[Machine]:
    strings: dict[int, dict[tuple[bytes, ...], list[str]]] = {}
    for item_id, text in items:
        words = words_of((text or "").encode())
        length = min(window, len(words))
        for at in range(len(words) - length + 1 if length else 0):
            owners = strings.setdefault(length, {}).setdefault(tuple(words[at : at + length]), [])
            if item_id is not None and item_id not in owners:
                owners.append(item_id)
    return [Machine(length, strings[length]) for length in sorted(strings)]


def find(text: bytes, search: list[Machine]) -> dict:
    """Word spans that lie in occurrences, joined where they meet, and the items."""
    words = words_of(text)
    found, items = [], set()
    for machine in search:
        for start, end, owners in machine.search(words):
            found.append((start, end))
            items.update(owners)
    spans: list[list[int]] = []
    for start, end in sorted(found):
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(end, spans[-1][1])
        else:
            spans.append([start, end])
    return {"n_words": len(words), "spans": [{"start": s, "end": e} for s, e in spans], "items": sorted(items)}


def blocks(benchmark: DataFrame, max_bytes: int = BLOCK_BYTES, max_items: int = BLOCK_ITEMS) -> Iterator[list[tuple[str | None, str | None]]]:
    """The items in blocks; the driver holds one partition and one block at a time."""
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        block.append(tuple(row))
        size += len(row[1] or "")
        if size >= max_bytes or len(block) >= max_items:
            yield block
            block, size = [], 0
    if block:
        yield block


def contamination(docs: DataFrame, benchmark: DataFrame, text: Column | None = None) -> Column:
    """A column (n_words, n_hit, items) of every row of ``docs``."""
    sc = docs.sparkSession.sparkContext
    text = F.col("text") if text is None else text
    parts = []
    for block in blocks(benchmark):
        shared = sc.broadcast(machines(block))
        parts.append(text_udf(lambda b, shared=shared: find(b, shared.value), _KIND, HITS)(text))
    if not parts:
        parts.append(text_udf(lambda b: find(b, []), _KIND, HITS)(text))
    spans = F.array_sort(F.concat(*[p["spans"] for p in parts]))
    covered = F.aggregate(
        spans, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0).cast("bigint"), s["end"] - F.greatest(a["end"], s["start"]))).alias("n"),
            F.greatest(a["end"], s["end"]).alias("end"),
        ), lambda a: a["n"],
    )
    items = F.array_sort(F.array_distinct(F.concat(*[p["items"] for p in parts])))
    return F.struct(parts[0]["n_words"].alias("n_words"), covered.alias("n_hit"), items.alias("items"))
