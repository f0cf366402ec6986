"""Best-fit packing of token pieces into sequences of bounded size.

Documents are tokenised in place; texts never leave their task, only pieces
(id, start, length, checksum) do. Every packing task runs bounded-space online
best fit: a fixed number of open bins, kept in lists keyed by their free space
with one integer as bitset over the keys, so that the tightest bin that takes a
piece is the lowest set bit at or above its length. When all places are taken
the fullest bin closes. A task's pieces arrive in falling order of length, which
wastes least as long as the places last; ``OPEN_BINS`` is above what
``TASK_PIECES`` can open. What is still open at the end of a task is packed once
more, bins as pieces, by fewer tasks.

Defined results: a NULL or empty text is the end token alone; ties go to the
bin opened last; equal rows are packed each for itself. Memory of a task is the
open bins and one Arrow batch of narrow rows.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slice_udf, stored

CAPACITY = 4096
OPEN_BINS = 1 << 16
#: Pieces of one packing task, on average. More pieces waste less at the end of a task.
TASK_PIECES = 50_000
#: Entries of a task's table of tokenised words before it starts anew.
CACHE_WORDS = 400_000

_BEFORE_PUNCTUATION = re.compile(rb"(?<=[0-9A-Za-z])(?=[!-/:-@\[-`{-~])")

PIECES = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"
_PIECES = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))


class WordTokens:
    """Token ids of a text, as packed 32-bit numbers, from a table of words.

    The vocabulary drops white space, sets punctuation off from letters and
    digits and never merges across either, so the ids of a text are those of its
    parts between white space and before punctuation, one after another. It
    ignores case; A-Z are lowered first, unless combining marks follow
    letters, which compose with some letters in one case only.
    """

    GROUP = 200

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}

    def _learn(self, parts: list[bytes]) -> None:
        """Words of letters are encoded many at a time and told apart by the
        word-end mark of their last token; all others one by one."""
        known, encode = self.known, self.tokenizer.encode_batch_fast
        names = [p.decode() for p in parts]
        plain = [i for i, name in enumerate(names) if name.lower().isalpha()]
        groups = [plain[at : at + self.GROUP] for at in range(0, len(plain), self.GROUP)]
        for group, found in zip(groups, encode([" ".join([names[i] for i in g]) for g in groups], add_special_tokens=False)):
            ids = np.array(found.ids, np.uint32)
            stops = np.flatnonzero(self.ends_word[ids]) + 1
            if len(stops) != len(group):
                raise AssertionError("a word of letters is not one pre-token")
            packed, start = ids.tobytes(), 0
            for i, stop in zip(group, (4 * stops).tolist()):
                known[parts[i]] = packed[start:stop]
                start = stop
        plain = set(plain)
        rest = [i for i in range(len(parts)) if i not in plain]
        for i, found in zip(rest, encode([names[i] for i in rest], add_special_tokens=False)):
            known[parts[i]] = array("I", found.ids).tobytes()

    def ids(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text; new words of all of them are learnt together."""
        split = []
        for text in texts:
            if b"\xcc" not in text and b"\xcd" not in text:
                text = text.lower()
            split.append(_BEFORE_PUNCTUATION.sub(b" ", text).split())
        every = set().union(*split)
        new = [p for p in every if p not in self.known]
        if len(self.known) + len(new) > CACHE_WORDS and self.known:
            self.known.clear()
            new = list(every)
        if new:
            self._learn(new)
        for parts in split:
            yield b"".join(map(self.known.__getitem__, parts))


@lru_cache(maxsize=4)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


def pieces_of(ids: bytes, end_id: int, capacity: int) -> list[dict]:
    ids += array("I", [end_id]).tobytes()
    step = 4 * capacity
    return [
        {"piece": at // step, "start": at // 4, "length": len(cut) // 4, "ids_crc32": zlib.crc32(cut)}
        for at in range(0, len(ids), step) for cut in (ids[at : at + step],)
    ]


def pieces(text: Column, tokenizer_path: str, end_id: int = 1, capacity: int = CAPACITY) -> Column:
    """The pieces of every text: its ids, then ``end_id``, cut at ``capacity``."""

    def each(part: list[bytes]) -> list[list[dict]]:
        return [pieces_of(ids, end_id, capacity) for ids in word_tokens(tokenizer_path).ids(part)]

    return slice_udf(each, _PIECES, PIECES)(text)


class OpenBins:
    """At most ``places`` open bins; a bin is [number, fill]."""

    def __init__(self, capacity: int, places: int) -> None:
        self.capacity, self.places = capacity, places
        self.by_free: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
        self.bits = self.count = self.opened = 0

    def _take(self, free: int) -> list[int]:
        found = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits ^= 1 << free
        self.count -= 1
        return found

    def _put(self, bin_: list[int]) -> None:
        free = self.capacity - bin_[1]
        if not free:
            return
        if not self.by_free[free]:
            self.bits |= 1 << free
        self.by_free[free].append(bin_)
        self.count += 1

    def place(self, length: int) -> tuple[int, int]:
        """Bin number and offset for a piece."""
        fitting = self.bits >> length
        if fitting:
            bin_ = self._take(length + (fitting & -fitting).bit_length() - 1)
        else:
            if self.count >= self.places:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            bin_ = [self.opened, 0]
            self.opened += 1
        offset = bin_[1]
        bin_[1] += length
        self._put(bin_)
        return bin_[0], offset

    def left(self) -> Iterator[tuple[int, int]]:
        for group in self.by_free:
            yield from map(tuple, group)


_PLACED = "key bigint, task int, bin bigint, offset bigint, open_fill bigint"


def _pack(rows: DataFrame, tasks: int, capacity: int, places: int) -> DataFrame:
    """Pack (key, length) rows. A second kind of row, without a key, tells which
    bins a task left open and how full they are."""

    def work(batches):
        from pyspark import TaskContext

        task, bins = TaskContext.get().partitionId(), OpenBins(capacity, places)
        for batch in batches:
            placed = [bins.place(n) for n in batch.column(1).to_pylist()]
            yield pa.record_batch({
                "key": batch.column(0), "task": pa.array([task] * len(placed), pa.int32()),
                "bin": pa.array([b for b, _ in placed], pa.int64()), "offset": pa.array([o for _, o in placed], pa.int64()),
                "open_fill": pa.nulls(len(placed), pa.int64()),
            })
        left = list(bins.left())
        yield pa.record_batch({
            "key": pa.nulls(len(left), pa.int64()), "task": pa.array([task] * len(left), pa.int32()),
            "bin": pa.array([b for b, _ in left], pa.int64()), "offset": pa.nulls(len(left), pa.int64()),
            "open_fill": pa.array([f for _, f in left], pa.int64()),
        })

    spread = rows.repartition(tasks, F.xxhash64("key")).sortWithinPartitions(F.desc("length"), "key")
    return stored(spread.mapInArrow(work, _PLACED), "packed")


def pack(items: DataFrame, capacity: int = CAPACITY, places: int = OPEN_BINS, task_pieces: int = TASK_PIECES) -> DataFrame:
    """Place ``items`` (key, length; keys distinct, lengths 1 to ``capacity``):
    returns key, sequence_id and offset. Whole sequences need no packing."""
    full = items.filter(F.col("length") >= capacity)
    loose = items.filter(F.col("length") < capacity)
    n = loose.count()
    first = _pack(loose, -(-n // task_pieces) or 1, capacity, places)
    open_bins = first.filter("key is null").select(F.struct("task", "bin").alias("group"), F.col("open_fill").alias("length"))
    group_key = F.shiftleft(F.col("group.task").cast("bigint"), 40).bitwiseOR(F.col("group.bin"))
    open_bins = open_bins.select(group_key.alias("key"), "length")
    m = open_bins.count()
    second = _pack(open_bins, -(-m // task_pieces) or 1, capacity, places).filter("key is not null")
    moved = second.select(F.col("key").alias("_moved"), F.shiftleft(F.col("task").cast("bigint"), 40).bitwiseOR(F.col("bin")).alias("_bin"), F.col("offset").alias("_by"))
    placed = first.filter("key is not null").select("key", F.shiftleft(F.col("task").cast("bigint"), 40).bitwiseOR(F.col("bin")).alias("_home"), "offset")
    # Sequences of the first round, of the second and whole ones get numbers of three kinds.
    result = placed.join(moved, F.col("_home") == F.col("_moved"), "left").select(
        "key", F.coalesce(F.col("_bin") * 3 + 1, F.col("_home") * 3).alias("sequence_id"),
        (F.col("offset") + F.coalesce("_by", F.lit(0))).alias("offset"),
    )
    return result.unionByName(full.select("key", (F.col("key") * 3 + 2).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")))


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = CAPACITY, places: int = OPEN_BINS) -> DataFrame:
    """One row for each piece of each document, with its sequence and offset."""
    cut = docs.select("doc_id", F.inline(pieces(F.col("text"), tokenizer_path, end_id, capacity)))
    rows = stored(cut.withColumn("_key", F.monotonically_increasing_id()), "pieces")
    placed = pack(rows.select(F.col("_key").alias("key"), "length"), capacity, places)
    return rows.join(placed, rows["_key"] == placed["key"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
    )
