"""Language-model scores from a hidden Markov model of words.

Tokens are the words of a text in lower case (A-Z) and one end token. A latent
state emits a symbol: one of the ``SYMBOLS`` commonest tokens, or a class of
rarer ones (kind of characters and ending). A token of a class follows the
class by its exact count, q(w) = (c + 1) / (N_class + V_class + 1), unseen tokens
sharing the one left over. So

    p(text) = p(symbols of the text) * product of q over its rarer tokens

where the first factor is the scaled forward recursion over the whole text and
the second needs counts alone, which are joined, not broadcast.

1. Counts of all tokens of the training texts, pre-aggregated in each task.
2. Texts become arrays of symbols, with their tokens outside the ``KNOWN``
   commonest ones beside them. Only these go through a join with the counts;
   none of them is common, so no key of that join is hot.
3. Baum-Welch: every round, each task runs forward-backward over its training
   texts and gives expected counts, which Spark sums; the driver holds one
   model of fixed size.
4. Forward recursion over every text.

Broadcast are the model and the ``KNOWN`` commonest tokens, at most 65 bytes
each: longer tokens go by their SHA-256.

Defined results: NULL and empty texts are the end token alone; each row is
scored for itself. Without training texts N = V = 0: the base score is 0 and the
score that of the first model.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from synthcurate.operators.ordinals import running_totals

from .common import stored, texts

STATES = 12
ROUNDS = 6
SYMBOLS = 16_384
KNOWN = 262_144
CLASSES = 256
LONGEST = 64
#: Tokens of one training piece, and of a batch of pieces run side by side.
PIECE = 65_536
BATCH = 400_000
#: Symbols a task holds at a time, besides one Arrow batch.
GATHER = 3_000_000
TASK_COUNTS = 300_000
END = b""

_LETTERS = b"abcdefghijklmnopqrstuvwxyz"
_DIGITS = b"0123456789"


def tokens_of(text: bytes) -> list[bytes]:
    words = text.lower().split()
    if len(text) > LONGEST and max(map(len, words), default=0) > LONGEST:
        words = [w if len(w) <= LONGEST else b" " + hashlib.sha256(w).hexdigest().encode() for w in words]
    words.append(END)
    return words


def class_of(token: bytes) -> int:
    """One of ``CLASSES``: what kinds of characters it has, and its ending."""
    if token.isalpha() and token.islower():  # as bytes: letters a-z alone
        return zlib.crc32(token[-2:]) % (CLASSES // 4)
    other = token.translate(None, _LETTERS)
    kind = 0 if not other else 1 if len(other.translate(None, _DIGITS)) < len(other) else 2 if other.isascii() else 3
    return kind * (CLASSES // 4) + zlib.crc32(token[-2:]) % (CLASSES // 4)


def class_column(token: Column) -> Column:
    """``class_of`` as a Spark expression of a binary column."""
    text = token.cast("string")
    kind = F.when(text.rlike(r"\A[a-z]*\z"), 0).when(text.rlike("[0-9]"), 1).when(text.rlike(r"[^\x00-\x7F]"), 3).otherwise(2)
    return kind * (CLASSES // 4) + (F.crc32(F.substring(token, -2, 2)) % (CLASSES // 4)).cast("int")


def token_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(token, c) over all texts."""

    def work(batches):
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for part in texts(batch.column(0)):
                for raw in part:
                    seen.update(tokens_of(raw or b""))
                if len(seen) >= TASK_COUNTS:
                    yield flush(seen)
                    seen.clear()
        if seen:
            yield flush(seen)

    def flush(seen):
        return pa.record_batch({"token": pa.array(list(seen), pa.binary()), "c": pa.array(list(seen.values()), pa.int64())})

    parts = docs.select(text).mapInArrow(work, "token binary, c bigint")
    return parts.groupBy("token").agg(F.sum("c").alias("c"))


@dataclass(frozen=True)
class Lexicon:
    """The commonest tokens by number, with symbol and count of each; totals of
    all and of the classes."""

    known: dict[bytes, int]
    symbols: np.ndarray
    counts: np.ndarray
    class_n: np.ndarray
    class_v: np.ndarray
    n: int
    v: int
    symbol_n: np.ndarray

    def log_in_class(self, symbol, c):
        k = np.asarray(symbol) - SYMBOLS
        return np.log10(np.asarray(c) + 1.0) - np.log10(self.class_n[k] + self.class_v[k] + 1.0)

    def logs(self) -> tuple[np.ndarray, np.ndarray, float]:
        """log10 of c + 1 of each known token, with 0 at the end for any other; of
        the size of each class; of the size of all."""
        return np.append(np.log10(self.counts + 1.0), 0.0), np.log10(self.class_n + self.class_v + 1.0), float(np.log10(self.n + self.v + 1.0))


def commonest(counts: DataFrame, k: int) -> pa.Table:
    """The ``k`` commonest tokens (ties by token bytes), commonest first. A
    threshold comes from the count of counts (one row per distinct count, at most
    about the square root of twice the number of tokens); only the tokens of the
    count at the threshold are ranked, by a distributed sort. No task gathers
    more than ``k`` rows, and the driver gets them."""
    words = counts.filter(F.octet_length("token") > 0)
    above, cut = 0, None
    for c, m in words.groupBy("c").agg(F.count("*").alias("m")).orderBy(F.desc("c")).collect():
        if above + m >= k:
            cut = c
            break
        above += m
    if cut is None:
        chosen = words
    else:
        tied = running_totals(words.filter(F.col("c") == cut).withColumn("_g", F.lit(0)), ["_g"], ["token"], before="_rank")
        chosen = words.filter(F.col("c") > cut).unionByName(tied.filter(F.col("_rank") < k - above).select("token", "c"))
    return chosen.toArrow().sort_by([("c", "descending"), ("token", "ascending")])


def lexicon(counts: DataFrame) -> Lexicon:
    """``counts`` is a stored table (token, c)."""
    top = commonest(counts, KNOWN - 1)
    end = counts.filter(F.octet_length("token") == 0).select("c").first()
    tokens = [END, *top.column(0).to_pylist()]
    own = np.array([end[0] if end else 0, *top.column(1).to_pylist()], np.int64)
    symbols = np.array([i if i < SYMBOLS else SYMBOLS + class_of(t) for i, t in enumerate(tokens)], np.int32)
    symbol_n = np.zeros(SYMBOLS + CLASSES)
    symbol_n[: len(own[:SYMBOLS])] = own[:SYMBOLS]

    totals = counts.groupBy().agg(F.sum("c"), F.count("*")).first()
    by_class = counts.filter(F.octet_length("token") > 0).groupBy(class_column(F.col("token")).alias("k")).agg(F.sum("c"), F.count("*")).collect()
    class_n, class_v = np.zeros(CLASSES), np.zeros(CLASSES)
    for k, n, v in by_class:
        class_n[k], class_v[k] = n, v
    for token, c in zip(tokens[1:SYMBOLS], own[1:]):  # these are symbols of their own
        k = class_of(token)
        class_n[k] -= c
        class_v[k] -= 1
    symbol_n[SYMBOLS:] = class_n
    return Lexicon({t: i for i, t in enumerate(tokens)}, symbols, own, class_n, class_v, totals[0] or 0, totals[1], symbol_n)


ENCODED = "n_tokens bigint, n_known bigint, base double, inner double, symbols array<int>, rare array<binary>, rare_n array<int>"


def encode(docs: DataFrame, words: Broadcast, keep: list[str]) -> DataFrame:
    """Symbols of every text; its other tokens; base and inner sums, which lack
    only log10(c + 1) of those (c their counts, to be joined)."""
    kinds = docs.select(*keep).schema
    names = [x.split()[0] for x in ENCODED.split(", ")]
    arrow = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.binary()), pa.list_(pa.int32())]

    def one(raw: bytes, lex: Lexicon, log_c: np.ndarray, log_class: np.ndarray, log_all: float) -> tuple:
        tokens = tokens_of(raw)
        numbers = np.fromiter(map(lex.known.get, tokens, repeat(-1)), np.int32, len(tokens))
        symbols, logs = lex.symbols[numbers], log_c[numbers]
        places = np.flatnonzero(numbers < 0)
        unknown = [tokens[i] for i in places.tolist()]
        symbols[places] = [SYMBOLS + class_of(t) for t in unknown]
        rare = Counter(unknown)
        in_class = np.flatnonzero(symbols >= SYMBOLS)
        return (
            len(tokens), int(np.count_nonzero(logs)), float(logs.sum() - len(tokens) * log_all),
            float((logs[in_class] - log_class[symbols[in_class] - SYMBOLS]).sum()), symbols, list(rare), list(rare.values()),
        )

    def work(batches):
        lex = words.value
        logs = lex.logs()
        for batch in batches:
            at = 0
            for part in texts(batch.column(len(keep))):
                rows = [one(raw or b"", lex, *logs) for raw in part]
                columns = [batch.column(i).slice(at, len(part)) for i in range(len(keep))]
                columns += [pa.array(c, k) for c, k in zip(zip(*rows), arrow)]
                yield pa.record_batch(columns, [*keep, *names])
                at += len(part)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds)
    return docs.select(*keep, "text").mapInArrow(work, f"{schema}, {ENCODED}")


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # symbols x states


def _rows(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Flat symbols and offsets of a list column."""
    column = batch.column(batch.schema.get_field_index(name))
    offsets = np.asarray(column.offsets)
    return np.asarray(column.values), offsets


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches put together to about ``GATHER`` symbols: the more texts of
    like length run side by side, the fewer steps there are."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(len(b.column(b.num_columns - 1).flatten()) for b in held) >= GATHER:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _batches(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Indices in falling order of length, in runs of bounded size."""
    order = np.argsort(-lengths, kind="stable")
    ends = np.cumsum(lengths[order])
    low = 0
    while low < len(order):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + BATCH)))
        yield order[low:high]
        low = high


def _side_by_side(flat: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, list[int], np.ndarray, np.ndarray]:
    """Sequences in falling order of length, step by step: the symbols, the
    number of sequences at each step, where each step begins, and the sequence
    of each symbol."""
    active = np.searchsorted(-size, -np.arange(int(size[0])), side="left")
    begin = np.concatenate(([0], np.cumsum(active)))
    step = np.repeat(np.arange(len(active)), active)
    sequence = np.arange(begin[-1]) - begin[step]
    return flat[starts[sequence] + step], active.tolist(), begin, sequence


def forward(model: Model, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """log10 probability of each sequence by the scaled forward recursion."""
    out, ones = np.zeros(len(starts)), np.ones((len(model.start), 1))
    for at in _batches(lengths):
        seen, active, begin, sequence = _side_by_side(flat, starts[at], lengths[at])
        emitted, scales, edges = np.take(model.emit, seen, axis=0), np.empty((len(seen), 1)), begin.tolist()
        state = np.repeat(model.start[None], len(at), 0)
        for t, n in enumerate(active):
            low, high = edges[t], edges[t + 1]
            if t:
                state = np.dot(state[:n], model.move)
            state *= emitted[low:high]
            state /= np.dot(state, ones, out=scales[low:high])
        out[at] = np.bincount(sequence, np.log10(scales[:, 0]), len(at))
    return out


def expected(model: Model, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, sums: Model) -> None:
    """Add the expected counts of the sequences to ``sums`` (forward-backward);
    those of moves still lack the factor of the model's own. Single precision
    is enough for counts: every state is scaled to sum to one."""
    k, move, back = len(model.start), model.move.astype(np.float32), model.move.T.astype(np.float32)
    emit, ones = model.emit.astype(np.float32), np.ones((len(model.start), 1), np.float32)
    runs, moves = list(_batches(lengths)), sums.move
    # Written anew by every batch. A step is short, so it makes no arrays of its own
    # and leaves to whole passes over the batch what does not carry over.
    longest = max((int(lengths[at].sum()) for at in runs), default=0)
    rooms = [np.empty((longest, width), np.float32) for width in (k, k, k, 1)]
    for at in runs:
        seen, active, begin, _ = _side_by_side(flat, starts[at], lengths[at])
        seen, edges = seen.astype(np.int64), begin.tolist()
        emitted, alpha, beta, scales = (room[: len(seen)] for room in rooms)
        np.take(emit, seen, axis=0, out=emitted, mode="clip")
        alpha[: active[0]] = model.start
        state = alpha[:0]
        for t, n in enumerate(active):
            low, high = edges[t], edges[t + 1]
            state = np.dot(state[:n], move, out=alpha[low:high]) if t else alpha[:high]
            state *= emitted[low:high]
            scale = np.dot(state, ones, out=scales[low:high])
            np.reciprocal(scale, out=scale)
            state *= scale
        emitted *= scales
        # Backward: with scaled emissions every posterior is alpha times beta.
        beta.fill(1)  # sequences that end keep ones
        for t in range(len(active) - 1, 0, -1):
            n, low, before = active[t], edges[t], edges[t - 1]
            weighted = emitted[low : low + n]
            weighted *= beta[low : low + n]
            moves += np.dot(alpha[before : before + n].T, weighted)
            np.dot(weighted, back, out=beta[before : before + n])
        alpha *= beta
        sums.start += alpha[: active[0]].sum(0)
        for z in range(k):
            sums.emit[:, z] += np.bincount(seen, alpha[:, z], len(sums.emit))


def in_pieces(starts: np.ndarray, lengths: np.ndarray, size: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of pieces of at most ``size`` that make up the sequences."""
    parts = np.maximum(1, -(-lengths // size))
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    return np.repeat(starts, parts) + nth * size, np.minimum(size, np.repeat(lengths, parts) - nth * size)


def first_model(lex: Lexicon, states: int) -> Model:
    """Unigram emissions, each token leaning to the state its ending hashes to,
    and states that last. Ties of the states are broken alike on every run."""
    lean = np.full((SYMBOLS + CLASSES, states), 1.0)
    for token, number in lex.known.items():
        if number < SYMBOLS:
            lean[number, zlib.crc32(token[-2:]) % states] += 2.0
    for k in range(CLASSES):
        lean[SYMBOLS + k, k % states] += 1.0
    emit = lean * (lex.symbol_n + 0.5)[:, None]
    move = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
    return Model(np.full(states, 1.0 / states), move, emit / emit.sum(0))


def maximised(sums: Model, lex: Lexicon) -> Model:
    """The model of the expected counts, smoothed towards the unigram model."""
    prior = lex.symbol_n + 0.5
    emit = sums.emit + 50.0 * (prior / prior.sum())[:, None]
    move = sums.move + 0.5
    start = sums.start + 0.5
    return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def train(encoded: DataFrame, lex: Lexicon, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over all rows of ``encoded`` (column symbols)."""
    sc, model = encoded.sparkSession.sparkContext, first_model(lex, states)
    names = [f"s{z}" for z in range(states)]

    def counted(batches, shared):
        sums = Model(np.zeros(states), np.zeros((states, states)), np.zeros((SYMBOLS + CLASSES, states)))
        for batch in _gathered(batches):
            flat, offsets = _rows(batch, "symbols")
            expected(shared.value, flat, *in_pieces(offsets[:-1].astype(np.int64), np.diff(offsets)), sums)
        rows = np.vstack([sums.emit, sums.move * shared.value.move, sums.start[None]])
        used = np.flatnonzero(rows.any(1))
        yield pa.record_batch([pa.array(used.astype(np.int32)), *(pa.array(rows[used, z]) for z in range(states))], ["row", *names])

    schema = "row int, " + ", ".join(f"{n} double" for n in names)
    for _ in range(rounds):
        shared = sc.broadcast(model)
        parts = encoded.select("symbols").mapInArrow(lambda b, shared=shared: counted(b, shared), schema)
        found = parts.groupBy("row").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
        rows = np.zeros((SYMBOLS + CLASSES + states + 1, states))
        rows[found.column(0).to_numpy()] = np.column_stack([found.column(n).to_numpy() for n in names])
        model = maximised(Model(rows[-1], rows[-1 - states : -1], rows[: SYMBOLS + CLASSES]), lex)
    return model


def scores(docs: DataFrame, training: Column, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): n_tokens, n_known, train_tokens,
    base_score and score. ``training`` says which rows are learnt from."""
    sc = docs.sparkSession.sparkContext
    rows = docs.select("doc_id", "text", training.alias("train"))
    counts = stored(token_counts(rows.filter("train")), "token-counts")
    lex = lexicon(counts)
    words = sc.broadcast(lex)
    encoded = encode(rows, words, ["doc_id", "train"]).withColumn("row", F.monotonically_increasing_id())
    encoded = stored(encoded, "symbols", compression="zstd")
    model = sc.broadcast(train(encoded.filter("train"), lex, states, rounds))

    def work(batches):
        for batch in _gathered(batches):
            flat, offsets = _rows(batch, "symbols")
            found = forward(model.value, flat, offsets[:-1].astype(np.int64), np.diff(offsets))
            yield pa.record_batch([*batch.columns[:-1], pa.array(found)], [*batch.schema.names[:-1], "forward"])

    narrow = "row bigint, doc_id {}, train boolean, n_tokens bigint, n_known bigint, base double, inner double"
    kind = docs.schema["doc_id"].dataType.simpleString()
    plain = encoded.select("row", "doc_id", "train", "n_tokens", "n_known", "base", "inner", "symbols").mapInArrow(work, narrow.format(kind) + ", forward double")

    rare = encoded.select("row", F.inline(F.arrays_zip(F.col("rare").alias("token"), F.col("rare_n").alias("times"))))
    left = counts.select(F.col("token").alias("of"), "c")
    met = rare.join(left, F.col("token") == F.col("of"), "left").withColumn("c", F.coalesce("c", F.lit(0)))
    # one sum serves both scores: what else they take from a rarer token is in the encoded sums
    met = met.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("more"),
    ).withColumnRenamed("row", "of_row")
    both = plain.join(met, F.col("row") == F.col("of_row"), "left")
    zero = F.lit(0.0)
    return both.select(
        "doc_id", "train", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(lex.n)).cast("bigint").alias("train_tokens"), (F.col("base") + F.coalesce("more", zero)).alias("base_score"),
        (F.col("forward") + F.col("inner") + F.coalesce("more", zero)).alias("score"),
    )
