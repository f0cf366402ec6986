"""Alignment of two tokenizations of the same bytes, as an associative monoid of
fragments.

A text is encoded by two public tokenizers: A (byte-level BPE, of a space and
the text) and B (SentencePiece with byte fallback, which adds the space
itself). Special-token strings inside a text stay plain text. A token's bytes:
for A the byte-level decoding of its string; for B its piece in UTF-8 with
U+2581 as a space and ``<0xHH>`` as byte HH. Where A and B both end a token
the text is cut; the tokens between two cuts form a group. A link is a pair of
an A and a B token whose byte ranges overlap; within a group of a A tokens and
b B tokens there are a + b - 1.

The method: a document's tokens are cut into chunks of ``CHUNK_BYTES`` bytes by
their ends. A chunk yields a fragment: the open prefix (its tokens up to its
first common end), the closed groups after it, and the open suffix (after its
last common end); a chunk without a common end is open as a whole. Two
neighbouring fragments compose: the left suffix and the right prefix close a
group, or, when the right side is open, extend the suffix. This is associative,
so the fragments of a long document are composed in a tree whose levels are
Spark aggregations by (document, chunk // 2). Closed groups travel only as
their summary (number of groups and links, link pairs with their counts, the
group text); only open ends carry tokens. All of it is array arithmetic
(numpy): the links of tokens that tile the same bytes are the elementary
intervals between all token ends. A document of one chunk is one fragment
without open ends; it is summarised where it is tokenised, in one pass with its
neighbours of up to ``BATCH_BYTES`` bytes, and skips the tree.

Corpus-wide, the count of an (A id, B id) pair is the number of documents (rows)
that link it at least once; each link is then weighed by that count and by the
highest count of its A id (ties are all best).

Results per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and
groups_sha256, the SHA-256 of ``a1,a2|b1;a3|b2,b3`` (groups in order). NULL,
empty texts and texts whose A or B bytes differ from a space and the text have
no tokens: zeros and ''. Repeated rows are separate documents; doc_id may be
NULL; other columns are ignored; very long texts are tokenised whole.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from synthcurate.session import broadcast_if_small

from .common import stored, texts

# Bytes of a chunk of a document, by token ends; longer documents go through the tree.
CHUNK_BYTES = 1 << 20
# Bytes of documents that are summarised in one pass.
BATCH_BYTES = 1 << 20
# A link pair as one number: A id times this plus B id (B ids are below it).
PAIR = 1 << 20

_I64 = pa.list_(pa.int64())
_OPEN = pa.struct([("a", _I64), ("a_end", _I64), ("b", _I64), ("b_end", _I64)])
_SUMMARY = pa.struct([("groups", pa.int64()), ("links", pa.int64()), ("pairs", _I64), ("counts", _I64), ("text", pa.string())])
_FRAGMENT = pa.struct([("k", pa.int64()), ("closed", pa.bool_()), ("prefix", _OPEN), ("inner", _SUMMARY), ("suffix", _OPEN)])
_RESULT = pa.struct([("ok", pa.bool_()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("whole", _SUMMARY), ("chunks", pa.list_(_FRAGMENT))])

_OPEN_T = T.StructType([T.StructField(c, T.ArrayType(T.LongType())) for c in ("a", "a_end", "b", "b_end")])
_SUMMARY_T = T.StructType([
    T.StructField("groups", T.LongType()), T.StructField("links", T.LongType()), T.StructField("pairs", T.ArrayType(T.LongType())),
    T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("text", T.StringType()),
])
_FRAGMENT_T = T.StructType([
    T.StructField("k", T.LongType()), T.StructField("closed", T.BooleanType()), T.StructField("prefix", _OPEN_T),
    T.StructField("inner", _SUMMARY_T), T.StructField("suffix", _OPEN_T),
])
_RESULT_DDL = T.StructType([
    T.StructField("ok", T.BooleanType()), T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()),
    T.StructField("whole", _SUMMARY_T), T.StructField("chunks", T.ArrayType(_FRAGMENT_T)),
])


@lru_cache(maxsize=2)
def _tokenizers(path_a: str, path_b: str):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    # byte-level alphabet: printable bytes stand for themselves, the others follow from 256 up
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    codes = {b: b for b in shown}
    extra = 0
    for b in range(256):
        if b not in codes:
            codes[b] = 256 + extra
            extra += 1
    back = {chr(c): b for b, c in codes.items()}
    a_bytes = [b""] * a.get_vocab_size()
    for token, i in a.get_vocab().items():
        a_bytes[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
    # The same byte-pair encoding by ranks: the ids of the vocabulary are the merge
    # ranks, so tiktoken built from this file gives the tokenizer's ids, faster.
    import tiktoken

    from public_tokenizers import PATTERN

    specials = set(a.get_added_tokens_decoder()) if hasattr(a, "get_added_tokens_decoder") else set()
    ranks = {x: i for i, x in enumerate(a_bytes) if x and i not in specials}
    a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    b_bytes = []
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        if b.is_byte(i):
            b_bytes.append(bytes([int(piece[3:5], 16)]))
        elif b.is_control(i) or b.is_unknown(i):
            b_bytes.append(b"")
        else:
            b_bytes.append(piece.replace("▁", " ").encode())
    return a, a_bytes, b, b_bytes


@lru_cache(maxsize=2)
def _lengths(path_a: str, path_b: str) -> tuple[np.ndarray, np.ndarray]:
    _, a_bytes, _, b_bytes = _tokenizers(path_a, path_b)
    return np.array([len(x) for x in a_bytes], np.int64), np.array([len(x) for x in b_bytes], np.int64)


def _tokens(a, a_end, b, b_end) -> dict:
    return {"a": np.asarray(a, np.int64), "a_end": np.asarray(a_end, np.int64), "b": np.asarray(b, np.int64), "b_end": np.asarray(b_end, np.int64)}


@lru_cache(maxsize=4)
def _names(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For ids below ``size`` (at most ``PAIR``, seven digits): the id as decimal
    text with the mark that follows it in the group text, eight bytes padded with
    zeros as one number. First A's ids inside a group and at its end, then B's;
    last, the bytes of each that are not padding."""
    digits = np.arange(size).astype("S7")
    marked = {mark: np.char.add(digits, mark).astype("S8").view("<u8") for mark in (b",", b"|", b";")}
    return np.r_[marked[b","], marked[b"|"]], np.r_[marked[b","], marked[b";"]], np.char.str_len(digits).astype(np.int64) + 1


_NONE = _tokens([], [], [], [])
_ZERO = {"groups": 0, "links": 0, "pairs": np.zeros(0, np.int64), "counts": np.zeros(0, np.int64), "text": ""}


def _cat(x: dict, y: dict) -> dict:
    return {k: np.concatenate([x[k], y[k]]) for k in ("a", "a_end", "b", "b_end")}


def _part(t: dict, lo: int, hi: int) -> dict:
    """Tokens whose end lies in (lo, hi]."""
    ia, ja = np.searchsorted(t["a_end"], [lo, hi], side="right")
    ib, jb = np.searchsorted(t["b_end"], [lo, hi], side="right")
    return {"a": t["a"][ia:ja], "a_end": t["a_end"][ia:ja], "b": t["b"][ib:jb], "b_end": t["b_end"][ib:jb]}


def summaries(t: dict, bounds: np.ndarray) -> list[dict]:
    """Summaries of stretches of closed groups, one after the other: ``t`` holds
    exactly their tokens, ``bounds`` where each stretch ends (ascending). Links are
    the elementary intervals between ends. The group texts are bytes."""
    a, b, base = t["a"], t["b"], min(t["a_end"][0], t["b_end"][0])
    at_a, at_b = np.zeros(bounds[-1] - base + 1, bool), np.zeros(bounds[-1] - base + 1, bool)
    at_a[t["a_end"] - base] = at_b[t["b_end"] - base] = True
    ends = np.flatnonzero(at_a | at_b)
    of_a, of_b = at_a[ends], at_b[ends]
    cut = of_a & of_b
    # tokens of either side and groups, up to each end
    n_a, n_b, n_cut = np.cumsum(of_a), np.cumsum(of_b), np.cumsum(cut)
    upto = np.searchsorted(ends, bounds - base, side="right")
    stretch = np.repeat(np.arange(len(bounds)), np.diff(upto, prepend=0))
    # an interval lies in the tokens that are the first to end with or after it
    keys = np.sort((stretch * PAIR + a[n_a - of_a]) * PAIR + b[n_b - of_b])
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    counts, keys = np.diff(first, append=len(keys)), keys[first]
    pair_upto = np.searchsorted(keys, np.arange(1, len(bounds) + 1) * PAIR * PAIR)
    keys %= PAIR * PAIR
    # the group text: each id with the mark after it, put where its group, side and place say
    size = 1 << int(max(a.max(), b.max())).bit_length()
    names_a, names_b, width = _names(size)
    group, last_a, last_b = n_cut - cut, cut[of_a], cut[of_b]
    items = np.empty(len(a) + len(b), "<u8")
    items[np.arange(len(a)) + np.r_[0, n_b[cut]][group[of_a]]] = names_a[a + size * last_a]
    items[np.arange(len(b)) + n_a[cut][group[of_b]]] = names_b[b + size * last_b]
    letters = items.view(np.uint8)
    letters = letters[letters != 0].tobytes()
    text_upto = np.cumsum(width[a])[n_a[upto - 1] - 1] + np.cumsum(width[b])[n_b[upto - 1] - 1]
    out, link, pair, letter, groups = [], 0, 0, 0, 0
    for i, j, k, g in zip(upto.tolist(), pair_upto.tolist(), text_upto.tolist(), n_cut[upto - 1].tolist()):
        out.append({"groups": g - groups, "links": i - link, "pairs": keys[pair:j], "counts": counts[pair:j], "text": letters[letter : k - 1]})
        link, pair, letter, groups = i, j, k, g
    return out


def summarize(t: dict, cuts: np.ndarray) -> dict:
    """Summary of closed groups: ``t`` holds exactly their tokens, ``cuts`` their
    common ends (ascending)."""
    if len(cuts) == 0:
        return dict(_ZERO)
    out = summaries(t, cuts[-1:])[0]
    return out | {"text": out["text"].decode()}


def add(x: dict, y: dict) -> dict:
    """Summaries of neighbouring closed groups, left first."""
    if not x["groups"]:
        return y
    if not y["groups"]:
        return x
    keys, where = np.unique(np.concatenate([x["pairs"], y["pairs"]]), return_inverse=True)
    counts = np.bincount(where, weights=np.concatenate([x["counts"], y["counts"]]), minlength=len(keys)).astype(np.int64)
    return {"groups": x["groups"] + y["groups"], "links": x["links"] + y["links"], "pairs": keys, "counts": counts, "text": x["text"] + ";" + y["text"]}


def _group(t: dict) -> dict:
    """Summary of tokens that form one closed group."""
    if len(t["a"]) == 0 and len(t["b"]) == 0:
        return dict(_ZERO)
    return summarize(t, np.array([max(t["a_end"][-1], t["b_end"][-1])]))


def fragment(t: dict, k: int = 0) -> dict:
    """The fragment of a chunk's tokens: open prefix, summary of closed groups, open suffix."""
    cuts = np.intersect1d(t["a_end"], t["b_end"], assume_unique=True)
    if len(cuts) == 0:
        return {"k": k, "closed": False, "prefix": t, "inner": dict(_ZERO), "suffix": _NONE}
    first, last = int(cuts[0]), int(cuts[-1])
    return {
        "k": k, "closed": True, "prefix": _part(t, -1, first), "inner": summarize(_part(t, first, last), cuts[1:]),
        "suffix": _part(t, last, 1 << 62),
    }


def compose(left: dict, right: dict) -> dict:
    """The fragment of two neighbouring fragments; associative, the open empty fragment is neutral."""
    k = left["k"] // 2
    if left["closed"] and right["closed"]:
        inner = add(add(left["inner"], _group(_cat(left["suffix"], right["prefix"]))), right["inner"])
        return {"k": k, "closed": True, "prefix": left["prefix"], "inner": inner, "suffix": right["suffix"]}
    if left["closed"]:
        return {"k": k, "closed": True, "prefix": left["prefix"], "inner": left["inner"], "suffix": _cat(left["suffix"], right["prefix"])}
    if right["closed"]:
        return {"k": k, "closed": True, "prefix": _cat(left["prefix"], right["prefix"]), "inner": right["inner"], "suffix": right["suffix"]}
    return {"k": k, "closed": False, "prefix": _cat(left["prefix"], right["prefix"]), "inner": dict(_ZERO), "suffix": _NONE}


def whole(frag: dict) -> dict:
    """Summary of a document from its composed fragment: its ends are cuts too."""
    out = add(_group(frag["prefix"]), frag["inner"])
    return add(out, _group(frag["suffix"])) if frag["closed"] else out


def encode(text: bytes | None, path_a: str, path_b: str) -> dict | None:
    """Ids and byte ends of A and B, or None where either differs from the bytes."""
    if not text:
        return None
    a, a_bytes, b, b_bytes = _tokenizers(path_a, path_b)
    s = text.decode("utf-8")
    want = b" " + text
    la, lb = _lengths(path_a, path_b)
    ai, bi = np.array(a.encode_ordinary(" " + s), np.int64), b.encode_as_numpy(s).astype(np.int64)
    a_end, b_end = np.cumsum(la[ai]), np.cumsum(lb[bi])
    # Byte-pair encoding by ranks cuts the bytes it is given, so A's bytes are the
    # text's when their lengths add up; B's pieces may be normalised and are compared.
    if not len(ai) or a_end[-1] != len(want) or b"".join(map(b_bytes.__getitem__, bi.tolist())) != want:
        return None
    return {"a": ai, "a_end": a_end, "b": bi, "b_end": b_end, "size": len(want)}


def _plain_open(t: dict) -> dict:
    return {k: t[k].tolist() for k in ("a", "a_end", "b", "b_end")}


def _plain_summary(x: dict) -> dict:
    return {"groups": int(x["groups"]), "links": int(x["links"]), "pairs": x["pairs"].tolist(), "counts": x["counts"].tolist(), "text": x["text"]}


def _plain_fragment(f: dict) -> dict:
    return {"k": f["k"], "closed": f["closed"], "prefix": _plain_open(f["prefix"]), "inner": _plain_summary(f["inner"]), "suffix": _plain_open(f["suffix"])}


def results(part: list[bytes | None], path_a: str, path_b: str) -> list[dict]:
    """Per document: its summary when it is one chunk, else the fragments of its chunks."""
    out, held, size = [], [], 0

    def summed():
        shift = np.cumsum([0, *(t["size"] for _, t in held)])
        moved = [t | {"a_end": t["a_end"] + at, "b_end": t["b_end"] + at} for (_, t), at in zip(held, shift.tolist())]
        joined = {k: np.concatenate([t[k] for t in moved]) for k in ("a", "a_end", "b", "b_end")}
        # a document's bounds are common ends, so that all its groups are closed
        for (row, _), x in zip(held, summaries(joined, shift[1:])):
            row["whole"] = x | {"text": hashlib.sha256(x["text"]).hexdigest()}

    for text in part:
        t = encode(text, path_a, path_b)
        if t is None:
            out.append({"ok": False, "n_a": 0, "n_b": 0, "whole": None, "chunks": []})
            continue
        out.append({"ok": True, "n_a": len(t["a"]), "n_b": len(t["b"]), "whole": None, "chunks": []})
        n = math.ceil(t["size"] / CHUNK_BYTES)
        if n > 1:
            out[-1]["chunks"] = [_plain_fragment(fragment(_part(t, k * CHUNK_BYTES, (k + 1) * CHUNK_BYTES), k)) for k in range(n)]
            continue
        held.append((out[-1], t))
        size += t["size"]
        if size >= BATCH_BYTES:
            summed()
            held, size = [], 0
    if held:
        summed()
    return out


def _hashed(x: dict) -> dict:
    """A document's summary with its group text replaced by the text's SHA-256 (lowercase hex)."""
    return x | {"text": hashlib.sha256(x["text"].encode()).hexdigest()}


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int64)))


def _arrow(rows: list[dict]) -> pa.Array:
    """Results of a slice as Arrow, the numeric lists straight from numpy."""
    empty = np.zeros(0, np.int64)
    wholes = [r["whole"] or {"groups": 0, "links": 0, "pairs": empty, "counts": empty, "text": ""} for r in rows]
    summary = pa.StructArray.from_arrays(
        [pa.array([w["groups"] for w in wholes], pa.int64()), pa.array([w["links"] for w in wholes], pa.int64()),
         _lists([w["pairs"] for w in wholes]), _lists([w["counts"] for w in wholes]), pa.array([w["text"] for w in wholes], pa.string())],
        fields=list(_SUMMARY), mask=pa.array([r["whole"] is None for r in rows]),
    )
    return pa.StructArray.from_arrays(
        [pa.array([r["ok"] for r in rows], pa.bool_()), pa.array([r["n_a"] for r in rows], pa.int64()),
         pa.array([r["n_b"] for r in rows], pa.int64()), summary, pa.array([r["chunks"] for r in rows], pa.list_(_FRAGMENT))],
        fields=list(_RESULT),
    )


def _result_udf(path_a: str, path_b: str):
    @F.arrow_udf(_RESULT_DDL)
    def apply(text: pa.Array) -> pa.Array:
        out = [_arrow(results(part, path_a, path_b)) for part in texts(text)]
        return pa.concat_arrays(out) if out else pa.array([], _RESULT)

    return apply


def _plain(x):
    return x.asDict(recursive=True) if hasattr(x, "asDict") else x


def _from_row(f) -> dict:
    f = _plain(f)
    o = lambda x: _tokens(x["a"], x["a_end"], x["b"], x["b_end"])
    i = f["inner"]
    inner = {"groups": i["groups"], "links": i["links"], "pairs": np.asarray(i["pairs"], np.int64), "counts": np.asarray(i["counts"], np.int64), "text": i["text"]}
    return {"k": int(f["k"]), "closed": bool(f["closed"]), "prefix": o(f["prefix"]), "inner": inner, "suffix": o(f["suffix"])}


def _level(pdf: pd.DataFrame) -> pd.DataFrame:
    """One level of the tree: neighbours (2i, 2i+1) of a document composed."""
    frags = sorted((_from_row(f) for f in pdf["frag"]), key=lambda f: f["k"])
    out = frags[0] if len(frags) == 1 else compose(frags[0], frags[1])
    out["k"] = frags[0]["k"] // 2
    return pd.DataFrame({"row": [int(pdf["row"].iloc[0])], "frag": [_plain_fragment(out)]})


def _final(pdf: pd.DataFrame) -> pd.DataFrame:
    f = _from_row(pdf["frag"].iloc[0])
    return pd.DataFrame({"row": [int(pdf["row"].iloc[0])], "whole": [_plain_summary(_hashed(whole(f)))]})


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    keyed = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    res = stored(keyed.select("row", "doc_id", _result_udf(path_a, path_b)(F.col("text")).alias("r")), "align-docs")
    # documents of several chunks: their fragments are composed level by level
    frags = res.filter(F.size("r.chunks") > 0).select("row", F.explode("r.chunks").alias("frag"))
    most = res.agg(F.max(F.size("r.chunks"))).first()[0] or 0
    level = T.StructType([T.StructField("row", T.LongType()), T.StructField("frag", _FRAGMENT_T)])
    for _ in range(math.ceil(math.log2(most)) if most > 1 else 0):
        frags = stored(frags.groupBy("row", (F.col("frag.k") / 2).cast("long")).applyInPandas(_level, level), "align-level")
    final = T.StructType([T.StructField("row", T.LongType()), T.StructField("whole", _SUMMARY_T)])
    long_docs = frags.groupBy("row").applyInPandas(_final, final) if most > 1 else spark.createDataFrame([], final)
    # a summary's text is already the SHA-256 of the group text
    summaries = stored(res.filter(F.col("r.whole").isNotNull()).select("row", F.col("r.whole").alias("whole")).unionByName(long_docs), "align-summaries")
    # corpus-wide: documents that link a pair, and the best count of each A id
    pairs = summaries.select("row", F.explode(F.arrays_zip("whole.pairs", "whole.counts")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"),
    )
    counts = pairs.groupBy("pair").agg(F.count("*").alias("count"))
    best = counts.groupBy((F.col("pair") / PAIR).cast("long").alias("a")).agg(F.max("count").alias("best"))
    weights = broadcast_if_small(counts.withColumn("a", (F.col("pair") / PAIR).cast("long")).join(best, "a").drop("a"))
    per_doc = pairs.join(weights, "pair").groupBy("row").agg(
        F.sum(F.col("n") * F.col("count")).alias("count_sum"), F.sum(F.when(F.col("count") == F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
    )
    shaped = summaries.select(
        "row", F.col("whole.groups").alias("n_groups"), F.col("whole.links").alias("n_links"), F.col("whole.text").alias("groups_sha256"),
    )
    out = res.select("row", "doc_id", F.col("r.n_a").alias("n_a"), F.col("r.n_b").alias("n_b"))
    out = out.join(shaped, "row", "left").join(per_doc, "row", "left")
    return out.select(
        "doc_id", "n_a", "n_b", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_groups", "n_links", "n_best", "count_sum")],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
