"""Quality rules from tokeniser fertility.

A public vocabulary with byte fallback cuts every word of a text. Four measures
follow: characters per token, tokens per word (fertility), the share of tokens
that are single bytes, and the entropy of the text's tokens. Their usual range
is gathered over all documents of a language (of a script where the language is
NULL), entropy also by the power of two of the token count, since it grows with
length. A text is rejected when a measure leaves the band: the median, plus or
minus the larger of ``SPREAD`` robust deviations and a fixed share of the median.
A group of fewer than ``LEAST_ROWS`` texts sets no band; its texts are judged by
the band of their script, then of all documents, and entropy at last by that of the
nearest size, opened by a bit for each power of two between, or of all sizes.

Medians and median deviations come from counts by bin, so that the driver and
any task see bins, never documents. Bands follow a language's texts; the fixed
shares keep them open where copies of one text make up much of a language.

Defined results: NULL is a text without words. Texts without words have no
measures and fail the plain rules. A table of fewer than ``LEAST_ROWS`` texts with
words sets no band and rejects nothing.
"""

from __future__ import annotations

from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from synthcurate.session import broadcast_if_small

from .common import stored, text_udf

SYMBOLS = b"#*$%&|<>"
CACHE_WORDS = 400_000
SPREAD = 5.0
LEAST_ROWS = 50
#: Width of a bin, least half-width of a band (share of the median, absolute), and
#: how much wider the upper half is: texts in several languages have more entropy.
MEASURES = {
    "chars_per_token": (0.01, 0.07, 0.0, 1.0), "fertility": (0.01, 0.25, 0.0, 1.0),
    "byte_share": (0.005, 0.0, 0.1, 1.0), "entropy": (0.02, 0.08, 0.0, 2.0),
}
_LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")
MEASURED = "struct<" + ",".join(f"{k}:bigint" for k in _LONGS) + "," + ",".join(f"{k}:double" for k in MEASURES) + ",script:string>"
_MEASURED = pa.struct([(k, pa.int64()) for k in _LONGS] + [(k, pa.float64()) for k in MEASURES] + [("script", pa.string())])


class WordPieces:
    """Piece ids of words, packed as 16-bit numbers."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        if self.model.vocab_size() > 1 << 16:
            raise ValueError(f"{path}: more than 65,536 pieces")
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.vocab_size())])
        self.known: dict[bytes, bytes] = {}

    def ids(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        new = list({w for w in words if w not in known})
        if new:
            if len(known) + len(new) > CACHE_WORDS and known:
                known.clear()
                new = list(set(words))
            for word, ids in zip(new, self.model.encode([w.decode() for w in new], num_threads=1)):
                known[word] = array("H", ids).tobytes()
        return np.frombuffer(b"".join(map(known.__getitem__, words)), np.uint16)


@lru_cache(maxsize=2)
def word_pieces(path: str) -> WordPieces:
    return WordPieces(path)


def script_of(text: str) -> str:
    """The commonest of a few scripts among the letters."""
    try:
        text.encode("latin-1")
        return "latin"
    except UnicodeEncodeError:
        pass
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    bounds = [("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("arabic", 0x600, 0x6FF), ("indic", 0x900, 0xDFF), ("kana", 0x3040, 0x30FF), ("han", 0x4E00, 0x9FFF), ("hangul", 0xAC00, 0xD7AF)]
    counts = [(int(((codes >= a) & (codes <= b)).sum()), name) for name, a, b in bounds]
    return max(counts, key=lambda x: x[0])[1] if any(n for n, _ in counts) else "other"


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in runs of ``window`` words found twice or more."""
    runs = list(zip(*(words[i:] for i in range(window))))
    once, more = set(), set()
    if len(set(runs)) == len(runs):
        return 0
    for run in runs:
        (more if run in once else once).add(run)
    covered = end = 0
    for at, run in enumerate(runs):
        if run in more:
            covered += at + window - max(end, at)
            end = at + window
    return covered


def measure(raw: bytes, pieces: WordPieces) -> dict:
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    out = {
        "n_words": len(words), "word_chars": sum(map(len, words)) if raw.isascii() else sum(len(w.decode()) for w in words),
        "n_symbols": len(raw) - len(raw.translate(None, SYMBOLS)), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated_words(words), "script": script_of(raw.decode()),
    }
    ids = pieces.ids(words)
    out["n_tokens"] = n = len(ids)
    if n:
        counts = np.unique(ids, return_counts=True)[1]
        out |= {
            "chars_per_token": out["word_chars"] / n, "fertility": n / len(words), "byte_share": float(pieces.is_byte[ids].mean()),
            "entropy": float(np.log2(n) - (counts * np.log2(counts)).sum() / n),
        }
    return out


def measures(text: Column, vocabulary_path: str) -> Column:
    return text_udf(lambda b: measure(b, word_pieces(vocabulary_path)), _MEASURED, MEASURED)(text)


def _middle(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Weighted lower median of ``value`` (weights ``n``) for each key."""
    ordered = Window.partitionBy(*keys).orderBy(value)
    share = rows.withColumn("_up_to", F.sum("n").over(ordered)).withColumn("_all", F.sum("n").over(Window.partitionBy(*keys)))
    return share.filter(F.col("_up_to") * 2 >= F.col("_all")).groupBy(*keys).agg(F.min(value).alias(name), F.max("_all").alias("rows"))


def bands(measured: DataFrame, measure_cols: dict[str, Column | list[Column]]) -> DataFrame:
    """(band, measure, low, high) for every group; ``measure_cols`` gives for
    each measure the key of its band, or several."""
    long = F.inline(F.array(*[
        F.struct(F.lit(m).alias("measure"), key.alias("band"), F.round(F.col(m) / MEASURES[m][0]).cast("bigint").alias("bin"))
        for m, keys in measure_cols.items() for key in (keys if isinstance(keys, list) else [keys])
    ]))
    counts = measured.select(long).filter("bin is not null and band is not null").groupBy("measure", "band", "bin").agg(F.count("*").alias("n"))
    keys = ["measure", "band"]
    middle = _middle(counts, keys, "bin", "centre")
    away = counts.join(middle.drop("rows"), keys).withColumn("away", F.abs(F.col("bin") - F.col("centre")))
    spread = _middle(away.groupBy(*keys, "away").agg(F.sum("n").alias("n")), keys, "away", "mad")
    setting = F.element_at(F.create_map(*[x for m, s in MEASURES.items() for x in (F.lit(m), F.struct(*[F.lit(v).alias(k) for k, v in zip("wfau", s)]))]), F.col("measure"))
    wide = F.greatest(
        SPREAD * 1.4826 * F.col("mad") * setting["w"], setting["f"] * F.col("centre") * setting["w"], setting["a"],
    )
    both = middle.join(spread.drop("rows"), keys).filter(F.col("rows") >= LEAST_ROWS)
    return both.select(*keys, (F.col("centre") * setting["w"] - wide).alias("low"), (F.col("centre") * setting["w"] + setting["u"] * wide).alias("high"))


def outside(measured: DataFrame, language: str = "lang") -> DataFrame:
    """Adds ``outside``: the measures that leave their band."""
    script = F.concat(F.lit("script "), F.col("script"))
    groups = [F.coalesce(F.concat(F.lit("lang "), F.col(language).cast("string")), script), script, F.lit("all")]
    size = F.floor(F.log2("n_tokens")).cast("int")
    sized = [F.concat(g, F.lit(" 2^"), size.cast("string")) for g in groups]
    keys = {m: list(groups) for m in MEASURES}
    keys["entropy"] = [*sized, F.lit("all")]
    own = {m: [F.array_distinct(F.array(*k))] for m, k in keys.items()}
    named = measured.select("*", *[k[0].alias(f"_{m}_keys") for m, k in own.items()])
    table = stored(bands(named, {m: [F.get(f"_{m}_keys", i) for i in range(len(k))] for m, k in keys.items()}), "bands")
    ends = table.filter(F.col("measure") == "entropy").filter(F.col("band").startswith("all 2^"))
    ends = ends.select(F.substring("band", 7, 9).cast("int").alias("near"), "low", "high")
    nearest = ends.select("*", F.explode(F.sequence(F.lit(0), F.lit(62))).alias("size")).withColumn("gap", F.col("size") - F.col("near"))
    nearest = nearest.groupBy("size").agg(F.min_by(F.struct("gap", "low", "high"), F.struct(F.abs("gap"), "gap")).alias("b"))
    nearest = nearest.select(
        F.concat(F.lit("near 2^"), F.col("size").cast("string")).alias("band"), (F.col("b.low") + F.least("b.gap", F.lit(0))).alias("low"),
        (F.col("b.high") + F.greatest("b.gap", F.lit(0))).alias("high"),
    )
    keys["entropy"].insert(3, F.concat(F.lit("near 2^"), size.cast("string")))
    rows, broken = measured, []
    for m, levels in keys.items():
        mine = table.filter(F.col("measure") == m).select("band", "low", "high")
        mine = mine.union(nearest) if m == "entropy" else mine
        for i, key in enumerate(levels):
            at = mine.select(F.col("band").alias(f"_{m}{i}"), F.struct("low", "high").alias(f"_{m}{i}_band"))
            rows = rows.join(broadcast_if_small(at), key == F.col(f"_{m}{i}"), "left")
        band = F.coalesce(*[F.col(f"_{m}{i}_band") for i in range(len(levels))])
        broken.append(F.when((F.col(m) < band["low"]) | (F.col(m) > band["high"]), F.lit(m)))
    return rows.select(*measured.columns, F.array_compact(F.array(*broken)).alias("outside"))
