import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import DATA
from synthcurate.llm import fertility as f
from synthcurate.llm.queries import QUERIES


def brute(text):
    raw = (text or "").encode()
    words = raw.split()
    runs = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if runs[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in raw.split(b"\n"):
        if line.split():
            dup += line in seen
            seen.add(line)
    return len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered)


@pytest.mark.parametrize("seed", range(4))
def test_repeated_words(seed):
    rnd = random.Random(seed)
    for _ in range(60):
        words = [rnd.choice([b"a", b"b", b"c", b"d"]) for _ in range(rnd.randrange(14))]
        assert f.repeated_words(words) == brute(b" ".join(words).decode())[4]


def test_plain_measures_of_the_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect()}
    for r in QUERIES["op8_fertility_rules"](spark, f"{DATA}/sf0.001").collect():
        n, chars, symbols, dup, repeat = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 50 or 100 * repeat > 50 * n) and not (r.kept and r.base_failed)


def test_measures_equal_the_vocabulary(vocabulary_path):
    pieces = f.WordPieces(vocabulary_path("piece_bpe_32k.model"))
    text = "The harbour, ﷽ 中 zéro\u0000x\nthe harbour,"
    m = f.measure(text.encode(), pieces)
    ids = [i for w in text.encode().split() for i in pieces.model.encode(w.decode())]
    p = np.array(list(Counter(ids).values())) / len(ids)
    assert m["n_tokens"] == len(ids) and np.isclose(m["entropy"], -(p * np.log2(p)).sum())
    assert np.isclose(m["byte_share"], sum(map(pieces.model.is_byte, ids)) / len(ids)) and m["byte_share"] > 0


def test_bands_are_median_and_deviation(spark, monkeypatch):
    monkeypatch.setattr(f, "LEAST_ROWS", 5)
    values = [2.0, 2.1, 2.2, 2.3, 2.4, 9.0, None]
    rows = spark.createDataFrame([("x", v) for v in values] + [("y", 1.0)], "g string, chars_per_token double")
    (band,) = f.bands(rows, {"chars_per_token": F.col("g")}).collect()
    wide = f.SPREAD * 1.4826 * 0.1
    assert np.isclose(band.low, 2.2 - wide) and np.isclose(band.high, 2.2 + wide)


def test_junk_leaves_and_clean_text_stays(spark):
    rows = QUERIES["op8_fertility_rules"](spark, f"{DATA}/sf0.01").filter("not base_failed")
    labels = spark.read.parquet(f"{DATA}/sf0.01/labels.parquet")
    kept = {(r.quality, r.kept): r.n for r in rows.join(labels, "doc_id").groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()}
    assert kept.get((1, False), 0) <= 0.02 * kept[(1, True)] and kept[(0, False)] > 2 * kept.get((0, True), 0)


def test_odd_rows(spark, odd_docs, no_docs, vocabulary_path, monkeypatch):
    path = vocabulary_path("piece_bpe_32k.model")
    column = f.measures(F.col("text"), path).alias("m")
    for docs in (odd_docs, no_docs):
        measured = docs.select("doc_id", "lang", column).select("doc_id", "lang", "m.*")
        out = f.outside(measured)
        assert out.count() == docs.count() and out.filter(F.size("outside") > 0).count() == 0
    scripts = {r.doc_id: r.m.script for r in odd_docs.select("doc_id", column).collect()}
    assert scripts[9] == "cyrillic" and scripts[0] == "latin" and f.script_of("→") == "other"


def test_a_full_table_starts_anew(vocabulary_path, monkeypatch):
    pieces = f.WordPieces(vocabulary_path("piece_bpe_32k.model"))
    first = pieces.ids([b"one", b"two"]).tolist()
    monkeypatch.setattr(f, "CACHE_WORDS", 2)
    pieces.ids([b"three", b"four"])
    assert pieces.ids([b"one", b"two"]).tolist() == first


def test_rare_languages_and_sizes_are_judged(spark):
    cols = "doc_id long, lang string, script string, n_tokens long, chars_per_token double, fertility double, byte_share double, entropy double"
    rows = [(i, "en", "latin", 600 + i, 4.0 + i % 5 / 50, 1.3, 0.0, 7.0 + i % 7 / 20) for i in range(200)]
    rows += [(1000, "xx", "latin", 700, 1.0, 1.3, 0.0, 7.1), (1001, "yy", "thai", 700, 4.0, 9.0, 0.9, 7.1)]
    rows += [(1002, "en", "latin", 50_000, 4.0, 1.3, 0.0, 1.0), (1003, "en", "latin", 50_000, 4.0, 1.3, 0.0, 9.5), (1004, "zz", "latin", 700, 4.0, 1.3, 0.0, 7.1)]
    out = {r.doc_id: r.outside for r in f.outside(spark.createDataFrame(rows, cols)).collect()}
    assert {k: v for k, v in out.items() if v} == {1000: ["chars_per_token"], 1001: ["fertility", "byte_share"], 1002: ["entropy"]}
