import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import DATA
from synthcurate.llm import lm_hmm as h
from synthcurate.llm.queries import QUERIES


def small_model(states=3, symbols=5, seed=1):
    rng = np.random.default_rng(seed)
    draw = lambda *s: rng.dirichlet(np.ones(s[-1]), s[:-1] or None)
    return h.Model(draw(states), draw(states, states), draw(states, symbols).T)


def paths(model, symbols):
    for path in itertools.product(range(len(model.start)), repeat=len(symbols)):
        p = model.start[path[0]] * model.emit[symbols[0], path[0]]
        for a, b, s in zip(path, path[1:], symbols[1:]):
            p *= model.move[a, b] * model.emit[s, b]
        yield path, p


SEQUENCES = [[0], [1, 2, 3, 4, 0], [4, 4], [2, 0, 1], [3]]


@pytest.fixture
def flat():
    lengths = np.array([len(s) for s in SEQUENCES])
    return np.concatenate(SEQUENCES), np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths


@pytest.mark.parametrize("batch", [1, 4, 1000])
def test_forward_is_the_sum_over_all_paths(flat, batch, monkeypatch):
    monkeypatch.setattr(h, "BATCH", batch)
    model = small_model()
    assert np.allclose(h.forward(model, *flat), [math.log10(sum(p for _, p in paths(model, s))) for s in SEQUENCES])


@pytest.mark.parametrize("batch", [1, 4, 1000])
def test_expected_counts_are_those_of_all_paths(flat, batch, monkeypatch):
    monkeypatch.setattr(h, "BATCH", batch)
    model = small_model()
    sums = h.Model(np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3)))
    h.expected(model, *flat, sums)
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for s in SEQUENCES:
        whole = sum(p for _, p in paths(model, s))
        for path, p in paths(model, s):
            start[path[0]] += p / whole
            for a, b in zip(path, path[1:]):
                move[a, b] += p / whole
            for z, x in zip(path, s):
                emit[x, z] += p / whole
    close = lambda a, b: np.allclose(a, b, atol=1e-4)
    assert close(sums.start, start) and close(sums.move * model.move, move) and close(sums.emit, emit)


@pytest.mark.parametrize("batch", [1, 310, 400_000])
def test_expected_counts_of_long_sequences(batch, monkeypatch):
    monkeypatch.setattr(h, "BATCH", batch)
    rng, model = np.random.default_rng(2), small_model()
    lengths = np.array([300, 1, 300, 17, 2])
    starts = np.cumsum(lengths) - lengths
    flat = rng.integers(0, 5, lengths.sum())
    sums = h.Model(np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3)))
    h.expected(model, flat, starts, lengths, sums)
    # plain forward-backward in double precision
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for at, n in zip(starts, lengths):
        seen = flat[at : at + n]
        alpha, beta = np.zeros((n, 3)), np.ones((n, 3))
        for t in range(n):
            alpha[t] = (alpha[t - 1] @ model.move if t else model.start) * model.emit[seen[t]]
            alpha[t] /= alpha[t].sum()
        for t in range(n - 1, 0, -1):
            beta[t - 1] = model.move @ (model.emit[seen[t]] * beta[t])
            beta[t - 1] /= beta[t - 1].sum()
        post = alpha * beta / (alpha * beta).sum(1, keepdims=True)
        start += post[0]
        np.add.at(emit, seen, post)
        for t in range(1, n):
            pair = alpha[t - 1][:, None] * model.move * (model.emit[seen[t]] * beta[t])
            move += pair / pair.sum()
    assert np.allclose(sums.start, start, rtol=1e-4) and np.allclose(sums.emit, emit, rtol=1e-4)
    assert np.allclose(sums.move * model.move, move, rtol=1e-4)


def test_probabilities_of_all_tokens_sum_to_one(spark):
    """Emissions of symbols and q within each class are distributions, with one
    unseen token in each class."""
    docs = spark.createDataFrame([(f"a{i % 7} b c{i} é{i % 3}!",) for i in range(40)], "text string")
    counts = h.stored(h.token_counts(docs), "t")
    lex = h.lexicon(counts)
    seen = {bytes(t): c for t, c in counts.collect()}
    assert lex.n == sum(seen.values()) == 200 and lex.v == len(seen) and seen[b""] == 40
    model = h.first_model(lex, 4)
    assert np.allclose(model.emit.sum(0), 1)
    assert (lex.class_n == 0).all()  # so few tokens all have symbols of their own


def test_classes_hold_what_is_no_symbol(spark, monkeypatch):
    monkeypatch.setattr(h, "SYMBOLS", 3)
    docs = spark.createDataFrame([("x x x y y zz zz q1",)], "text string")
    lex = h.lexicon(h.stored(h.token_counts(docs), "t"))
    k1, k2 = h.class_of(b"zz"), h.class_of(b"q1")
    assert lex.class_n[k1] + lex.class_n[k2] + lex.class_n[h.class_of(b"y")] >= 3
    for k in {k1, k2}:
        own = lex.counts[lex.symbols == 3 + k]
        assert math.isclose(sum(10 ** h.Lexicon.log_in_class(lex, 3 + k, c) for c in own) + 1 / (lex.class_n[k] + lex.class_v[k] + 1), 1)


def test_long_tokens_and_pieces():
    assert h.tokens_of(b"A " + b"q" * 100)[1].startswith(b" ") and h.tokens_of(b"") == [b""]
    starts, lengths = h.in_pieces(np.array([0, 5, 12]), np.array([5, 7, 4]), 4)
    assert starts.tolist() == [0, 4, 5, 9, 12] and lengths.tolist() == [4, 1, 4, 3, 4]


def test_odd_rows(spark, odd_docs, no_docs):
    rows = h.scores(odd_docs, F.col("doc_id") % 2 == 0, states=2, rounds=1).collect()
    assert len(rows) == odd_docs.count() and all(r.score < 0 and r.base_score < 0 and r.n_tokens >= 1 for r in rows)
    untrained = h.scores(odd_docs, F.lit(False), states=2, rounds=1).collect()
    assert all(r.base_score == 0 and r.n_known == 0 and r.train_tokens == 0 and r.score <= 0 for r in untrained)
    assert h.scores(no_docs, F.lit(True), states=2, rounds=1).count() == 0


def test_rare_tokens_go_through_the_join(spark, monkeypatch):
    monkeypatch.setattr(h, "KNOWN", 3)
    texts = ["a a a b", "a b c", "d d e", None, "zz"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = h.scores(docs, F.col("doc_id") < 3, states=2, rounds=1).orderBy("doc_id").collect()
    c = Counter(w for t in texts[:3] for w in [*t.split(), ""])
    n, v = sum(c.values()), len(c)
    for row, text in zip(rows, texts):
        own = [*(text or "").split(), ""]
        assert math.isclose(row.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own))
        assert (row.n_tokens, row.n_known) == (len(own), sum(w in c for w in own))


def test_joined_tokens_need_counts_alone(spark, monkeypatch, capsys):
    """Rows of the join with the counts go through no Python; the class of a rarer
    token is taken where its text is encoded. Scores are the sums over all tokens."""
    monkeypatch.setattr(h, "KNOWN", 4)
    monkeypatch.setattr(h, "SYMBOLS", 2)
    texts = ["a a a b", "a b c c", "d d e f1 f1", None, "zz q-q d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = h.scores(docs, F.col("doc_id") < 3, states=1, rounds=1)
    found.explain()
    assert "ArrowEvalPython" not in capsys.readouterr().out
    c = Counter(w.encode() for t in texts[:3] for w in [*t.split(), ""])
    lex = h.lexicon(h.stored(h.token_counts(docs.filter("doc_id < 3")), "t"))
    for r in found.collect():
        own = [w.encode() for w in [*(texts[r.doc_id] or "").split(), ""]]
        symbol = [lex.known[w] if lex.known.get(w, 2) < 2 else 2 + h.class_of(w) for w in own]
        inner = sum(float(lex.log_in_class(s, c[w])) for s, w in zip(symbol, own) if s >= 2)
        base = sum(math.log10((c[w] + 1) / (lex.n + lex.v + 1)) for w in own)
        assert math.isclose(r.base_score, base, rel_tol=1e-12) and r.n_known == sum(w in c for w in own)
        counted = Counter(lex.known[w] if lex.known.get(w, 2) < 2 else 2 + h.class_of(w) for t in texts[:3] for w in [x.encode() for x in [*t.split(), ""]])
        prior = (lex.symbol_n + 0.5) / (lex.symbol_n + 0.5).sum()
        trained = np.array([counted[s] for s in range(2 + h.CLASSES)]) + 50.0 * prior
        trained /= trained.sum()
        assert math.isclose(r.score, inner + sum(math.log10(trained[s]) for s in symbol), rel_tol=1e-5)


def test_classes_by_spark_are_those_of_python(spark):
    tokens = [b"", b"a", b"zz", b"q1", b"7", b"-", b"a-b", "é".encode(), "straße".encode(), "é1".encode(), "中文".encode(), b"AB", b"aB", b"\x00",
              b"\x7f", b" " + b"0a" * 32, "🙂".encode(), b"a\x80", b"\xff\xfe", b"x\x85"]
    rows = spark.createDataFrame([(bytearray(t),) for t in tokens], "token binary").select("token", h.class_column(F.col("token")).alias("k")).collect()
    assert [r.k for r in rows] == [h.class_of(bytes(r.token)) for r in rows] and len(rows) == len(tokens)


def test_query_base_and_gain(spark):
    rows = QUERIES["op5_hmm_scores"](spark, f"{DATA}/sf0.001").collect()
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [b""] for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    c = Counter(w for i, t in texts.items() if not held[i] for w in t)
    n, v = sum(c.values()), len(c)
    for r in rows:
        t = texts[r.doc_id]
        assert r.held_out == held[r.doc_id] and r.train_tokens == n and r.n_tokens == len(t) and r.n_known == sum(w in c for w in t)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > 0.97 * sum(r.base_score for r in out)


def test_queries_train_six_rounds(spark, monkeypatch):
    done, whole = [], h.maximised
    monkeypatch.setattr(h, "maximised", lambda *a: done.append(1) or whole(*a))
    docs = spark.createDataFrame([(1, "a b a b c"), (2, "b a c")], "doc_id long, text string")
    h.scores(docs, F.lit(True), states=2)
    assert len(done) == 6
