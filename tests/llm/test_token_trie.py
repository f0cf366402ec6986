import math
import random

from pyspark.sql import functions as F

from synthcurate.llm import token_trie as t

SCORES = {"▁": -4.0, "▁a": -2.0, "a": -3.0, "b": -3.0, "ab": -3.5, "▁ab": -5.2, "bab": -4.0, "é": -6.0, "aab": -9.0, ",": -5.0}


def brute(text, scores):
    """(tokens, byte tokens) of the best of all ways, fewer tokens first among equals."""
    low = min(scores.values()) - 10

    def ways(at):
        if at == len(text):
            yield 0.0, 0, 0
        for end in range(at + 1, len(text) + 1):
            piece = text[at:end]
            for score, n, b in ways(end) if piece in scores or len(piece) == 1 else ():
                if piece in scores:
                    yield score + scores[piece], n + 1, b
                if len(piece) == 1:
                    size = len(piece.encode())
                    yield score + low * size, n + size, b + size

    best = max((round(s, 9), -n, b) for s, n, b in ways(0))
    return -best[1], best[2]


def split(value):
    return tuple(reversed(divmod(value, t._BYTE)))


def test_counts_equal_all_ways():
    rnd = random.Random(4)
    words = sorted({rnd.choice([t.MARK, ""]) + "".join(rnd.choice("abaéz中") for _ in range(rnd.randrange(1, 8))) for _ in range(400)})
    for word, value in zip(words, t.Trie(SCORES).walk(words)):
        assert split(value) == brute(word, SCORES), word


def test_prefixes_are_scored_once():
    trie = t.Trie(SCORES)
    list(trie.walk(["aba", "abab", "abac", "b"]))
    assert trie.nodes == 6


def test_pretokens():
    assert t.pretokens("Don't, no.. é! 1.5 «x»".encode()) == [b"Don", b"\xff't", b"\xff,", b"no", b"\xff..", "é!".encode(), b"1", b"\xff.5", "«x»".encode()]
    assert t.spelled(b"\xff't") == "'t" and t.spelled(b"no") == "▁no"


def test_a_full_table_starts_anew():
    texts = [b"abab ba, aab", b"abab zz bab", b"", b"ba"]
    small, large = t.Trie(SCORES, max_words=2), t.Trie(SCORES)
    assert [small.count([x])[0] for x in texts] == large.count(texts)


def test_odd_rows(spark, odd_docs, no_docs, vocabulary_path):
    path = vocabulary_path("piece_bpe_32k.model")
    column, trie = t.token_counts(F.col("text"), path).alias("c"), t.Trie(t.pieces(path))
    for r in odd_docs.select("text", column).collect():
        parts = t.pretokens((r.text or "").encode())
        counts = [split(next(trie.walk([t.spelled(p)]))) for p in set(parts) for _ in range(parts.count(p))]
        assert (r.c.n_words, r.c.n_pretokens) == (len((r.text or "").encode().split()), len(parts))
        assert (r.c.n_tokens, r.c.n_byte_tokens) == (sum(c[0] for c in counts), sum(c[1] for c in counts))
    assert no_docs.select(column).count() == 0


def test_vocabulary_is_a_distribution(vocabulary_path):
    scores = t.pieces(vocabulary_path("piece_bpe_32k.model"))
    assert len(scores) > 31_000 and math.isclose(sum(map(math.exp, scores.values())), 1, rel_tol=1e-6)
