import hashlib
import random

import pytest
from pyspark.sql import functions as F

from synthcurate.llm import token_align as ta
from synthcurate.llm.queries import vocabulary


@pytest.fixture(scope="module")
def paths():
    return vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


def brute(texts, paths):
    """Plain alignment: tokens by the plain libraries, groups by a walk, links by all overlapping pairs."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(paths[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=paths[1])
    _, a_bytes, _, b_bytes = ta._tokenizers(*paths)
    per, pair_docs = [], {}
    for t in texts:
        if not t:
            per.append(None)
            continue
        ai, bi = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        want = (" " + t).encode()
        if b"".join(a_bytes[i] for i in ai) != want or b"".join(b_bytes[i] for i in bi) != want:
            per.append(None)
            continue
        ra, rb, at = [], [], 0
        for i in ai:
            ra.append((at, at + len(a_bytes[i]), i))
            at += len(a_bytes[i])
        at = 0
        for i in bi:
            rb.append((at, at + len(b_bytes[i]), i))
            at += len(b_bytes[i])
        links = [(x[2], y[2]) for x in ra for y in rb if x[0] < y[1] and y[0] < x[1]]
        cuts = sorted({x[1] for x in ra} & {y[1] for y in rb})
        groups, lo = [], 0
        for c in cuts:
            groups.append(([x[2] for x in ra if lo < x[1] <= c], [y[2] for y in rb if lo < y[1] <= c]))
            lo = c
        per.append((ai, bi, groups, links))
        for p in set(links):
            pair_docs[p] = pair_docs.get(p, 0) + 1
    best = {}
    for (x, _), c in pair_docs.items():
        best[x] = max(best.get(x, 0), c)
    out = []
    for item in per:
        if item is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        ai, bi, groups, links = item
        line = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((len(ai), len(bi), len(groups), len(links), sum(pair_docs[p] == best[p[0]] for p in links),
                    sum(pair_docs[p] for p in links), hashlib.sha256(line.encode()).hexdigest()))
    return out


def test_fragments_compose_in_any_tree(paths):
    rnd = random.Random(3)
    text = " ".join(rnd.choice(["alpha", "béta", "中文", "<|endoftext|>", "x", "  ", "zz9", "😀", "\n"]) for _ in range(400))
    tok = ta.encode(text.encode(), *paths)
    one = ta.whole(ta.fragment(tok))
    plain = lambda x: (x["groups"], x["links"], x["pairs"].tolist(), x["counts"].tolist(), x["text"])
    for size in (1, 2, 3, 7, 50, 5000):
        pieces = [ta.fragment(ta._part(tok, lo, lo + size), k) for k, lo in enumerate(range(0, tok["size"], size))]
        left = pieces[0]
        for f in pieces[1:]:
            left = ta.compose(left, f)
        level = pieces
        while len(level) > 1:
            level = [ta.compose(level[i], level[i + 1]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        assert plain(ta.whole(left)) == plain(one) == plain(ta.whole(level[0]))


def test_spark_equals_brute_force(spark, paths, monkeypatch):
    rnd = random.Random(5)
    words = ["the", "Über", "日本語", "<|endoftext|>", "<s>", "a", "  ", "\t", "x1", "🙂", "don't", "\n\n"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(60))) for _ in range(40)]
    texts += [None, "", "the the the", "the the the", "q" * 20_000, " odd spaces", "tab\tend "]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = brute(texts, paths)
    cols = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    for chunk in (1 << 20, 16):
        monkeypatch.setattr(ta, "CHUNK_BYTES", chunk)
        got = {r.doc_id: tuple(r[c] for c in cols) for r in ta.align(docs, *paths).collect()}
        assert [got[i] for i in range(len(texts))] == want


def test_neighbours_are_summarised_in_one_pass(paths, monkeypatch):
    """Documents of one chunk share a pass of array arithmetic; each gets the summary of its own fragment."""
    rnd = random.Random(9)
    words = ["the", "Über", "日本語", "<s>", "a", "  ", "x1", "🙂", "don't", "\n\n", "q" * 90]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 60))).encode() for _ in range(50)]
    texts += [None, b"", "▁".encode(), texts[0], texts[0], b"\x00", b" "]
    want = []
    for t in texts:
        tok = ta.encode(t, *paths)
        want.append(tok and ta.whole(ta.fragment(tok)))
    passes, plain = [], ta.summaries
    monkeypatch.setattr(ta, "summaries", lambda t, bounds: passes.append(len(bounds)) or plain(t, bounds))
    for size, most in ((1 << 20, 1), (2000, 12), (1, 60)):
        monkeypatch.setattr(ta, "BATCH_BYTES", size)
        passes.clear()
        got = ta.results(texts, *paths)
        assert sum(passes) == sum(w is not None for w in want) and len(passes) <= most
        for g, w in zip(got, want):
            assert g["ok"] == (w is not None)
            if w is not None:
                x = g["whole"]
                assert (x["groups"], x["links"], x["pairs"].tolist(), x["counts"].tolist()) == (w["groups"], w["links"], w["pairs"].tolist(), w["counts"].tolist())
                assert x["text"] == hashlib.sha256(w["text"].encode()).hexdigest()


def test_query_on_tables(spark, paths):
    from synthcurate.llm.queries import op12_token_alignment
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in op12_token_alignment(spark, sf).collect()}
    texts = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    want = brute([t.text for t in texts], paths)
    assert len(rows) == len(texts)
    for t, w in zip(texts, want):
        r = rows[t.doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == w


def test_odd_and_empty(spark, paths, odd_docs, no_docs):
    rows = ta.align(odd_docs, *paths).collect()
    assert len(rows) == odd_docs.count()
    assert ta.align(no_docs, *paths).count() == 0
