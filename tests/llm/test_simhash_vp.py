import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from synthcurate.llm import simhash_vp as s


def brute_fingerprint(text, n=4):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " ", "One", "one two three", "a b c d", "a b a b a b a b", "é ß Ü x y z \x0b q", "w " * 40_000])
def test_fingerprint(text):
    assert s.fingerprint(text.encode()).hex() == f"{brute_fingerprint(text):016x}"


def test_spark_hash_is_the_same(spark):
    value = spark.sql("select xxhash64('a b c d') as h").first().h
    assert value % 2**64 == xxhash.xxh64_intdigest(b"a b c d", 42)


def closure(values, linked):
    label = list(range(len(values)))
    while True:
        new = [min(label[j] for j in range(len(values)) if linked(i, j)) for i in range(len(values))]
        if new == label:
            return label
        label = new


def crowd(rnd, n):
    """Random fingerprints, chains, a dense cluster and copies."""
    out = [rnd.getrandbits(64) for _ in range(n)]
    for _ in range(n):
        x = rnd.choice(out)
        for b in rnd.sample(range(64), rnd.randrange(7)):
            x ^= 1 << b
        out.append(x)
    out += [out[0] ^ (1 << b) for b in range(64)] + [out[0] ^ (1 << b) ^ 1 for b in range(1, 64)]
    return out


@pytest.mark.parametrize("seed, leaf", [(1, 2), (2, 8), (3, 64)])
def test_link_equals_brute_force(seed, leaf, monkeypatch):
    monkeypatch.setattr(s, "LEAF", leaf)
    values = crowd(random.Random(seed), 60)
    home = np.array([random.Random(i).random() < 0.7 for i in range(len(values))])
    got = s.link(np.array(values, np.uint64)[:, None], home, 4).root
    near = lambda i, j: i == j or ((home[i] or home[j]) and (values[i] ^ values[j]).bit_count() <= 4)
    assert got.tolist() == closure(values, near)


@pytest.mark.parametrize("shard_rows", [20_000, 0.0001])
def test_classes_equal_brute_force(spark, shard_rows):
    """Also where trees over whole fingerprints cut the shards."""
    values = crowd(random.Random(9), 100)
    values += values[:20]
    ids = [1000 - i for i in range(len(values))]
    rows = spark.createDataFrame([(i, v.to_bytes(8, "big")) for i, v in zip(ids, values)], "doc_id long, fp binary").repartition(3)
    label = closure(values, lambda i, j: (values[i] ^ values[j]).bit_count() <= 4)
    least = {}
    for i, c in zip(ids, label):
        least[c] = min(least.get(c, i), i)
    expected = {(v, least[c]) for v, c in zip(values, label)}
    got = {(int.from_bytes(r.fp, "big"), r.component) for r in s.classes(rows, shard_rows=shard_rows).collect()}
    assert got == expected


def test_components_of_chains_and_stars(spark):
    edges = [(i + 1, i) for i in range(60)] + [(100 + i, 100) for i in range(1, 40)] + [(201, 200), (200, 201), (300, 300)]
    got = {r.node: r.root for r in s.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 40)} | {201: 200}
    assert s.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark, odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    got = {(r.doc_id, r.fp.hex()): r.component for r in s.near_duplicates(odd_docs).collect()}
    assert len({v for k, v in got.items() if k[1] == "0" * 16}) == 1 and got[(1, "0" * 16)] == 1
    same = f"{brute_fingerprint(rows[0].text):016x}"
    assert got[(0, same)] == got[(8, same)] == 0
    kept = s.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = [(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()]
    assert len(texts) == len(set(texts))
    assert (0, rows[0].text) in texts and (8, rows[0].text) not in texts and (None, rows[6].text) in texts
    assert sum(not (t or "").strip() for _, t in texts) == 1 and sum(i == 7 for i, _ in texts) == 2
    assert s.near_duplicates(no_docs).count() == 0 and s.keep_one(no_docs).count() == 0


def test_similar_plan_tells_near_from_far(spark):
    """Pairs well above a similarity of 0.8 go, pairs well below stay."""
    rnd = random.Random(11)
    docs, expected = [], set()
    for g in range(40):
        words = [f"w{rnd.randrange(5000)}" for _ in range(400)]
        near, far = list(words), list(words)
        for at in rnd.sample(range(400), 4):
            near[at] = "changed"
        for at in rnd.sample(range(400), 60):
            far[at] = "other"
        docs += [(3 * g, " ".join(words)), (3 * g + 1, " ".join(near)), (3 * g + 2, " ".join(far))]
        expected |= {3 * g, 3 * g + 2}
    kept = {r.doc_id for r in s.keep_one(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert kept == expected


def test_segments_cover_all_bits():
    for plan in (s.EXACT, s.SIMILAR):
        parts = s.segments(plan)
        for turn in range(plan.rounds):
            places = np.concatenate(parts[turn * plan.segments : (turn + 1) * plan.segments])
            assert sorted(places) == list(range(64 * plan.words))
    assert s.EXACT.segments > s.EXACT.bits  # so that no link can be missed


def jaccard(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.split(), b.split()))
    return len(a & b) / len(a | b)


def at_similarity(rnd, g, shared, own):
    """Two texts with ``shared`` common shingles and ``own`` in each alone."""
    words = [f"g{g}w{rnd.randrange(10**6)}" for _ in range(shared + 4)]
    return [" ".join(words + [f"g{g}{side}{i}" for i in range(own)]) for side in "xy"]


def test_links_are_those_of_exact_similarity(spark):
    """Pairs at 0.8 and just above go, pairs just below stay."""
    rnd, docs, expected = random.Random(5), [], set()
    for g in range(300):
        shared, own, near = ((400, 50, True), (410, 49, True), (397, 50, False), (300, 50, False), (8, 1, True))[g % 5]
        a, b = at_similarity(rnd, g, shared, own)
        assert (jaccard(a, b) >= 0.8) == near
        docs += [(2 * g, a), (2 * g + 1, b)]
        expected |= {2 * g} if near else {2 * g, 2 * g + 1}
    kept = {r.doc_id for r in s.keep_one(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert kept == expected


def test_large_group_with_stragglers_equals_brute_force(spark):
    """Copies of copies: links across components are found, also where the leader is not similar."""
    rnd, texts = random.Random(3), []
    base = [f"w{rnd.randrange(5000)}" for _ in range(300)]
    for _ in range(70):
        words = list(rnd.choice(texts).split()) if texts and rnd.random() < 0.5 else list(base)
        for at in rnd.sample(range(300), rnd.randrange(1, 9)):
            words[at] = f"n{rnd.randrange(10**6)}"
        texts.append(" ".join(words))
    label = closure(texts, lambda i, j: jaccard(texts[i], texts[j]) >= 0.8)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component for r in s.similar(rows).collect()} == dict(enumerate(label))


def test_bands_meet_at_the_stated_rate():
    rnd, met = np.random.default_rng(1), 0
    for _ in range(2000):
        values = rnd.integers(0, 2**64, 90, np.uint64)
        met += bool((s.bands(values[:81]) == s.bands(np.concatenate((values[:72], values[81:])))).any())
    assert met >= 0.997 * 2000
