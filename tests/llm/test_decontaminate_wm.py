import random

import pytest
from pyspark.sql import functions as F

from synthcurate.llm import decontaminate_wm as w


def brute(text, items, window=10):
    words = w.words_of(text.encode())
    hit, found = set(), set()
    for item_id, item in items:
        own = w.words_of((item or "").encode())
        n = min(window, len(own))
        for s in range(len(own) - n + 1 if n else 0):
            for at in range(len(words) - n + 1):
                if words[at : at + n] == own[s : s + n]:
                    hit.update(range(at, at + n))
                    found.add(item_id)
    return len(words), len(hit), sorted(found, key=str)


@pytest.mark.parametrize("seed", range(6))
def test_search_equals_brute_force(seed):
    rnd = random.Random(seed)
    make = lambda n: " ".join(rnd.choice(["a", "b", "C", "é", "9"]) + rnd.choice(["", ",", "!"]) for _ in range(n))
    items = [(str(i), make(rnd.choice([0, 1, 2, 3, 9, 10, 11, 25]))) for i in range(12)]
    machines = w.machines(items)
    for _ in range(40):
        text = make(rnd.randrange(60))
        if rnd.random() < 0.5 and items[rnd.randrange(12)][1]:
            text += " - " + rnd.choice(items)[1].upper() + " " + make(4)
        found = w.find(text.encode(), machines)
        assert (found["n_words"], sum(s["end"] - s["start"] for s in found["spans"]), found["items"]) == brute(text, items)


def test_words():
    assert w.words_of("Don't stop-NOW 42é\n".encode()) == [b"don", b"t", b"stop", b"now", "42é".encode()]


def test_blocks_give_the_same_as_one(spark, odd_docs, monkeypatch):
    rows = [(1, " ".join(odd_docs.first().text.split()[3:20])), (2, None), (3, ""), (4, "a"), (None, "a"), (5, "один два")]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    read = lambda: [(r.f.n_words, r.f.n_hit, r.f["items"]) for r in odd_docs.select(w.contamination(odd_docs, bench).alias("f")).collect()]
    whole = read()
    monkeypatch.setattr(w.blocks, "__defaults__", (1, 1))
    assert read() == whole
    named = [(str(i) if i is not None else None, t) for i, t in rows]
    for row, found in zip(odd_docs.collect(), whole):
        n_words, n_hit, items = brute(row.text or "", named) if len(row.text or "") < 9999 else (1, 0, [])
        assert found == (n_words, n_hit, [i for i in items if i is not None])
    assert whole[0][1] >= 17


def test_empty_tables(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert odd_docs.select(w.contamination(odd_docs, bench).alias("f")).filter(F.col("f")["n_hit"] > 0).count() == 0
    assert no_docs.select(w.contamination(no_docs, bench).alias("f")).count() == 0
