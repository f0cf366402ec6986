import random
import zlib
from array import array

import pytest
from pyspark.sql import functions as F

from synthcurate.llm import pack_bestfit as p


def plain_best_fit(lengths, capacity, places):
    """Open bins in a list, scanned for the fullest that fits; the last opened of equals."""
    bins, out, opened = [], [], 0
    for n in lengths:
        fit = [b for b in bins if capacity - b[1] >= n]
        if fit:
            b = max(fit, key=lambda b: (b[1], b[2]))
        else:
            if len(bins) >= places:
                bins.remove(max(bins, key=lambda b: (b[1], b[2])))
            b = [opened, 0, 0]
            bins.append(b)
            opened += 1
        out.append((b[0], b[1]))
        b[1] += n
        b[2] = len(out)
        if b[1] == capacity:
            bins.remove(b)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_bins_equal_a_plain_scan(seed):
    rnd = random.Random(seed)
    lengths = [rnd.randrange(1, 51) for _ in range(400)]
    bins = p.OpenBins(50, 7)
    assert [bins.place(n) for n in lengths] == plain_best_fit(lengths, 50, 7)
    assert bins.count <= 7


def check(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for group in by.values():
        at = 0
        for offset, length in sorted(group):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pack_is_gapless_and_tight(spark):
    rnd = random.Random(1)
    lengths = [rnd.choice([rnd.randrange(1, 4097), 7, 300, 900, 4096]) for _ in range(3000)]
    items = spark.createDataFrame(list(enumerate(lengths)), "key long, length long").repartition(5)
    placed = p.pack(items, task_pieces=500).join(items, "key").collect()
    assert sorted(r.key for r in placed) == list(range(3000))
    assert check(placed, 4096) <= -(-sum(lengths) // 4096) * 1.02


def test_ids_are_those_of_the_tokenizer(vocabulary_path):
    tokens = p.WordTokens(vocabulary_path("word_bpe_49k.json"))
    rnd = random.Random(2)
    texts = ["", "it's John's WE'LL don't'sabc", "J̌ ǰ İx ẖ H̱ é É", "…,a… ,.;a!!b <|endoftext|> x≮y", "中文 한국어 12.5 ½x", "z" * 3000]
    texts += ["".join(rnd.choice("aB'sS.,!́é中1½ \t<|>") for _ in range(40)) for _ in range(800)]
    for text, ids in zip(texts, tokens.ids([t.encode() for t in texts])):
        assert ids == array("I", tokens.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def test_a_full_table_of_words_starts_anew(vocabulary_path, monkeypatch):
    monkeypatch.setattr(p, "CACHE_WORDS", 3)
    tokens = p.WordTokens(vocabulary_path("word_bpe_49k.json"))
    first = list(tokens.ids([b"one two", b"three"]))
    assert list(tokens.ids([b"four five six seven"])) and list(tokens.ids([b"one two", b"three"])) == first


def test_documents(spark, odd_docs, no_docs, vocabulary_path):
    path = vocabulary_path("word_bpe_49k.json")
    rows = p.pack_documents(odd_docs, path, capacity=512).collect()
    check(rows, 512)
    tokens = p.WordTokens(path)
    expected = []
    for r in odd_docs.collect():
        ids = next(tokens.ids([(r.text or "").encode()])) + array("I", [1]).tobytes()
        expected += [(r.doc_id, i // 2048, i // 4, len(ids[i : i + 2048]) // 4, zlib.crc32(ids[i : i + 2048])) for i in range(0, len(ids), 2048)]
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(expected, key=key)
    assert p.pack_documents(no_docs, path).count() == 0


def test_pieces_of_exact_length():
    cut = p.pieces_of(array("I", range(2, 9)).tobytes(), 1, 4)
    assert [(c["start"], c["length"]) for c in cut] == [(0, 4), (4, 4)]
