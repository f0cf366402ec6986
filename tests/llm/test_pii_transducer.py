import random
import re

import pytest
from pyspark.sql import functions as F

from synthcurate.llm import pii_transducer as p

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = (
                kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))
                or kind == "card" and 12 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15
            )
            if good:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], p.KINDS.index(s[2])))


@pytest.mark.parametrize("seed", range(5))
def test_plain_spans_equal_the_patterns(seed):
    rnd = random.Random(seed)
    bits = ["a", "é", "@", ".", "-", " ", "+", "1", "4", "0", "255", "@b.c", "1.2.3.4", "4111 1111 1111 1111", "+1 (988) 555-2485", "(", ")", "中", "\n", "%"]
    for _ in range(1500):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randrange(25)))
        assert p.find(text)[0] == plain(text), text


def spans(text):
    base, every = p.find(text)
    return [(kind, text[a:b]) for a, b, kind in every if (a, b, kind) not in base]


@pytest.mark.parametrize("kind, shown", [
    ("email", "john.doe (at) example (dot) com"), ("email", "joe[at]mail[dot]example.org"), ("email", "jane at example dot co dot uk"),
    ("email", "name AT host DOT net"), ("email", "user_at_mail_dot_com"), ("email", "user@example dot com"), ("email", "{0}"),
    ("email", "jоhn@exаmple.com"), ("email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"), ("email", "john@exam​ple.com"),
    ("phone", "plus one nine eight eight five five five two four eight five"), ("phone", "+one (nine eight eight) five five five-two four eight five"),
    ("phone", "+１ (９８８) ５５５-２４８５"), ("card", "４１１１ １１１１ １１１１ １１１１"), ("card", "four" + " one" * 15), ("card", "vier" + " eins" * 15),
    ("card", "quatre un un un-" + "un " * 11 + "un"), ("ip", "one nine two dot one six eight dot zero dot one"), ("ip", "٤٢.144.35.254"),
])
def test_disguises(kind, shown):
    if shown == "{0}":
        shown = "a.b{at}c.de"
    for text in (shown, f"Né le {shown}, said so.", "ü" * 500 + f" {shown}\n" + "no " * 300):
        assert spans(text) == [(kind, shown)]


@pytest.mark.parametrize("text", [
    "look at google.com, one two three", "the point at dot of it one day", "eins zwei drei vier fünf", "Anna at home dot", "see fig. 1.2.3 at (dot)",
    "один@два", "un deux trois, six", "the lyan at that thhe (at) noon", "é" * 3000, "",
])
def test_clean_text_stays(text):
    assert p.find(text) == ([], [])


def test_plain_spans_are_not_repeated():
    text = "mail a@b.cd or two@three.fo at 1.2.3.4 ０"
    base, every = p.find(text)
    assert base == every == plain(text)


@pytest.mark.parametrize("text", ["a" * 200_000, "1" * 200_000, "a@" * 50_000, "+1 " * 50_000, "1." * 100_000, "one " * 40_000, "а" * 100_000, "a (at) " * 20_000, "a_dot_" * 30_000])
def test_long_texts_take_time_in_proportion(text):
    import time

    start = time.process_time()
    p.find(text)
    assert time.process_time() - start < 15


def test_odd_rows(spark, odd_docs, no_docs):
    column = p.personal_data(F.col("text")).alias("p")
    assert odd_docs.select(column).filter(F.size("p.spans") > 0).count() == 0
    assert no_docs.select(column).count() == 0
    row = spark.createDataFrame([("é a@b.cd x (at) y.zz",)], "text string").select(column).first().p
    assert row.base == ["email:2:8"] and row.spans == ["email:2:8", "email:9:20"] and row.counts == [1, 0, 0, 0]


@pytest.mark.parametrize("kind, shown", [
    ("email", "jane\ufe6bexample\u2024com"), ("email", "jane\ufe6bexample\ufe52com"), ("card", "4 one 1 one 1 one 1 one 1 one 1 one 1 one 1 one"),
    ("phone", "+1 nine 8 eight 5 five 5 two 4 eight 5"), ("ip", "\u2074\u2082.144.35.254"), ("email", "jane.doe at example.com"),
])
def test_disguises_of_all_transducers(kind, shown):
    for text in (shown, f"write to {shown}, said so.", "no " * 200 + f"«{shown}»\n"):
        assert spans(text) == [(kind, shown)]


@pytest.mark.parametrize("seed", range(4))
def test_lines_that_are_skipped_hide_nothing(seed, monkeypatch):
    rnd = random.Random(seed)
    bits = ["one", "two", "4", "1", " ", " ", " ", "-", "\n", "jane.doe", " at ", " dot ", "(at)", "x.com", "\ufe6b", "\u2024", "\u2074", "а", "plus ", "+", "·", "é", "_dot_"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(60))) for _ in range(1500)]
    some = [p.find(t) for t in texts]
    monkeypatch.setattr(p, "stretches", lambda text: [(0, len(text))])
    assert some == [p.find(t) for t in texts]
