import json
import random
import re

import pytest
from pyspark.sql import functions as F

from synthcurate.operators import gate as g


def reject_constant(name):
    raise ValueError(name)


def verdict(text, strict):
    """The gate in plain Python over strict JSON."""
    try:
        value = json.loads(text, parse_constant=reject_constant)
    except ValueError:
        return None
    if isinstance(value, dict) and not strict:
        value = [value]
    if not isinstance(value, list):
        return None
    for item in value:
        if not isinstance(item, dict) or set(item) != {"headline", "sentiment"} or not isinstance(item["headline"], str):
            return None
        if not re.search("[a-zA-Z]", item["headline"]):
            return None
        if strict and str(item["sentiment"]) not in ("0", "1", "2"):
            return None
    return [i["headline"] for i in value]


H = '"headline": "Up"'
EDGE = [
    f'[{{{H}, "sentiment": {v}}}]' for v in ('"1"', "1", "2", "3", "1.0", "1e0", "true", "null", "{}", "[1]", '"01"', '" 1"', "-0", "10")
] + [
    f'[{{"headline": {v}, "sentiment": "1"}}]' for v in ("true", "null", "{}", "1", '""', '"é"', '"1a"', '"\\u0041"', '["a"]')
] + [
    '[{"sentiment": "0", "headline": "x"}]', f'[{{{H}, "sentiment": "7", "sentiment": "1"}}]',
    f'[{{{H}, "sentiment": "1", "sentiment": "7"}}]', f'[{{{H}}}]', '[{"sentiment": "1"}]', "[{}]", "{}", "[]", "[[]]", "[null]",
    "null", "1", '"x"', "", " ", "[1] x", "1,2", "[1]]", "[] []", '[],"a"', "[", "]", "{", "[,]", "[1,]", "nan", "[NaN]", "'a'",
    f'{{{H}, "sentiment": "1"}}', f'{{{H}, "sentiment": "1"}} tail', f'{{{H}, "sentiment": "1", "x": 1}}', f'[{{{H}, "sentiment": "1"}}, 7]',
    f'[{{{H}, "sentiment": "1"}}, null]', f'[{{{H}, "sentiment": "1"}}, {{{H}, "sentiment": 0}}]', '// c\n[]', "[] // c", "[]\n", "\t[ ]",
    '{"headline: STRING, sentiment": "x"}', f'[[{{{H}, "sentiment": "1"}}]]', '[{"Headline": "Up", "sentiment": "1"}]', "﻿[]",
]


def run(rows, texts, strict):
    df = rows([(i, t) for i, t in enumerate(texts)], "i int, raw string")
    out = g.gate(df, strict, clean=False).orderBy("i").select(F.col("items.headline").alias("h"), "n_items").collect()
    for r in out:
        assert r.n_items == (None if r.h is None else len(r.h))
    return [r.h for r in out]


@pytest.mark.parametrize("strict", [True, False])
def test_edge_rows(rows, strict):
    got = run(rows, EDGE, strict)
    expected = [verdict(t, strict) for t in EDGE]
    assert {t: h for t, h in zip(EDGE, got)} == {t: h for t, h in zip(EDGE, expected)}


@pytest.mark.parametrize("strict", [True, False])
def test_random_texts(rows, strict):
    rng = random.Random(5)

    def value(depth=0):
        kinds = ["str", "int", "bad"] + (["item"] * 6 + ["list"] * 2 if depth < 3 else [])
        kind = rng.choice(kinds)
        if kind == "str":
            return rng.choice(["1", "0", "Up", "", "x]", '"', "```", "é"])
        if kind == "int":
            return rng.choice([0, 1, 2, 3, 1.5, True, None])
        if kind == "item":
            item = {"headline": rng.choice(["Up", "Down 2", "12"]), "sentiment": rng.choice(["0", "1", 2, 5, None])}
            if rng.random() < 0.15:
                item["why"] = value(depth + 1)
            if rng.random() < 0.1:
                item.pop("sentiment")
            return item
        return [value(depth + 1) for _ in range(rng.randint(0, 3))]

    texts = []
    for _ in range(600):
        text = json.dumps([value(1) for _ in range(rng.randint(0, 3))] if rng.random() < 0.6 else value())
        spot = rng.randint(0, len(text))
        change = rng.random()
        if change < 0.15:
            text = text[:spot]
        elif change < 0.3:
            text = text[:spot] + rng.choice('[]{},":x ') + text[spot:]
        texts.append(text)
    assert run(rows, texts, strict) == [verdict(t, strict) for t in texts]


def test_extra_checks_and_flatten(rows):
    df = rows([(1, '[{"headline": "a", "sentiment": "1"}, {"headline": "b", "sentiment": 0}]'), (2, "[]"), (3, "no"),
               (4, '[{"headline": "c", "sentiment": 2}]')], "prompt_id long, raw string")
    out = g.flatten(g.gate(df, checks={"two": F.size("items") == 2}))
    assert [tuple(r) for r in out.orderBy("pos").collect()] == [(1, 0, "a", "1"), (1, 1, "b", "0")]


def test_reasons(rows):
    cases = {
        "x": "not_json", "7": "wrong_shape", "[7]": "item_not_object", "[{}]": "wrong_keys", "[]": "accepted",
        '[{"headline": "1", "sentiment": "1"}]': "bad_headline", '[{"headline": "a", "sentiment": "9"}]': "bad_sentiment",
        '{"headline": "a", "sentiment": "1"}': "wrong_shape",
    }
    df = rows([(t,) for t in cases], "raw string")
    assert {r.raw: r.reason for r in g.reasons(df).collect()} == cases
    assert {r.reason for r in g.reasons(df.limit(1), strict=False).collect()} == {"not_json"}


def test_filters_stay_above_the_parse(rows):
    df = rows([("[]",)], "raw string")
    plan = g.gate(df).filter("items is not null and n_items < 5")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
    plan = g.flatten(g.gate(df)).filter("headline > 'a'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
