import random

import pytest

from synthcurate.llm import line_dedup as d


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs):
    """By document, in order: (lines, places equal, places near). Whether a line
    is near is decided where its text first stands."""
    seen, near_text, out = [], {}, {}
    for doc, text in docs:
        equal, near = [], []
        lines = text.split("\n") if text is not None else []
        for i, line in enumerate(x.strip(" \t\r") for x in lines):
            if len(line) < d.MIN_EXACT:
                continue
            if line in near_text:
                equal.append(i)
            else:
                near_text[line] = len(line) >= d.MIN_CHARS and any(len(x) >= d.MIN_CHARS and one_edit(x, line) for x in seen)
                seen.append(line)
                if near_text[line]:
                    near.append(i)
        out[doc] = (len(lines), equal, near)
    return out


def edited(rnd, s):
    i = rnd.randrange(len(s) + 1)
    return rnd.choice([s[:i] + rnd.choice("abz") + s[i + 1 :], s[:i] + rnd.choice("abz") + s[i:], s[:i] + s[i + 1 :], s])


@pytest.mark.parametrize("seed", [1, 2])
def test_decisions_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abé中 ") for _ in range(n)).strip().ljust(n, "x") for n in (9, 10, 31, 32, 33, 60, 64, 65, 127, 128, 129, 200, 700, 9000)]
    docs = []
    for doc in range(60):
        lines = []
        for _ in range(rnd.randrange(8)):
            line = rnd.choice(base)
            for _ in range(rnd.randrange(3)):
                line = edited(rnd, line)
            lines.append(rnd.choice(["", "  ", "\t"]) + line + rnd.choice(["", " ", "\r"]))
        docs.append((doc, "\n".join(lines)))
    df = spark.createDataFrame([*docs, (60, None), (61, "")], "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_lines, list(r.equal), list(r.near)) for r in d.decisions(df).collect()}
    expected = brute([*docs, (60, None), (61, "")])
    assert got == expected
    assert sum(len(v[2]) for v in expected.values()) > 20


def test_texts_follow_the_decisions(spark):
    long = "the harbour lights went out one by one at dawn"
    docs = [(3, f"{long}\nshort\nunique line of three"), (1, f"{long}!\n\nshort"), (2, f"  {long}!  \n"), (4, "short"), (5, None), (6, long.replace("dawn", "noon"))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.text for r in d.dedup_lines(df).collect()}
    assert got == {1: f"{long}!\n\nshort", 3: "short\nunique line of three", 4: "short", 5: None, 6: long.replace("dawn", "noon")}
    assert {r.doc_id: r.text for r in d.dedup_lines(df, keep_empty=True).collect()}[2] == ""


def test_group_around_one_line_keeps_all_links(spark):
    """Many longer lines around one short line, and many replacements."""
    base = "0123456789" * 5
    texts = [base[:i] + "x" + base[i:] for i in range(50)] + [base] + [base[:i] + "y" + base[i + 1 :] for i in range(50)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, list(r.equal), list(r.near)) for r in d.decisions(df).collect()}
    assert got == brute(list(enumerate(texts)))


def test_odd_rows(spark, odd_docs, no_docs):
    kept = d.dedup_lines(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    by_id = {i: t for i, t in rows}
    assert (1, None) in rows and (2, "") in rows and (3, " \n\t ") in rows and (10, "a") in rows and len(by_id[6]) == 150_000
    assert 8 not in by_id and 0 in by_id  # a copy loses its only line
    assert sum(i == 4 for i, _ in rows) == 2  # repeated rows go or stay together
    assert sorted(t.count("\n") for i, t in rows if i == 7) == [0, 0]
    assert d.decisions(no_docs).count() == 0 and d.dedup_lines(no_docs).count() == 0


def test_no_python_in_the_plan(spark, odd_docs):
    plan = d.dedup_lines(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
