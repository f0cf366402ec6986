import json

import pytest
from pyspark.sql import functions as F

from synthcurate.functions import text as tx

# Every character str.strip() removes.
PY_BLANKS = [chr(i) for i in range(0x3001) if chr(i).isspace()]


def apply(rows, values, fn):
    df = rows([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_whitespace_table_is_pythons():
    assert sorted(tx.WHITESPACE) == sorted(PY_BLANKS)


def py_clean(raw):
    if "```" in raw:
        parts = raw.split("```")
        out = parts[1].strip() if len(parts) >= 3 else raw
    else:
        out = raw.strip()
    return out[4:].strip() if out.lower().startswith("json") else out


CLEAN = [
    "", "  ", "x", " x ", "json", "JSON [1]", "jsonl", "```", "a```b", "json ```[1]", "```json\n[1]\n```", "```\n[1]\n```",
    "``` a ``` b ``` c ``` d", "``````", "x ```JSON [1]``` y", "  json　[1] ", "\x1c[1]\x1f",
    "jSoN  \n {\"a\": 1}", " ```json [1]", "````json [1]````",
]


def test_clean_matches_python(rows):
    out = apply(rows, CLEAN, lambda c: tx.without_json_tag(tx.fenced_part(c)))
    assert out == [py_clean(t) for t in CLEAN]


def test_urls_and_tickers(rows):
    texts = [
        "see https://a.b/$XYZ now $AB", "http://x $CD", "$Ab", "$$$ de", "no", "$ A $B $C", "https://$A", "x$TSLA,y",
        "https:// $E", "é$Éa $FG",
    ]
    import re

    def ticker(t):
        m = re.search(r"\$([A-Z]+)", re.sub(r"https?://\S+", "", t))
        return m and m.group(1)

    assert apply(rows, texts, tx.strip_urls) == [re.sub(r"https?://\S+", "", t) for t in texts]
    assert apply(rows, texts, tx.first_ticker) == [ticker(t) for t in texts]


def test_ticker_text(spark):
    df = spark.sql("select array('A','B') a union all select null union all select array()")
    assert sorted(r[0] for r in df.select(tx.ticker_text(F.col("a"))).collect()) == ["", "", "$A, $B"]


def test_fewshot_json_is_indented_python_json(spark):
    shots = [("a \"q\" \\ \n\t é € 😀 </x> \x01  }", 0), ("}\"}", 2)]
    df = spark.createDataFrame([(shots,)], "s array<struct<text:string,label:int>>")
    batch, single = df.select(tx.fewshot_json(F.col("s")), tx.fewshot_json(F.col("s"), "x", "y")).first()
    expected = [{"headline": t, "sentiment": n} for t, n in shots]
    assert json.loads(batch) == expected
    assert batch.replace("\\u0001", "\u0001") == json.dumps(expected, indent=2, ensure_ascii=False).replace("\\u0001", "\u0001")
    assert json.loads(single) == [{"x": t, "y": n} for t, n in shots]


def test_json_text_null(rows):
    assert apply(rows, [None, "", "}"], tx.json_text) == [None, '""', '"}"']


@pytest.mark.parametrize("model,expected", [
    ("llama3.1-8b", "llama3.1-8b"),
    ("llama3.3-70b", "llama3.3-70b"),
    ("meta-llama/Llama-2-8B-Instruct", "llama3.1-8b-instruct"),
    ("llama", "llama"),
    ("qwen2.5:32b", "qwen2.5-32b"),
    ("Qwen/Qwen2.5-7B-Instruct-AWQ", "qwen2.5-7b-instruct"),
    ("Qwen/Qwen2.5-Coder-32B-Instruct", "qwen2.5-coder-32b-instruct"),
    ("org/other-instruct", "org--other-instruct-instruct"),
    ("a/b/c", "a--b--c"),
])
def test_model_name(rows, model, expected):
    assert apply(rows, [model], tx.model_name) == [expected]


def test_dataset_name_round_trip(spark):
    df = spark.sql("select 'm_1' m, 500L n, 'few-shot_v1' t").select(tx.dataset_name(F.col("m"), F.col("n"), F.col("t")).alias("d"))
    assert df.first().d == "m_1_500_prompt=few-shot_v1.json"
    assert tuple(df.select(*tx.dataset_parts(F.col("d"))).first()) == ("m_1", 500, "few-shot_v1")
    assert spark.sql("select 'm' m, 't' t").select(tx.metadata_name(F.col("m"), F.col("t"))).first()[0] == "m_prompt=t_metadata.json"


def test_error_action(rows):
    errors = ["limit per minute exceeded", "day limit exceeded", "exceeded", "limit", "boom", None]
    assert apply(rows, errors, tx.error_action) == ["retry_after", "stop", "retry", "retry", "retry", None]
