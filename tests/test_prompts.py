import pytest
from pyspark.sql import functions as F

from synthcurate.operators import prompts as p
from synthcurate.sources import readers


def render(rows, name, body, examples=None, ticker=None):
    templates = p.catalog(rows([(name, body)], "template string, body string"))
    return p.with_prompt(rows([(name, examples, ticker)], "template string, examples string, stock_ticker string"), templates).first().prompt


def test_slots_are_filled_at_once(rows):
    out = render(rows, "few-shot_x", "{examples}|{stock_ticker}{examples}{{kept}}|{format_instructions}", "{stock_ticker}", "$A {examples}")
    assert out == "{stock_ticker}|$A {examples}{stock_ticker}{kept}|" + p.format_instructions()


def test_missing_values_are_empty(rows):
    assert render(rows, "zero-shot_x", "a{stock_ticker}b{examples}") == "ab"


def test_escaped_slot_is_text(rows):
    assert render(rows, "zero-shot_x", "{{examples}} {examples}", "E") == "{examples} E"


def test_unknown_slot_and_mode_are_errors(rows):
    with pytest.raises(Exception, match="no value for slots: foo"):
        render(rows, "zero-shot_x", "{foo}")
    with pytest.raises(Exception, match="unknown prompt mode: other"):
        p.catalog(rows([("other", "x")], "template string, body string")).collect()


def test_packaged_templates(spark):
    out = {r.template: r for r in p.catalog(readers.default_templates(spark)).collect()}
    assert len(out) == 8
    assert out["zero-shot_bg_train-time-info_v1"].pool == "train"
    assert out["few-shot_bg_test-time-info_v1"].pool == "validation"
    assert out["few-shot_v1"].pool is None and out["few-shot_v1"].mode == "few-shot"
    for name, r in out.items():
        assert ("{examples}" in r.body) == (r.mode == "few-shot")
        assert ("{stock_ticker}" in r.body) == (r.pool is not None)
        assert "".join(r.parts) == r.body and r.uses_bg == ("_bg_" in name)


def test_distinct_prompts(rows):
    templates = p.catalog(rows([("zero-shot_a", "T {stock_ticker}")], "template string, body string"))
    inputs = rows([(1, "zero-shot_a", None, "$A"), (2, "zero-shot_a", None, "$A"), (3, "zero-shot_a", None, "")],
                  "prompt_id long, template string, examples string, stock_ticker string")
    shared = p.distinct_prompts(inputs, templates)
    assert sorted((r.prompt, r.n_uses) for r in shared.collect()) == [("T ", 1), ("T $A", 2)]
    by_key = inputs.withColumn("prompt_key", p.prompt_key()).join(shared, "prompt_key")
    assert {r.prompt_id: r.prompt for r in by_key.select("prompt_id", "prompt").collect()} == {1: "T $A", 2: "T $A", 3: "T "}


def test_run_grid(rows):
    asked = rows([(1, "zero-shot_a"), (2, "few-shot_b")], "prompt_id long, template string")
    assert p.run_grid(asked, ["m", "n"]).count() == 4
    assert [tuple(r) for r in p.run_grid(asked, ["m"], "few-shot").collect()] == [(2, "few-shot_b", "m")]
    with pytest.raises(ValueError):
        p.run_grid(asked, ["m"], "one-shot")


def test_info_columns(rows):
    out = p.with_template_info(rows([("few-shot_bg_test-time-info_v1",)], "template string")).first()
    assert (out["mode"], out.pool) == ("few-shot", "validation")
