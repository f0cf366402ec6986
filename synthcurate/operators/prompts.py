"""Template catalog and prompt rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from synthcurate.functions.completion import STRICT, Gate
from synthcurate.functions.text import fewshot_json, ticker_text
from synthcurate.session import broadcast_if_small

# The slots a template may use.
SLOTS = ("format_instructions", "examples", "stock_ticker")
_NAMES = "|".join(SLOTS)
_SLOT = rf"(?<!\{{)\{{(?:{_NAMES})\}}(?!\}})"
_ANY_SLOT = r"(?<!\{)\{(\w+)\}(?!\})"


def format_instructions(spec: Gate = STRICT) -> str:
    """What a completion must look like, derived from the gate it will meet."""
    return spec.instructions()


def mode_of(template: Column) -> Column:
    """``zero-shot`` is looked for first; a name with neither mode is an error."""
    return (
        F.when(F.contains(template, F.lit("zero-shot")), "zero-shot")
        .when(F.contains(template, F.lit("few-shot")), "few-shot")
        .otherwise(F.raise_error(F.concat(F.lit("unknown prompt mode: "), template)))
    )


def pool_of(template: Column) -> Column:
    """The ticker pool a template draws from, NULL for none."""
    return F.when(F.contains(template, F.lit("train-time-info")), "train").when(
        F.contains(template, F.lit("test-time-info")), "validation"
    )


def catalog(templates: DataFrame) -> DataFrame:
    """Add mode, pool, background flag and the body cut at its slots.

    ``parts`` alternates text, doubled braces undone, and ``{slot}``; a slot
    nobody can fill is an error.
    """
    used = F.array_distinct(F.regexp_extract_all(F.col("body"), F.lit(_ANY_SLOT), 1))
    unknown = F.array_except(used, F.array(*map(F.lit, SLOTS)))
    body = F.when(F.size(unknown) == 0, F.col("body")).otherwise(
        F.raise_error(F.concat(F.lit("no value for slots: "), F.array_join(unknown, ", ")))
    )
    return templates.select(
        "template",
        body.alias("body"),
        mode_of(F.col("template")).alias("mode"),
        pool_of(F.col("template")).alias("pool"),
        F.contains(F.col("template"), F.lit("_bg_")).alias("uses_bg"),
        F.transform(
            F.split(body, f"(?={_SLOT})|(?<=(?<!\\{{)\\{{(?:{_NAMES})\\}}(?!\\}}))"),
            lambda part: F.replace(F.replace(part, F.lit("{{"), F.lit("{")), F.lit("}}"), F.lit("}")),
        ).alias("parts"),
    )


def with_template_info(requests: DataFrame) -> DataFrame:
    """Requests with the mode and pool their template name stands for."""
    return requests.withColumn("mode", mode_of(F.col("template"))).withColumn("pool", pool_of(F.col("template")))


def filled(parts: Column, values: dict[str, Column]) -> Column:
    """Join the parts with every slot replaced. All slots are filled at once,
    so a value that itself contains ``{...}`` stays as it is."""

    def value(part: Column) -> Column:
        out = part
        for slot, col in values.items():
            out = F.when(part == "{" + slot + "}", col).otherwise(out)
        return out

    return F.array_join(F.transform(parts, value), "")


def with_prompt(inputs: DataFrame, templates: DataFrame, spec: Gate = STRICT) -> DataFrame:
    """Add ``prompt`` to rows of (template, examples, stock_ticker). A template
    that is not in the catalog is an error."""
    parts = broadcast_if_small(templates.select("template", "parts"))
    missing = F.raise_error(F.concat(F.lit("no such template: "), F.coalesce("template", F.lit("NULL"))))
    values = {
        "format_instructions": F.lit(format_instructions(spec)),
        "examples": F.coalesce(F.col("examples"), F.lit("")),
        "stock_ticker": F.coalesce(F.col("stock_ticker"), F.lit("")),
    }
    rows = inputs.join(parts, "template", "left")
    known = F.when(F.col("parts").isNotNull(), F.col("parts")).otherwise(missing)
    return rows.withColumn("prompt", filled(known, values)).drop("parts")


def prompt_inputs(
    requests: DataFrame, shots: DataFrame, tickers: DataFrame,
    text_key: str = "headline", label_key: str = "sentiment",
) -> DataFrame:
    """Requests with their rendered slot values. Both draws arrive partitioned
    by ``prompt_id``, so only the requests are shuffled."""
    return (
        requests.join(shots, "prompt_id", "left")
        .join(tickers, "prompt_id", "left")
        .withColumn("examples", F.when(F.col("shots").isNotNull(), fewshot_json(F.col("shots"), text_key, label_key)))
        .withColumn("stock_ticker", ticker_text(F.col("tickers")))
        .drop("shots", "tickers")
    )


def distinct_prompts(inputs: DataFrame, templates: DataFrame) -> DataFrame:
    """Each distinct prompt rendered once, with the number of its uses.

    ``prompt_key`` can be computed from a request's own slot values, so
    requests refer to the shared text without a join.
    """
    slots = ("template", "examples", "stock_ticker")
    uses = inputs.withColumn("prompt_key", prompt_key()).groupBy("prompt_key").agg(
        F.count("*").alias("n_uses"), *[F.any_value(c).alias(c) for c in slots]
    )
    return with_prompt(uses, templates)


def prompt_key() -> Column:
    """Key of the prompt that a row of slot values renders to."""
    return F.md5(F.concat_ws("\x1f", "template", F.coalesce("examples", F.lit("")),
                             F.coalesce("stock_ticker", F.lit(""))))


def run_grid(requests: DataFrame, models: list[str], modes: str = "all") -> DataFrame:
    """Every request once per model, for the templates of one mode or all.

    The model list is a parameter and becomes an array constant: one job for
    the whole grid, and no join.
    """
    if modes not in ("all", "zero-shot", "few-shot"):
        raise ValueError(f"invalid prompt mode: {modes!r}")
    out = requests if modes == "all" else requests.filter(mode_of(F.col("template")) == modes)
    return out.withColumn("model", F.explode(F.array(*map(F.lit, models))))
