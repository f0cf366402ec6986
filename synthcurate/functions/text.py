"""Column functions for headlines, completions and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
FENCE = "```"

# The patterns the data contract names.
URL = r"(?U)https?://[^\s\x1c-\x1f]+"
TICKER = r"\$([A-Z]+)"
ASCII_LETTER = "[a-zA-Z]"


def strip(text: Column) -> Column:
    """Trim every Unicode white-space character, not only blanks."""
    return F.btrim(text, F.lit(WHITESPACE))


def strip_urls(text: Column) -> Column:
    # Most texts hold no URL; a plain search tells so much faster than the pattern.
    return F.when(F.contains(text, F.lit("http")), F.regexp_replace(text, URL, "")).otherwise(text)


def first_ticker(text: Column) -> Column:
    """The first ``$TICKER`` outside URLs, NULL where there is none."""
    found = F.nullif(F.regexp_extract(strip_urls(text), TICKER, 1), F.lit(""))
    return F.when(F.contains(text, F.lit("$")), found)


def has_letter(text: Column) -> Column:
    return text.rlike(ASCII_LETTER)


def ticker_text(tickers: Column) -> Column:
    """``$A, $B`` for an array of tickers, the empty string for none."""
    marked = F.transform(tickers, lambda t: F.concat(F.lit("$"), t))
    return F.coalesce(F.array_join(marked, ", "), F.lit(""))


def json_text(value: Column) -> Column:
    """A string as a JSON literal, quotes included; non-ASCII kept as is."""
    wrapped = F.to_json(F.struct(value.alias("v")))  # {"v":"..."}
    return F.when(value.isNotNull(), F.rtrim(F.substr(wrapped, F.lit(6)), F.lit("}")))


def fewshot_json(shots: Column, text_key: str = "headline", label_key: str = "sentiment") -> Column:
    """Render array<struct<text,label>> as a JSON array indented by two."""
    items = F.transform(
        shots,
        lambda s: F.concat(
            F.lit(f'  {{\n    "{text_key}": '), json_text(s["text"]),
            F.lit(f',\n    "{label_key}": '), s["label"].cast("string"), F.lit("\n  }"),
        ),
    )
    body = F.concat(F.lit("[\n"), F.array_join(items, ",\n"), F.lit("\n]"))
    return F.when(F.size(shots) > 0, body).otherwise("[]")


def object_json(**fields: Column) -> Column:
    """One element of an indented JSON array; values are JSON text already."""
    lines = [F.concat(F.lit(f'    "{key}": '), F.coalesce(value, F.lit("null"))) for key, value in fields.items()]
    return F.concat(F.lit("  {\n"), F.concat_ws(",\n", *lines), F.lit("\n  }"))


def example_json(headline: Column, sentiment: Column) -> Column:
    return object_json(headline=json_text(headline), sentiment=json_text(sentiment))


def fenced_part(raw: Column) -> Column:
    """With two or more fences the text between the first two; with a lone
    fence the text as it is; without a fence the trimmed text."""
    pieces = F.split(raw, FENCE, 3)
    return (
        F.when(~F.contains(raw, F.lit(FENCE)), strip(raw))
        .when(F.size(pieces) >= 3, strip(pieces[1]))
        .otherwise(raw)
    )


def without_json_tag(text: Column) -> Column:
    """Drop a leading ``json`` in any case, and trim if there was one."""
    tagged = F.lower(F.substring(text, 1, 4)) == "json"
    return F.when(tagged, strip(F.substr(text, F.lit(5)))).otherwise(text)


def model_name(model: Column) -> Column:
    """Canonical model name used in dataset names."""
    # The family, size and variant parts stored datasets are named with.
    flat = F.lower(F.regexp_replace(model, "-", ""))

    def has(part: str) -> Column:
        return F.contains(flat, F.lit(part))

    llama = F.concat(
        F.lit("llama"),
        F.when(has("70b"), "3.3-70b").when(has("8b"), "3.1-8b").otherwise(""),
    )
    qwen = F.concat(
        F.lit("qwen2.5"),
        F.when(has("coder"), "-coder").otherwise(""),
        F.when(has("7b"), "-7b").when(has("32b"), "-32b").otherwise(""),
    )
    family = (
        F.when(has("llama"), llama)
        .when(has("qwen2.5"), qwen)
        .otherwise(F.replace(model, F.lit("/"), F.lit("--")))
    )
    return F.concat(family, F.when(has("instruct"), "-instruct").otherwise(""))


def dataset_name(model: Column, size: Column, template: Column) -> Column:
    """``<model>_<n>_prompt=<template>.json``; ``model`` is already canonical."""
    return F.concat(model, F.lit("_"), size.cast("string"), F.lit("_prompt="), template, F.lit(".json"))


def metadata_name(model: Column, template: Column) -> Column:
    """Name of the settings file that the one-request path writes."""
    return F.concat(model, F.lit("_prompt="), template, F.lit("_metadata.json"))


def dataset_parts(name: Column) -> list[Column]:
    """Model, size and template columns read back from a dataset name."""
    pattern = r"^(.*)_(\d+)_prompt=(.*)\.json$"
    return [
        F.regexp_extract(name, pattern, 1).alias("model"),
        F.regexp_extract(name, pattern, 2).try_cast("bigint").alias("size"),
        F.regexp_extract(name, pattern, 3).alias("template"),
    ]


def error_action(error: Column) -> Column:
    """What to do after a failed request: wait and retry, stop, or retry."""
    limited = F.contains(error, F.lit("exceeded")) & F.contains(error, F.lit("limit"))
    return (
        F.when(error.isNull(), F.lit(None))
        .when(limited & F.contains(error, F.lit("minute")), "retry_after")
        .when(limited, "stop")
        .otherwise("retry")
    )
