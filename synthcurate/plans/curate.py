"""Completions to curated examples in one plan, with user hooks."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from synthcurate.functions.completion import Gate
from synthcurate.operators.gate import flatten, gate
from synthcurate.operators.select import first_headlines

Step = Callable[[DataFrame], DataFrame]


def unchanged(df: DataFrame) -> DataFrame:
    return df


@dataclass(frozen=True)
class CurationSpec:
    """What a run may choose. Every hook maps a DataFrame to a DataFrame.

    ``strict`` is the gate: True, False, one of your own, or None. ``unique``
    is the field whose equal values are kept once.
    """

    strict: bool | Gate | None = True
    clean: bool = True
    by: tuple[str, ...] = ()
    order: tuple[str, ...] = ("prompt_id", "attempt", "pos")
    deduplicate: bool = True
    unique: str = "headline"
    checks: Mapping[str, Column] = field(default_factory=dict)
    each_output: Step = unchanged
    all_results: Step = unchanged


def curate(completions: DataFrame, spec: CurationSpec = CurationSpec()) -> DataFrame:
    """Gate, flatten and deduplicate completions; lazy, one shuffle.

    ``completions`` needs ``raw`` and the columns of ``spec.by`` and
    ``spec.order`` except ``pos``; any further columns stay.
    """
    gated = gate(completions, spec.strict, spec.clean, spec.checks).transform(spec.each_output)
    rows = flatten(gated)
    if spec.deduplicate:
        rows = first_headlines(rows, list(spec.order), list(spec.by), spec.unique)
    return rows.transform(spec.all_results)
