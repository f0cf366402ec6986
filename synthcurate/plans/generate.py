"""From prompt requests to stored examples in one call."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synthcurate.functions.completion import STRICT, gate_of
from synthcurate.operators import draws, prompts, rounds
from synthcurate.operators.gate import flatten
from synthcurate.operators.select import first_headlines
from synthcurate.plans.curate import CurationSpec
from synthcurate.session import scratch_path
from synthcurate.sources import readers, sinks


@dataclass(frozen=True)
class GenerationSpec:
    """What a run may choose; ``curation`` holds the gate and the hooks."""

    num_shots: int = 3
    num_tickers: int = 1
    replace_tickers: bool = False
    seed: int = 42
    max_rounds: int = 5
    curation: CurationSpec = field(default_factory=lambda: CurationSpec(by=("model", "prompt")))


def prompt_table(requests: DataFrame, labeled: DataFrame, templates: DataFrame, spec: GenerationSpec = GenerationSpec()) -> DataFrame:
    """Requests (prompt_id, template, and any others) with their ``prompt``."""
    asked = prompts.with_template_info(requests)
    few_shot = asked.filter(F.col("mode") == "few-shot")
    shots = draws.draw_fewshot(few_shot, labeled.filter(F.col("split") == "train"), spec.num_shots, spec.seed)
    tickers = draws.draw_tickers(asked, draws.ticker_pool(labeled), spec.num_tickers, spec.replace_tickers, spec.seed)
    inputs = prompts.prompt_inputs(requests, shots, tickers)
    return prompts.with_prompt(inputs, prompts.catalog(templates), gate_of(spec.curation.strict) or STRICT)


def generate(
    requests: DataFrame, labeled: DataFrame, templates: DataFrame, completer: rounds.Completer,
    path: str, spec: GenerationSpec = GenerationSpec(),
) -> tuple[DataFrame, DataFrame]:
    """Draw, render, ask in rounds, curate and store below ``path``.

    ``requests`` have ``prompt_id``, ``template`` and ``model`` (already in
    its canonical form). Returns the stored examples and the prompts that no
    round filled. Prompts are stored before the first round, so all rounds ask
    the same ones.
    """
    spark, choice = requests.sparkSession, spec.curation
    asked_path = scratch_path(spark, "prompts")
    prompt_table(requests, labeled, templates, spec).select("prompt_id", "template", "model", "prompt").write.parquet(asked_path)
    asked = spark.read.parquet(asked_path)
    done, unfilled = rounds.run_rounds(asked, completer, spec.max_rounds, strict=choice.strict, clean=choice.clean, checks=choice.checks)
    names = asked.select("prompt_id", "model", F.col("template").alias("prompt"))
    rows = flatten(done.join(names, "prompt_id").transform(choice.each_output))
    if choice.deduplicate:
        rows = first_headlines(rows, list(choice.order), list(choice.by), choice.unique)
    sinks.write_examples(rows.transform(choice.all_results), path)
    return readers.read_examples(spark, path), unfilled
