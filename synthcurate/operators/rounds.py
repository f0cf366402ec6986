"""Asking for completions: pending prompts, providers, retry rounds, quotas."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from synthcurate import schemas
from synthcurate.functions.completion import Gate
from synthcurate.functions.text import error_action
from synthcurate.operators.gate import flatten, gate
from synthcurate.operators.ordinals import running_totals
from synthcurate.session import broadcast_if_small, join_on, materialize, scratch_path

Provider = Callable[[list[str]], list[str]]


def pending(requests: DataFrame, accepted: DataFrame) -> DataFrame:
    """Requests without an accepted completion. The accepted side is reduced
    to distinct ids map-side, so a prompt with very many attempts is one row."""
    return requests.join(accepted.select("prompt_id").distinct(), "prompt_id", "left_anti")


def next_batch(requests: DataFrame, accepted: DataFrame, batch_size: int = 100) -> DataFrame:
    return pending(requests, accepted).orderBy("prompt_id").limit(batch_size)


def align_aux(requests: DataFrame, aux: DataFrame) -> DataFrame:
    """Requests with their auxiliary row; a row without partner is an error."""
    left = requests.withColumn("_asked", F.lit(True))
    right = aux.withColumn("_given", F.lit(True))
    paired = F.col("_asked").isNotNull() & F.col("_given").isNotNull()
    message = F.concat(F.lit("prompts and auxiliary rows differ at prompt_id "), F.col("prompt_id").cast("string"))
    return (
        left.join(right, "prompt_id", "full_outer")
        .filter(F.when(paired, True).otherwise(F.raise_error(message)))
        .drop("_asked", "_given")
    )


def first_valid(completions: DataFrame, strict: bool = True, clean: bool = True) -> DataFrame:
    """The first accepted attempt of each prompt, with its items. ``min_by``
    keeps one candidate per prompt and map task before the shuffle."""
    gated = gate(completions.select("prompt_id", "attempt", "raw"), strict, clean)
    first = F.min_by(F.struct("attempt", "items", "n_items"), "attempt").alias("f")
    return gated.filter(F.col("items").isNotNull()).groupBy("prompt_id").agg(first).select("prompt_id", "f.*")


def take_quota(
    counts: DataFrame, target: int, order: list[str], by: list[str], n: str = "n_items",
) -> DataFrame:
    """Rows taken in order while the count of examples so far is below the
    target. The last one may overshoot and is not cut; ``before`` is the count
    it was taken at."""
    return running_totals(counts, by, order, n).filter(F.col("before") < target)


def resume_with(earlier: DataFrame, new: DataFrame, target: int, by: list[str], order: list[str]) -> DataFrame:
    """Examples of an earlier run first, then whole new completions up to the
    target. Earlier examples all stay, even beyond it.

    ``earlier`` holds examples with ``pos``; ``new`` is a stored gated table,
    since it is read twice. Both carry ``by``. ``phase`` is 0 for earlier and 1
    for new rows.
    """
    old = earlier.groupBy(*by).agg(F.count("*").alias("have"))
    counts = new.filter(F.col("n_items") > 0).select(*by, *order, "n_items")
    totals = running_totals(counts, by, order, "n_items")
    kept = join_on(totals, broadcast_if_small(old), by, "left").filter(F.col("before") + F.coalesce("have", F.lit(0)) < target)
    fresh = flatten(join_on(new, kept.select(*by, *order), [*by, *order], "left_semi"))
    return earlier.withColumn("phase", F.lit(0)).unionByName(
        fresh.withColumn("phase", F.lit(1)), allowMissingColumns=True
    )


def apply_provider(
    prompts: DataFrame, provider: Provider, path: str, batch_size: int = 100, parallel: int | None = None,
) -> DataFrame:
    """Complete ``(prompt_id, prompt)`` rows and return the written table.

    A provider may answer differently when asked again, so its output is
    stored before anything reads it. A batch that raises is stored with its
    error text. ``parallel`` is the number of tasks that call the provider.
    """

    # Local to this call, so that executors need no copy of this package.
    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                part = frame.iloc[start:start + batch_size]
                raw, error = None, None
                try:
                    raw = list(provider(part["prompt"].tolist()))
                    if len(raw) != len(part):
                        raise ValueError(f"{len(part)} prompts gave {len(raw)} completions")
                except Exception as exc:  # a failed batch is data: it is classified and retried
                    raw, error = None, f"{type(exc).__name__}: {exc}"
                yield pd.DataFrame({"prompt_id": part["prompt_id"], "raw": raw, "error": error})

    asked = prompts.select("prompt_id", "prompt")
    if parallel:
        asked = asked.repartition(parallel)
    asked.mapInPandas(ask, schemas.ATTEMPT).write.mode("overwrite").parquet(path)
    return prompts.sparkSession.read.schema(schemas.ATTEMPT).parquet(path)


Completer = Callable[[DataFrame, int, str], DataFrame]


def provider_completer(provider: Provider, batch_size: int = 100, parallel: int | None = None) -> Completer:
    """A completer that asks a provider function."""

    def complete(prompts: DataFrame, round_no: int, path: str) -> DataFrame:
        return apply_provider(prompts, provider, path, batch_size, parallel)

    return complete


def replay_completer(completions: DataFrame) -> Completer:
    """A completer that answers round ``r`` from rows with ``attempt = r``."""

    def complete(prompts: DataFrame, round_no: int, path: str) -> DataFrame:
        rows = completions.filter(F.col("attempt") == round_no).select("prompt_id", "raw")
        found = prompts.select("prompt_id").join(rows, "prompt_id").withColumn("error", F.lit(None).cast("string"))
        found.write.mode("overwrite").parquet(path)
        return prompts.sparkSession.read.schema(schemas.ATTEMPT).parquet(path)

    return complete


def classified(attempts: DataFrame) -> DataFrame:
    """Add ``action`` for failed attempts: retry_after, stop or retry."""
    return attempts.withColumn("action", error_action(F.col("error")))


def request_fingerprint(prompts: DataFrame) -> str:
    """A fingerprint of a request set that does not depend on row order or
    partitioning: the count and the sum of 64-bit hashes of all columns."""
    row = prompts.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64(*[F.col(c) for c in sorted(prompts.columns)]).cast("decimal(38,0)")).alias("h"),
    ).first()
    return f"{row['n']}:{row['h'] or 0}"


def finished_rounds(spark: SparkSession, path: str) -> DataFrame:
    """The ledger beside the attempts: ``(round, requests, stopped)`` of each
    round whose attempts were written in full. A round's entry is written
    after its attempts, by a committed Spark write, so a run stopped within a
    round leaves no entry for it."""
    try:
        rows = spark.read.schema("requests string, stopped boolean").json(f"{path}/ledger")
    except Exception as e:  # no round finished yet
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return spark.createDataFrame([], "round bigint, requests string, stopped boolean")
    return rows.select(F.col("round").cast("bigint").alias("round"), "requests", "stopped")


def run_rounds(
    prompts: DataFrame, completer: Completer, max_rounds: int, path: str | None = None,
    strict: bool = True, clean: bool = True, first_round: int = 1, checks: Mapping[str, Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Ask for all prompts, then again for those without an accepted
    completion, for at most ``max_rounds`` rounds.

    Returns the accepted completions ``(prompt_id, attempt, items, n_items)``
    and the prompts left unfilled. Each round is a partition of the attempts
    table at ``path``; only counts come to the driver. A provider that reports
    an exhausted limit ends the loop. ``checks`` are the gate's further named
    tests over the items; a completion that fails one is not accepted.

    A ledger of finished rounds lies beside the attempts. Given the ``path`` of
    a stopped run, the rounds go on after its last finished round (the
    attempts of a round cut short are asked again) and no accepted prompt is
    asked again; ``max_rounds`` counts the rounds of both runs. A ledger of
    another request set is an error, as is going on after a stop.
    """
    spark = prompts.sparkSession
    path = path or scratch_path(spark, "attempts")
    requests = request_fingerprint(prompts)
    ledger = finished_rounds(spark, path).collect()  # a row per finished round
    if any(r["requests"] != requests for r in ledger):
        raise ValueError(f"the attempts at {path} belong to another request set")
    last = max((r["round"] for r in ledger), default=first_round - 1)
    stopped = any(r["stopped"] for r in ledger)
    open_prompts, done = prompts, spark.createDataFrame([], schemas.ACCEPTED)
    if ledger:
        attempts = spark.read.parquet(f"{path}/gated").filter(F.col("attempt") <= last)
        done = attempts.filter(F.col("items").isNotNull())
        open_prompts = pending(prompts, done)
    for round_no in range(last + 1, first_round + max_rounds):
        if stopped or open_prompts.isEmpty():
            break
        answers = completer(open_prompts, round_no, f"{path}/raw/attempt={round_no}")
        gated = gate(answers.withColumn("attempt", F.lit(round_no).cast("bigint")), strict, clean, checks)
        gated.drop("attempt").write.mode("overwrite").parquet(f"{path}/gated/attempt={round_no}")
        attempts = spark.read.schema(gated.schema).parquet(f"{path}/gated").filter(F.col("attempt") <= round_no)
        done = attempts.filter(F.col("items").isNotNull())
        open_prompts = pending(prompts, done)
        stopped = not classified(attempts.filter(F.col("attempt") == round_no)).filter(F.col("action") == "stop").isEmpty()
        entry = spark.createDataFrame([(requests, stopped)], "requests string, stopped boolean")
        entry.coalesce(1).write.mode("overwrite").json(f"{path}/ledger/round={round_no}")
    return done.select("prompt_id", "attempt", "items", "n_items"), open_prompts


PromptMaker = Callable[[DataFrame], DataFrame]


def run_quotas(
    datasets: DataFrame, make_prompts: PromptMaker, completer: Completer, by: list[str], max_rounds: int,
    path: str | None = None, per_prompt: float = 3.0, strict: bool | Gate | None = True, clean: bool = True,
    checks: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Ask new prompts for many datasets at once until each has its examples.

    ``datasets`` has ``by``, ``target`` and ``have`` (examples of an earlier
    run). Every round is one pass over all open datasets: ``make_prompts`` gets
    their ``by``, ``start`` and ``count`` and gives prompts (``by``,
    ``prompt_id``, ``prompt``), numbered in dataset order. A dataset is closed
    when it has enough, or when it got fewer prompts than it asked for. The
    result holds whole completions in prompt order and may overshoot by the
    last one of a dataset. An exhausted provider limit ends the loop. ``checks``
    are the gate's further named tests, as in ``run_rounds``.
    """
    spark = datasets.sparkSession
    path = path or scratch_path(spark, "quotas")
    zero = F.lit(0).cast("bigint")
    state = materialize(datasets.select(*by, "target", "have", zero.alias("planned"), zero.alias("got"), zero.alias("found")))
    stored = None
    for round_no in range(1, max_rounds + 1):
        missing = F.col("target") - F.col("have") - F.col("found")
        rate = F.when(F.col("found") > 0, F.col("found") / F.col("got")).otherwise(per_prompt)
        wanted = state.filter((missing > 0) & (F.col("got") >= F.col("planned"))).select(
            *by, F.col("planned").alias("start"), F.greatest(F.lit(1), F.ceil(missing / rate)).cast("bigint").alias("count")
        )
        wanted = materialize(wanted)
        if wanted.isEmpty():
            break
        prompts_path = f"{path}/prompts/attempt={round_no}"
        make_prompts(wanted).write.mode("overwrite").parquet(prompts_path)
        prompts = spark.read.parquet(prompts_path)
        answers = completer(prompts, round_no, f"{path}/raw/attempt={round_no}")
        named = answers.join(prompts.select(*by, "prompt_id"), "prompt_id")
        gated = gate(named.withColumn("attempt", F.lit(round_no).cast("bigint")), strict, clean, checks)
        gated.drop("attempt").write.mode("overwrite").parquet(f"{path}/gated/attempt={round_no}")
        stored = spark.read.schema(gated.schema).parquet(f"{path}/gated")
        this = stored.filter(F.col("attempt") == round_no)
        asked = prompts.groupBy(*by).agg(F.count("*").alias("_got"))
        counted = this.groupBy(*by).agg(F.coalesce(F.sum("n_items"), F.lit(0)).alias("_found"))
        news = join_on(join_on(wanted, asked, by, "left"), counted, by, "left")
        state = join_on(state, news, by, "left").select(
            *by, "target", "have", (F.col("planned") + F.coalesce("count", zero)).alias("planned"),
            (F.col("got") + F.coalesce("_got", zero)).alias("got"), (F.col("found") + F.coalesce("_found", zero)).alias("found"),
        )
        state = materialize(state)
        if not classified(this).filter(F.col("action") == "stop").isEmpty():
            break
    if stored is None:
        kinds = {f.name: f.dataType.simpleString() for f in datasets.schema}
        return spark.createDataFrame([], ", ".join([*(f"{k} {kinds[k]}" for k in by), "prompt_id bigint, attempt bigint, pos bigint, headline string, sentiment string"]))
    counts = running_totals(stored.filter(F.col("n_items") > 0).select(*by, "prompt_id", "attempt", "n_items"), by, ["prompt_id", "attempt"], "n_items")
    limits = broadcast_if_small(datasets.select(*by, (F.col("target") - F.col("have")).alias("_limit")))
    kept = join_on(counts, limits, by).filter(F.col("before") < F.col("_limit")).select(*by, "prompt_id", "attempt")
    return flatten(join_on(stored.drop("error"), kept, [*by, "prompt_id", "attempt"], "left_semi"))


def run_quota(
    make_prompts: Callable[[int, int], DataFrame], completer: Completer, target: int, max_rounds: int,
    spark: SparkSession, path: str | None = None, have: int = 0, per_prompt: float = 3.0,
    strict: bool = True, clean: bool = True, checks: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Ask new prompts until ``target`` examples are accepted.

    ``make_prompts(start, count)`` gives the prompts with ids from ``start``;
    ``have`` examples of an earlier run count toward the target. Each round
    asks as many prompts as the yield so far calls for, ``per_prompt`` examples
    being the first guess. The result holds whole completions in prompt order
    and may overshoot by the last one. An exhausted provider limit ends the loop.
    """
    path = path or scratch_path(spark, "quota")
    asked, found, stored = 0, 0, None
    for round_no in range(1, max_rounds + 1):
        if have + found >= target:
            break
        rate = found / asked if found else per_prompt
        count = max(1, math.ceil((target - have - found) / rate))
        answers = completer(make_prompts(asked, count), round_no, f"{path}/raw/attempt={round_no}")
        gated = gate(answers.withColumn("attempt", F.lit(round_no).cast("bigint")), strict, clean, checks)
        gated.drop("attempt").write.mode("overwrite").parquet(f"{path}/gated/attempt={round_no}")
        stored = spark.read.schema(gated.schema).parquet(f"{path}/gated")
        asked += count
        found = stored.agg(F.coalesce(F.sum("n_items"), F.lit(0))).first()[0]
        if not classified(stored.filter(F.col("attempt") == round_no)).filter(F.col("action") == "stop").isEmpty():
            break
    if stored is None:
        return spark.createDataFrame([], "prompt_id bigint, attempt bigint, pos bigint, headline string, sentiment string")
    counts = stored.filter(F.col("n_items") > 0).select("prompt_id", "n_items")
    kept = take_quota(counts, target - have, ["prompt_id"], [])
    rows = flatten(stored.join(kept.select("prompt_id"), "prompt_id", "left_semi"))
    return rows.select("prompt_id", "attempt", "pos", "headline", "sentiment")
