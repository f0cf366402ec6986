"""The registered queries: each operator over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from synthcurate import schemas
from synthcurate.functions import text as tx
from synthcurate.functions.completion import Field, Gate
from synthcurate.operators import draws, gate, metrics, prompts, rounds, schedule, select
from synthcurate.operators.ordinals import running_totals
from synthcurate.plans.curate import CurationSpec, curate
from synthcurate.plans.generate import GenerationSpec, generate
from synthcurate.plans.inputs import Inputs
from synthcurate.session import broadcast_if_small, join_on, materialize, scratch_path
from synthcurate.sources import array_scan, committed, readers, sinks
from synthcurate.streaming import curate as streaming

SEED = 42
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
    return fn


def _examples(i: Inputs, strict: bool = True) -> DataFrame:
    return gate.flatten(gate.gate(i.completions(), strict))


def _datasets(i: Inputs) -> DataFrame:
    return i.by_dataset(_examples(i))


def _stored(i: Inputs, fmt: str = "parquet") -> DataFrame:
    path = scratch_path(i.spark, "examples")
    sinks.write_examples(_datasets(i), path, fmt=fmt)
    return readers.read_examples(i.spark, path, fmt)


def _train(i: Inputs) -> DataFrame:
    return i.headlines().filter(F.col("split") == "train")


def _shots(i: Inputs) -> DataFrame:
    asked = prompts.with_template_info(i.requests()).filter(F.col("mode") == "few-shot")
    return draws.draw_fewshot(asked, _train(i), 3, SEED)


def _tickers(i: Inputs, k: int, replace: bool) -> DataFrame:
    asked = prompts.with_template_info(i.requests())
    return draws.draw_tickers(asked, draws.ticker_pool(i.headlines()), k, replace, SEED)


def _templates(i: Inputs) -> DataFrame:
    return prompts.catalog(readers.default_templates(i.spark))


def _prompt_inputs(i: Inputs) -> DataFrame:
    return prompts.prompt_inputs(i.requests().select("prompt_id", "template"), _shots(i), _tickers(i, 2, False))


# --- sources and sinks ---------------------------------------------------


@query
def scan_labeled(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "labeled")
    element = tx.object_json(text=tx.json_text(F.col("text")), label=F.col("label").cast("string"))
    sinks.write_json_arrays(i.headlines(), path, ["split"], ["row_id"], element)
    return readers.read_labeled(i.spark, f"{path}/split=train", f"{path}/split=validation")


@query
def scan_array_split(i: Inputs) -> DataFrame:
    """Labelled headlines as JSON-array files, read back by byte ranges."""
    path = scratch_path(i.spark, "array-split")
    element = tx.object_json(row_id=F.col("row_id").cast("string"), text=tx.json_text(F.col("text")), label=F.col("label").cast("string"))
    sinks.write_json_arrays(i.headlines(), path, ["split"], ["row_id"], element)
    item = T.StructType([T.StructField("row_id", T.LongType()), *schemas.LABELED.fields])
    rows = array_scan.scan_arrays(i.spark, path, item)
    return rows.select(F.regexp_extract("file", "/split=([^/]+)/", 1).alias("split"), "row_id", "label", "text")


@query
def scan_synthetic(i: Inputs) -> DataFrame:
    """Datasets as named array files, with settings files below them."""
    folder = scratch_path(i.spark, "named")
    _named_files(i, _datasets(i), folder)
    settings = i.requests().select(
        F.concat(F.lit("metadata_"), tx.model_name(F.col("model")), F.lit("_prompt="), "template", F.lit(".json")).alias("file")
    ).distinct()
    element = tx.object_json(MODEL=tx.json_text(F.col("file")))
    sinks.write_named_arrays(settings, f"{folder}/metadata", F.col("file"), [], element)
    return readers.read_named_datasets(i.spark, folder).select("dataset", "headline", "sentiment")


def _named_files(i: Inputs, rows: DataFrame, folder: str) -> DataFrame:
    """Write each dataset as ``<model>_<n>_prompt=<template>.json``."""
    sizes = metrics.dataset_counts(rows, ["model", "prompt"])
    sized = join_on(rows, broadcast_if_small(sizes), ["model", "prompt"])
    name = tx.dataset_name(F.col("model"), F.col("n"), F.col("prompt"))
    return sinks.write_named_arrays(sized, folder, name, ["prompt_id", "attempt", "pos"])


@query
def named_files(i: Inputs) -> DataFrame:
    return _named_files(i, _datasets(i), scratch_path(i.spark, "named"))


@query
def write_roundtrip(i: Inputs) -> DataFrame:
    return _stored(i).select("model", "prompt", "prompt_id", "attempt", "pos", "headline", "sentiment")


@query
def missing_datasets(i: Inputs) -> DataFrame:
    rows = _datasets(i)
    existing = rows.filter(F.col("attempt") == 1)
    return sinks.missing_datasets(rows, existing).select("model", "prompt", "prompt_id", "attempt", "pos", "headline")


@query
def committed_writes(i: Inputs) -> DataFrame:
    """Two writers of overlapping datasets: first attempts, then all rows. A
    dataset is kept once, as its first committer wrote it."""
    root = scratch_path(i.spark, "committed")
    rows = _datasets(i).select("model", "prompt", "prompt_id", "attempt", "pos", "headline", "sentiment")
    committed.write_committed(rows.filter(F.col("attempt") == 1), root, writer="first-attempts")
    committed.write_committed(rows, root, writer="all-attempts")
    schema = "model string, prompt string, prompt_id bigint, attempt bigint, pos bigint, headline string, sentiment string"
    return committed.read_committed(i.spark, root, schema)


# Fixed value: the most tokens of a completion, as the run settings record it.
MAX_TOKENS = 1024


@query
def run_metadata(i: Inputs) -> DataFrame:
    runs = i.requests().groupBy("model", F.col("template").alias("prompt")).agg(F.count("*").alias("num_prompts"))
    settings = F.create_map(
        F.lit("MODEL"), "model", F.lit("PROMPT"), "prompt", F.lit("NUM_SHOTS"), F.lit("3"),
        F.lit("TEMPERATURE"), F.lit("0.0"), F.lit("MAX_TOKENS"), F.lit(str(MAX_TOKENS)), F.lit("NUM_TICKERS"), F.lit("1"),
    )
    path = scratch_path(i.spark, "runs")
    named = runs.withColumn("settings", settings).withColumn(
        "file", tx.metadata_name(tx.model_name(F.col("model")), F.col("prompt"))
    )
    sinks.write_runs(sinks.run_settings(named, {"TEMPERATURE": 1.0, "TOP_P": 0.95}), path)
    stored = i.spark.read.schema("file string, num_prompts bigint, settings map<string,string>").parquet(path)
    keys = ("MODEL", "PROMPT", "NUM_SHOTS", "TEMPERATURE", "TOP_P", "MAX_TOKENS", "NUM_TICKERS")
    return stored.select("file", "num_prompts", *[F.col("settings")[k].alias(k.lower()) for k in keys])


# --- text and names --------------------------------------------------------


@query
def strip_urls(i: Inputs) -> DataFrame:
    return i.links().select("doc_id", tx.strip_urls(F.col("text")).alias("text"))


@query
def ticker_pool(i: Inputs) -> DataFrame:
    return draws.ticker_pool(i.headlines()).select("row_id", "pool", "ticker")


@query
def ticker_freq(i: Inputs) -> DataFrame:
    return draws.ticker_counts(draws.ticker_pool(i.headlines()))


@query
def clean_completions(i: Inputs) -> DataFrame:
    return gate.cleaned(i.completions()).select("prompt_id", "attempt", "text")


@query
def model_name(i: Inputs) -> DataFrame:
    return i.requests().select("prompt_id", "model", tx.model_name(F.col("model")).alias("name"))


@query
def dataset_name(i: Inputs) -> DataFrame:
    sizes = i.requests().groupBy("model", "template").agg(F.count("*").alias("n"))
    named = sizes.select(
        "model", tx.dataset_name(tx.model_name(F.col("model")), F.col("n"), F.col("template")).alias("name")
    )
    model, size, template = tx.dataset_parts(F.col("name"))
    return named.select(
        F.col("model").alias("asked_model"), "name", model.alias("model"), size.alias("size"), template.alias("template")
    )


@query
def classify_errors(i: Inputs) -> DataFrame:
    return rounds.classified(i.attempts()).select("prompt_id", "attempt", "action")


# --- gate ----------------------------------------------------------------------


@query
def parse_completions(i: Inputs) -> DataFrame:
    rows = gate.parsed(i.completions(), strict=False)
    return rows.select(
        "prompt_id", "attempt",
        F.col("value").isNotNull().alias("is_json"),
        F.coalesce(F.size(F.try_variant_get("value", "$", "array<variant>")), F.lit(-1)).cast("bigint").alias("n_elements"),
    )


def _verdicts(i: Inputs, strict: bool | Gate | None) -> DataFrame:
    rows = gate.gate(i.completions(), strict)
    return rows.select("prompt_id", "attempt", F.col("items").isNotNull().alias("ok"),
                       F.coalesce("n_items", F.lit(-1)).alias("n_items"))


@query
def gate_lenient(i: Inputs) -> DataFrame:
    return _verdicts(i, strict=False)


@query
def gate_strict(i: Inputs) -> DataFrame:
    return _verdicts(i, strict=True)


@query
def reject_reasons(i: Inputs) -> DataFrame:
    return gate.reason_counts(i.completions(), {"lenient": False, "strict": True})


@query
def gate_none(i: Inputs) -> DataFrame:
    return _verdicts(i, None)


#: Another schema over the same completions: any headline, sentiments as text.
TEXTS = Gate((Field("headline", ("STRING",), r"^\$|^Shares|^[A-Z0-9]"), Field("sentiment", ("STRING",))), single=True)


@query
def gate_custom(i: Inputs) -> DataFrame:
    return _verdicts(i, TEXTS)


@query
def flatten_custom(i: Inputs) -> DataFrame:
    return gate.flatten(gate.gate(i.completions(), TEXTS))


@query
def flatten_examples(i: Inputs) -> DataFrame:
    return _examples(i)


@query
def flatten_lenient(i: Inputs) -> DataFrame:
    return _examples(i, strict=False)


# --- prompts ---------------------------------------------------------------------


@query
def template_catalog(i: Inputs) -> DataFrame:
    """Every template read from files, with the requests that name it."""
    folder = scratch_path(i.spark, "templates")
    bodies = readers.default_templates(i.spark)
    file = F.concat("template", F.lit(".txt"))
    sinks.write_named_texts(bodies, folder, file, F.col("body"))
    uses = i.requests().groupBy("template").agg(F.count("*").alias("n_requests"))
    catalog = prompts.catalog(readers.read_templates(i.spark, folder)).drop("parts")
    return catalog.join(uses, "template", "left").withColumn("n_requests", F.coalesce("n_requests", F.lit(0)))


def _slots(drawn: DataFrame) -> DataFrame:
    rows = drawn.select("prompt_id", F.posexplode("tickers").alias("slot", "ticker"))
    return rows.withColumn("slot", F.col("slot").cast("bigint"))


@query
def ticker_draw_worepl(i: Inputs) -> DataFrame:
    return _slots(_tickers(i, 2, replace=False))


@query
def ticker_draw_repl(i: Inputs) -> DataFrame:
    return _slots(_tickers(i, 2, replace=True))


@query
def ticker_text(i: Inputs) -> DataFrame:
    drawn = i.requests().select("prompt_id").join(_tickers(i, 2, False), "prompt_id", "left")
    return drawn.select("prompt_id", tx.ticker_text(F.col("tickers")).alias("stock_ticker"))


@query
def fewshot_draw(i: Inputs) -> DataFrame:
    return _shots(i).select("prompt_id", F.inline("shots")).withColumn("pos", F.col("pos").cast("bigint"))


@query
def fewshot_json(i: Inputs) -> DataFrame:
    return _shots(i).select(
        "prompt_id",
        tx.fewshot_json(F.col("shots")).alias("examples"),
        tx.fewshot_json(F.col("shots"), "x", "y").alias("examples_xy"),
    )


@query
def render_prompts(i: Inputs) -> DataFrame:
    rendered = prompts.with_prompt(_prompt_inputs(i), _templates(i))
    return rendered.select("prompt_id", "template", "prompt")


@query
def prompt_reuse(i: Inputs) -> DataFrame:
    shared = prompts.distinct_prompts(_prompt_inputs(i), _templates(i))
    return shared.select("prompt_key", "template", "n_uses", "prompt")


@query
def run_grid_modes(i: Inputs) -> DataFrame:
    zero = prompts.run_grid(i.requests().drop("model"), ["m"], "zero-shot").withColumn("mode", F.lit("zero-shot"))
    few = prompts.run_grid(i.requests().drop("model"), ["m"], "few-shot").withColumn("mode", F.lit("few-shot"))
    return zero.unionByName(few)


@query
def run_grid(i: Inputs) -> DataFrame:
    models = ["llama3.1-8b", "llama3.3-70b", "qwen2.5:7b", "qwen2.5:32b"]
    return prompts.run_grid(i.requests().drop("model"), models)


# --- rounds ----------------------------------------------------------------------


@query
def pending_prompts(i: Inputs) -> DataFrame:
    first = i.completions().filter(F.col("attempt") == 1)
    return rounds.pending(i.requests(), rounds.first_valid(first))


@query
def next_batch(i: Inputs) -> DataFrame:
    first = i.completions().filter(F.col("attempt") == 1)
    return rounds.next_batch(i.requests(), rounds.first_valid(first), batch_size=25)


@query
def align_aux(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "aux")
    element = tx.object_json(idx=F.col("prompt_id").cast("string"), opening=tx.json_text(F.col("opening")))
    sinks.write_named_arrays(i.aux(), path, F.concat(F.lit("aux-"), F.pmod("prompt_id", F.lit(8)), F.lit(".json")), ["prompt_id"], element)
    aux = readers.read_aux(i.spark, path, T.StructType.fromDDL("idx bigint, opening string"))
    return rounds.align_aux(i.requests(), aux)


@query
def first_valid(i: Inputs) -> DataFrame:
    return rounds.first_valid(i.completions()).select("prompt_id", "attempt", "n_items")


@query
def unfilled_prompts(i: Inputs) -> DataFrame:
    tries = i.completions().groupBy("prompt_id").agg(F.count("*").alias("tries"))
    unfilled = rounds.pending(i.requests(), rounds.first_valid(i.completions()))
    return unfilled.join(tries, "prompt_id", "left").select(
        "prompt_id", "template", F.coalesce("tries", F.lit(0)).cast("bigint").alias("tries")
    )


@query
def quota_take(i: Inputs) -> DataFrame:
    gated = gate.gate(i.completions())
    counts = i.by_dataset(gated).filter(F.col("n_items").isNotNull())
    return rounds.take_quota(
        counts.select("prompt", "prompt_id", "attempt", "n_items"), 10, ["prompt_id", "attempt"], ["prompt"]
    )


@query
def resume_union(i: Inputs) -> DataFrame:
    """First attempts as an earlier run in files, read back for one template
    each; later attempts fill up to the target."""
    folder = scratch_path(i.spark, "earlier")
    gated = materialize(i.by_dataset(gate.gate(i.completions())))
    first = gate.flatten(gated.filter(F.col("attempt") == 1))
    files = _named_files(i, first, folder).select(readers.template_in_name(F.col("file"))).distinct().collect()  # a row per template
    parts = [readers.read_resume(i.spark, f"{folder}/*_prompt={t}.json", t).withColumn("prompt", F.lit(t)) for (t,) in files]
    rows = reduce(DataFrame.unionByName, parts)
    model, _, _ = tx.dataset_parts(F.element_at(F.split("file", "/"), -1))
    earlier = rows.withColumn("model", model).withColumn("prompt_id", F.lit(None).cast("bigint")).withColumn("attempt", F.lit(None).cast("bigint")).drop("file")
    fresh = gated.filter(F.col("attempt") > 1)
    union = rounds.resume_with(earlier, fresh, 4, ["model", "prompt"], ["prompt_id", "attempt"])
    return union.select("phase", "model", "prompt", "prompt_id", "attempt", "pos", "headline", "sentiment")


@query
def apply_provider(i: Inputs) -> DataFrame:
    # A stand-in for a model: one headline that tells the prompt's length.
    def echo(batch: list[str]) -> list[str]:
        return [f'[{{"headline": "Prompt of {len(p)} characters", "sentiment": "2"}}]' for p in batch]

    asked = prompts.with_prompt(_prompt_inputs(i), _templates(i))
    answers = rounds.apply_provider(asked, echo, scratch_path(i.spark, "answers"))
    return answers.select("prompt_id", "raw", "error")


@query
def quota_rounds(i: Inputs) -> DataFrame:
    """Rounds over all datasets at once, answered by the first attempts."""
    by = ["model", "template"]
    asked = i.by_dataset(i.requests().select("prompt_id")).withColumnRenamed("prompt", "template")
    ordered = materialize(running_totals(asked, by, ["prompt_id"], before="ord"))
    targets = ordered.select(*by).distinct().select(*by, F.lit(6).cast("bigint").alias("target"), F.lit(0).cast("bigint").alias("have"))

    def make(wanted: DataFrame) -> DataFrame:
        rows = join_on(ordered, wanted, by).filter((F.col("ord") >= F.col("start")) & (F.col("ord") < F.col("start") + F.col("count")))
        return rows.select(*by, "prompt_id", F.lit("").alias("prompt"))

    first = i.completions().filter(F.col("attempt") == 1)

    def answer(prompts: DataFrame, round_no: int, path: str) -> DataFrame:
        found = prompts.select("prompt_id").join(first.select("prompt_id", "raw"), "prompt_id", "left")
        found.withColumn("error", F.lit(None).cast("string")).write.parquet(path)
        return i.spark.read.schema(schemas.ATTEMPT).parquet(path)

    rows = rounds.run_quotas(targets, make, answer, by, max_rounds=50)
    return rows.select("model", F.col("template").alias("prompt"), "prompt_id", "pos", "headline", "sentiment")


@query
def generate_e2e(i: Inputs) -> DataFrame:
    """Requests to stored examples; the stand-in for a model tells its prompt."""
    def echo(batch: list[str]) -> list[str]:
        import hashlib

        return [f'[{{"headline": "P {len(p)} {hashlib.md5(p.encode()).hexdigest()[:8]}", "sentiment": 1}}]' for p in batch]

    requests = i.requests().withColumn("model", tx.model_name(F.col("model")))
    spec = GenerationSpec(num_tickers=2, seed=SEED, max_rounds=2)
    examples, _ = generate(
        requests, i.headlines(), readers.default_templates(i.spark), rounds.provider_completer(echo), scratch_path(i.spark, "generated"), spec,
    )
    return examples.select("model", "prompt", "prompt_id", "attempt", "pos", "headline", "sentiment")


@query
def retry_rounds(i: Inputs) -> DataFrame:
    """One round for each attempt there is, as long as prompts are open."""
    low, high = i.completions().agg(F.min("attempt"), F.max("attempt")).first()
    n = 0 if low is None else high - low + 1
    accepted, _ = rounds.run_rounds(i.requests(), rounds.replay_completer(i.completions()), max_rounds=n, first_round=low or 1)
    return accepted.select("prompt_id", "attempt", "n_items")


@query
def resumed_rounds(i: Inputs) -> DataFrame:
    """The rounds of ``retry_rounds``, stopped after the first half and run on
    from the ledger of that run."""
    low, high = i.completions().agg(F.min("attempt"), F.max("attempt")).first()
    n = 0 if low is None else high - low + 1
    path = scratch_path(i.spark, "resumed")
    completer = rounds.replay_completer(i.completions())
    rounds.run_rounds(i.requests(), completer, max_rounds=n // 2, first_round=low or 1, path=path)
    accepted, _ = rounds.run_rounds(i.requests(), completer, max_rounds=n, first_round=low or 1, path=path)
    return accepted.select("prompt_id", "attempt", "n_items")


# Requests of an event type start at least this many microseconds apart.
LANE_GAP_US = 20 * 60 * 1_000_000


@query
def schedule_requests(i: Inputs) -> DataFrame:
    """Events as requests, one lane per event type, started under a rate limit."""
    events = i.table("events").select("event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("ready"))
    out = schedule.schedule(events, ["event_type"], "ready", "event_id", LANE_GAP_US)
    return out.select("event_id", "event_type", "place", "ready", "start", "wait")


# --- curation ----------------------------------------------------------------------


@query
def letter_filter(i: Inputs) -> DataFrame:
    stored = i.table("documents").select("doc_id", F.col("text").alias("headline"))
    return select.with_letter(stored)


@query
def dedup_headline(i: Inputs) -> DataFrame:
    return select.first_headlines(_datasets(i), ["prompt_id", "attempt", "pos"], ["model", "prompt"])


@query
def dataset_counts(i: Inputs) -> DataFrame:
    return metrics.dataset_counts(_datasets(i), ["model", "prompt"])


@query
def sample_per_dataset(i: Inputs) -> DataFrame:
    rows = select.with_letter(_datasets(i))
    return select.sample_exact(rows, ["model", "prompt"], ["prompt_id", "attempt", "pos"], 3, SEED, "keep")


def curated(i: Inputs) -> DataFrame:
    """Completions to distinct accepted headlines per dataset; lazy."""
    return curate(i.by_dataset(i.completions()), CurationSpec(by=("model", "prompt")))


@query
def curate_e2e(i: Inputs) -> DataFrame:
    """Completions to the stored datasets, then an exact sample of each."""
    path = scratch_path(i.spark, "curated")
    sinks.write_examples(curated(i), path)
    rows = select.with_letter(readers.read_examples(i.spark, path))
    sample = select.sample_exact(rows, ["model", "prompt"], ["prompt_id", "attempt", "pos"], 5, SEED, "keep")
    return sample.select("model", "prompt", "prompt_id", "attempt", "pos", "headline", "sentiment")


@query
def stream_curate(i: Inputs) -> DataFrame:
    landing, out, state = (scratch_path(i.spark, n) for n in ("landing", "stream", "state"))
    completions = i.completions()
    completions.write.parquet(landing)
    landed = i.spark.readStream.schema(completions.schema).parquet(landing)
    # Which of equal headlines comes first depends on arrival, so what is
    # comparable with the batch job is the dataset and the headline.
    rows = streaming.curate_stream(i.by_dataset(landed), CurationSpec(by=("model", "prompt"))).select("model", "prompt", "headline")
    streaming.start(rows, out, state).awaitTermination()
    return i.spark.read.schema("model string, prompt string, headline string").parquet(out)


# --- run statistics ------------------------------------------------------------------


@query
def throughput(i: Inputs) -> DataFrame:
    runs = metrics.with_throughput(i.runs().drop("throughput"))
    return runs.select(
        "run_id", "num_examples", F.round("throughput", 6).alias("throughput"),
        F.round("written_per_second", 6).alias("written_per_second"),
    )


@query
def benchmark_union(i: Inputs) -> DataFrame:
    runs = i.runs()
    one = runs.filter(F.col("gpu_config") == "1 GPU").select("run_id", "num_examples", "total_time")
    two = runs.filter(F.col("gpu_config") == "2 GPUs").select("run_id", "num_examples", "total_time", "rows_written")
    both = metrics.union_groups({"1 GPU": one, "2 GPUs": two})
    return both.withColumn("rows_written", F.coalesce("rows_written", F.lit(-1)))


@query
def runs_ordered(i: Inputs) -> DataFrame:
    ordered = metrics.runs_in_order(i.runs().select("run_id", "gpu_config", "finished_at", "total_time"))
    return ordered.select("gpu_config", "run_no", "run_id", "total_time")


@query
def benchmark_files(i: Inputs) -> DataFrame:
    """Runs through their files, then in order."""
    path = scratch_path(i.spark, "benchmarks")
    sinks.write_benchmarks(i.runs().withColumn("model", F.col("gpu_config")), path)
    ordered = metrics.runs_in_order(readers.read_runs(i.spark, path), by="model")
    return ordered.select(F.col("model").alias("gpu_config"), "run_no", F.col("run_id").cast("bigint").alias("run_id"), "finished_at", "num_examples")


@query
def summary_csv(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "summary")
    stats = metrics.summary(i.runs())
    sinks.write_summary(stats, path)
    stored = i.spark.read.option("header", True).schema(stats.schema).csv(path)
    return stored.select("gpu_config", *[F.round(c, 6).alias(c) for c in stats.columns if c != "gpu_config"])


@query
def benchmark_summary(i: Inputs) -> DataFrame:
    stats = metrics.summary(i.runs())
    return stats.select("gpu_config", *[F.round(c, 6).alias(c) for c in stats.columns if c != "gpu_config"])


@query
def benchmark_box(i: Inputs) -> DataFrame:
    box, _ = metrics.box_figures(i.runs())
    figures = ("q1", "median", "q3", "whisker_low", "whisker_high")
    return box.select("measure", "gpu_config", "n", *[F.round(c, 6).alias(c) for c in figures], "n_outliers")


@query
def benchmark_outliers(i: Inputs) -> DataFrame:
    _, outliers = metrics.box_figures(i.runs())
    return outliers.withColumn("figure", F.round("figure", 6))
