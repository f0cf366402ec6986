"""The shapes the jobs work on, derived from the supplied tables.

Labelled headlines come from ``documents`` and ``labels``, prompt requests and
completions from ``conversations``, runs from ``events``. Whole tables and
whole texts are used. ``plans/oracle.py`` holds the same definitions as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from synthcurate.functions.text import json_text, model_name
from synthcurate.session import configure

# Template names as stored datasets carry them, and model names in
# the spellings users give. Template and model of a prompt go by prompt_id modulo the list length.
TEMPLATES = (
    "zero-shot_v1", "zero-shot_bg_v1", "zero-shot_bg_train-time-info_v1", "zero-shot_bg_test-time-info_v1",
    "few-shot_v1", "few-shot_bg_v1", "few-shot_bg_train-time-info_v1", "few-shot_bg_test-time-info_v1",
)
MODELS = (
    "llama3.1-8b", "llama3.3-70b", "qwen2.5:32b", "Qwen/Qwen2.5-7B-Instruct-AWQ", "org/other-instruct",
)


# Twelve ways a model answers, from the example objects a, b and c.
SHAPES = r"""
 WHEN 0 THEN concat('[', a, ', ', b, ', ', c, ']')
 WHEN 1 THEN concat('```json\n[', a, ', ', b, ', ', c, ']\n```')
 WHEN 2 THEN concat('  JSON [', a, ', ', b, '] ')
 WHEN 3 THEN a
 WHEN 4 THEN concat('Sure!\n```\n[', a, ', ', c, ']\n``` done')
 WHEN 5 THEN '[{"headline": "2024 1234", "sentiment": "1"}]'
 WHEN 6 THEN concat('[', a, ', {"headline": "Odd", "sentiment": "9"}]')
 WHEN 7 THEN concat('[', a, ', {"headline": "Extra", "sentiment": "1", "why": "x"}]')
 WHEN 8 THEN concat('[', a, ', ', substr(b, 1, 20))
 WHEN 9 THEN '[]'
 WHEN 10 THEN concat('[', a, ', 7]')
 ELSE concat('```json\n[', a, ']')"""

# Columns of the tables used, so that opening one does not read a footer.
TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _pick(names: tuple[str, ...], key: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), (F.pmod(key, F.lit(len(names))) + 1).cast("int"))


def letters(n: Column) -> Column:
    """A number spelt with the letters A to J."""
    return F.translate(n.cast("string"), "0123456789", "ABCDEFGHIJ")


def _link(doc: Column) -> Column:
    return F.when(doc % 7 == 0, F.concat(F.lit("https://x.example/$ABC/"), doc, F.lit(" "))).otherwise("")


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def headlines(self) -> DataFrame:
        """row_id, split, label, text"""
        doc = F.col("doc_id")
        ticker = F.when(doc % 4 == 0, "").otherwise(F.concat(F.lit("$"), letters(doc % 97), F.lit(" - ")))
        return self.table("documents").join(self.table("labels"), "doc_id").select(
            doc.alias("row_id"),
            F.when(doc % 5 == 0, "validation").otherwise("train").alias("split"),
            F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 1, 1).otherwise(2).alias("label"),
            F.concat(_link(doc), ticker, F.col("text")).alias("text"),
        )

    def links(self) -> DataFrame:
        """doc_id, text: every document, some of them behind a link"""
        return self.table("documents").select("doc_id", F.concat(_link(F.col("doc_id")), F.col("text")).alias("text"))

    def by_dataset(self, rows: DataFrame) -> DataFrame:
        """Rows with the ``model`` and ``prompt`` of their dataset. Both follow
        from ``prompt_id``, so nothing is joined."""
        key = F.col("prompt_id")
        return rows.withColumn("model", model_name(_pick(MODELS, key))).withColumn("prompt", _pick(TEMPLATES, key))

    def requests(self) -> DataFrame:
        """prompt_id, template, model"""
        ids = self.table("conversations").select(F.col("conv_id").alias("prompt_id")).distinct()
        return ids.select(
            "prompt_id",
            _pick(TEMPLATES, F.col("prompt_id")).alias("template"),
            _pick(MODELS, F.col("prompt_id")).alias("model"),
        )

    def completions(self) -> DataFrame:
        """prompt_id, attempt, raw: the assistant turns in twelve good and bad shapes"""
        said = self.table("conversations").filter("role = 'assistant'").select(
            F.col("conv_id").alias("prompt_id"), F.col("turn").alias("attempt"), json_text(F.col("text")).alias("said")
        )
        examples = said.selectExpr(
            "prompt_id", "attempt",
            """concat('{"headline": ', said, ', "sentiment": "1"}') AS a""",
            """concat('{"headline": "Shares of ', translate(prompt_id % 29, '0123456789', 'ABCDEFGHIJ'),
                      ' fall", "sentiment": "0"}') AS b""",
            """concat('{"headline": "Market flat ', prompt_id, '", "sentiment": 2}') AS c""",
        )
        return examples.selectExpr("prompt_id", "attempt", f"CASE pmod(prompt_id * 7 + attempt, 12) {SHAPES} END AS raw")

    def attempts(self) -> DataFrame:
        """prompt_id, attempt, error: every turn as a request that failed in one of three ways, or not"""
        conv, turn = F.col("conv_id"), F.col("turn")
        kind = F.pmod(conv + turn, F.lit(4))
        error = (
            F.when(kind == 0, F.concat(F.lit("429 limit of requests per minute exceeded: "), "text"))
            .when(kind == 1, F.concat(F.lit("daily token limit exceeded: "), "text"))
            .when(kind == 2, F.concat(F.lit("connection reset: "), "text"))
        )
        return self.table("conversations").select(conv.alias("prompt_id"), turn.alias("attempt"), error.alias("error"))

    def aux(self) -> DataFrame:
        """prompt_id, opening: the first text of each conversation"""
        return self.table("conversations").groupBy(F.col("conv_id").alias("prompt_id")).agg(
            F.min_by("text", "turn").alias("opening")
        )

    def runs(self) -> DataFrame:
        """run_id, gpu_config, finished_at, num_examples, rows_written, total_time, throughput"""
        elapsed = F.col("value") + 1.0
        return self.table("events").select(
            F.col("event_id").alias("run_id"),
            F.when(F.col("event_type").isin("click", "purchase"), "1 GPU").otherwise("2 GPUs").alias("gpu_config"),
            F.col("ts").alias("finished_at"),
            F.lit(1000).cast("bigint").alias("num_examples"),
            (1000 - F.col("user_id") % 100).alias("rows_written"),
            elapsed.alias("total_time"),
            (1000 / elapsed).alias("throughput"),
        )
