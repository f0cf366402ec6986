"""A corpus in five stages: quality, lines, near duplicates, benchmarks, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read as the next one's
``docs``. All but the last return the columns of ``documents``.

Each stage's operator states what NULLs, empty and long texts, ties, repeated
rows and empty tables give; columns besides ``doc_id`` and ``text`` pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from synthcurate.llm import decontaminate_wm, line_dedup, pack_bestfit, quality_qda, simhash_vp
from synthcurate.llm.common import fresh, stored, table
from synthcurate.llm.queries import fit_quality, vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not reject (score of at least 0.7)."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"), quality_qda.features(F.col("text")))
    return quality_qda.keep_good(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line equals or nearly equals."""
    kept = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by the SimHash operator with
    the shingles and bit distance of its contract (four words, four bits)."""
    return simhash_vp.keep_one(docs, simhash_vp.EXACT).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test string of the benchmark."""
    name = fresh(docs, "_found")
    found = docs.withColumn(name, decontaminate_wm.contamination(docs, table(spark, sf_dir, "benchmark")))
    return found.filter(F.col(name)["n_hit"] == 0).drop(name)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    return pack_bestfit.pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near dedup", near_duplicates),
    ("decontamination", benchmark),
    ("packing", packing),
]

#: The classifier, the fingerprints and the tokenizer are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
