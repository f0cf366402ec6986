"""One registered query for each operator on training text, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate_wm, fertility, line_dedup, lm_hmm, pack_bestfit, pii_transducer, quality_qda, secrets_trigram, simhash_vp, source_stripes, token_align, token_trie,
    warc_normalise,
)
from .common import in_fold, stored, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def vocabulary(name: str) -> str:
    """Where the public tokenizer files are on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def fit_quality(docs: DataFrame, labels: DataFrame, features: Column) -> quality_qda.Model:
    """Fitted on all labelled rows outside the held-out fold."""
    train = quality_qda.labelled_rows(docs, labels.filter(~in_fold(F.col("doc_id"), 4, 2)), features)
    return quality_qda.fit(train, "_features", "_label")


@register
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", quality_qda.features(F.col("text")).alias("features"))
    docs = stored(docs, "quality-features")
    model = fit_quality(docs, table(spark, sf_dir, "labels"), F.col("features"))
    return docs.select(
        "doc_id", in_fold(F.col("doc_id"), 4, 2).alias("held_out"), quality_qda.score_features(model, F.col("features")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@register
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", decontaminate_wm.contamination(docs, table(spark, sf_dir, "benchmark")).alias("f"))
    return found.select(
        "doc_id", "f.n_words", "f.n_hit", F.size("f.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("f.items", ","), 256).alias("items_sha256"), (F.col("f.n_hit") > 0).alias("contaminated"),
    )


@register
def op3_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc_normalise.round_trip(table(spark, sf_dir, "pages"))
    return warc_normalise.read_members(archives, payloads=False).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to",
    )


@register
def op4_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_bestfit.pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))

@register
def op5_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lm_hmm.scores(table(spark, sf_dir, "documents"), ~in_fold(F.col("doc_id"), 7, 2))
    return rows.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@register
def op6_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", token_trie.token_counts(F.col("text"), vocabulary("piece_bpe_32k.model")).alias("c")).select("doc_id", "c.*")


@register
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash_vp.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


@register
def op8_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    m = docs.select("doc_id", "lang", fertility.measures(F.col("text"), vocabulary("piece_bpe_32k.model")).alias("m"))
    rows = fertility.outside(stored(m.select("doc_id", "lang", "m.*"), "fertility"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.size("outside") == 0)).alias("kept"), "n_tokens", *fertility.MEASURES, F.array_join("outside", ",").alias("outside"),
    )


@register
def op9_pii_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", pii_transducer.personal_data(F.col("text")).alias("p"))
    return docs.select(
        "doc_id", *[F.col("p.counts")[i].alias(f"n_{kind}") for i, kind in enumerate(pii_transducer.KINDS)],
        F.sha2(F.array_join("p.base", ","), 256).alias("base_sha256"), F.array_join("p.spans", ",").alias("spans"),
    )


@register
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.decisions(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", F.col("n_lines").cast("bigint").alias("n_lines"), F.size("equal").cast("bigint").alias("n_equal"),
        F.size("near").cast("bigint").alias("n_near"), F.array_join(F.sort_array(F.array_union("equal", "near")), ",").alias("removed"),
    )


def _spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


@register
def op11_secret_trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", secrets_trigram.secrets(F.col("text")).alias("s"))
    base = F.filter("s", lambda s: s["kind"].isin(*secrets_trigram.BASE))
    return docs.select(
        "doc_id", *[F.size(F.filter("s", _of_kind(k))).cast("bigint").alias(f"n_{k}") for k in secrets_trigram.BASE],
        F.sha2(_spans(base), 256).alias("base_sha256"), _spans(F.col("s")).alias("spans"),
    )


@register
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_align.align(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@register
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_stripes.audit(table(spark, sf_dir, "documents"))


from .oracle import ORACLE as _SQL  # noqa: E402

ORACLE.update(_SQL)
