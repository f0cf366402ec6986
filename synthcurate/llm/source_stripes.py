"""Source divergence audit by in-mapper stripes.

Each task folds whole documents into stripes: for a (lang, term), the number of
documents that hold the term and, per source, its documents and occurrences.
A task keeps its stripes as Arrow tables that a hash aggregation combines (the
terms of a batch are split and counted in Arrow's C++ kernels, A-Z lower-cased
by Spark first) and spills them as rows when they hold ``STRIPE_ENTRIES``
entries after combining, so its memory is bounded whatever it reads.
Spilled stripes are merged by key in Spark: one shuffle by (lang, term), then
sums per source and per term in the same partitions, so a term or source that
fills a third of all rows arrives as at most one row per task, spill and
source. Only stripes of kept terms are written; they carry their source
counts; each emits its share of every divergence at once: a p value per source of its language, the term rows, and |p - q| for each
pair of sources, which one more aggregation sums.

Definitions (exact integer arithmetic, decimals of 38 digits where products
exceed 64 bits): NULL text, lang and source read as ''. Terms are matches of
``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. A lang keeps the
V terms that at least ``MIN_DOCS`` of its documents hold. For a group (a
(lang, source) that occurs, or a whole lang) and a kept term with ``count``
occurrences there (0 included), p = 1 + floor(1e9 * (count + 5) / (N + 5 V)),
N the group's occurrences of kept terms.

Rows: (lang, source, part, item, value, rank). ``pair``: each other source of
the lang, value the sum over kept terms of |p - q| (0 when V is 0), all ranks.
``term``: each kept term the group holds with p above the lang's p, value the
difference, ranks 1 to ``TOP_TERMS``. Ranks count from 1 by value descending,
then item ascending in UTF-8 bytes. A lang with one source has no pair rows;
empty tables give no rows; repeated rows count as often as they occur; other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from synthcurate.session import broadcast_if_small

from .common import stored

# Fixed values of the audit.
MIN_DOCS = 30
TOP_TERMS = 50
SMOOTH = 5
SCALE = 1_000_000_000

# Entries (lang, term, source) a task holds before it spills its stripes.
STRIPE_ENTRIES = 1_000_000

# What lies between terms: ASCII other than letters (A-Z were lower-cased before).
_BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
_STRIPE_DDL = "lang string, term string, source string, docs bigint, count bigint"
_KEY = ["lang", "term", "source"]


def _combine(table: pa.Table) -> pa.Table:
    """Entries of equal key added up (a hash aggregation in Arrow)."""
    out = table.group_by(_KEY, use_threads=False).aggregate([("docs", "sum"), ("count", "sum")])
    return out.rename_columns({"docs_sum": "docs", "count_sum": "count"}).select([*_KEY, "docs", "count"])


def _entries(batch: pa.RecordBatch) -> pa.Table:
    """The stripe entries of a batch of documents: per (lang, term, source),
    documents that hold the term and its occurrences."""
    words = pc.split_pattern_regex(batch.column("text"), _BETWEEN)
    flat = pc.list_flatten(words)
    doc = pc.list_parent_indices(words)
    keep = pc.not_equal(flat, "")
    occurrences = pa.table({"doc": pc.filter(doc, keep), "term": pc.filter(flat, keep)})
    per_doc = occurrences.group_by(["doc", "term"], use_threads=False).aggregate([("term", "count")])
    at = per_doc.column("doc")
    return _combine(pa.table({
        "lang": pc.take(batch.column("lang"), at), "term": per_doc.column("term"), "source": pc.take(batch.column("source"), at),
        "docs": pa.repeat(pa.scalar(1, pa.int64()), per_doc.num_rows) if per_doc.num_rows else pa.array([], pa.int64()),
        "count": per_doc.column("term_count").cast(pa.int64()),
    }))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        part = _entries(batch)
        held.append(part)
        rows += part.num_rows
        if rows >= STRIPE_ENTRIES:
            table = _combine(pa.concat_tables(held))
            held, rows = [table], table.num_rows
            if rows >= STRIPE_ENTRIES // 2:
                yield from table.to_batches()
                held, rows = [], 0
    if held:
        yield from _combine(pa.concat_tables(held)).to_batches()


def stripes(docs: DataFrame) -> DataFrame:
    """Entries of the stripes of each task, spilled: (lang, term, source, docs, count)."""
    read = docs.select(
        F.translate(F.coalesce(F.col("text"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("text"),
        F.coalesce(F.col("lang"), F.lit("")).alias("lang"), F.coalesce(F.col("source"), F.lit("")).alias("source"),
    )
    return read.mapInArrow(_fold, _STRIPE_DDL)


def merged(docs: DataFrame) -> DataFrame:
    """Stripes merged by key, (lang, term, df, lang_count, counts by source). One
    shuffle by (lang, term): the stripes were combined in the tasks already."""
    by_source = stripes(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("docs").alias("docs"), F.sum("count").alias("count"),
    )
    return by_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("df"), F.sum("count").alias("lang_count"),
        F.map_from_entries(F.collect_list(F.struct("source", "count"))).alias("counts"),
    )


def _p(count: Column, n: Column, v: Column) -> Column:
    num = F.lit(SCALE).cast("decimal(38,0)") * (count + SMOOTH).cast("decimal(38,0)")
    return (F.lit(1) + F.floor(num / (n + SMOOTH * v).cast("decimal(38,0)"))).cast("bigint")


def audit(docs: DataFrame) -> DataFrame:
    """The audit rows: lang, source, part, item, value, rank."""
    kept = stored(merged(docs).filter(F.col("df") >= MIN_DOCS), "stripes-kept")
    # groups that occur, with their occurrences of kept terms; V and N of each lang
    groups = docs.select(F.coalesce(F.col("lang"), F.lit("")).alias("lang"), F.coalesce(F.col("source"), F.lit("")).alias("source")).distinct()
    occur = kept.select("lang", F.explode("counts").alias("source", "count")).groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = groups.join(occur, ["lang", "source"], "left").fillna(0, ["n"])
    per_lang = groups.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("source", "n"))).alias("groups"), F.sum("n").alias("lang_n"),
    ).join(kept.groupBy("lang").agg(F.count("*").alias("v")), "lang", "left").fillna(0, ["v"])
    per_lang = broadcast_if_small(per_lang)
    # each merged stripe emits its p values, one per source of its lang
    stripe = kept.join(per_lang, "lang").select(
        "lang", "term", _p(F.col("lang_count"), F.col("lang_n"), F.col("v")).alias("q"),
        F.transform("groups", lambda g: F.struct(
            g["source"].alias("source"), F.coalesce(F.col("counts")[g["source"]], F.lit(0)).alias("c"),
            _p(F.coalesce(F.col("counts")[g["source"]], F.lit(0)), g["n"], F.col("v")).alias("p"),
        )).alias("ps"),
    )
    terms = stripe.select("lang", "term", "q", F.explode("ps").alias("g")).filter((F.col("g.c") > 0) & (F.col("g.p") > F.col("q"))).select(
        "lang", F.col("g.source").alias("source"), F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("g.p") - F.col("q")).alias("value"),
    )
    diffs = stripe.select("lang", F.explode("ps").alias("a"), "ps").select(
        "lang", F.col("a.source").alias("source"),
        F.explode(F.transform(F.filter("ps", lambda b: b["source"] != F.col("a.source")), lambda b: F.struct(
            b["source"].alias("item"), F.abs(F.col("a.p") - b["p"]).alias("f"),
        ))).alias("d"),
    ).groupBy("lang", "source", F.col("d.item").alias("item")).agg(F.sum("d.f").alias("value"))
    # every pair of sources of a lang, 0 where no term is kept
    pairs = per_lang.select("lang", F.explode("groups.source").alias("source"), F.col("groups.source").alias("others")).select(
        "lang", "source", F.explode(F.filter("others", lambda o: o != F.col("source"))).alias("item"),
    )
    pairs = pairs.join(diffs, ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("bigint").alias("value"),
    )
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item").cast("binary"))
    ranked = pairs.unionByName(terms.withColumn("value", F.col("value").cast("bigint"))).withColumn("rank", F.row_number().over(order))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= TOP_TERMS))
