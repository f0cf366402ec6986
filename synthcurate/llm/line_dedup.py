"""Line deduplication by a deletion-neighbourhood join, in DataFrame functions only.

A line is removed if an earlier line, by (document id, place), equals it or is
within one character edit of it (insertion, deletion, replacement). Spaces, tabs
and returns at the ends of a line do not count. Lines of fewer than
``MIN_EXACT`` characters stay; lines of fewer than ``MIN_CHARS`` are removed for
equality only.

1. Equal lines: the earliest place of each distinct line, by a hash of two
   64-bit numbers. Only numbers are shuffled.
2. Two lines one edit apart share their first or their last half. Distinct lines
   that share no half with another line of fitting length have no partner and
   leave here, before anything large is made of them.
3. Each remaining line emits its deletion neighbourhood as hashed keys: what is
   left of the line without the character at each place, and the line itself for
   those with a character more. A line is cut into blocks of about the square
   root of its length; a key is made of the hashes before and after a block and
   of the block without a character, so a line of n characters costs n times
   the block, not n times n. A block whose surroundings no other line has cannot
   hold the one edit and emits nothing.
4. Lines that agree on a key differ in that place only, so the earliest of them
   stands for all and no pairs within a key are listed. ``levenshtein`` confirms.

Lines of one key that miss the same character are one edit apart from each
other; a line and those with one character more are told apart in a key by
their length. Every line thus meets its earliest partner.

Defined results: NULL texts have no lines and stay NULL. Ids that are NULL come
last. Rows that repeat both id and text are one document: their lines share
places and go or stay together. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, stored

MIN_EXACT = 10
MIN_CHARS = 32
MIN_BLOCK = 64
PLACE = ("doc", "version", "pos")
_LAST = 2**63 - 1


def _document(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """Sort key of a document: its id, and a hash to tell texts of one id apart."""
    return F.coalesce(doc_id.cast("bigint"), F.lit(_LAST)), F.xxhash64(text)


def _two_hashes(*parts: Column | str) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)


def _half_keys(text: Column, n: Column) -> Column:
    """Hashes of both halves, cut for partners of equal length or one more, and
    for partners of one less."""
    keys = []
    for length in (n, n - 1):
        half = F.floor(length / 2).cast("int")
        keys.append(F.xxhash64(F.lit("first"), length, F.substring(text, F.lit(1), half)))
        keys.append(F.xxhash64(F.lit("last"), length, F.substring(text, n - length + half + 1, length - half)))
    return F.when(n >= MIN_CHARS, F.array(*keys))


def lines_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Place, hashes, length and half keys of every line that may be removed."""
    doc, version = _document(F.col(doc_id), F.col(text))
    rows = docs.select(doc.alias("doc"), version.alias("version"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    rows = rows.withColumn("line", F.btrim("line", F.lit(" \t\r"))).withColumn("n", F.char_length("line")).filter(F.col("n") >= MIN_EXACT)
    h1, h2 = _two_hashes("line")
    return rows.select(*PLACE, h1.alias("h1"), h2.alias("h2"), "n", _half_keys(F.col("line"), F.col("n")).alias("halves"))


def with_possible_partner(distinct: DataFrame) -> DataFrame:
    """Places of distinct lines that share a half with another one. A clash of
    hashes only lets one line more through."""
    halves = stored(distinct.filter("halves is not null").select("place", F.explode("halves").alias("half")), "line-halves")
    shared = stored(halves.groupBy("half").agg(F.count("*").alias("lines")).filter("lines > 1").select(F.col("half").alias("of")), "shared-halves")
    return halves.join(shared, F.col("half") == F.col("of")).select("place").distinct()


def blocks_of(lines: DataFrame) -> DataFrame:
    """Blocks of (place, line) with hashes of what is around them. ``longer``
    marks a line as the one with a character more than its partner."""
    n = F.char_length("line")
    as_class = F.inline(F.array(
        F.struct(F.lit(False).alias("longer"), n.alias("length")), F.struct(F.lit(True).alias("longer"), (n - 1).alias("length")),
    ))
    rows = lines.select("place", "line", as_class).filter(F.col("length") >= MIN_CHARS)
    rows = rows.withColumn("size", F.greatest(F.lit(MIN_BLOCK), F.ceil(F.sqrt("length")).cast("int")))
    starts = F.sequence(F.lit(0), F.floor((F.col("length") - 1) / F.col("size")).cast("int"))
    rows = rows.select("*", F.explode(F.transform(starts, lambda i: i * F.col("size"))).alias("start"))
    after = F.greatest(F.lit(0), F.col("length") - F.col("start") - F.col("size"))
    more = F.col("longer").cast("int")
    before = F.substring("line", F.lit(1), F.col("start"))
    behind = F.substring("line", F.col("length") + more - after + 1, after)
    h1, h2 = _two_hashes("length", "start", before, behind)
    block = F.substring("line", F.col("start") + 1, F.col("length") + more - after - F.col("start"))
    return rows.select("place", "longer", h1.alias("around1"), h2.alias("around2"), block.alias("block"))


def neighbourhood(blocks: DataFrame) -> DataFrame:
    """Keys of the blocks without each of their characters, and of the shorter
    lines' whole blocks. Keys for replacements hold the place in the block."""
    without = F.transform(
        F.sequence(F.lit(1), F.char_length("block")),
        lambda i: F.struct(i.alias("at"), F.concat(F.substring("block", F.lit(1), i - 1), F.substring("block", i + 1, F.char_length("block"))).alias("rest")),
    )
    whole = F.struct(F.lit(0).alias("at"), F.col("block").alias("rest"))
    variants = F.when(F.col("longer"), without).otherwise(F.concat(F.array(whole), without))
    rows = blocks.select("place", "longer", "around1", "around2", F.inline(variants))
    # Of a longer line any character may be the one more.
    at = F.when(F.col("longer"), F.lit(0)).otherwise(F.col("at"))
    h1, h2 = _two_hashes("around1", "around2", at, "rest")
    return rows.select("place", "longer", h1.alias("k1"), h2.alias("k2"))


def partners(lines: DataFrame) -> DataFrame:
    """(place, partner): the earliest line of each shared key, where it is
    earlier. Only blocks emit variants whose surroundings another line shares."""
    blocks = stored(blocks_of(lines), "line-blocks")
    around = blocks.groupBy(F.col("around1").alias("a1"), F.col("around2").alias("a2")).agg(F.count("*").alias("lines"))
    around = stored(around.filter("lines > 1").drop("lines"), "shared-blocks")
    keys = neighbourhood(blocks.join(around, (F.col("around1") == F.col("a1")) & (F.col("around2") == F.col("a2"))))
    groups = keys.groupBy(F.col("k1").alias("g1"), F.col("k2").alias("g2")).agg(
        F.count("*").alias("lines"), F.min(F.when(~F.col("longer"), F.col("place"))).alias("first"),
        F.min(F.when(F.col("longer"), F.col("place"))).alias("first_longer"),
    )
    groups = stored(groups.filter("lines > 1").drop("lines"), "line-keys")
    met = keys.join(groups, (F.col("k1") == F.col("g1")) & (F.col("k2") == F.col("g2")))
    # The shorter line meets the first longer one; lines of equal length meet the
    # first of them; a longer line meets the shorter.
    partner = F.when(F.col("longer"), F.col("first")).otherwise(F.least("first", "first_longer"))
    return met.select("place", partner.alias("partner")).filter("partner < place").distinct()


def near_lines(docs: DataFrame, distinct: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Places of distinct lines with an earlier line one edit away."""
    wanted = with_possible_partner(distinct).select("place.*").groupBy("doc", "version").agg(F.collect_list("pos").alias("places"))
    doc, version = _document(F.col(doc_id), F.col(text))
    source = docs.select(doc.alias("d"), version.alias("v"), F.col(text).alias("t")).filter("t is not null")
    found = source.join(wanted, (F.col("d") == F.col("doc")) & (F.col("v") == F.col("version")))
    all_lines = F.split("t", "\n", -1)
    picked = found.select("doc", "version", all_lines.alias("all"), F.explode("places").alias("pos"))
    picked = picked.select(F.struct(*PLACE).alias("place"), F.btrim(F.col("all")[F.col("pos")], F.lit(" \t\r")).alias("line")).distinct()
    lines = stored(picked, "near-lines")
    pairs = stored(partners(lines), "line-partners")
    a = lines.select(F.col("place").alias("a"), F.col("line").alias("line_a"))
    b = lines.select(F.col("place").alias("b"), F.col("line").alias("line_b"))
    both = pairs.join(a, F.col("place") == F.col("a")).join(b, F.col("partner") == F.col("b"))
    return both.filter(F.levenshtein("line_a", "line_b", 1).between(0, 1)).select("place").distinct()


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, version, equal, near): places of the lines to remove, for every
    document that has some."""
    lines = stored(lines_of(docs, doc_id, text), "lines")
    groups = lines.groupBy("h1", "h2").agg(
        F.min(F.struct(*PLACE)).alias("place"), F.count("*").alias("times"), F.max("halves").alias("halves"),
    )
    distinct = stored(groups, "distinct-lines")
    near = near_lines(docs, distinct, doc_id, text).select(F.col("place").alias("near_place"))
    marked = distinct.join(near, F.col("place") == F.col("near_place"), "left")
    marked = stored(
        marked.filter("times > 1 or near_place is not null")
        .select(F.col("h1").alias("m1"), F.col("h2").alias("m2"), "place", F.col("near_place").isNotNull().alias("near")), "marked-lines",
    )
    gone = lines.join(marked, (F.col("h1") == F.col("m1")) & (F.col("h2") == F.col("m2"))).filter(
        F.col("near") | (F.struct(*PLACE) != F.col("place")))
    equal = F.struct(*PLACE) != F.col("place")
    return gone.groupBy("doc", "version").agg(
        F.sort_array(F.collect_set(F.when(equal, F.col("pos")))).alias("equal"),
        F.sort_array(F.collect_set(F.when(~equal, F.col("pos")))).alias("near"),
    )


def decisions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document its id, its number of lines and the places removed."""
    gone = removals(docs, doc_id, text)
    doc, version = _document(F.col(doc_id), F.col(text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), doc.alias("d"), version.alias("v"), F.coalesce(F.size(F.split(text, "\n", -1)), F.lit(0)).alias("n_lines"))
    rows = rows.join(gone, (F.col("d") == F.col("doc")) & (F.col("v") == F.col("version")), "left")
    none = F.array().cast("array<int>")
    return rows.select("doc_id", F.greatest("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("equal", none).alias("equal"), F.coalesce("near", none).alias("near"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_empty: bool = False) -> DataFrame:
    """The documents with their kept lines. A document that loses its last line
    with characters leaves, unless ``keep_empty``."""
    gone = removals(docs, doc_id, text)
    doc, version = _document(F.col(doc_id), F.col(text))
    names = [fresh(docs, f"_{k}") for k in ("gone", "doc", "version")]
    places, d, v = names
    gone = gone.select(F.col("doc").alias(d), F.col("version").alias(v), F.array_union("equal", "near").alias(places))
    rows = docs.join(gone, (doc == F.col(d)) & (version == F.col(v)), "left")
    lines = F.split(text, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(places))
    new = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    rows = rows.withColumn(text, F.when(F.col(places).isNull(), F.col(text)).otherwise(new))
    if not keep_empty:
        rows = rows.filter(F.col(places).isNull() | F.col(text).rlike(r"[^ \t\r\n]"))
    return rows.drop(*names)
