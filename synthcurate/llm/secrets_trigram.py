"""Secrets in text by a trigram index: Boolean trigram queries from each rule,
intersected with the trigrams of a document, then confirmed by the rule itself.

Every rule is a regular expression with a check of its match. From the parsed
expression ``trigram_query`` derives a Boolean query over trigrams that any
matching text must contain (Cox's construction for regular expressions: exact
sets of short strings, prefixes and suffixes, AND over concatenations, OR over
alternatives). Trigrams are compared with A-Z lower-cased on both sides, so the
query of a case-sensitive rule is a necessary condition too.

The index of a document is the set of query trigrams it contains. Those
postings are computed where the document is read, in Spark's generated code
(``instr`` on the lower-cased text), so intersecting them needs no shuffle; the
query of each rule is a Boolean column over them. Only rules whose query holds
run on the text, in an Arrow function over slices of rows. A rule without a
mandatory trigram (``hex``: any three hex digits) has the query TRUE and scans
every text in full.

``postings`` gives the same index as (doc_id, trigram) rows, for a stored index
that many rule sets can query; ``candidates_from_postings`` intersects it by a
join and a count per document, and equals the in-row evaluation (tested).

Results, per text: spans (start, end, kind) in code points, end exclusive,
leftmost non-overlapping within a kind, sorted by start and then by the order
of ``KINDS``. NULL and empty texts have none; very long texts are scanned whole;
equal rows give equal spans; other columns pass through untouched.
"""

from __future__ import annotations

import itertools
import re
from re import _parser as sre_parse
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, texts

# The three base rules of the contract, then well-known public
# formats of keys that the method adds.
RULES: list[tuple[str, str, int, int | None]] = [
    # kind, pattern, least length of the checked part, group checked (None: whole match)
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 1),
    ("access", r"AKIA[A-Z0-9]+", 18, None),
    ("hex", r"[0-9a-f]+", 16, None),
    ("private_key", r"-----BEGIN[A-Z ]*PRIVATE KEY-----", 0, None),
    ("github", r"gh[pousr]_[A-Za-z0-9]+", 40, None),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15, None),
    ("google", r"AIza[0-9A-Za-z_-]+", 39, None),
    ("stripe", r"[rs]k_live_[0-9A-Za-z]+", 32, None),
]
KINDS = [kind for kind, *_ in RULES]
BASE = KINDS[:3]
_COMPILED = [(kind, re.compile(p), least, group) for kind, p, least, group in RULES]

# A set of strings of a sub-expression is kept exact up to this size.
MAX_EXACT = 16
# A character class of at most this many characters is a set of strings.
MAX_CLASS = 8


# --- Boolean trigram queries -------------------------------------------------

ANY = ("any",)


def _and(*qs):
    flat = []
    for q in qs:
        flat += list(q[1]) if q[0] == "and" else [] if q == ANY else [q]
    flat = tuple(sorted(set(flat), key=repr))
    return ANY if not flat else flat[0] if len(flat) == 1 else ("and", flat)


def _or(*qs):
    if not qs or any(q == ANY for q in qs):
        return ANY
    flat = []
    for q in qs:
        flat += list(q[1]) if q[0] == "or" else [q]
    flat = tuple(sorted(set(flat), key=repr))
    return flat[0] if len(flat) == 1 else ("or", flat)


def _strings(strings: set[str]):
    """Query of a set of strings: one of them, each with all its trigrams."""
    return _or(*[_and(*[("tri", s[i:i + 3]) for i in range(len(s) - 2)]) for s in strings])


@dataclass
class _Info:
    exact: set[str] | None
    prefix: set[str]
    suffix: set[str]
    match: tuple
    empty: bool

    def loose(self) -> "_Info":
        """The same facts without the exact set."""
        if self.exact is None:
            return self
        return _Info(None, {s[:2] for s in self.exact}, {s[-2:] for s in self.exact}, _and(self.match, _strings(self.exact)), self.empty)


_UNKNOWN = _Info(None, {""}, {""}, ANY, True)


def _lower1(c: str) -> str:
    return c.lower() if "A" <= c <= "Z" else c


def _chars(op, av) -> set[str] | None:
    if op == sre_parse.LITERAL:
        return {_lower1(chr(av))}
    if op == sre_parse.IN:
        out = set()
        for sub_op, sub_av in av:
            if sub_op == sre_parse.LITERAL:
                out.add(chr(sub_av))
            elif sub_op == sre_parse.RANGE and sub_av[1] - sub_av[0] < MAX_CLASS:
                out |= {chr(c) for c in range(sub_av[0], sub_av[1] + 1)}
            else:
                return None
        out = {_lower1(c) for c in out}
        return out if len(out) <= MAX_CLASS else None
    return None


def _concat(a: _Info, b: _Info) -> _Info:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MAX_EXACT:
        return _Info({x + y for x in a.exact for y in b.exact}, set(), set(), _and(a.match, b.match), a.empty and b.empty)
    la, lb = a.loose(), b.loose()
    # what spans the border: a suffix of the left side followed by a prefix of the right
    cross = _or(*[_strings({x + y}) for x in la.suffix for y in lb.prefix]) if len(la.suffix) * len(lb.prefix) <= MAX_EXACT else ANY
    prefix = la.prefix | lb.prefix if a.empty else la.prefix
    suffix = la.suffix | lb.suffix if b.empty else lb.suffix
    return _Info(None, prefix, suffix, _and(la.match, lb.match, cross), a.empty and b.empty)


def _alternate(infos: list[_Info]) -> _Info:
    empty = any(i.empty for i in infos)
    if all(i.exact is not None for i in infos) and sum(len(i.exact) for i in infos) <= MAX_EXACT:
        return _Info(set().union(*[i.exact for i in infos]), set(), set(), _or(*[i.match for i in infos]), empty)
    loose = [i.loose() for i in infos]
    return _Info(None, set().union(*[i.prefix for i in loose]), set().union(*[i.suffix for i in loose]), _or(*[i.match for i in loose]), empty)


def _item(op, av) -> _Info:
    chars = _chars(op, av)
    if chars is not None:
        return _Info(chars, set(), set(), ANY, False)
    if op == sre_parse.SUBPATTERN:
        return _info(av[-1])
    if op == sre_parse.BRANCH:
        return _alternate([_info(b) for b in av[1]])
    if op in (sre_parse.MAX_REPEAT, sre_parse.MIN_REPEAT, getattr(sre_parse, "POSSESSIVE_REPEAT", None)):
        low, high, body = av
        inner = _info(body)
        if low == 0:
            return _UNKNOWN
        if low == high == 1:
            return inner
        # the body at least once: its demands, its start and its end
        loose = inner.loose()
        return _Info(None, loose.prefix, loose.suffix, loose.match, inner.empty)
    if op == sre_parse.AT:
        return _Info({""}, set(), set(), ANY, True)
    return _UNKNOWN


def _info(parsed) -> _Info:
    """Facts of a sequence; runs of exact items are joined before they meet a loose one."""
    out, run = _Info({""}, set(), set(), ANY, True), None
    for op, av in parsed:
        item = _item(op, av)
        if item.exact is not None and run is not None and len(run.exact) * len(item.exact) <= MAX_EXACT:
            run = _concat(run, item)
            continue
        if run is not None:
            out = _concat(out, run)
        run = item if item.exact is not None else None
        if run is None:
            out = _concat(out, item)
    return _concat(out, run) if run is not None else out


def trigram_query(pattern: str) -> tuple:
    """The Boolean trigram query that every match of ``pattern`` satisfies:
    ("tri", s), ("and", [...]), ("or", [...]) or ANY."""
    info = _info(sre_parse.parse(pattern)).loose()
    return info.match


def query_trigrams(query: tuple) -> set[str]:
    if query[0] == "tri":
        return {query[1]}
    if query[0] in ("and", "or"):
        return set().union(*[query_trigrams(q) for q in query[1]])
    return set()


QUERIES = {kind: trigram_query(pattern) for kind, pattern, *_ in RULES}
TRIGRAMS = sorted(set().union(*[query_trigrams(q) for q in QUERIES.values()]))


# --- matching ------------------------------------------------------------------

def matches(text: str, kind: str) -> list[tuple[int, int, str]]:
    """Spans of one rule: leftmost non-overlapping matches whose checked part is long enough."""
    _, pattern, least, group = _COMPILED[KINDS.index(kind)]
    out = []
    for m in pattern.finditer(text):
        part = m.group(group) if group else m.group()
        if len(part) >= least:
            out.append((m.start(), m.end(), kind))
    return out


def find(text: str, kinds: list[str] | None = None) -> list[tuple[int, int, str]]:
    """Spans of the given rules (all by default), by start and then order of ``KINDS``."""
    found = [s for kind in (KINDS if kinds is None else kinds) for s in matches(text, kind)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType())])))
def _verify(text: pa.Array, mask: pa.Array) -> pa.Array:
    masks = mask.to_pylist()
    out, at = [], 0
    for part in texts(text):
        rows = []
        for raw in part:
            bits = masks[at]
            at += 1
            kinds = [k for i, k in enumerate(KINDS) if bits >> i & 1]
            spans = find((raw or b"").decode("utf-8"), kinds) if kinds and raw else []
            rows.append([{"start": a, "end": b, "kind": k} for a, b, k in spans])
        out.append(pa.array(rows, _SPAN))
    return pa.concat_arrays(out) if out else pa.array([], _SPAN)


def _lower(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _holds(query: tuple, present: dict[str, Column]) -> Column:
    if query == ANY:
        return F.lit(True)
    if query[0] == "tri":
        return present[query[1]]
    parts = [_holds(q, present) for q in query[1]]
    return reduce(lambda a, b: (a & b) if query[0] == "and" else (a | b), parts)


def candidate_mask(text: Column) -> Column:
    """Bit i set when the trigram query of rule i holds for the text (JVM side)."""
    low = _lower(text)
    present = {t: F.instr(low, t) > 0 for t in TRIGRAMS}
    bits = [F.when(_holds(QUERIES[k], present), F.lit(1 << i)).otherwise(F.lit(0)) for i, k in enumerate(KINDS)]
    return reduce(lambda a, b: a + b, bits).cast("int")


def secrets(text: Column) -> Column:
    """Spans of all rules, as an array of (start, end, kind), confirmed on the candidates of the index."""
    return _verify(text, candidate_mask(text))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a column ``secrets`` (a fresh name if taken) of spans."""
    return docs.withColumn(fresh(docs, "secrets"), secrets(F.col(text)))


def postings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The index as rows: (key, trigram) for each query trigram a text contains."""
    low = _lower(F.col(text))
    present = F.array(*[F.when(F.instr(low, t) > 0, F.lit(t)) for t in TRIGRAMS]) if TRIGRAMS else F.array()
    return docs.select(F.col(key).alias("key"), F.explode(F.array_compact(present)).alias("trigram"))


def _dnf(query: tuple) -> list[frozenset[str]]:
    if query == ANY:
        return [frozenset()]
    if query[0] == "tri":
        return [frozenset([query[1]])]
    parts = [_dnf(q) for q in query[1]]
    if query[0] == "or":
        return [c for p in parts for c in p]
    return [frozenset().union(*combo) for combo in itertools.product(*parts)]


def candidates_from_postings(index: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, kind) for each rule whose query the postings of a key meet. The
    conjunctions of a query are a small table; each is intersected with the
    postings by a join and a count of its trigrams per key. ``keys`` lists all
    keys, for rules that need no trigram."""
    spark = index.sparkSession
    conj = [(kind, n, t, len(c)) for kind in KINDS for n, c in enumerate(_dnf(QUERIES[kind])) for t in sorted(c)]
    free = [(kind,) for kind in KINDS if any(len(c) == 0 for c in _dnf(QUERIES[kind]))]
    table = spark.createDataFrame(conj, "kind string, conj int, trigram string, size int")
    met = (
        index.join(F.broadcast(table), "trigram").groupBy("key", "kind", "conj", "size").agg(F.count_distinct("trigram").alias("n"))
        .filter("n = size").select("key", "kind")
    )
    every = keys.select("key", F.explode(F.array(*[F.lit(k) for (k,) in free])).alias("kind")) if free else None
    return (met.unionByName(every) if every is not None else met).distinct()
