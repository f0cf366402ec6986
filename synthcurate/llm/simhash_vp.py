"""Near duplicates: SimHash fingerprints linked through vantage-point trees.

Equal fingerprints are merged first, with the smallest id of each, so copies
cost nothing further. The distinct fingerprints are dealt into shards by their
Hamming distances from vantage points, in two steps:

* A forest of trees, each over a segment of the fingerprint. In the tree of a
  segment in which two fingerprints agree both lie at the same distance from
  every vantage point, so rings around the points are shards that need no
  overlap. With one segment more than the ``bits`` allowed to differ some
  segment agrees: the forest misses no link.
* Where rings would grow too large, a tree over whole fingerprints cuts them
  further. By the triangle bound a fingerprint has partners on the other side of
  a radius only if its own distance is within ``bits`` of it; it then visits that
  shard as well.

Within a shard a vantage-point tree is built on the fly and searched with the
same bound. What lies within ``bits`` of a vantage point is one component at
once, whose pairs are never compared; the rest is compared directly. A shard
reports a spanning forest of its links, not pairs. Forests are joined by rounds
of large-star and small-star steps, each a grouping and a join over stored edges.

``keep_one`` decides by the Jaccard similarity of whole sets of five-word shingles.
Fingerprints tell that too roughly, so it takes candidates from MinHash bands and
confirms each by its exact similarity; see ``similar``.

Vantage points come from the ``SAMPLE`` fingerprints that are first by hash; they
decide how evenly shards fill, not what is found.

Defined results: NULL text is empty; texts without words have fingerprint zero.
A NULL id never is a component's id unless all its ids are NULL. Rows that repeat
an id and text have the same component.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, stored, text_udf

SAMPLE = 4096
#: Vantage points of a segment tree, and fingerprints of a shard before it is cut.
RINGS = 8
SHARD_ROWS = 20_000
LEAF = 64
BLOCK = 1 << 20
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


@dataclass(frozen=True)
class Plan:
    """``words`` 64-bit parts of a fingerprint; ``bits`` that may differ;
    segments of each of ``rounds`` ways to deal the bits out."""

    shingle: int = 4
    words: int = 1
    bits: int = 4
    segments: int = 5
    rounds: int = 1


#: Links at four bits, without a miss.
EXACT = Plan()
#: Five-word shingles by fingerprints alone. At a Jaccard similarity of 0.8, 39 of
#: 256 bits are expected to differ, with a deviation of six: a rough cut, which
#: misses a sixth of the pairs there and takes half of those at 0.75.
SIMILAR = Plan(shingle=5, words=4, bits=44, segments=19, rounds=2)
#: Shingles have ``SHINGLE`` words; a link has a similarity of ``NEAR[0] / NEAR[1]`` at
#: least. A pair at 0.8 shares one of the bands with probability
#: 1 - (1 - 0.8 ** BAND_ROWS) ** BANDS = 0.9993, at whatever length of the texts.
SHINGLE = 5
NEAR = (4, 5)
BANDS, BAND_ROWS = 24, 6
_FACTORS, _MASKS = (np.array([xxhash.xxh64_intdigest(b"%d" % i, seed) | 1 for i in range(BANDS * BAND_ROWS)], np.uint64)[:, None] for seed in (1, 2))
SKETCH = "struct<fp:binary,n:bigint,bands:array<bigint>>"
_SKETCH = pa.struct([("fp", pa.binary()), ("n", pa.int64()), ("bands", pa.list_(pa.int64()))])


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """Hashes of all shingles in their order; fewer words are one shingle."""
    words = text.lower().split()
    n, joined, digest = len(words), b" ".join(words), xxhash.xxh64_intdigest
    if n <= shingle:
        return np.array([digest(joined, 42)] if n else [], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist())], np.uint64)


def fingerprint(text: bytes, plan: Plan = EXACT) -> bytes:
    """The SimHash, most significant byte first. Parts after the first use the
    shingle hashes mixed with the number of the part."""
    values, out = shingle_hashes(text, plan.shingle), []
    if not len(values):
        return bytes(8 * plan.words)
    for part in range(plan.words):
        mixed = values
        if part:
            mixed = values + np.uint64(part * _MIX[0] % 2**64)
            mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(_MIX[1])
            mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(_MIX[2])
            mixed = mixed ^ (mixed >> np.uint64(31))
        counts = np.zeros(64, np.int64)
        for at in range(0, len(mixed), 1 << 15):
            bits = np.unpackbits(mixed[at : at + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            counts += bits.sum(0, dtype=np.int64)
        out.append(np.packbits(2 * counts > len(mixed)).tobytes())
    return b"".join(out)


def fingerprints(text: Column, plan: Plan = EXACT) -> Column:
    return text_udf(lambda b: fingerprint(b, plan), pa.binary(), "binary")(text)


def _matrix(values: list[bytes], words: int) -> np.ndarray:
    """Fingerprints as rows of 64-bit numbers."""
    return np.frombuffer(b"".join(values), ">u8").reshape(-1, words).astype(np.uint64)


def _distance(values: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values ^ point).sum(-1, dtype=np.int32)


@dataclass(frozen=True)
class Node:
    """``radius`` splits by distance from ``point``; a leaf has a number only."""

    leaf: int = -1
    point: np.ndarray | None = None
    radius: int = 0
    inner: Node | None = None
    outer: Node | None = None


def build_tree(sample: np.ndarray, depth: int) -> Node:
    """A tree of at most ``depth`` levels with median radii over the sample."""
    leaves = iter(range(1 << 30))

    def grow(values: np.ndarray, levels: int) -> Node:
        if levels and len(values) > 1:
            point = values[0]
            away = _distance(values, point)
            radius = int(np.sort(away)[(len(away) - 1) // 2])
            inside = away <= radius
            if not inside.all():
                return Node(-1, point, radius, grow(values[inside], levels - 1), grow(values[~inside], levels - 1))
        return Node(next(leaves))

    return grow(sample, depth)


def visits(tree: Node, values: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(leaf, indices, at home) for all leaves a value lies in or may have
    partners in. Of two leaves only the one of smaller number is visited."""
    home = np.empty(len(values), np.int64)
    found = []
    stack = [(tree, np.arange(len(values)), np.ones(len(values), bool))]
    while stack:
        node, at, own = stack.pop()
        if node.inner is None:
            home[at[own]] = node.leaf
            found.append((node.leaf, at, own))
            continue
        away = _distance(values[at], node.point)
        inside = away <= node.radius
        go = away <= node.radius + bits
        stack.append((node.inner, at[go], own[go] & inside[go]))
        go = away > node.radius - bits
        stack.append((node.outer, at[go], own[go] & ~inside[go]))
    for leaf, at, own in found:
        goes = own | (home[at] > leaf)
        yield leaf, at[goes], own[goes]


def segments(plan: Plan) -> list[np.ndarray]:
    """Bit places of every segment; later rounds step through the bits in odd strides."""
    total, out = 64 * plan.words, []
    for turn in range(plan.rounds):
        places = np.arange(total) * (1 + 100 * turn) % total
        out += np.array_split(places, plan.segments)
    return out


def segment_values(values: np.ndarray, plan: Plan) -> Iterator[np.ndarray]:
    bits = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(len(values), 8 * plan.words), axis=1).astype(np.int64)
    for places in segments(plan):
        yield bits[:, places] @ (1 << np.arange(len(places), dtype=np.int64))


def deal(distinct: DataFrame, sample: np.ndarray, depth: int, plan: Plan) -> DataFrame:
    """(segment, leaf, ring, id, fp, home) rows of every fingerprint (id, fp)."""
    tree = build_tree(sample, depth)
    points = [list(dict.fromkeys(v.tolist()))[:RINGS] for v in segment_values(sample, plan)]

    def work(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            values, rings = _matrix(batch.column(1).to_pylist(), plan.words), []
            for part, own_points in zip(segment_values(values, plan), points):
                ring = np.zeros(len(values), np.int64)
                for p in own_points:
                    ring = ring * 32 + np.bitwise_count(part ^ p)  # of fewer than 32 bits
                rings.append(ring)
            for leaf, at, own in visits(tree, values, plan.bits):
                rows = pa.array(at)
                for segment, ring in enumerate(rings):
                    yield pa.record_batch({
                        "segment": pa.array(np.full(len(at), segment, np.int32)), "leaf": pa.array(np.full(len(at), leaf, np.int32)),
                        "ring": pa.array(ring[at]), "id": batch.column(0).take(rows), "fp": batch.column(1).take(rows), "home": pa.array(own),
                    })

    return distinct.select("id", "fp").mapInArrow(work, "segment int, leaf int, ring bigint, id bigint, fp binary, home boolean")


class Forest:
    """Smallest index of each set; links come as arrays."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root[a], self.root[b]
            apart = a != b
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(above := self.root[self.root], self.root):
                self.root = above


def link(values: np.ndarray, home: np.ndarray, bits: int) -> Forest:
    """Join all pairs within ``bits`` of which one is at home: a vantage-point
    tree over those at home, searched by all."""
    forest = Forest(len(values))
    stack = [(np.flatnonzero(home), np.arange(len(values)), True)]
    while stack:
        data, query, whole = stack.pop()
        if not len(data) or not len(query):
            continue
        if len(data) > LEAF:
            point = data[len(data) // 2]
            away, reach = _distance(values[data], values[point]), _distance(values[query], values[point])
            close, within = away <= bits, reach <= bits
            if whole and close.sum() > max(LEAF, len(data) // 8):
                # One component; its members need only those within twice the bound.
                for group in (data[close], query[within]):
                    forest.join(group, np.full(len(group), point))
                stack.append((data[close], query[~within & (reach <= 2 * bits)], False))
                stack.append((data[~close & (away <= 2 * bits)], query[within], False))
                stack.append((data[~close], query[~within], True))
                continue
            radius = int(np.sort(away)[(len(away) - 1) // 2])
            inside = away <= radius
            if not inside.all():
                stack.append((data[inside], query[reach <= radius + bits], whole))
                stack.append((data[~inside], query[reach > radius - bits], whole))
                continue
        rows = max(1, BLOCK // len(data))
        for at in range(0, len(query), rows):
            part = query[at : at + rows]
            apart = np.zeros((len(part), len(data)), np.int32)
            for word in range(values.shape[1]):
                apart += np.bitwise_count(values[part, word][:, None] ^ values[data, word][None, :])
            q, d = np.nonzero(apart <= bits)
            forest.join(part[q], data[d])
    return forest


def links(shards: DataFrame, plan: Plan) -> DataFrame:
    """(a, b) edges, b < a, of a spanning forest of every shard."""
    keys = ["segment", "leaf", "ring"]

    def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        rows = pa.Table.from_batches(held)
        if len(rows) < 2:
            return None
        ids, home = rows.column("id").to_numpy(), rows.column("home").to_numpy()
        values, order = _matrix(rows.column("fp").to_pylist(), plan.words), np.argsort(ids, kind="stable")
        ids = ids[order]
        root = link(values[order], home[order], plan.bits).root
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.record_batch({"a": pa.array(ids[moved]), "b": pa.array(ids[root[moved]])})

    def work(batches):
        key, held = None, []
        for batch in batches:
            columns = [np.asarray(batch.column(i)) for i in range(3)]
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            bounds = [0, *change.tolist(), batch.num_rows]
            for low, high in zip(bounds, bounds[1:]):
                if low == high:
                    continue
                this = tuple(int(c[low]) for c in columns)
                if held and this != key:
                    if (out := solve(held)) is not None and out.num_rows:
                        yield out
                    held = []
                key = this
                held.append(batch.slice(low, high - low))
        if held and (out := solve(held)) is not None:
            yield out

    dealt = shards.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(work, "a bigint, b bigint")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: every node ties its larger (or its other) neighbours to the
    smallest node it sees."""
    if large:
        seen = edges.union(edges.select("b", "a")).toDF("u", "v")
    else:
        seen = edges.select(F.greatest("a", "b"), F.least("a", "b")).toDF("u", "v")
    least = seen.groupBy("u").agg(F.min("v").alias("least")).select(F.col("u").alias("n"), F.least("u", "least").alias("least"))
    tied = seen.join(stored(least, "star"), F.col("u") == F.col("n"))
    if large:
        pairs = tied.filter("v > u").select(F.col("v").alias("a"), F.col("least").alias("b"))
    else:
        pairs = tied.select(F.inline(F.array(
            F.struct(F.col("v").alias("a"), F.col("least").alias("b")), F.struct(F.col("u").alias("a"), F.col("least").alias("b")),
        )))
    return pairs.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of every component that has an edge."""
    edges = stored(edges.filter("a <> b").distinct(), "links")
    before = None
    while True:
        edges = stored(_star(_star(edges, large=True), large=False), "links")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def classes(rows: DataFrame, plan: Plan = EXACT, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(fp, root, component) for ``rows`` (doc_id, fp): a number and the smallest
    id of each fingerprint's component."""
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    distinct = stored(distinct.withColumn("id", F.monotonically_increasing_id()), "fingerprints")
    n = distinct.count()
    sample = _matrix(distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toArrow().column("fp").to_pylist(), plan.words)
    # Cutting by whole fingerprints helps only where few reach across a radius.
    cells = 2 ** min(64 * plan.words // plan.segments, 13)
    depth = int(n / (shard_rows * cells)).bit_length() if 8 * plan.bits <= 64 * plan.words else 0
    roots = components(links(deal(distinct, sample, depth, plan), plan))
    tied = distinct.join(roots, F.col("id") == F.col("node"), "left")
    tied = stored(tied.select("fp", "least", F.coalesce("root", "id").alias("root")), "rooted")
    top = stored(tied.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component")), "components")
    return tied.join(top, F.col("root") == F.col("of")).select("fp", "root", "component")


def near_duplicates(docs: DataFrame, plan: Plan = EXACT) -> DataFrame:
    """(doc_id, version, fp, root, component) of every document; ``version`` is
    a hash of the text, to tell texts of one id apart."""
    rows = stored(docs.select("doc_id", F.xxhash64("text").alias("version"), fingerprints(F.col("text"), plan).alias("fp")), "simhash")
    found = classes(rows.select("doc_id", "fp"), plan)
    found = stored(found.select(F.col("fp").alias("of"), "root", "component"), "classes")
    return rows.join(found, F.col("fp") == F.col("of")).select("doc_id", "version", "fp", "root", "component")


def bands(values: np.ndarray) -> np.ndarray:
    """A number for each band of the MinHash of a set of hashes; none of an empty set."""
    if not len(values):
        return np.array([], np.int64)
    least = np.full(BANDS * BAND_ROWS, -1).astype(np.uint64)
    for at in range(0, len(values), 1 << 11):
        np.minimum(least, ((values[at : at + (1 << 11)] ^ _MASKS) * _FACTORS).min(1), out=least)
    rows = least.reshape(BANDS, BAND_ROWS)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(rows)], np.uint64).view(np.int64)


def sketch(text: bytes) -> dict:
    """A digest of the set of shingles, its size and its bands."""
    values = np.unique(shingle_hashes(text, SHINGLE))
    return {"fp": xxhash.xxh3_128_digest(values.tobytes()), "n": len(values), "bands": bands(values)}


def _shingle_set(text: Column) -> Column:
    each = lambda b: np.unique(shingle_hashes(b, SHINGLE)).view(np.int64)
    return text_udf(each, pa.list_(pa.int64()), "array<bigint>")(text)


def _may_link(n: Column, m: Column) -> Column:
    """Sets of sizes too far apart cannot be similar."""
    return NEAR[1] * F.least(n, m) >= NEAR[0] * F.greatest(n, m)


def confirmed(pairs: DataFrame, docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """Those of the (a, b) pairs whose shingle sets have the similarity, counted exactly.
    Sets are made of the texts in ``pairs`` only."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("of")).distinct()
    own = distinct.join(needed, F.col("id") == F.col("of"), "left_semi").select("id", "text_of")
    named = docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("v"), "text")
    found = named.join(own, F.col("d").eqNullSafe(F.col("text_of.doc_id")) & (F.col("v") == F.col("text_of.version")))
    sets = stored(found.select("id", "text").dropDuplicates(["id"]).select("id", _shingle_set(F.col("text")).alias("set")), "sets")
    both = pairs.join(sets.toDF("a_id", "a_set"), F.col("a") == F.col("a_id")).join(sets.toDF("b_id", "b_set"), F.col("b") == F.col("b_id"))
    both = both.select("a", "b", (F.size("a_set") + F.size("b_set")).alias("sizes"), F.size(F.array_intersect("a_set", "b_set")).alias("common"))
    return both.filter(NEAR[1] * F.col("common") >= NEAR[0] * (F.col("sizes") - F.col("common"))).select("a", "b")


def similar(docs: DataFrame) -> DataFrame:
    """(doc_id, version, fp, root, component) of every document, by links of exact
    Jaccard similarity; ``fp`` is a digest of the set of shingles.

    Candidates share a band. First each set is compared with one other, the leader
    of most of its bands, and components are formed of the confirmed links. Of pairs
    that share a band, only those of different components are compared then: all of
    them, but no pairs within a large group of copies."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("version"), text_udf(sketch, _SKETCH, SKETCH)(F.col("text")).alias("s"))
    rows = stored(rows.select("doc_id", "version", "s.*"), "sketches")
    distinct = rows.groupBy("fp").agg(
        F.min("doc_id").alias("least"), F.first(F.struct("doc_id", "version")).alias("text_of"), F.first("n").alias("n"), F.first("bands").alias("bands"),
    )
    distinct = stored(distinct.withColumn("id", F.monotonically_increasing_id()), "shingle-sets")
    members = distinct.select("id", "n", F.explode("bands").alias("band"))
    order = F.xxhash64("id")
    leaders = members.groupBy(F.col("band").alias("of")).agg(F.min_by("id", order).alias("b"), F.min_by("n", order).alias("m"), F.count("*").alias("rows"))
    members = members.join(stored(leaders.filter("rows > 1"), "leaders"), F.col("band") == F.col("of"))
    members = stored(members.select("band", "id", "n", "b", "m"), "band-members")

    led = members.filter((F.col("id") != F.col("b")) & _may_link(F.col("n"), F.col("m"))).groupBy("id", "b").agg(F.count("*").alias("bands"))
    led = led.groupBy("id").agg(F.max_by("b", F.struct("bands", "b")).alias("b"))
    pair = (F.greatest("id", "b").alias("a"), F.least("id", "b").alias("b"))
    near = stored(confirmed(stored(led.select(*pair).distinct(), "led"), docs, distinct), "near")

    roots = components(near).withColumnRenamed("node", "of")
    parted = members.join(roots, F.col("id") == F.col("of"), "left").select("band", "id", "n", F.coalesce("root", "id").alias("part"))
    parted = stored(parted, "parted")
    main = parted.groupBy("band", "part").agg(F.count("*").alias("rows")).groupBy(F.col("band").alias("of"))
    main = stored(main.agg(F.max_by("part", "rows").alias("main"), F.count("*").alias("parts")).filter("parts > 1"), "main-parts")
    mixed = parted.join(main, F.col("band") == F.col("of")).select("band", "id", "n", "part", "main")
    others = mixed.filter("part <> main").select(F.col("band").alias("of"), F.col("id").alias("b"), F.col("n").alias("m"), F.col("part").alias("of_part"))
    across = mixed.join(others, (F.col("band") == F.col("of")) & (F.col("part") != F.col("of_part")) & _may_link(F.col("n"), F.col("m")))
    more = confirmed(stored(across.select(*pair).distinct(), "across"), docs, distinct)

    roots = components(near.union(more))
    tied = distinct.join(roots, F.col("id") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "id").alias("root"))
    tied = stored(tied, "rooted")
    top = stored(tied.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component")), "components")
    found = stored(tied.join(top, F.col("root") == F.col("of")).select(F.col("fp").alias("of"), "root", "component"), "classes")
    return rows.join(found, F.col("fp") == F.col("of")).select("doc_id", "version", "fp", "root", "component")


def keep_one(docs: DataFrame, plan: Plan | None = None) -> DataFrame:
    """One document of each component: that of the smallest id, of several
    texts of that id the first by hash. Ids that are NULL come last. Components
    are those of ``similar``, or of fingerprints with a ``plan``."""
    marked = stored(near_duplicates(docs, plan) if plan else similar(docs), "near-duplicates")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "fp", "version")
    keepers = stored(marked.groupBy(F.col("root").alias("of")).agg(F.min(place).alias("keeper")), "keepers")
    others = marked.join(keepers, F.col("root") == F.col("of"))
    is_keeper = place.eqNullSafe(F.col("keeper"))
    repeated = others.filter(is_keeper).groupBy("of").agg(F.count("*").alias("n")).filter("n > 1")
    name = fresh(docs, "_version")
    gone = others.filter(~is_keeper).select(F.col("doc_id").alias(f"{name}d"), F.col("version").alias(f"{name}v"))
    kept = docs.join(gone, F.col("doc_id").eqNullSafe(F.col(f"{name}d")) & F.xxhash64("text").eqNullSafe(F.col(f"{name}v")), "left_anti")
    return kept if repeated.isEmpty() else kept.dropDuplicates(["doc_id", "text"])
