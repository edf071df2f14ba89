"""Near-duplicate documents by an inverted join over MinHash coordinates.

Each distinct shingle set gets a signature of ``COORDINATES`` minima and is posted under each
(coordinate, value) pair. Two sets count as candidates when they collide in at least
``MATCHES`` coordinates:

* **Prefix.** Two sets with ``MATCHES`` common lists share one among the
  ``COORDINATES - MATCHES + 1`` shortest lists of either, by a common order of all lists.
  Only those are merged.
* **Skip.** The longer lists are never read; their collisions are counted by comparing
  the two signatures.

Candidates are confirmed on their full shingle sets. A pair at 85 % similarity collides in 27 of
32 coordinates on average; it falls below 16 with a probability of 5e-7.

Large groups do not emit their pairs. The member of a list whose values are the most
frequent sits in the middle of the group and is tried first against all others; what it links needs no
further comparison with each other. Only members outside the list's largest linked group are compared again, in cells
of bounded size that return one link for each component they reach.
Before that, a bound removes what cannot link at all: shingles of one set alone are never
shared, so a set that has more than 15 % of them has no partner, and a pair needs enough others on both sides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import ascii_words, hashes, map_texts, windows
from tradewind.llm.components import components
from tradewind.session import stage

COORDINATES, MATCHES, WORDS = 32, 16, 5
_SCALE = np.random.default_rng(85).integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct five-word shingles; the whole sequence if it is shorter."""
    words = ascii_words(text.translate(_LOWER) if text else None)
    if len(words) >= WORDS:
        return np.unique(windows(hashes(words), WORDS))
    return hashes([b" ".join(words)] if words else [])


_LOWER = {a: a + 32 for a in range(65, 91)}


def _signatures(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = [shingle_set(t) for t in batch.column("text").to_pylist()]
    full = [s for s in sets if len(s)]
    sig = np.zeros((COORDINATES, len(full)), np.uint64)
    if full:
        every, starts = np.concatenate(full), np.cumsum([0, *map(len, full)])[:-1]
        for k in range(COORDINATES):
            sig[k] = np.minimum.reduceat(every * _SCALE[k], starts)
    rows = iter(sig.T.astype(np.int64) if full else [])
    return pa.RecordBatch.from_arrays([
        batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
        pa.array([next(rows) if len(s) else None for s in sets], pa.list_(pa.int64()))],
        ["doc_id", "n", "key", "sig"])


#: a filter of chosen doc_ids: bits for each of them, bits at most (8 MB, false hits of 1 % at 5 million ids), hashes
FILTER_BITS, LARGEST_FILTER, FILTER_HASHES = 16, 1 << 26, 4


class _Filter:
    """Says of most doc_ids outside ``ids`` that they are not in it, and never so of one inside."""

    def __init__(self, ids: DataFrame):
        many = ids.count()
        self.bits = 64
        while self.bits < min(FILTER_BITS * many, LARGEST_FILTER):
            self.bits *= 2
        h = F.xxhash64("node")
        low, high = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)
        at = F.explode(F.array(*[(low + high * i) % self.bits for i in range(FILTER_HASHES)]))
        one = F.expr("shiftleft(1L, cast(at % 64 as int))")
        words = (ids.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(one).alias("set"))
                 .toArrow())
        self.words = np.zeros(self.bits // 64, np.int64)
        self.words[words.column("word").to_numpy()] = words.column("set").to_numpy()

    def __call__(self, hashed: np.ndarray) -> np.ndarray:
        """Which of the doc_ids with these xxhash64 may be inside."""
        low, high = hashed & 0xFFFFFFFF, (hashed >> 32) & 0xFFFFFFFF
        inside = np.ones(len(hashed), bool)
        for i in range(FILTER_HASHES):
            at = (low + high * i) % self.bits
            inside &= (self.words[at >> 6] >> (at & 63)) & 1 == 1
        return inside


def _sets(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = [shingle_set(t) for t in batch.column("text").to_pylist()]
    return pa.RecordBatch.from_arrays([
        batch.column("doc_id"),
        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "key", "set"])


def _collisions(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("u"), F.col("set").alias("us"))
    right = sets.select(F.col("node").alias("v"), F.col("set").alias("vs"))
    both = F.size(F.array_intersect("us", "vs"))
    return (pairs.join(left, "u").join(right, "v")
            .where(100 * both >= percent * (F.size("us") + F.size("vs") - both)).select("u", "v"))


def duplicate_groups(docs: DataFrame, percent: int = 85, name: str = "minhash") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs`` (doc_id, text).

    Documents whose shingle sets reach ``percent`` similarity are linked, and linked documents
    form a component, named by its smallest ``doc_id``; that document is kept.

    * Null, empty and blank texts have no shingles and no links; each is its own component.
    * Equal sets always link, so copies are folded into one row before anything is compared.
    * ``doc_id`` names a document: rows that repeat it are the same document, and the texts
      of one ``doc_id`` belong together. A row without it gets the component of its text, if
      another row names one, and is never kept.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stage(map_texts(docs, "text", "doc_id long, n long, key binary, sig array<long>", _signatures),
                   f"{name}_signed")
    named = signed.where("key is not null and doc_id is not null")
    folded = stage(named.groupBy("key").agg(F.min("doc_id").alias("node")), f"{name}_folded")
    # one row for each set: (node, key) of the smallest document that has it
    distinct = (named.dropDuplicates(["doc_id", "key"]).withColumnRenamed("doc_id", "node")
                .join(folded, ["node", "key"], "left_semi"))
    sets = _candidate_sets(docs, distinct, percent, name)
    links = _links(sets, percent, name)
    label = components(links, f"{name}_components")
    folded = stage(folded.join(label, folded["node"] == label["id"], "left")
                   .select("key", F.coalesce("component", "node").alias("component")), f"{name}_labels")
    return (signed.join(folded, "key", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))


def _candidate_sets(docs: DataFrame, distinct: DataFrame, percent: int, name: str) -> DataFrame:
    """The sets that share enough lists and shingles to have a partner, with their prefix lists."""
    # next to the node, 64 bits of the key tell the texts of a repeated doc_id apart
    distinct = distinct.withColumn("key", F.xxhash64("key"))
    posts = distinct.select("node", "key", F.posexplode("sig").alias("c", "v"))
    lists = stage(posts.groupBy("c", "v").agg(F.count("*").alias("posted")).where("posted > 1"), f"{name}_lists")
    # dealt out as plain rows, which are smaller than the lists that each task would begin
    shared = (posts.join(lists, ["c", "v"]).repartition("node", "key").groupBy("node", "key")
              .agg(F.sort_array(F.collect_list(F.struct("posted", "c", "v"))).alias("lists"),
                   F.sum(F.log("posted")).alias("score"))
              .where(F.size("lists") >= MATCHES))
    # a set has COORDINATES - size(lists) lists of its own, which fill the front of its prefix
    shared = stage(shared.withColumn("prefix", F.expr(f"slice(lists, 1, size(lists) - {MATCHES - 1})"))
                   .select("node", "key", "prefix", "score"), f"{name}_shared")
    # no text is moved for it: what the filter lets through falls out of the join with ``shared``
    inside = _Filter(shared.select("node"))

    def chosen(batch: pa.RecordBatch) -> pa.RecordBatch:
        return _sets(batch.filter(pa.array(inside(batch.column("at").to_numpy()))))

    texts = docs.where("doc_id is not null").select("doc_id", "text", F.xxhash64("doc_id").alias("at"))
    made = map_texts(texts, "text", "node long, key binary, set array<long>", chosen)
    made = made.withColumn("key", F.xxhash64("key")).dropDuplicates(["node", "key"])
    sets = stage(made.join(shared, ["node", "key"]), f"{name}_sets")
    # by key: a repeated doc_id may have several sets, and a set has one key
    alone = (sets.select("key", F.explode("set").alias("s")).groupBy("s")
             .agg(F.count("*").alias("held"), F.min("key").alias("key")).where("held = 1")
             .groupBy("key").agg(F.count("*").alias("alone")))
    able = (sets.join(alone, "key", "left")
            .withColumn("n", F.size("set")).withColumn("common", F.col("n") - F.coalesce("alone", F.lit(0)))
            .where(100 * F.col("common") >= percent * F.col("n"))
            .join(distinct.select("node", "key", "sig"), ["node", "key"])
            .select("node", "n", "common", "prefix", "score", "sig", "set"))
    return stage(able, f"{name}_able")


def _links(sets: DataFrame, percent: int, name: str) -> DataFrame:
    """Enough of the links (u, v) to connect all sets that similar ones connect."""
    # without signatures: they are looked up for pairs
    posts = stage(sets.select("node", "n", "common", "score", F.explode("prefix").alias("p"))
                  .select("node", "n", "common", "score", "p.c", "p.v"), f"{name}_posts")
    middle = F.max(F.struct("score", "node", "n", "common"))
    heads = stage(posts.groupBy("c", "v").agg(middle.alias("m"), F.count("*").alias("posted"))
                  .where("posted > 1").select("c", "v", F.col("m.node").alias("head"),
                                              F.col("m.n").alias("hn"), F.col("m.common").alias("hcommon")),
                  f"{name}_heads")

    def fits(n, common, other_n, other_common):
        # similarity needs that many common shingles, and neither side can give more than it shares at all
        return (100 + percent) * F.least(common, other_common) >= percent * (n + other_n)

    listed = posts.join(heads, ["c", "v"])
    tried = (listed.where(F.col("node") != F.col("head")).where(fits(*map(F.col, ("n", "common", "hn", "hcommon"))))
             .select(F.col("node").alias("u"), F.col("head").alias("v")).distinct()
             .join(sets.select(F.col("node").alias("u"), F.col("sig").alias("usig")), "u")
             .join(sets.select(F.col("node").alias("v"), F.col("sig").alias("vsig")), "v")
             .where(_collisions(F.col("usig"), F.col("vsig")) >= MATCHES).select("u", "v").distinct())
    stars = stage(_confirmed(tried, sets, percent), f"{name}_stars")
    joined = components(stars, f"{name}_joined")
    anchors = (sets.select("node").join(joined, F.col("node") == F.col("id"), "left")
               .select("node", F.coalesce("component", "node").alias("anchor")))
    anchors = stage(anchors, f"{name}_anchors")
    listed = posts.select("c", "v", "node").join(anchors, "node")
    listed = stage(listed, f"{name}_anchored")
    sizes = listed.groupBy("c", "v", "anchor").agg(F.count("*").alias("k"))
    active = stage(sizes.groupBy("c", "v").agg(F.max(F.struct("k", "anchor")).alias("m"), F.count("*").alias("groups"))
                   .where("groups > 1").select("c", "v", F.col("m.anchor").alias("main")), f"{name}_active")
    # a link that is still missing has both ends in one of these lists
    posted = stage(listed.join(active, ["c", "v"]).select("main", "node", (F.col("anchor") != F.col("main")).alias("outer"))
                   .distinct(), f"{name}_outside")
    sets = sets.select("node", "n", "sig", "set").join(anchors, "node")
    return stars.unionByName(_outside_links(sets, posted, percent, name))


#: shingles and sets at most on each side of a cell, on average
CELL_SHINGLES, CELL_SETS = 1_000_000, 256


def _outside_links(sets: DataFrame, posted: DataFrame, percent: int, name: str) -> DataFrame:
    """Links (u, v) of the nodes outside a group with that group's members and with each other.

    ``posted`` (main, node, outer) names the nodes that share a list with group ``main`` and says which of them stand
    outside it. Groups are cut into a grid of cells of bounded size; a cell compares full sets in blocks and returns
    one link for each outside node and component.
    """
    def cells(of):
        return F.ceil(F.greatest(F.sum(F.col("n").cast("long")) / CELL_SHINGLES, F.count("*") / CELL_SETS)).cast("int").alias(of)

    both = stage(sets.join(posted, "node"), f"{name}_both")
    grid = (both.where("outer").groupBy("main").agg(cells("rows"))
            .join(both.groupBy("main").agg(cells("columns")), "main"))
    both = both.join(stage(grid, f"{name}_grid"), "main")
    at = F.xxhash64("node")
    left = both.where("outer").withColumn("i", F.pmod(at, "rows").cast("int")).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.col("columns") - 1))).withColumn("outer", F.lit(True))
    right = both.withColumn("j", F.pmod(at, "columns").cast("int")).withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.col("rows") - 1))).withColumn("outer", F.lit(False))
    columns = ["main", "i", "j", "outer", "node", "anchor", "sig", "set"]

    def compare(table: pa.Table) -> pa.Table:
        return _compare(table, percent)

    return (left.select(*columns).unionByName(right.select(*columns)).groupBy("main", "i", "j")
            .applyInArrow(compare, "u long, v long"))


def _compare(table: pa.Table, percent: int) -> pa.Table:
    outer = table.column("outer").to_numpy()
    node, anchor = (table.column(c).to_numpy() for c in ("node", "anchor"))
    sets = table.column("set").combine_chunks()
    ends = sets.offsets.to_numpy()
    values = sets.values.to_numpy()
    sig = table.column("sig").combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES)
    a, b = np.flatnonzero(outer), np.flatnonzero(~outer)
    shared = np.zeros((len(a), len(b)), np.float32)
    for x, y, z in _columns(values, ends, a, b):
        one, other = np.zeros((len(a), z), np.float32), np.zeros((len(b), z), np.float32)
        one[x], other[y] = 1, 1
        shared += one @ other.T
    size = np.diff(ends)
    near = 100 * shared >= percent * (size[a][:, None] + size[b][None, :] - shared)
    near &= anchor[a][:, None] != anchor[b][None, :]
    u, v = np.nonzero(near)
    hit = (sig[a[u]] == sig[b[v]]).sum(1) >= MATCHES
    u, v = u[hit], v[hit]
    # a second link of a node into the same component adds nothing
    _, first = np.unique(np.stack([u, anchor[b[v]]]), axis=1, return_index=True) if len(u) else (None, [])
    return pa.table({"u": node[a[u[first]]] if len(u) else pa.array([], pa.int64()),
                     "v": node[b[v[first]]] if len(u) else pa.array([], pa.int64())})


def _columns(values: np.ndarray, ends: np.ndarray, a: np.ndarray, b: np.ndarray, width: int = 4096):
    """Slices of the incidence matrices of two lists of sets, ``width`` shingles at a time."""
    def flat(rows):
        size = ends[rows + 1] - ends[rows]
        take = np.arange(size.sum()) + np.repeat(ends[rows] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        return values[take], np.repeat(np.arange(len(rows)), size)

    (left, left_row), (right, right_row) = flat(a), flat(b)
    known = np.intersect1d(left, right)
    parts = []
    for value, row in ((left, left_row), (right, right_row)):
        at = np.searchsorted(known, value)
        at = np.minimum(at, max(len(known) - 1, 0))
        here = known[at] == value if len(known) else np.zeros(len(value), bool)
        at, row = at[here], row[here]
        order = np.argsort(at, kind="stable")
        parts.append((at[order], row[order]))
    for low in range(0, len(known), width):
        cut = []
        for at, row in parts:
            x, y = np.searchsorted(at, [low, low + width])
            cut.append((row[x:y], at[x:y] - low))
        yield cut[0], cut[1], min(width, len(known) - low)
