"""Nearest neighbours by a block matrix join with int8 tiles.

Queries and candidates are packed into blocks of bounded size, and each pair of blocks is a tile of its own, which any task can take.
Vectors are scaled to int8; the product of the two int8 matrices estimates all inner products of a tile, and
by Cauchy-Schwarz the error is at most ``|q - q'| |c| + |q'| |c - c'|``, where ``q'`` and ``c'`` are the scaled vectors
put back. A pair survives unless its estimate plus error stays below the k-th largest estimate minus error of its
query. Survivors are computed anew from the original vectors in double precision, a heap keeps the ``k`` best of a
query in a tile, and the heaps of the tiles are merged by a window with a group limit. The result is exact.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.session import stage

#: components in a block of queries and of candidates, on average
QUERIES, CANDIDATES = 2048 * 64, 8192 * 64
#: int8 products of so many dimensions are exact in float32
_EXACT = 1024
#: rows of a tile handled at once, and values of survivors
_ROWS, _VALUES = 256, 1 << 22
_PACKED = "block int, number array<long>, ids array<long>, dims int, vectors binary"


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, name: str = "neighbours") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` rows of ``vectors`` with the largest inner product.

    Both tables have vec_id and embedding. The score is the sum, in component order, of products of doubles. A query's own
    rows are those with its vec_id. Ties go to the smaller vec_id, rows without one last.

    * Vectors that are null, empty or zero, or hold a null or non-finite component, take no part.
    * Only vectors of equal length are compared.
    * Rows that repeat a candidate are candidates of their own; rows that repeat a query's vec_id are queries of their
      own, with the same query_id. A row without vec_id is a candidate but never a query.
    * Products beyond the range of doubles are infinite; one that is not a number counts as the least.
    * With fewer candidates than ``k`` all of them are returned; an empty table gives no rows. Extra columns are ignored.
    """
    asked = _packed(queries.where("vec_id is not null"), QUERIES, f"{name}_queries")
    given = _packed(vectors, CANDIDATES, f"{name}_candidates")
    ends = [b.agg(F.max("block")).first()[0] for b in (asked, given)]

    def dealt(blocks, own, other, last):
        # one copy of a block for each block of the other side; tiles of different lengths stay empty
        to = F.explode(F.sequence(F.lit(0), F.lit(last or 0))).alias(other)
        return blocks.select(F.col("block").alias(own), to, F.lit(own == "i").alias("asks"), "number", "ids", "dims", "vectors")

    def tile(table: pa.Table) -> pa.Table:
        return _tile(table, k)

    tiles = dealt(asked, "i", "j", ends[1]).unionByName(dealt(given, "j", "i", ends[0])).groupBy("i", "j", "dims")
    found = tiles.applyInArrow(tile, "number long, query_id long, vec_id long, score double")
    best = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _packed(vectors: DataFrame, size: int, name: str) -> DataFrame:
    """The vectors that take part, one row for each block and length; ``number`` is unique among all rows."""
    x = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
            .where(F.size("embedding") > 0).where(finite).where(F.exists("embedding", lambda v: v != 0))
            .select("vec_id", x.alias("v")))
    rows = stage(rows, f"{name}_rows")
    blocks = max(1, -(-(rows.agg(F.sum(F.size("v"))).first()[0] or 0) // size))

    def pack(batches):
        by: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            long = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
            for dims in np.unique(long).tolist():
                by.setdefault(dims, []).append(batch.filter(pa.array(long == dims)))
        block, at = TaskContext.get().partitionId(), 0
        for dims, held in sorted(by.items()):
            table = pa.Table.from_batches(held)
            values = table.column("v").combine_chunks().flatten().to_numpy()
            n = table.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([[block << 32 | x for x in range(at, at + n)]], pa.list_(pa.int64())),
                 pa.array([table.column("vec_id").to_pylist()], pa.list_(pa.int64())), pa.array([dims], pa.int32()),
                 pa.array([values.tobytes()], pa.large_binary()).cast(pa.binary())], ["block", "number", "ids", "dims", "vectors"])
            at += n

    return stage(rows.repartition(blocks).mapInArrow(pack, _PACKED), name)


def _tile(table: pa.Table, k: int) -> pa.Table:
    """The ``k`` best candidates of each query of a tile; a side of it may be missing."""
    schema = pa.schema([("number", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    if table.num_rows < 2:
        return schema.empty_table()
    asks = table.column("asks").to_pylist()
    dims = table.column("dims")[0].as_py()
    (q, q_ids, number), (c, c_ids, _) = (
        (np.frombuffer(table.column("vectors")[at].as_buffer(), np.float64).reshape(-1, dims),
         table.column("ids")[at].as_py(), table.column("number")[at].as_py()) for at in (asks.index(True), asks.index(False)))
    c, c_ids = _unlike(c, c_ids, k)
    heaps = _best(q, q_ids, c, c_ids, k)
    # an id that is missing sorts behind all others
    rows = [(number[i], q_ids[i], None if isinstance(key, float) else -key, score) for i, heap in enumerate(heaps) for score, key in heap]
    return pa.Table.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*rows, strict=True), schema, strict=True)],
                                schema=schema) if rows else schema.empty_table()


def _key(vec_id: int | None) -> int | float:
    return float("-inf") if vec_id is None else -vec_id


def _unlike(c: np.ndarray, ids: list, k: int) -> tuple[np.ndarray, list]:
    """The candidates without those that no query can list, because 2 k rows with the same vector come before them.

    A query leaves out one id, and of one id at most ``k`` rows stay; so ``k`` others remain before any row left out here.
    """
    raw = np.ascontiguousarray(c + 0.0).view(f"V{8 * c.shape[1]}").ravel()
    _, group, many = np.unique(raw, return_inverse=True, return_counts=True)
    if many.max() <= 2 * k:
        return c, ids
    held: dict[int, list[int]] = {}
    for at in sorted(np.flatnonzero(many[group] > 2 * k).tolist(), key=lambda at: (ids[at] is None, ids[at] or 0)):
        held.setdefault(int(group[at]), []).append(at)
    out = np.ones(len(ids), bool)
    for own in held.values():
        seen: dict = {}
        left = 0
        for at in own:
            seen[ids[at]] = seen.get(ids[at], 0) + 1
            out[at] = left < 2 * k and seen[ids[at]] <= k
            left += int(out[at])
    keep = np.flatnonzero(out)
    return c[keep], [ids[at] for at in keep.tolist()]


def _scaled(v: np.ndarray):
    """int8 codes (as floats), scale, norm of the vector, of the scaled vector put back, and of the difference."""
    scale = np.abs(v).max(1) / 127
    scale[scale == 0] = np.finfo(float).tiny
    code = np.clip(np.rint(v / scale[:, None]), -127, 127)
    back = code * scale[:, None]
    return (code.astype(np.int8).astype(np.float32), scale, *(np.sqrt((x * x).sum(1)) for x in (v, back, v - back)))


def _best(q: np.ndarray, q_ids: list, c: np.ndarray, c_ids: list, k: int) -> list[list[tuple]]:
    """For each query a heap of (score, key), the ``k`` best; a greater key is a smaller id."""
    heaps: list[list[tuple]] = [[] for _ in q_ids]
    (qa, qs, qn, qb, qe), (ca, cs, cn, _, ce) = _scaled(q), _scaled(c)
    own = {}
    for at, x in enumerate(c_ids):
        own.setdefault(x, []).append(at)
    step = max(1, _VALUES // q.shape[1])
    for low in range(0, len(q), _ROWS):
        part = slice(low, min(low + _ROWS, len(q)))
        product = np.zeros((part.stop - low, len(c)))
        for d in range(0, q.shape[1], _EXACT):
            product += qa[part, d:d + _EXACT] @ ca[:, d:d + _EXACT].T
        product *= qs[part, None]
        product *= cs
        # the last term covers the rounding of this estimate and of the score itself
        error = qe[part, None] * cn + qb[part, None] * ce + 1e-12 * q.shape[1] * (qn[part, None] * cn)
        floor, alive = product - error, np.ones(product.shape, bool)
        for i, x in enumerate(q_ids[part]):
            floor[i, own.get(x, [])] = -np.inf
            alive[i, own.get(x, [])] = False
        if len(c) > k:
            alive &= ~(product + error < np.partition(floor, len(c) - k, 1)[:, len(c) - k, None])
        i, j = np.nonzero(alive)
        for cut in range(0, len(i), step):
            a, b = i[cut:cut + step], j[cut:cut + step]
            score = np.zeros(len(a))
            for d in range(q.shape[1]):
                score += q[low + a, d] * c[b, d]
            for at, x, s in zip(a.tolist(), b.tolist(), score.tolist(), strict=True):
                heap, entry = heaps[low + at], (s if s == s else float("-inf"), _key(c_ids[x]))
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
    return heaps
