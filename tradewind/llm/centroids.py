"""Centroid clustering over dictionaries of subvectors.

Vectors are cut into blocks of ``BLOCK`` components. Chunks of ``ROWS`` vectors are encoded once, without loss: each block
of a chunk gets a dictionary of its distinct subvectors, and a vector becomes one code for each block. A round works out
the exact squared distance of each dictionary entry to each centroid once; the distance of a vector is then the sum of the
entries that its codes name, and the sums behind the next centroids are counts of codes times entries. All of it is
integer arithmetic, so the result does not depend on how rows are dealt out.

A dictionary belongs to a chunk, as one of all rows would grow with them. A round shuffles one row for each task, cluster
and component; the driver sees the centroids only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.session import stage

BLOCK, ROWS = 2, 65_536
#: components below this (after scaling) keep squared distances of up to 64 dimensions within 64 bits
LARGEST = 2**27


def cluster(vectors: DataFrame, centroids: int = 40, rounds: int = 5, dimensions: int = 64, scale: int = 256,
            seed: str = "2:", name: str = "centroids") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 for each row of ``vectors`` (vec_id, embedding).

    Components count as ``floor(scale * x)``. Kept are vectors of ``dimensions`` components, none of them null, not a
    number, infinite, or ``LARGEST`` and more after scaling (whose squares no long holds). The first centroids
    are the vectors with the smallest SHA-256 of ``seed`` and vec_id (a missing vec_id counts as empty, equal hashes are
    ordered by the vectors); with fewer vectors than ``centroids``, each is one. Ties go to the smaller number.

    * Rows that repeat a vec_id or a vector are vectors of their own, and so are rows without vec_id.
    * An empty table, or one without any kept vector, gives no rows. Extra columns are ignored.
    """
    if not 0 < dimensions <= 64:
        raise ValueError("distances of more than 64 components may not fit a long")
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("int"))
    small = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(F.lit(float(scale)) * x.cast("double")) < LARGEST))
    kept = (vectors.select("vec_id", "embedding").where(F.size("embedding") == dimensions).where(small)
            .select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")))
    first = kept.select(F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256).alias("h"), "v")
    now = np.array([r.v for r in first.orderBy("h", "v").limit(centroids).collect()], np.int64).reshape(-1, dimensions)

    def encode(batches):
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= ROWS:
                table = pa.Table.from_batches(held)
                while table.num_rows >= ROWS:
                    yield _encoded(table.slice(0, ROWS), dimensions)
                    table = table.slice(ROWS)
                held, count = table.to_batches(), table.num_rows
        if count:
            yield _encoded(pa.Table.from_batches(held), dimensions)

    chunks = stage(kept.mapInArrow(encode, "ids array<long>, sizes array<int>, entries binary, codes binary"), f"{name}_chunks")
    for _ in range(rounds):
        now = _moved(chunks, now)

    def place(batches):
        for ids, entries, codes in _chunks(batches, dimensions):
            label, far, _ = _nearest(entries, codes, now)
            yield pa.RecordBatch.from_arrays([ids, pa.array(label), pa.array(far)], ["vec_id", "cluster", "distance"])

    placed = stage(chunks.mapInArrow(place, "vec_id long, cluster int, distance long"), f"{name}_placed")
    inside = {r.cluster: r.s for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    facts = [(k, inside.get(k, 0), sum(inside.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
             for k, c in enumerate(now.tolist())]
    facts = vectors.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row for each centroid
    return (placed.join(F.broadcast(facts), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def _encoded(table: pa.Table, dimensions: int) -> pa.RecordBatch:
    """One row: the ids, and for each block its number of entries, the entries and a code for each vector."""
    v = table.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dimensions)
    v = np.pad(v, ((0, 0), (0, -dimensions % BLOCK)))
    entries, codes = [], []
    for at in range(0, v.shape[1], BLOCK):
        # subvectors compare as raw bytes, as only equality counts
        raw = np.ascontiguousarray(v[:, at:at + BLOCK]).view(f"V{4 * BLOCK}" if BLOCK != 2 else np.int64).ravel()
        distinct, code = np.unique(raw, return_inverse=True)
        entries.append(distinct.view(np.int32))
        codes.append(code.astype(np.uint16))
    sizes = [len(e) // BLOCK for e in entries]
    return pa.RecordBatch.from_arrays(
        [pa.array([table.column("vec_id").to_pylist()], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())),
         pa.array([np.concatenate(entries).tobytes()], pa.binary()), pa.array([np.concatenate(codes).tobytes()], pa.binary())],
        ["ids", "sizes", "entries", "codes"])


def _chunks(batches, dimensions: int):
    """ids, the entries of each block and the codes of each block, chunk by chunk."""
    for batch in batches:
        for i in range(batch.num_rows):
            sizes = batch.column("sizes")[i].as_py()
            entries = np.frombuffer(batch.column("entries")[i].as_buffer(), np.int32).reshape(-1, BLOCK)
            codes = np.frombuffer(batch.column("codes")[i].as_buffer(), np.uint16).reshape(len(sizes), -1)
            yield batch.column("ids")[i].values, np.split(entries, np.cumsum(sizes)[:-1]), codes


def _nearest(entries: list[np.ndarray], codes: np.ndarray, now: np.ndarray):
    """The nearest centroid of each vector, its squared distance, and the centroids padded to whole blocks."""
    now = np.pad(now, ((0, 0), (0, len(entries) * BLOCK - now.shape[1])))
    total = np.zeros((codes.shape[1], len(now)), np.int64)
    for k, (own, code) in enumerate(zip(entries, codes, strict=True)):
        gap = own[:, None, :].astype(np.int64) - now[None, :, k * BLOCK:(k + 1) * BLOCK]
        total += (gap * gap).sum(2)[code]
    label = total.argmin(1)
    return label.astype(np.int32), total[np.arange(len(label)), label], now


def _moved(chunks: DataFrame, now: np.ndarray) -> np.ndarray:
    """The centroids after one round; those without vectors stay."""
    many, dimensions = now.shape

    def add(batches):
        # what a task has seen of each cluster: number of vectors, then the sum of each component
        seen = np.zeros((many, dimensions + 1), np.int64)
        for _, entries, codes in _chunks(batches, dimensions):
            label, _, padded = _nearest(entries, codes, now)
            seen[:, 0] += np.bincount(label, minlength=many)
            sums = np.zeros(padded.shape, np.int64)
            for k, (own, code) in enumerate(zip(entries, codes, strict=True)):
                held = np.bincount(label.astype(np.int64) * len(own) + code, minlength=many * len(own)).reshape(many, -1)
                sums[:, k * BLOCK:(k + 1) * BLOCK] = held @ own.astype(np.int64)
            seen[:, 1:] += sums[:, :dimensions]
        filled = np.flatnonzero(seen[:, 0])
        if len(filled):
            at, column = np.repeat(filled, dimensions + 1), np.tile(np.arange(dimensions + 1), len(filled))
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(column.astype(np.int32)),
                                              pa.array(seen[at, column])], ["cluster", "at", "n"])

    sums = chunks.mapInArrow(add, "cluster int, at int, n long").groupBy("cluster", "at").agg(F.sum("n").alias("n")).collect()
    total = {(r.cluster, r.at): r.n for r in sums}
    return np.array([[total[k, d + 1] // total[k, 0] if (k, 0) in total else int(c[d]) for d in range(dimensions)]
                     for k, c in enumerate(now)], np.int64).reshape(many, dimensions)
