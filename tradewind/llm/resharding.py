"""Minimum-cost-flow resharding: new shard sizes with the fewest bytes moved.

Old shards are cut into blocks, the rows of one power of two of bytes. A flow network sends the rows of each block to
new shards of given capacity; a row that stays in the shard of the same number costs nothing, another costs the mean
bytes of its block. The cheapest flow is the plan: "so many rows of this block go there". Its size depends on the number of
shards alone, never on the number of rows. Rows are then numbered within their block and look up their place, and
the files of the shards that gain or lose rows are written anew.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import fresh, number, small


class Network:
    """Directed edges with capacity and cost; successive cheapest paths with potentials."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def edge(self, a: int, b: int, room: int, cost: int) -> int:
        """An edge and its reverse; returns the edge's number."""
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def send(self, source: int, sink: int) -> None:
        """Send as much as fits, as cheaply as it goes."""
        potential = [0] * len(self.out)
        while True:
            far: list[float] = [float("inf")] * len(self.out)
            via = [-1] * len(self.out)
            far[source], queue = 0, [(0, source)]
            while queue:
                d, a = heapq.heappop(queue)
                if d > far[a]:
                    continue
                for e in self.out[a]:
                    if self.room[e]:
                        b = self.to[e]
                        new = d + self.cost[e] + potential[a] - potential[b]
                        if new < far[b]:
                            far[b], via[b] = new, e
                            heapq.heappush(queue, (new, b))
            if via[sink] < 0:
                return
            potential = [p + min(d, far[sink]) for p, d in zip(potential, far, strict=True)]
            path, at = [], sink
            while at != source:
                path.append(via[at])
                at = self.to[via[at] ^ 1]
            many = min(self.room[e] for e in path)
            for e in path:
                self.room[e] -= many
                self.room[e ^ 1] += many


@dataclass
class Plan:
    """moves[(old, size_class)]: rows to each new shard, in the order in which the rows of the block are taken."""

    moves: dict[tuple[int, int], list[tuple[int, int]]]
    shards: int

    def moved(self) -> int:
        """Rows that change their shard."""
        return sum(n for (old, _), to in self.moves.items() for new, n in to if new != old)

    def affected(self) -> set[int]:
        """New shards whose files are written anew: all that gain or lose a row."""
        crossed = [(old, new) for (old, _), to in self.moves.items() for new, n in to if n and new != old]
        return {x for pair in crossed for x in pair if x < self.shards}

    def places(self) -> np.ndarray:
        """Rows of (old, size_class, first row of the block, shard, slot of that row)."""
        next_slot = dict.fromkeys(range(self.shards), 0)
        out = []
        for (old, size_class), to in sorted(self.moves.items()):
            first = 0
            for new, n in to:
                out.append((old, size_class, first, new, next_slot[new]))
                first += n
                next_slot[new] += n
        return np.array(out, np.int64).reshape(-1, 5)


def solve(blocks: dict[tuple[int, int], tuple[int, int]], shards: int) -> Plan:
    """The cheapest flow for blocks {(old, size_class): (rows, bytes)} into shards whose row counts differ by one at most.

    Which shards take the odd rows is part of the solution.
    """
    keys = sorted(blocks)
    total = sum(blocks[k][0] for k in keys)
    source, extra, sink, first = 0, 1, 2, 3
    net = Network(first + shards + len(keys))
    for new in range(shards):
        net.edge(first + new, sink, total // shards, 0)
        net.edge(first + new, extra, 1, 0)
    net.edge(extra, sink, total % shards, 0)
    edges = {}
    for i, (old, size_class) in enumerate(keys):
        rows, size = blocks[old, size_class]
        node = first + shards + i
        net.edge(source, node, rows, 0)
        for new in range(shards):
            edges[i, new] = net.edge(node, first + new, rows, 0 if new == old else -(-size // max(rows, 1)))
    net.send(source, sink)
    moves = {}
    for i, key in enumerate(keys):
        sent = [(new, net.room[edges[i, new] ^ 1]) for new in range(shards)]
        moves[key] = [(new, n) for new, n in sent if n]
    return Plan(moves, shards)


def old_shard(source, shards: int):
    """Number of the shard in which documents of a source lie together; null sources count as an empty one."""
    return F.pmod(F.crc32(F.encode(F.coalesce(source.cast("string"), F.lit("")), "UTF-8")), F.lit(shards)).cast("int")


def reshard(docs: DataFrame, old: str, shards: int, name: str = "resharding") -> tuple[DataFrame, Plan]:
    """``docs`` with size (bytes of text and one), text_crc32, shard and slot, and the plan.

    ``old`` names the column with the number of the shard a row lies in (integer, not null). Row counts of the new
    shards differ by one at most, slots are gapless from 0. Null texts are empty but stay null; repeated rows and rows without
    doc_id are placed like all others; an empty table has an empty plan. Other columns pass through; an
    added column whose name is taken gets a ``_`` suffix. Texts are written once with their place and never shuffled.
    """
    size, crc, block, rank, shard, slot = (fresh(docs, x) for x in ("size", "text_crc32", "_block", "_rank", "shard", "slot"))
    body = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    sized = (docs.withColumn(size, F.octet_length(body).cast("long") + 1).withColumn(crc, F.crc32(body))
             .withColumn(block, F.floor(F.log2(size)).cast("int")))
    numbered = number(sized, [old, block], rank, name)
    counts = numbered.groupBy(old, block).agg(F.count("*").alias("rows"), F.sum(size).alias("bytes")).collect()
    plan = solve({(r[0], r[1]): (r["rows"], r["bytes"]) for r in counts}, shards)
    table = plan.places()
    keep = [c for c in numbered.columns if c not in (block, rank)]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.select(*keep).schema)

    def run(batches):
        for batch in small(batches, "text"):
            o, b, r = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64)
                       for c in (old, block, rank))
            where = np.empty(len(r), np.int64)
            for key in np.unique(np.stack([o, b]), axis=1).T:
                own = np.flatnonzero((table[:, 0] == key[0]) & (table[:, 1] == key[1]))
                here = (o == key[0]) & (b == key[1])
                where[here] = own[np.searchsorted(table[own, 2], r[here], side="right") - 1]
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(table[where, 3].astype(np.int32)), pa.array(table[where, 4] + r - table[where, 2])],
                [*keep, shard, slot])

    return numbered.mapInArrow(run, f"{kinds}, `{shard}` int, `{slot}` long"), plan


def rewrite(placed: DataFrame, plan: Plan, path: str, shard: str = "shard") -> DataFrame:
    """Write the affected shards below ``path``, a folder each, and return all rows in their new layout.

    Shards that neither gain nor lose rows are left as they lie.
    """
    touched = sorted(plan.affected())
    files = placed.where(F.col(shard).isin(touched)) if touched else placed.limit(0)
    kept = placed.where(~F.col(shard).isin(touched)) if touched else placed
    files.write.partitionBy(shard).parquet(path)
    written = placed.sparkSession.read.schema(placed.schema).parquet(path)
    return written.unionByName(kept) if len(touched) < plan.shards else written
