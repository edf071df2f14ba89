"""Best-fit packing of documents into training sequences by large-item matching.

Where a piece goes depends on its length alone, so the plan is made for the number of pieces of
each length, at most ``capacity`` numbers however many documents there are:

* two pieces above a third of the capacity at most share a sequence, so the longest is matched with the
  longest that still fits, all equal pairs in one step;
* shorter pieces go, longest first, into the smallest gap that takes them, again whole runs
  of equal gaps at once.

The plan is a list of runs: "pieces r to s of length n, so many to a sequence, from sequence f on". Pieces are
numbered within their length without a sort, and each looks up its run.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import number, small
from tradewind.session import stage

CAPACITY, END = 4096, 1
#: words whose ids a worker remembers, and the longest of them in bytes
REMEMBERED, LONGEST = 600_000, 64
_SHIFT = 40
#: letters that have one lower case, and marks that are no part of a short form such as 's
_LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_WORD = re.compile(f"[{_LETTERS}]+")
_MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class Ids:
    """Ids of texts as little-endian unsigned 32-bit integers.

    The vocabulary's tokens never cross white space and the tokenizer drops it, so a text's ids are those of its
    words one after the other, and each word is encoded once. Nor do they cross from a letter to a mark: what is
    made of Western letters only goes to the vocabulary's model at once, and the marks behind it are looked up as a word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # how the vocabulary writes each letter
        self.written = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in _LETTERS}
        self.known: dict[bytes, bytes] = {}

    def __call__(self, text: str | None) -> bytes:
        raw = text.encode() if text else b""
        if b"<|" not in raw:  # the vocabulary lower-cases, but not the strings of its special tokens
            raw = raw.lower()
        words = raw.split()
        try:
            return b"".join([self.known[w] for w in words])
        except KeyError:
            pass
        if len(self.known) > REMEMBERED:
            self.known.clear()
        got = self._new({w for w in words if w not in self.known})
        ids = b"".join([got.get(w) or self.known.get(w, b"") for w in words])
        self.known.update((w, i) for w, i in got.items() if len(w) <= LONGEST)
        return ids

    def _new(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The ids of words that are not known yet."""
        plain, other = [], set()
        for w in words:
            letters = w.rstrip(_MARKS)
            low = letters.decode().lower()
            if _WORD.fullmatch(low):
                plain.append((w, low.encode(), w[len(letters):]))
            else:
                other.add(w)
        other.update(marks for _, _, marks in plain if marks and marks not in self.known)
        got = self._encoded(list(other)) if other else {}
        for w, letters, marks in plain:
            ids = self.known.get(letters) or got.get(letters)
            if ids is None:
                made = self.model.tokenize(letters.decode().translate(self.written))
                ids = got[letters] = b"".join([t.id.to_bytes(4, "little") for t in made])
            got[w] = ids + (self.known.get(marks) or got[marks]) if marks else ids
        return got

    def _encoded(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of each word, from one pass over all of them; offsets tell which word an id belongs to."""
        plain = [w.decode() for w in words]
        made = self.tokenizer.encode(" ".join(plain), add_special_tokens=False)
        starts = np.cumsum([0, *(len(w) + 1 for w in plain)])
        cuts = np.searchsorted(np.array([a for a, _ in made.offsets], np.int64), starts)
        raw = np.array(made.ids, "<u4").tobytes()
        return {w: raw[4 * a:4 * b] for w, a, b in zip(words, cuts.tolist(), cuts[1:].tolist(), strict=False)}


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for each piece of each row of ``docs`` (doc_id, text)."""
    def run(batches):
        ids = Ids(tokenizer)
        tail = np.array([end], "<u4").tobytes()
        for batch in small(batches, "text"):
            rows = []
            for doc, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
                raw = ids(text) + tail
                for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at:at + 4 * capacity]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            kinds = [batch.column("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


@dataclass
class Plan:
    """Runs of pieces of one length: (length, first piece, first sequence, pieces to a sequence, offset)."""

    runs: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """sequence_id and offset of pieces, given by length and number within it."""
        table = np.array(sorted(self.runs), np.int64)
        at = np.searchsorted((table[:, 0] << _SHIFT) + table[:, 1], (length << _SHIFT) + rank, side="right") - 1
        _, first, sequence, each, offset = table[at].T
        own = rank - first
        return sequence + own // each, offset + own % each * length


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Sequences for so many pieces of each length."""
    out, done = Plan(), dict.fromkeys(counts, 0)
    left = {n: c for n, c in counts.items() if c}
    gaps: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []

    def put(length: int, many: int, sequence: int, each: int, offset: int) -> None:
        out.runs.append((length, done[length], sequence, each, offset))
        done[length] += many
        left[length] -= many

    def leave(gap: int, sequence: int, many: int) -> None:
        if many and gap:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((sequence, many))

    def opened(many: int) -> int:
        out.sequences += many
        return out.sequences - many

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        fits = bisect_left(large, capacity - a + 1) - 1
        b = large[fits] if fits >= 0 else 0
        if b == a and left[a] > 1:
            many = left[a] // 2
            first = opened(many)
            put(a, 2 * many, first, 2, 0)
            leave(capacity - 2 * a, first, many)
        else:
            if b == a:
                b = large[fits - 1] if fits else 0
            many = min(left[a], left[b]) if b else left[a]
            first = opened(many)
            put(a, many, first, 1, 0)
            if b:
                put(b, many, first, 1, a)
            leave(capacity - a - b, first, many)
        large = [n for n in large if left[n]]
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            at = bisect_left(order, n)
            if at == len(order):
                leave(capacity, opened(-(-left[n] // (capacity // n))), -(-left[n] // (capacity // n)))
                continue
            gap = order[at]
            first, many = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], order[at]
            each = gap // n
            full = min(many, left[n] // each)
            if full:
                put(n, full * each, first, each, capacity - gap)
                leave(gap - each * n, first, full)
            else:
                full, rest = 1, left[n]
                put(n, rest, first, rest, capacity - gap)
                leave(gap - rest * n, first, 1)
            leave(gap, first + full, many - full)
    return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, name: str = "packing") -> DataFrame:
    """The pieces of ``docs`` (doc_id, text) with sequence_id and offset.

    A document is its ids and then ``end``; only one longer than ``capacity`` is cut, into pieces of
    that length, the last one shorter. Null and empty texts are the one id ``end``. Each row is packed for itself, so
    repeated rows (and rows without ``doc_id``) take their own place. An empty table gives no rows.
    ``tokenizer`` is the path of a vocabulary file that every executor can read.
    """
    cut = stage(pieces(docs, tokenizer, capacity, end), f"{name}_pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    made = plan(counts, capacity)
    ranked = number(cut, ["length"], "rank", f"{name}_numbered")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
                sequence, offset = made.place(length, rank)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)],
                                                 [*cut_columns, "sequence_id", "offset"])

    cut_columns = cut.columns
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def sequences(packed: DataFrame, docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """sequence_id and ids (array of integers) of what ``pack`` placed; ``doc_id`` must be unique.

    A sequence has at most ``capacity`` ids, so gathering one is bounded.
    """
    def run(batches):
        ids = Ids(tokenizer)
        for batch in small(batches, "text"):
            rows = []
            for doc, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
                raw = np.append(np.frombuffer(ids(text), "<u4").astype(np.int32), np.int32(end))
                rows += [(doc, at, raw[at:at + capacity]) for at in range(0, len(raw), capacity)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], batch.column("doc_id").type),
                                              pa.array([r[1] for r in rows], pa.int64()),
                                              pa.array([r[2] for r in rows], pa.list_(pa.int32()))],
                                             ["doc_id", "start", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, start long, ids array<int>")
    placed = made.join(packed.select("doc_id", "start", "sequence_id", "offset"), ["doc_id", "start"])
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p.ids)).alias("ids"))
