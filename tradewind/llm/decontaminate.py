"""Benchmark decontamination with an FM-index for each training shard.

A shard is what a task reads at once, about ``SHARD_BYTES`` of text. Its words become symbols of
the query alphabet: words of no benchmark item end a run, as documents do, and runs
shorter than the shortest window hold no occurrence. The index of the remaining runs is a suffix array
turned into its Burrows-Wheeler transform, a wavelet matrix for ranks, and sampled suffix positions:

* backward search takes all windows through the ranks at once, last word first;
* each row of a matching range walks back to a sampled position, which gives its occurrence;
* overlapping occurrences merge into the spans to remove.

The benchmark is read in blocks of about ``BLOCK_WORDS`` words, one pass over the documents for each. With several
blocks a pass writes only what it finds, so that the driver and a task hold one block at a time, and nothing is cut
before all blocks have been searched. With one block documents never move between tasks.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import fresh, small
from tradewind.session import stage

WINDOW = 10
SHARD_BYTES = 8 << 20
BLOCK_WORDS = 2_000_000
#: windows of an item that go to one block together
PIECE_WORDS = 10_000
#: every SAMPLE-th symbol of a run keeps its position
SAMPLE = 8
#: bytes that are no part of a word become blanks, A-Z become a-z
_FOLD = bytes(32 if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F
              else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_WHOLE = ("tinyint", "smallint", "int", "bigint")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


class Windows:
    """The distinct windows of some benchmark items, as symbols 1 to ``len(alphabet)``."""

    def __init__(self, items: list[tuple[object, str | None]]):
        self.alphabet: dict[bytes, int] = {}
        self.items: list[list] = []
        where: dict[tuple, int] = {}
        by_size: dict[int, list[tuple]] = {}
        for item, text in items:
            own = [self.alphabet.setdefault(w, len(self.alphabet) + 1) for w in words(text)]
            size = min(WINDOW, len(own))
            for window in {tuple(own[i:i + size]) for i in range(len(own) - size + 1)} if own else ():
                if window not in where:
                    where[window] = len(self.items)
                    self.items.append([])
                    by_size.setdefault(size, []).append(window)
                self.items[where[window]].append(item)
        #: by size: the windows, a row each, and their numbers
        self.sizes = {n: (np.array(w, np.int32), np.array([where[x] for x in w])) for n, w in sorted(by_size.items())}


class FMIndex:
    """Index of runs of symbols; ``text`` has 0 between runs, ends with 0 and starts with a symbol."""

    def __init__(self, text: np.ndarray, alphabet: int):
        self.n = len(text)
        order = _suffixes(text)
        before = text[order - 1]  # the symbol before the first one is the last 0
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet + 2))])
        self.bits = max(1, int(alphabet).bit_length())
        self.ones, self.zeros = [], []
        level = before
        for bit in range(self.bits - 1, -1, -1):
            one = (level >> bit & 1).astype(bool)
            self.ones.append(np.concatenate([[0], np.cumsum(one)]).astype(np.int32))
            self.zeros.append(self.n - int(self.ones[-1][-1]))
            level = np.concatenate([level[~one], level[one]])
        marked = (before == 0) | (order % SAMPLE == 0)
        self.rank_marked = np.concatenate([[0], np.cumsum(marked)]).astype(np.int32)
        self.marked, self.positions = marked, order[marked]

    def _rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before place ``at`` of the transform, plus where its rows begin in the last level."""
        for depth, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = symbol >> (self.bits - 1 - depth) & 1
            up = ones[at]
            at = np.where(bit, zeros + up, at - up)
        return at

    def _step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        zero = np.zeros_like(at)
        return self.first[symbol] + self._rank(symbol, at) - self._rank(symbol, zero)

    def _symbol(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            up = ones[at]
            bit = ones[at + 1] - up
            symbol = symbol << 1 | bit
            at = np.where(bit, zeros + up, at - up)
        return symbol

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of the suffixes that begin with each pattern, from, to."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for column in patterns.T[::-1]:
            low, high = self._step(column, low), self._step(column, high)
            high = np.maximum(low, high)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: walk back symbol by symbol to a sampled one."""
        found, steps = np.full(len(rows), -1, np.int64), 0
        open_ = np.arange(len(rows))
        while len(open_):
            hit = self.marked[rows]
            found[open_[hit]] = self.positions[self.rank_marked[rows[hit]]] + steps
            open_, rows = open_[~hit], rows[~hit]
            rows = self._step(self._symbol(rows), rows)
            steps += 1
        return found


def _suffixes(text: np.ndarray) -> np.ndarray:
    """The suffix array by prefix doubling; each 0 is a symbol of its own, smaller than all others."""
    n = len(text)
    ends = np.flatnonzero(text == 0)
    rank = text.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    step = 1
    order = np.argsort(rank, kind="stable")
    while True:
        s = rank[order]
        dense = np.empty(n, np.int64)
        dense[order] = np.cumsum(np.concatenate([[0], s[1:] != s[:-1]]))
        if dense[order[-1]] == n - 1:
            return order
        after = np.zeros(n, np.int64)
        after[:-step] = dense[step:] + 1
        rank = dense * (n + 1) + after
        order = np.argsort(rank, kind="stable")
        step *= 2


def occurrences(texts: list[str | None], bench: Windows) -> tuple[np.ndarray, list[dict], list[list]]:
    """For each text: its number of words, item -> 1 of the items found, and the merged word spans."""
    blob = b" \x01 ".join([b"", *((t or "").encode().translate(_FOLD) for t in texts)])
    symbols = np.fromiter(map(({b"\x01": -1} | bench.alphabet).get, blob.split(), repeat(0)), np.int32)
    starts = np.flatnonzero(symbols == -1)
    n_words = np.diff(np.append(starts, len(symbols))) - 1
    found: list[dict] = [{} for _ in texts]
    spans: list[list] = [[] for _ in texts]
    shortest = min(bench.sizes, default=0)
    inside = symbols > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], inside, [0]]).astype(np.int8)))
    begin, end = edges[::2], edges[1::2]
    long = (end - begin) >= shortest if shortest else np.zeros(len(begin), bool)
    begin, end = begin[long], end[long]
    if not len(begin):
        return n_words, found, spans
    size = end - begin + 1  # with the 0 that ends the run
    moved = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(moved[-1]) + np.repeat(begin - moved[:-1], size)
    text = symbols[np.minimum(at, len(symbols) - 1)]
    text[moved[1:] - 1] = 0
    index = FMIndex(text, len(bench.alphabet))
    hits = []
    for length, (patterns, numbers) in bench.sizes.items():
        low, high = index.search(patterns)
        many = high - low
        rows = np.arange(many.sum()) + np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
        if len(rows):
            hits.append((at[index.locate(rows)], np.full(len(rows), length), np.repeat(numbers, many)))
    if not hits:
        return n_words, found, spans
    where, length, window = (np.concatenate(x) for x in zip(*hits, strict=True))
    order = np.argsort(where, kind="stable")
    where, length, window = where[order], length[order], window[order]
    doc = np.searchsorted(starts, where, side="right") - 1
    for d, a, n, w in zip(doc.tolist(), (where - starts[doc] - 1).tolist(), length.tolist(), window.tolist(), strict=True):
        found[d].update(dict.fromkeys(bench.items[w], 1))
        if spans[d] and a <= spans[d][-1][1]:
            spans[d][-1][1] = max(spans[d][-1][1], a + n)
        else:
            spans[d].append([a, a + n])
    return n_words, found, spans


def without(text: str, spans: list[list]) -> str:
    """``text`` without the words of the spans and what stands between them."""
    at = [m.span() for m in _WORD.finditer(text)]
    out, last = [], 0
    for a, b in spans:
        out.append(text[last:at[a][0]])
        last = at[b - 1][1]
    return "".join([*out, text[last:]])


def _blocks(benchmark: DataFrame, block_words: int) -> list[DataFrame]:
    """The items (item_id, text) in blocks, dealt by a hash of the text, so that a common or missing item_id does not matter."""
    whole = benchmark.schema["item_id"].dataType.simpleString() in _WHOLE
    sized = benchmark.select(F.col("item_id").cast("long" if whole else "string"), "text").where("text is not null")
    total = sized.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // (2 * block_words)))  # a word has two bytes at least, its blank included
    if n == 1:
        return [sized]
    pieces = stage(sized.mapInArrow(_pieces, sized.schema).distinct(), "decontaminate_items")
    number = F.pmod(F.xxhash64("text"), F.lit(n))
    used = pieces.select(number.alias("b")).distinct().collect()
    return [pieces.where(number == b) for b in sorted(r.b for r in used)]


def _pieces(batches):
    """Items of more than ``PIECE_WORDS`` words in pieces that have all their windows."""
    for batch in batches:
        item, text = [], []
        for i, t in zip(*(batch.column(c).to_pylist() for c in (0, 1)), strict=True):
            own = words(t)
            for a in range(0, max(1, len(own) - WINDOW + 1), PIECE_WORDS):
                item.append(i)
                text.append(b" ".join(own[a:a + PIECE_WORDS + WINDOW - 1]).decode())
        yield pa.RecordBatch.from_arrays([pa.array(item, batch.schema.types[0]), pa.array(text, pa.string())], ["item_id", "text"])


def _windows(block: DataFrame) -> Windows:
    return Windows([tuple(r) for r in block.collect()])


def mark(docs: DataFrame, benchmark: DataFrame, clean: bool = False, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with n_words, spans (merged word positions, end exclusive) and items (found item_ids).

    A window is ten consecutive words of an item; an item with fewer, but not none, is one window. With
    ``clean`` the spans are cut out of ``text`` until no window is left, and n_words, spans and items tell what the text
    had before. Null texts have no words and stay null; rows are handled one by one, so repeated
    rows get equal results; an empty benchmark hits nothing, and items without ``item_id`` cut their
    words but are not listed. Other columns pass through; an added column whose name is taken gets a ``_`` suffix.
    The results do not depend on ``block_words``.
    """
    added = tuple(fresh(docs, x) for x in ("n_words", "spans", "items"))
    plain = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    item_type = "long" if benchmark.schema["item_id"].dataType.simpleString() in _WHOLE else "string"
    blocks = _blocks(benchmark, block_words)
    if len(blocks) > 1:
        return _mark_in_rounds(docs, blocks, added, item_type, clean)
    schema = ", ".join([*plain, f"`{added[0]}` long, `{added[1]}` array<array<long>>, `{added[2]}` array<{item_type}>"])
    return docs.mapInArrow(_marker(_windows(blocks[0]), docs.columns, added, item_type, clean), schema)


def _marker(bench: Windows, columns: list[str], added: tuple[str, ...], item_type: str, clean: bool):
    def run(batches):
        for batch in small(batches, "text", SHARD_BYTES):
            texts = batch.column(columns.index("text")).to_pylist()
            n_words, found, spans = occurrences(texts, bench)
            arrays = list(batch.columns)
            if clean:
                arrays[columns.index("text")] = pa.array(_cleaned(texts, bench), arrays[columns.index("text")].type)
            made = [pa.array(n_words, pa.int64()), pa.array(spans, _SPANS), pa.array(_listed(found), _items(item_type))]
            yield pa.RecordBatch.from_arrays([*arrays, *made], [*columns, *added])
    return run


_SPANS = pa.list_(pa.list_(pa.int64()))


def _items(item_type: str) -> pa.DataType:
    return pa.list_(pa.int64() if item_type == "long" else pa.string())


def _listed(found: list[dict]) -> list[list]:
    return [sorted(x for x in f if x is not None) for f in found]


def _mark_in_rounds(docs: DataFrame, blocks: list[DataFrame], added: tuple[str, ...], item_type: str, clean: bool) -> DataFrame:
    """``mark`` with several blocks: a round searches all of them in the same texts, then cuts; the next one takes the cut texts only."""
    row, cut = fresh(docs, "_row"), fresh(docs, "_cut")
    columns = docs.columns
    at = columns.index("text")

    def counted(batches):
        for batch in small(batches, "text", SHARD_BYTES):
            n_words = [len(words(t)) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n_words, pa.int64())], [*columns, added[0]])

    plain = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    whole = stage(docs.mapInArrow(counted, f"{plain}, `{added[0]}` long").withColumn(row, F.monotonically_increasing_id()),
                  "decontaminate_rows")
    now = whole.select(F.col(row).alias("row"), "text")
    hits = first = _hits(now, blocks, item_type)
    settled = []
    while clean and not hits.isEmpty():
        now = stage(now.join(hits.select("row", "spans"), "row").mapInArrow(_cut, "row long, text string"), "decontaminate_cut")
        hits = _hits(now, blocks, item_type)
        settled.append(now.join(hits, "row", "left_anti"))
    out = whole.join(first.select(F.col("row").alias(row), F.col("spans").alias(added[1]), F.col("items").alias(added[2])), row, "left")
    if settled:
        texts = reduce(DataFrame.unionByName, settled)
        out = (out.join(texts.select(F.col("row").alias(row), F.col("text").alias(cut)), row, "left")
               .withColumn("text", F.coalesce(cut, "text")))
    empty = {added[1]: "array<array<bigint>>", added[2]: f"array<{item_type}>"}
    return out.select(*columns, added[0], *[F.coalesce(c, F.array().cast(kind)).alias(c) for c, kind in empty.items()])


def _hits(texts: DataFrame, blocks: list[DataFrame], item_type: str) -> DataFrame:
    """row, spans and items of the ``texts`` (row, text) in which any block has a window."""
    schema = f"row long, spans array<array<long>>, items array<{item_type}>"
    found = [stage(texts.mapInArrow(_finder(_windows(block), item_type), schema), "decontaminate_found") for block in blocks]
    every = (reduce(DataFrame.unionByName, found).groupBy("row")
             .agg(F.flatten(F.collect_list("spans")).alias("spans"),
                  F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))

    def merge(batches):
        for batch in batches:
            spans = [_merged(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPANS), batch.column(2)], ["row", "spans", "items"])

    return stage(every.mapInArrow(merge, schema), "decontaminate_hits")


def _finder(bench: Windows, item_type: str):
    def run(batches):
        for batch in small(batches, "text", SHARD_BYTES):
            _, found, spans = occurrences(batch.column(1).to_pylist(), bench)
            made = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, _SPANS), pa.array(_listed(found), _items(item_type))], ["row", "spans", "items"])
            yield made.filter(pa.array([bool(s) for s in spans], pa.bool_()))
    return run


def _cut(batches):
    for batch in small(batches, "text", SHARD_BYTES):
        texts = [without(t, s) for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"])


def _merged(spans: list[list]) -> list[list]:
    out: list[list] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _cleaned(texts: list[str | None], bench: Windows) -> list[str | None]:
    """Cutting a span can bring the words of another one together, so it goes on until nothing is found."""
    texts, todo = list(texts), list(range(len(texts)))
    while todo:
        _, _, spans = occurrences([texts[i] for i in todo], bench)
        todo, spans = [i for i, s in zip(todo, spans, strict=True) if s], [s for s in spans if s]
        for i, s in zip(todo, spans, strict=True):
            texts[i] = without(texts[i], s)
    return texts


