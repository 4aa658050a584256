"""Benchmark decontamination (4): q-gram lemma filtering with verification by banded alignment.

Two texts within e edits share at least m - q + 1 - q * e of the m - q + 1 q-grams of one of
them, at offsets that differ by at most e. Texts are compared as UTF-8 bytes with letters A-Z and
the capitals of Latin-1 in lower case and every run of other ASCII characters as one blank.
Every window of q = 8 bytes of a document is one 64-bit word (short items, of which 8 bytes are too
many for the lemma, have an index of their own with a smaller q); one table lookup tells whether an
item may have it. Shared q-grams are counted per document, item and diagonal band (bands of
twice the budget that overlap by half, so that an alignment lies whole in one of them), and the
bands that meet the bound are aligned.

The most frequent q-grams of an item are left out of the index, and its bound is lowered by as
many: the lemma still holds, so nothing is lost by it. A band that meets the lowered bound is
counted again with all q-grams before it is aligned.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import U64, text_slices

Q = 8
SCHEMA = "doc_id long, item_id long, start long, end long, edits long, shared long"
_BLANK = 32
_FOLD = np.full(256, _BLANK, np.uint8)
_FOLD[0] = 0
_FOLD[128:] = np.arange(128, 256)
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _FOLD[_c] = _c
    if _c >= 97:
        _FOLD[_c - 32] = _c
_TABLE_BITS = 22
_SPREAD = U64(0x9E3779B97F4A7C15)


def fold(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes as they are compared, and where each stood in ``data``."""
    out = _FOLD[data]
    if len(out) > 1:
        capital = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        out[capital] += 32
    blank = out == _BLANK
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    at = np.flatnonzero(keep)
    return out[at], at


def item_bytes(text: str) -> np.ndarray:
    out, _ = fold(np.frombuffer(text.encode(), np.uint8))
    return np.frombuffer(out.tobytes().replace(b"\0", b"").strip(b" "), np.uint8)


def grams(data: np.ndarray, q: int = Q) -> np.ndarray:
    if len(data) < q:
        return np.zeros(0, U64)
    a = data.astype(U64) if q == Q else np.concatenate([data, np.zeros(Q - q, np.uint8)]).astype(U64)
    for width in (1, 2, 4):
        a = a[:-width] | a[width:] << U64(8 * width)
    return a if q == Q else a & U64((1 << 8 * q) - 1)


def gram_size(size: int, edit_rate: float) -> int:
    """The largest q, up to ``Q``, that leaves an item of ``size`` bytes a bound of at least one shared q-gram."""
    return min(Q, size // (int(edit_rate * size) + 1))


class Index:
    """Q-grams of a block of benchmark items of one q, with each item's edit budget and count bound."""

    def __init__(self, ids: list, items: list[np.ndarray], edit_rate: float, q: int):
        self.ids, self.items, self.q = ids, items, q
        size = np.array([len(i) for i in self.items], np.int64)
        self.budget = (edit_rate * size).astype(np.int64)
        bound = size - q + 1 - q * self.budget
        self.every, self.full_bound = [grams(i, q) for i in self.items], bound.copy()
        every = self.every
        known = Counter(g for item in every for g in set(item.tolist()))
        gram, item, place = [], [], []
        for k, own in enumerate(every):
            spare = max(0, bound[k] - max(4, int(bound[k]) // 4))
            order = sorted(range(len(own)), key=lambda p: (-known[int(own[p])], p))  # frequent first
            kept = sorted(order[spare:])
            bound[k] -= min(spare, len(own))
            gram.append(own[kept])
            item.append(np.full(len(kept), k))
            place.append(np.array(kept, np.int64))
        self.bound, self.size = bound, size
        gram, item, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (gram, item, place))
        order = np.argsort(gram, kind="stable")
        self.item, self.place = item[order].astype(np.int64), place[order]
        self.gram, self.first, self.count = np.unique(gram[order].astype(U64), return_index=True, return_counts=True)
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[(self.gram * _SPREAD) >> U64(64 - _TABLE_BITS)] = True

    def regions(self, text: np.ndarray, row_of: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(row, item, band, shared q-grams) that meet the bound, over the folded bytes of a slice."""
        g = grams(text, self.q)
        at = np.flatnonzero(self.table[(g * _SPREAD) >> U64(64 - _TABLE_BITS)])
        if not len(at) or not len(self.gram):
            return []
        k = np.minimum(np.searchsorted(self.gram, g[at]), len(self.gram) - 1)
        real = self.gram[k] == g[at]
        at, k = at[real], k[real]
        times = self.count[k]
        at = np.repeat(at, times)
        entry = np.repeat(self.first[k], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        item, place = self.item[entry], self.place[entry]
        width = self.budget[item] + 1
        band = (at - place + self._shift) // width
        row = row_of[at]
        one = (row << 40 | item << 20) + 0
        # a band spans two widths, so each hit is in its own band and the one before
        key = np.concatenate([one, one])
        both = np.concatenate([band, band - 1])
        order = np.lexsort((both, key))
        key, both = key[order], both[order]
        edge = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (both[1:] != both[:-1]))))
        shared = np.diff(np.append(edge, len(key)))
        items = (key[edge] >> 20) & ((1 << 20) - 1)
        good = np.flatnonzero(shared >= self.bound[items])
        return [(int(key[edge[x]] >> 40), int(items[x]), int(both[edge[x]]), int(shared[x])) for x in good]

    @property
    def _shift(self) -> int:
        return int(self.size.max(initial=0)) + 1

    def align(self, text: np.ndarray, low: int, high: int, item: int, band: int) -> tuple[int, int, int] | None:
        """(edits, start, end) of the best match of the item in text[low:high] whose diagonals lie in
        the band widened by the budget, if within the budget."""
        pattern, e = self.items[item], int(self.budget[item])
        width = e + 1
        first = band * width - self._shift - e  # smallest diagonal
        a, b = max(low, first), min(high, first + 2 * width + 2 * e + len(pattern))
        if a >= b:
            return None
        exact = text[a:b].tobytes().find(pattern.tobytes())
        if exact >= 0:
            return 0, a + exact, a + exact + len(pattern)
        # the lemma's bound with the q-grams that the index leaves out
        if not e or np.isin(self.every[item], grams(text[a:b], self.q)).sum() < self.full_bound[item]:
            return None
        span = 2 * width + 2 * e + 1
        one = np.int64(1) << 40
        far = one * 1_000_000
        # cost * 2^40 + start, over the diagonals first .. first + span - 1
        start = first + np.arange(span)
        cost = np.where((start >= low) & (start <= high), start - min(first, low), far)
        base, ramp = min(first, low), np.arange(span) * one
        for i, letter in enumerate(pattern):
            j = first + i + np.arange(span)  # text position that this item byte would match
            inside = (j >= low) & (j < high)
            same = np.zeros(span, bool)
            same[inside] = text[j[inside]] == letter
            step = np.where(inside, cost + np.where(same, 0, one), far)  # match or replace
            skip = np.append(cost[1:], far) + one  # item byte left out
            reach = np.minimum(step, np.where((j + 1 >= low) & (j + 1 <= high), skip, far))
            reach[:-1] = np.minimum(reach[:-1], np.where((j[:-1] >= low - 1) & (j[:-1] < high), skip[:-1], far))
            cost = np.minimum.accumulate(reach - ramp) + ramp  # text byte left out
            cost = np.where(j + 1 <= high, cost, far)
        best = int(np.argmin(cost))
        edits = int(cost[best] >> 40)
        if edits > e:
            return None
        return edits, int(cost[best] & (one - 1)) + base, first + len(pattern) + best


def leaks(docs: DataFrame, benchmark: DataFrame, edit_rate: float = 0.1, block_items: int = 5_000) -> DataFrame:
    """One row per document row and benchmark item found in it: (doc_id, item_id, start, end, edits,
    shared), of the region with the fewest edits (then the first). start and end are character
    offsets in the text; edits counts bytes, within ``edit_rate`` of the item's folded bytes.

    The benchmark is the stated query set: it is read in blocks of ``block_items`` items, and each
    block meets all documents (only a block is broadcast at a time). Items of any length have the same
    budget (those of fewer than ten folded bytes: none, found exactly). Null texts, and items that
    fold to nothing, match nothing. Items of equal text are reported each; repeated
    document rows and null ids are reported as they come; other columns are ignored; texts of any length
    are searched whole. An empty table gives an empty table.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    out = None
    for shared in _blocks(benchmark, edit_rate, block_items):
        found = rows.mapInArrow(lambda batches, shared=shared: _search(batches, shared.value), SCHEMA)
        out = found if out is None else out.unionAll(found)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, edit_rate: float = 0.1, block_items: int = 5_000) -> DataFrame:
    """The rows of ``docs`` in whose text ``leaks`` finds no item, with all their columns. Judged row
    by row, so rows that repeat an id or have none are kept or dropped by their own text."""
    text_at = docs.columns.index("text")
    for shared in _blocks(benchmark, edit_rate, block_items):

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                clean = np.ones(b.num_rows, bool)
                clean[[r for r, _, _ in _hits(b.column(text_at).cast(pa.string()), shared.value)]] = False
                yield b.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def _blocks(benchmark: DataFrame, edit_rate: float, block_items: int) -> Iterator:
    """Broadcast indexes of the items, ``block_items`` at a time; at least one."""
    wanted = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).dropna(subset=["text"]).orderBy("item_id", "text")
    share = benchmark.sparkSession.sparkContext.broadcast
    block: list = []
    first = True
    for r in wanted.toLocalIterator():
        block.append(r)
        if len(block) == block_items:
            yield share(indexes(block, edit_rate))
            block, first = [], False
    if block or first:
        yield share(indexes(block, edit_rate))


def indexes(block: list, edit_rate: float) -> list[Index]:
    """One index per q that the items (id, text) of a block need."""
    by_q: dict[int, tuple[list, list]] = {}
    for item_id, text in block:
        item = item_bytes(text)
        if len(item):
            ids, items = by_q.setdefault(gram_size(len(item), edit_rate), ([], []))
            ids.append(item_id)
            items.append(item)
    return [Index(ids, items, edit_rate, q) for q, (ids, items) in sorted(by_q.items(), reverse=True) if q]


def _hits(texts: pa.Array, block: list[Index]) -> dict[tuple[int, int, int], tuple]:
    """(row, index, item) -> (edits, start in the folded slice, first and last character, shared q-grams)."""
    found: dict[tuple[int, int, int], tuple] = {}
    for row, _, data, ends in text_slices(texts):
        # rows are kept apart by a zero byte, which no item holds
        marks = np.insert(data, ends, 0) if len(data) else np.zeros(len(ends), np.uint8)
        text, at = fold(marks)
        row_ends = ends + np.arange(len(ends))  # of the marks, each row's zero byte
        folded_ends = np.searchsorted(at, row_ends)
        row_of = np.searchsorted(row_ends, at, "left")
        for n, index in enumerate(block):
            for r, item, band, shared in index.regions(text, row_of.astype(np.int64)):
                known = found.get((row + r, n, item))
                if known and known[0] == 0:
                    continue
                low = int(folded_ends[r - 1]) + 1 if r else 0
                hit = index.align(text, low, int(folded_ends[r]), item, band)
                if hit and (known is None or (hit[0], hit[1]) < known[:2]):
                    begin = int(row_ends[r - 1]) + 1 if r else 0
                    own = marks[begin: int(row_ends[r])]
                    chars = [len(bytes(own[: x - begin]).decode(errors="ignore")) for x in (int(at[hit[1]]), int(at[hit[2] - 1]) + 1)]
                    found[row + r, n, item] = (hit[0], hit[1], chars[0], chars[1], shared)
    return found


def _search(batches: Iterable[pa.RecordBatch], block: list[Index]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column(0).to_pylist()
        found = _hits(b.column(1), block)
        if found:
            keys = sorted(found)
            values = [found[k] for k in keys]
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[r] for r, _, _ in keys], pa.int64()), pa.array([block[n].ids[i] for _, n, i in keys], pa.int64()),
                 *[pa.array([v[c] for v in values], pa.int64()) for c in (2, 3, 0, 4)]],
                [c.split(" ")[0] for c in SCHEMA.split(", ")])
