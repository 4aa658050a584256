"""N-gram Jaccard join (9): exact set-similarity join with set-relation skipping.

A document's set holds the 64-bit hashes of its distinct w-word shingles. The join:

1. One scan hashes every set, counts shingles in a fixed table of cells (a document-frequency
   estimate, used only to order shingles: rare first), gives equal sets one node and each set a
   sketch (a bit a class of shingles: whether an odd number of its shingles fall into it). Each shingle that
   only one of two sets has flips a bit, so sketches of sets that link differ in few; more classes
   for larger sets tell those of any size apart.
2. A second scan writes each node's prefix, once however many documents are equal: two sets that link
   share a shingle among the first n - ceil(t n) + 1 of each in that order.
3. Index lists are keyed by shingle and ordered by size class, position and size. Lists of one node
   are skipped; a list is cut into blocks that carry their least size and the largest size that
   any entry's position (what follows the shingle) lets it link to. Two blocks meet only where these
   allow a link, between tasks (long lists) as inside one; entries that no other of a short list fits in size
   and position go before the sketches are joined, then pairs are skipped by their own
   sizes, positions and sketches. The rest joins nodes to candidate clusters.
4. Clusters are compared in blocks of bounded size. In a block a set's overlap with all
   larger ones comes from index lists in size order, entered and left where sizes begin and cease
   to fit; a set much like one already answered starts from that answer and visits the lists of the
   differing shingles only.
5. In clusters of several blocks, sets outside the largest component found so far meet the other
   blocks too, so every pair that is not already connected is compared, and copies need
   not be compared with each other across blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (BITMAP_ROWS, U64, bitmap_bits, bitmap_of, bitmap_rows, by_group, collect_bitmap, components, cut, drop,
                               holds, longs, mix, repeat_rows, unite, word_slices)

CELLS = 1 << 20  # cells of the frequency table: 4 MB, whatever the input
_PART = 1 << 15
SKETCH_BITS = 1 << 15  # of a sketch, at most
LIST_BLOCK = 2048  # entries of a list that meet in one task
SKIP = 64  # entries of a list that a task skips at once
LONE = 64  # entries of a list whose pairs are looked at before sketches are joined
STEPS = 4  # size classes that linked sets are apart at most
_PAIRS = 1 << 15  # pairs that a task looks at together
BLOCK_SETS, BLOCK_SHINGLES = 4096, 4_000_000  # sets and shingles that one task compares


def shingle_sets(column: pa.Array, w: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every row; a row of fewer than w words has its whole
    sequence as its one shingle, a row without words an empty array."""
    for row, end, words in word_slices(column, lower=True):
        hashes, full = words.windows(w)
        first = words.first
        short = {k: words.windows(k)[0] for k in range(1, w)}
        for r in range(end - row):
            a, b = first[r], first[r + 1]
            if b - a >= w:
                yield row + r, np.unique(hashes[a: b - w + 1])
            elif b > a:
                yield row + r, mix(short[b - a][a: a + 1] + U64(b - a))
            else:
                yield row + r, np.zeros(0, U64)


def node_of(own: np.ndarray) -> int:
    """64-bit id of a set: the mixed sum of its mixed hashes, as a signed long."""
    return int(mix(np.atleast_1d(mix(own).sum(dtype=U64) + U64(len(own)))).view(np.int64)[0])


def least_overlap(n: int, percent: int) -> int:
    """Overlap that a set of n must have with any set it links to: ceil(t n)."""
    return -(-percent * n // 100)


def pair_overlap(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Overlap at which sets of n and m link: ceil(t (n + m) / (1 + t))."""
    return -(-percent * (n + m) // (100 + percent))


def reach(n, pos, percent: int):
    """Largest size of a set that an entry can link to. The n - pos shingles from its position on bound the
    overlap, so that two entries may link exactly where each one's size is within the other's reach."""
    return (n - pos) * (100 + percent) // percent - n


def class_width(percent: int) -> float:
    """Width of a size class in ln n: linked sets are at most ``STEPS`` classes apart."""
    return max(math.log(100 / percent), 0.01) * (1 + 1e-9) / STEPS


def sketch_bits(n: int, percent: int) -> int:
    """Classes of the sketch of a set of n: a power of two well over twice the shingles by which it may differ
    from a set that it links to, so that unlike sets, which differ in half of the classes, are told apart."""
    differ = 2 * n * (100 - percent) // (100 + percent)
    return min(SKETCH_BITS, 1 << (differ * 26 // 10 + 63).bit_length())


def sketch(own: np.ndarray, bits: int) -> bytes:
    """A bit a class: whether an odd number of the hashes fall into it."""
    odd = np.bincount(((own >> U64(32)) & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


class Sketches:
    """The sketches of some entries, of which pairs are compared at the smaller size: halves laid over each
    other are the sketch of half as many classes."""

    def __init__(self, rows: Iterable[bytes], order: np.ndarray):
        rows = list(rows)
        words = np.array([len(x) for x in rows], np.int64) // 8
        self.words, self.start = words[order], (np.cumsum(words) - words)[order]
        self.data = np.frombuffer(b"".join(rows), np.uint64)

    def _at(self, i: np.ndarray, words: int) -> np.ndarray:
        out = np.zeros((len(i), words), np.uint64)
        halves = self.words[i] // words
        at = self.start[i][:, None] + np.arange(words)
        for k in range(int(halves.max(initial=0))):
            on = halves > k
            out[on] ^= self.data[at[on] + k * words]
        return out

    def differ(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Classes in which each pair differs: no more than shingles that only one of the two has."""
        out = np.zeros(len(i), np.int64)
        words = np.minimum(self.words[i], self.words[j])
        for size in np.unique(words):
            of = np.flatnonzero(words == size)
            step = max(1, (1 << 17) // int(size))
            for k in range(0, len(of), step):
                some = of[k: k + step]
                out[some] = np.bitwise_count(self._at(i[some], size) ^ self._at(j[some], size)).sum(axis=1, dtype=np.int64)
        return out


def _scan(docs: DataFrame, w: int, percent: int) -> DataFrame:
    """Rows (doc_id, n, node, sketch) per document, and (part, cells) per task with its shingle counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, np.int64)
        names = ["doc_id", "n", "node", "sketch", "part", "cells"]
        for b in batches:
            sizes, nodes, sketches, found = [], [], [], []
            for _, own in shingle_sets(b.column(1), w):
                sizes.append(len(own))
                nodes.append(node_of(own) if len(own) else None)
                sketches.append(sketch(own, sketch_bits(len(own), percent)) if len(own) else None)
                found.append(own)
                if len(found) == 512:
                    counts += np.bincount((np.concatenate(found) & U64(CELLS - 1)).astype(np.int64), minlength=CELLS)
                    found = []
            if found:
                counts += np.bincount((np.concatenate(found) & U64(CELLS - 1)).astype(np.int64), minlength=CELLS)
            none = pa.nulls(len(sizes))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sketches, pa.binary()),
                 none.cast(pa.int64()), none.cast(pa.binary())], names)
        parts = [p for p in range(CELLS // _PART) if counts[p * _PART: (p + 1) * _PART].any()]
        none = pa.nulls(len(parts), pa.int64())
        cells = [_narrow(counts[p * _PART: (p + 1) * _PART]).tobytes() for p in parts]
        yield pa.RecordBatch.from_arrays([none, none, none, pa.nulls(len(parts), pa.binary()), pa.array(parts, pa.int64()), pa.array(cells, pa.binary())], names)

    return docs.mapInArrow(run, "doc_id long, n long, node long, sketch binary, part long, cells binary")


def _narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as the largest takes (1, 2 or 4)."""
    most = int(counts.max())
    return np.minimum(counts, 2**32 - 1).astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4")


def _frequencies(scan: DataFrame) -> np.ndarray:
    """The summed cells as 64 logarithmic steps (1 MB); a fixed size for any input."""

    def add(key, part: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(_PART, np.int64)
        for raw in part.cells:
            total += np.frombuffer(raw, f"<u{len(raw) // _PART}")
        steps = np.floor(4 * np.log2(1 + total)).astype(np.uint8)
        return pd.DataFrame({"part": [key[0]], "cells": [steps.tobytes()]})

    out = np.zeros(CELLS, np.uint8)
    for r in by_group(scan.where("part is not null").select("part", "cells"), ["part"], add, "part long, cells binary").toLocalIterator():
        out[r.part * _PART: (r.part + 1) * _PART] = np.frombuffer(r.cells, np.uint8)
    return out


def _prefixes(docs: DataFrame, w: int, percent: int, frequency, picked) -> DataFrame:
    """(shingle, node, n, pos) of the prefix shingles of every set, with its size and their position in
    it. Of documents with equal sets only the one that stands for the node writes it (``picked``; a few others
    may), and a task writes a set once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = frequency.value
        known: set[int] = set()
        for b in batches:
            out: list[tuple] = []
            size = 0
            ids = np.asarray(b.column(0).fill_null(0))
            for row, own in shingle_sets(b.column(1), w):
                n = len(own)
                if not n:
                    continue
                node = node_of(own)
                if node in known or not holds(picked.value, _pair(np.array([node]), ids[row: row + 1]))[0]:
                    continue
                known.add(node)
                order = np.lexsort((own, rank[own & U64(CELLS - 1)]))
                keep = n - least_overlap(n, percent) + 1
                out.append((own[order[:keep]], node, n))
                size += keep
                if size > 200_000:
                    yield _prefix_rows(out)
                    out, size = [], 0
            if out:
                yield _prefix_rows(out)

    return docs.mapInArrow(run, "shingle long, node long, n int, pos int")


def _prefix_rows(out: list[tuple]) -> pa.RecordBatch:
    times = [len(x[0]) for x in out]
    return pa.RecordBatch.from_arrays(
        [longs(np.concatenate([x[0] for x in out])), pa.array(np.repeat(np.array([x[1] for x in out], np.int64), times)),
         pa.array(np.repeat(np.array([x[2] for x in out], np.int32), times)), pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in times]))],
        ["shingle", "node", "n", "pos"])


def _live(entries: DataFrame) -> DataFrame:
    """The entries whose shingle may have another entry: lists of one set are skipped. A bitmap of
    bounded size tells; it never drops a shingle that comes twice."""
    bits = bitmap_bits(entries.count(), per_row=4)

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            held.append(mix(np.asarray(b.column(0)).view(U64)))  # prefixes hold few of the cells, and so of the low bits
            size += len(held[-1])
            if size > 1_000_000:
                yield from repeat_rows(np.concatenate(held), bits)
                held, size = [], 0
        if size:
            yield from repeat_rows(np.concatenate(held), bits)

    twice = entries.sparkSession.sparkContext.broadcast(collect_bitmap(entries.select("shingle").mapInArrow(emit, BITMAP_ROWS), bits, twice=True))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(holds(twice.value, mix(np.asarray(b.column(0)).view(U64)), both=False)))

    return entries.mapInArrow(run, entries.schema)


def blocks_that_meet(of: np.ndarray, blk: np.ndarray, cross: np.ndarray, low: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (x, y), x <= y, of the blocks of one list (``of``, ascending) that may hold a link: the least size of
    each is within the other's reach. Where two blocks of a long list meet, only pairs across them count."""
    last = np.searchsorted(of, of, "right")
    times = last - np.arange(len(of))
    x = np.repeat(np.arange(len(of)), times)
    y = x + ragged(times)
    keep = (far[x] >= low[y]) & (far[y] >= low[x]) & (~cross[x] | (blk[x] != blk[y]))
    x, y = x[keep], y[keep]
    order = np.argsort(y - x, kind="stable")  # neighbours first: what they tie need not be compared again
    return x[order], y[order]


def ragged(times: np.ndarray) -> np.ndarray:
    """0 .. t - 1 for each t."""
    return np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)


def _compare_lists(percent: int):
    """For rows sorted by list: a spanning forest (a, b) of the pairs of each list that may link."""

    def near(part: pd.DataFrame) -> pd.DataFrame:
        group = part[["shingle", "a", "b"]].to_numpy(np.int64)
        of = np.cumsum(np.append(False, (group[1:] != group[:-1]).any(axis=1)))
        n, pos, blk = (part[c].to_numpy(np.int64) for c in ("n", "pos", "blk"))
        order = np.lexsort((n, pos, np.floor(np.log(n) / class_width(percent)), blk, of))
        of, n, pos, blk, cross = of[order], n[order], pos[order], blk[order], (group[:, 1] != group[:, 2])[order]
        node = part.node.to_numpy(np.int64)[order]
        far = reach(n, pos, percent)
        new = np.append(True, (of[1:] != of[:-1]) | (blk[1:] != blk[:-1]))
        start = np.flatnonzero(new)
        within = np.arange(len(n)) - np.repeat(start, np.diff(np.append(start, len(n))))
        head = np.flatnonzero(within % SKIP == 0)
        many = np.diff(np.append(head, len(n)))
        x, y = blocks_that_meet(of[head], blk[head], cross[head], np.minimum.reduceat(n, head), np.maximum.reduceat(far, head))
        sketches = Sketches(part.sketch, order)
        root = np.arange(len(n))
        times = many[x] * many[y]
        chunk = np.cumsum(times) // _PAIRS
        ends = np.append(np.flatnonzero(chunk[1:] != chunk[:-1]) + 1, len(x))
        at = 0
        for end in ends:
            p, q, t = x[at:end], y[at:end], times[at:end]
            at = end
            least, most = np.minimum.reduceat(root, head), np.maximum.reduceat(root, head)
            apart = (np.minimum(least[p], least[q]) != np.maximum(most[p], most[q])) & ((p != q) | (many[p] > 1))
            p, q, t = p[apart], q[apart], t[apart]
            step, wide = ragged(t), np.repeat(many[q], t)
            i, j = np.repeat(head[p], t) + step // wide, np.repeat(head[q], t) + step % wide
            may = (i < j) & (far[i] >= n[j]) & (far[j] >= n[i]) & (node[i] != node[j]) & (root[i] != root[j])
            i, j = i[may], j[may]
            if not len(i):
                continue
            may = sketches.differ(i, j) <= n[i] + n[j] - 2 * pair_overlap(n[i], n[j], percent)
            unite(root, i[may], j[may])
        tied = root != np.arange(len(root))
        return pd.DataFrame({"a": node[tied], "b": node[root[tied]]})

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for part in parts:
            if not len(part):
                continue
            held = part if held is None else pd.concat([held, part], ignore_index=True)
            keys = held[["shingle", "a", "b"]]
            inner = np.flatnonzero((keys != keys.iloc[-1]).any(axis=1).to_numpy())
            if len(inner):  # the last list may go on
                yield near(held.iloc[: inner[-1] + 1])
                held = held.iloc[inner[-1] + 1:]
        if held is not None and len(held):
            yield near(held)

    return run


def size_class(percent: int) -> Column:
    return F.floor(F.log("n") / class_width(percent))


def list_blocks(entries: DataFrame, percent: int) -> DataFrame:
    """(shingle, node, n, pos, cls, blk) of long lists, each ordered by size class, position and size over as
    many tasks as it fills and cut into blocks of at most ``LIST_BLOCK`` entries."""
    keys = ["shingle", "cls", "pos", "n", "node"]
    size = LIST_BLOCK

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blk, last, held = (TaskContext.get().partitionId() << 32) - 1, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            shingle = np.asarray(b.column(0))
            new = np.append(shingle[0] != last, shingle[1:] != shingle[:-1])
            start = np.flatnonzero(new)
            start = start if new[0] else np.append(-held, start)
            within = np.arange(len(new)) - start[np.searchsorted(start, np.arange(len(new)), "right") - 1]
            ids = blk + np.cumsum(within % size == 0)
            blk, last, held = int(ids[-1]), shingle[-1], int(within[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids)], ["shingle", "node", "n", "pos", "cls", "blk"])

    rows = entries.select("shingle", "node", "n", "pos", size_class(percent).alias("cls"))
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(run, "shingle long, node long, n int, pos int, cls long, blk long")


def meetings(blocks: DataFrame, percent: int) -> DataFrame:
    """(shingle, blk, a, b): the blocks of each list with the pairs (a, b) of blocks that they meet in; pairs
    whose sizes and positions allow no link are skipped."""
    far = F.expr(f"(cast(n as bigint) - pos) * {100 + percent} div {percent} - n")  # as ``reach``
    bounds = blocks.groupBy("shingle", "blk").agg(F.min("n").alias("low"), F.max(far).alias("far"), F.min("cls").alias("first"), F.max("cls").alias("last"))
    one = bounds.select("shingle", F.explode(F.sequence("first", "last")).alias("cls"), F.col("blk").alias("a"), F.col("low").alias("a_low"), F.col("far").alias("a_far"))
    two = bounds.select("shingle", F.explode(F.sequence(F.col("first") - STEPS, F.col("last") + STEPS)).alias("cls"),
                        F.col("blk").alias("b"), F.col("low").alias("b_low"), F.col("far").alias("b_far"))
    pairs = one.join(two, ["shingle", "cls"]).where("a <= b and a_far >= b_low and b_far >= a_low").select("shingle", "a", "b").distinct()
    return pairs.select("shingle", F.explode(F.array_distinct(F.array("a", "b"))).alias("blk"), "a", "b")


def _met(percent: int):
    """Of rows (shingle, node, n, pos) sorted by shingle, those that another node of their list fits in size and
    position; lists of over ``LONE`` entries stay whole."""

    def near(shingle: np.ndarray, node: np.ndarray, n: np.ndarray, pos: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(n), bool)
        far = reach(n, pos, percent)
        new = np.append(True, shingle[1:] != shingle[:-1])
        many = np.diff(np.append(np.flatnonzero(new), len(n)))
        keep[np.repeat(many > LONE, many)] = True
        later = np.repeat(np.cumsum(many), many) - np.arange(len(n)) - 1
        later[keep] = 0
        # as many rows at a time as have _PAIRS pairs or so
        chunk = np.cumsum(later) // _PAIRS
        ends = np.append(np.flatnonzero(chunk[1:] != chunk[:-1]) + 1, len(n))
        at = 0
        for end in ends:
            i = np.repeat(np.arange(at, end), later[at:end])
            j = i + 1 + ragged(later[at:end])
            may = (far[i] >= n[j]) & (far[j] >= n[i]) & (node[i] != node[j])
            keep[i[may]], keep[j[may]] = True, True
            at = end
        return keep

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def told(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            columns = [rows.column(k).to_numpy() for k in range(2)] + [rows.column(k).to_numpy().astype(np.int64) for k in (2, 3)]
            yield from rows.filter(pa.array(near(*columns))).to_batches()

        for b in batches:
            if not b.num_rows:
                continue
            shingle = np.asarray(b.column(0))
            inner = int(np.searchsorted(shingle, shingle[-1]))
            if held and (inner or shingle[0] != held[-1].column(0)[-1].as_py()):
                yield from told(pa.Table.from_batches([*held, b.slice(0, inner)]))
                held = []
            elif inner:
                yield from told(pa.Table.from_batches([b.slice(0, inner)]))
            held.append(b.slice(inner))  # the last list may go on
        if held:
            yield from told(pa.Table.from_batches(held))

    return run


def _divide(live: DataFrame, long) -> tuple[DataFrame, DataFrame]:
    """The rows of short and of long lists; a bitmap of the long ones tells (a few short ones may come with them)."""

    def of(want: bool) -> DataFrame:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array(holds(long.value, np.asarray(b.column(0)).view(U64)) == want))

        return live.mapInArrow(run, live.schema)

    return of(False), of(True)


def _clusters(entries: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(node, root) of the nodes that share an index list with another node they may link to. Drops ``entries``."""
    spark = entries.sparkSession
    live = cut(_live(entries), "jaccard-live")
    drop(entries)
    long = cut(live.groupBy("shingle").agg(F.count("*").alias("_n")).where(F.col("_n") > LIST_BLOCK).select("shingle"), "jaccard-long")
    n_long = long.count()
    short, rest = _divide(live, spark.sparkContext.broadcast(bitmap_of(long, "shingle", bitmap_bits(n_long)))) if n_long else (live, None)
    met = cut(short.repartition("shingle").sortWithinPartitions("shingle").mapInArrow(_met(percent), live.schema), "jaccard-lists")
    used = [met]
    zero = F.lit(0).cast("long")
    names = ["shingle", "a", "b", "node", "n", "pos", "blk"]
    listed = met.withColumns({"a": zero, "b": zero, "blk": zero}).select(names)
    if rest is not None:
        blocks = cut(list_blocks(rest, percent), "jaccard-blocks")
        used += [blocks, cut(meetings(blocks, percent), "jaccard-meetings")]
        listed = listed.unionByName(blocks.join(used[-1], ["shingle", "blk"]).select(names))
    drop(live)
    listed = listed.join(classes.select("node", "sketch"), "node")
    keys = ["shingle", "a", "b"]
    edges = cut(listed.repartition(*keys).sortWithinPartitions(*keys, "node").mapInPandas(_compare_lists(percent), "a long, b long").distinct(), "jaccard-edges")
    for x in used:
        drop(x)
    out = cut(components(edges, "a", "b"), "jaccard-clusters")
    drop(edges)
    return out


class Block:
    """Sets of a block in size order with an index list per shingle."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.size = np.array([len(s) for s in sets], np.int64)
        every, code = np.unique(np.concatenate(sets), return_inverse=True)
        first = np.concatenate(([0], np.cumsum(self.size)))
        self.sets = [code[first[k]: first[k + 1]] for k in range(len(sets))]
        # lists one after the other, each in size order, as the sets are
        self.entries = np.sort(code * len(sets) + np.repeat(np.arange(len(sets)), self.size))
        # past the last set that each may link to
        self.high = np.searchsorted(self.size, self.size * 100 // percent, "right")
        self.percent = percent
        self.visited = 0  # entries of lists

    def tally(self, codes: np.ndarray, low: int, high: int) -> np.ndarray:
        """Overlaps with the sets low .. high - 1; what a list holds before and after them is skipped."""
        m = len(self.sets)
        if high <= low or not len(codes):
            return np.zeros(max(0, high - low), np.int64)
        a, b = np.searchsorted(self.entries, codes * m + low), np.searchsorted(self.entries, codes * m + high)
        times = b - a
        self.visited += int(times.sum())
        return np.bincount(self.entries[np.repeat(a, times) + ragged(times)] % m - low, minlength=high - low)

    def answers(self) -> Iterator[tuple[int, np.ndarray]]:
        """(set, the later sets it links to): overlaps are counted from the lists, or carried over from
        the set most like it among those answered."""
        m = len(self.sets)
        like, best = np.full(m, -1), np.zeros(m, np.int64)
        held: dict[int, np.ndarray] = {}
        for k in range(m):
            own, r, low, high = self.sets[k], like[k], k + 1, int(self.high[k])
            if r >= 0 and self.size[k] + self.size[r] - 2 * best[k] < self.size[k]:
                other, known = self.sets[r], int(self.high[r])
                overlap = np.concatenate((
                    held[r][k - r:] + self.tally(np.setdiff1d(own, other, True), low, known) - self.tally(np.setdiff1d(other, own, True), low, known),
                    self.tally(own, known, high)))
            else:
                overlap = self.tally(own, low, high)
            closer = overlap > best[low:high]
            if closer.any():
                held[k] = overlap.astype(np.int32)
                best[low:high][closer], like[low:high][closer] = overlap[closer], k
            linked = 100 * overlap >= self.percent * (self.size[k] + self.size[low:high] - overlap)
            yield k, low + np.flatnonzero(linked)


def _link(percent: int):
    def compare(key, part: pd.DataFrame) -> pd.DataFrame:
        """A spanning forest of the links of a block; guests meet members, not each other."""
        part = part.drop_duplicates(["node", "guest"])
        sets = [np.frombuffer(x, np.uint64) for x in part["set"]]
        order = sorted(range(len(sets)), key=lambda k: len(sets[k]))
        node = part.node.to_numpy()[order]
        root = np.arange(len(node))
        if len(node) > 1:
            for k, others in Block([sets[x] for x in order], percent).answers():
                near = np.unique(root[np.append(others, k)])
                if len(near) > 1:
                    root[np.isin(root, near)] = near[0]
        tied = root != np.arange(len(node))
        return pd.DataFrame({"a": node[tied], "b": node[root[tied]]})

    return compare


def place(clusters: DataFrame, sizes: DataFrame) -> DataFrame:
    """(root, node, blocks, blk): the block of its cluster that each node is compared in."""
    known = clusters.join(sizes, "node")
    blocks = known.groupBy("root").agg(F.count("*").alias("m"), F.sum("n").alias("sum")).select(
        "root", F.greatest(F.ceil(F.col("m") / BLOCK_SETS), F.ceil(F.col("sum") / BLOCK_SHINGLES)).alias("blocks"))
    return known.select("root", "node").join(blocks, "root").withColumn("blk", F.pmod(F.xxhash64("node"), F.col("blocks")))


def link_sets(placed: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Links (a, b) between nodes that span the link graph of every cluster. ``sets`` reads the sets
    (node, set) of a table's nodes."""
    names = ["root", "blk", "node", "set", "guest"]
    found = sets(placed).join(placed, "node").withColumn("guest", F.lit(False))
    links = cut(by_group(found.select(names), ["root", "blk"], _link(percent), "a long, b long"), "jaccard-links")
    split = placed.where("blocks > 1")
    if split.isEmpty():
        return links
    # sets outside their cluster's largest component so far meet its other blocks
    part = components(links, "a", "b").select("node", F.col("root").alias("part"))
    split = cut(split.join(part, "node", "left").withColumn("part", F.coalesce("part", "node")), "jaccard-split")
    largest = (split.groupBy("root", "part").agg(F.count("*").alias("_n"))
               .groupBy("root").agg(F.max(F.struct("_n", "part")).alias("_most")).select("root", F.col("_most.part").alias("_part")))
    guests = (split.join(largest, "root").where("part <> _part")
              .withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).where("at <> blk")
              .select("root", F.col("at").alias("blk"), "node", F.lit(True).alias("guest")))
    rows = cut(split.select("root", "blk", "node", F.lit(False).alias("guest")).unionByName(guests), "jaccard-guests")
    again = by_group(sets(split).join(rows, "node").select(names), ["root", "blk"], _link(percent), "a long, b long")
    return links.union(cut(again, "jaccard-links"))


def jaccard_components(docs: DataFrame, percent: int = 85, w: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id): documents link when 100 * intersection >= percent * union of
    their shingle sets; component_id is the smallest doc_id reachable by links, itself included.

    Words: runs of bytes outside space, tab, line feed, vertical tab, form feed and carriage return,
    A-Z lower-cased. A null or wordless text has an empty set (n_shingles 0) and is a component of its
    own; a text of fewer than ``w`` words has one shingle, its whole sequence. Repeated rows come out
    repeated; a null doc_id keeps a null component unless it links to others. Columns other than
    doc_id and text are ignored; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scan = cut(_scan(docs, w, percent), "jaccard-scan")
    frequency = spark.sparkContext.broadcast(_frequencies(scan))
    rows = scan.where("part is null").select("doc_id", "n", "node")
    # the document that stands for each node, its smallest
    classes = cut(scan.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("_doc"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "jaccard-classes")
    entries = cut(_prefixes(docs, w, percent, frequency, _picked(classes)), "jaccard-prefixes")
    clusters = _clusters(entries, classes, percent)
    placed = cut(place(clusters, classes.select("node", "n")), "jaccard-places")

    def sets(wanted: DataFrame) -> DataFrame:
        return _sets(docs, w, wanted.select("node").join(classes, "node"))

    roots = components(link_sets(placed, sets, percent), "a", "b")
    first = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = first.groupBy("root").agg(F.min("_doc").alias("component_id"))
    ids = first.join(least, "root").select("node", "component_id")
    return (rows.join(ids, "node", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))


def _pair(node: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return mix(node.view(U64) + mix(doc.view(U64)))


def _picked(wanted: DataFrame):
    """Broadcast bitmap of the pairs (node, _doc) of ``wanted``; null ids stand under 0."""
    pairs = wanted.select("node", F.coalesce("_doc", F.lit(0)).alias("_doc"))
    bits = bitmap_bits(pairs.count())

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from bitmap_rows(_pair(np.asarray(b.column(0)), np.asarray(b.column(1))), bits)

    return wanted.sparkSession.sparkContext.broadcast(collect_bitmap(pairs.mapInArrow(emit, BITMAP_ROWS), bits))


def _sets(docs: DataFrame, w: int, wanted: DataFrame) -> DataFrame:
    """(node, set) of the rows of ``docs`` that stand for a node of ``wanted`` (node, _doc); a bitmap of
    the pairs picks them, so a few others may come along."""
    picked = _picked(wanted)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = np.asarray(b.column(0).fill_null(0))
            nodes, found, size = [], [], 0
            for row, own in shingle_sets(b.column(1), w):
                node = node_of(own) if len(own) else 0
                if not len(own) or not holds(picked.value, _pair(np.array([node]), ids[row: row + 1]))[0]:
                    continue
                nodes.append(node)
                found.append(own)
                size += len(own)
                if size > 500_000:
                    yield _set_rows(nodes, found)
                    nodes, found, size = [], [], 0
            if nodes:
                yield _set_rows(nodes, found)

    return docs.mapInArrow(run, "node long, set binary")


def _set_rows(nodes: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "set"])
