"""Suffix-array dedup (12): deep-shallow sorting of the suffixes that can repeat.

A window is ``length`` consecutive bytes of a text; what occurs twice is removed. The suffixes (one per
window, compared to ``length`` bytes) of all texts fall apart by *minimiser*, the least hash of the
``GRAM``-byte strings in a window: equal windows have equal ones, and neighbouring windows mostly
share theirs, so that a stretch of text travels once for some 85 suffixes.

1. Stretches of windows with one minimiser are listed by hash; a minimiser that occurs at one position
   alone can't be part of a repeat. Texts give the other stretches' bytes.
2. Equal stretches are counted. The distinct ones of each minimiser are sorted in one task: multikey
   quicksort by symbols of eight bytes to depth ``SHALLOW``; what is still equal there goes to blind
   tries: one suffix of a group is the path from root to leaf, the others branch off at the
   byte where they leave it, and those that leave it at one place and byte make the next
   group. Neighbours in the order that agree in ``length`` bytes are repeats.
3. Minimisers with more bytes than a task takes (a line that a third of the texts share, say): their
   windows are counted by Spark's grouping, by 128 bits of hash.
4. Repeats go back to the texts, whose bytes they cover are cut out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import U64, cut, drop, longs, mix, text_slices

LENGTH, GRAM, SHALLOW = 200, 32, 16
STRETCH = 4096       # windows of one stretch
PIECE = 4 << 20      # bytes of a text looked at together
LARGEST = 4 << 20    # bytes of the stretches of one minimiser that a task sorts
_BYTE = np.random.default_rng(0x5AF).integers(1, 2**63, 256, dtype=np.int64).astype(U64)
_BYTE2 = np.random.default_rng(0x5B0).integers(1, 2**63, 256, dtype=np.int64).astype(U64)
_STEP = U64(0x9E3779B97F4A7C15)


def grams(data: np.ndarray, size: int, table: np.ndarray = _BYTE) -> np.ndarray:
    """Hash of the ``size`` bytes from each byte on, by doubling."""
    run, length, step = table[data], 1, _STEP
    out, done, factor = None, 0, U64(1)
    while True:
        if size & length:
            part = run[done:]
            out = part.copy() if out is None else out[: len(part)] + part[: len(out)] * factor
            done += length
            factor = U64((int(factor) * int(step)) & (2**64 - 1))
        if 2 * length > size:
            return mix(out[: len(data) - size + 1])
        run = run[:-length] + run[length:] * step
        step = U64((int(step) * int(step)) & (2**64 - 1))
        length *= 2


def _sliding(values: np.ndarray, size: int, pick: np.ufunc) -> np.ndarray:
    """Least or greatest of ``size`` neighbours from each value on."""
    length = 1
    while 2 * length <= size:
        values = pick(values[:-length], values[length:])
        length *= 2
    rest = size - length
    return pick(values[:-rest], values[rest:]) if rest else values


def stretches(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Maximal runs of windows with one minimiser in texts that lie end to end: (first window, windows,
    minimiser, whether that occurs twice around, text)."""
    begins = np.concatenate(([0], ends[:-1])).astype(np.int64)
    size = ends - begins
    long = np.flatnonzero(size >= length)
    if not len(long):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(U64), none.astype(bool), none
    hashes = grams(data, gram)
    low = _sliding(hashes, length - gram + 1, np.minimum)
    inside = np.zeros(len(low) + 1, np.int8)
    inside[begins[long]] += 1
    inside[ends[long] - length + 1] -= 1
    at = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
    new = np.append(True, (at[1:] != at[:-1] + 1) | (low[at[1:]] != low[at[:-1]]))
    first = at[new]
    count = np.diff(np.append(np.flatnonzero(new), len(at)))
    pieces = -(-count // STRETCH)
    if (pieces > 1).any():
        step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = np.repeat(first, pieces) + step * STRETCH
        count = np.minimum(np.repeat(count, pieces) - step * STRETCH, STRETCH)
    # where a minimiser stands: no window around has a greater least hash
    pad = np.zeros(length - gram, U64)
    stands = np.flatnonzero(hashes == _sliding(np.concatenate([pad, low, pad]), length - gram + 1, np.maximum))
    value = hashes[stands]
    twice = np.isin(low[first], value[1:][value[1:] == value[:-1]])
    return first, count, low[first], twice, np.searchsorted(ends, first, "right")


def _listed(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(mini, k, n, at, windows, twice): the stretches of the texts (k, n, text); a task lists equal texts once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for b in batches:
            keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            new = []
            for k, key in enumerate(keys):
                if key not in seen:
                    seen.add(key)
                    new.append(k)
            b = b.take(pa.array(new, pa.int64()))
            code, size = (np.asarray(b.column(k)) for k in (0, 1))
            for row, _, whole, ends in text_slices(b.column(2)):
                for base in range(0, max(len(whole) - length, 0) + 1, PIECE) if len(ends) == 1 else (0,):
                    data = whole[base: base + PIECE + length - 1] if len(ends) == 1 else whole
                    first, count, mini, twice, text = stretches(data, np.minimum(ends, len(data)), length, gram)
                    if not len(first):
                        continue
                    begins = np.concatenate(([0], ends))[text]
                    yield pa.RecordBatch.from_arrays(
                        [longs(mini), pa.array(code[row + text]), pa.array(size[row + text]), pa.array((first - begins + base).astype(np.int32)),
                         pa.array(count.astype(np.int32)), pa.array(twice)], ["mini", "k", "n", "at", "windows", "twice"])

    return texts.mapInArrow(run, "mini long, k long, n int, at int, windows int, twice boolean")


def _cut_out(met: DataFrame, length: int) -> DataFrame:
    """(mini, sid, k, n, at, bytes): the listed stretches (array ``places``) out of their texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for b in batches:
            out, held = [], 0
            for r in range(b.num_rows):
                k, n = b.column(0)[r].as_py(), b.column(1)[r].as_py()
                if (k, n) in seen:
                    continue
                seen.add((k, n))
                text = b.column(2)[r].as_buffer().to_pybytes()
                for place in b.column(3)[r].as_py():
                    piece = text[place["at"]: place["at"] + place["windows"] + length - 1]
                    out.append((place["mini"], k, n, place["at"], piece))
                    held += len(piece)
                    if held > 1 << 20:
                        yield _batch(out)
                        out, held = [], 0
            if out:
                yield _batch(out)

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["mini", "k", "n", "at", "bytes"])

    found = met.mapInArrow(run, "mini long, k long, n int, at int, bytes binary")
    return found.select("mini", F.xxhash64("bytes").alias("sid"), "k", "n", "at", "bytes")


def _symbols(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte on as a big-endian number (zeros follow the last)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(len(data), U64)
    for k in range(8):
        out |= padded[k: k + len(data)].astype(U64) << U64(56 - 8 * k)
    return out


def _common(symbols: np.ndarray, a: np.ndarray, b: np.ndarray, known: np.ndarray, length: int) -> np.ndarray:
    """Common bytes of the suffixes at a and b (``length`` at most), of which ``known`` are known."""
    out = known.copy()
    todo = np.arange(len(a))
    while len(todo):
        apart = symbols[a[todo] + out[todo]] ^ symbols[b[todo] + out[todo]]
        split = apart != 0
        done, rest = apart[split], todo[~split]
        for bits in (56, 48, 40, 32, 24, 16, 8):
            out[todo[split]] += done < (U64(1) << U64(bits))
        out[rest] += 8
        todo = rest[out[rest] < length]
    return np.minimum(out, length)


def sort_suffixes(data: np.ndarray, at: np.ndarray, group: np.ndarray, length: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Deep-shallow order of the suffixes at ``at`` (each has ``length`` bytes), group by group: the places in
    order, and whether each agrees in ``length`` bytes with the one before it."""
    symbols = _symbols(np.concatenate([data, np.zeros(length + 8, np.uint8)]))
    order, group = at.copy(), np.unique(group, return_inverse=True)[1].astype(np.int64)
    same = np.zeros(len(at), bool)
    slot = np.arange(len(at))
    # shallow: multikey sort, one symbol of eight bytes at a time
    for depth in range(0, min(shallow, length // 8 * 8), 8):
        by = symbols[order[slot] + depth]
        moved = np.lexsort((by, group))
        order[slot] = order[slot][moved]
        slot, group, _ = _classes(slot, group[moved], by[moved])
    known = np.full(len(slot), min(shallow, length // 8 * 8))
    # deep: blind tries
    while len(slot):
        place = order[slot]
        head = place[np.append(True, group[1:] != group[:-1])][group]
        agree = _common(symbols, place, head, known, length)
        leaf = agree >= length
        branch, trunk = data[np.minimum(place + agree, len(data) - 1)], data[np.minimum(head + agree, len(data) - 1)]
        side = np.where(leaf, 1, np.where(branch < trunk, 0, 2))
        level = np.where(leaf, 0, np.where(side == 0, agree, (1 << 16) - 1 - agree))
        by = side << 24 | level << 8 | np.where(leaf, 0, branch)
        moved = np.argsort(group << 26 | by, kind="stable")
        order[slot] = place[moved]
        group, by, leaf = group[moved], by[moved], leaf[moved]
        same[slot[1:]] = leaf[1:] & leaf[:-1] & (group[1:] == group[:-1])
        slot, group, picked = _classes(slot, group, by, ~leaf)
        known = agree[moved][picked]
    return order, same


def _classes(slot: np.ndarray, group: np.ndarray, by: np.ndarray, open_: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries in classes of two or more that agree in group and ``by``: their slots, class numbers and places."""
    new = np.append(True, (group[1:] != group[:-1]) | (by[1:] != by[:-1])) if len(group) else np.zeros(0, bool)
    number = np.cumsum(new) - 1
    several = np.bincount(number, minlength=1)[number] > 1 if len(number) else new
    if open_ is not None:
        several &= open_
    picked = np.flatnonzero(several)
    return slot[picked], np.unique(number[picked], return_inverse=True)[1].astype(np.int64), picked


SPANS = "mini long, sid long, first int, last int"


def _span_rows(mini: np.ndarray, sid: np.ndarray, row: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(mini[row]), pa.array(sid[row]), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
                                      ["mini", "sid", "first", "last"])


def _runs(hit: np.ndarray, begins: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first byte, end) of the stretches' maximal runs of repeated windows."""
    row = np.searchsorted(begins, hit, "right") - 1
    new = np.append(True, (hit[1:] != hit[:-1] + 1) | (row[1:] != row[:-1]))
    last = np.append(np.flatnonzero(new)[1:], len(hit)) - 1
    return row[new], hit[new] - begins[row[new]], hit[last] - begins[row[new]] + length


def _sorted_repeats(distinct: DataFrame, length: int, shallow: int, together: int = 2 << 20) -> DataFrame:
    """(mini, sid, first, last): the bytes of each distinct stretch that repeated windows cover. Rows of one
    minimiser are sorted in one task, several minimisers together."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            for k in range(0, b.num_rows, 1000):
                part = b.slice(k, 1000)
                size += sum(len(x) for x in part.column(3).to_pylist())
                held.append(part)
                if size > together:
                    whole = pa.Table.from_batches(held).combine_chunks()
                    mini = np.asarray(whole.column(0))
                    upto = int(np.searchsorted(mini, mini[-1]))  # the last minimiser may go on
                    if upto:
                        yield repeats(whole.slice(0, upto))
                    held = whole.slice(upto).to_batches()
                    size = sum(len(x) for p in held for x in p.column(3).to_pylist())
        if held:
            yield repeats(pa.Table.from_batches(held))

    def repeats(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        mini, sid, weight = (np.asarray(rows.column(k)) for k in range(3))
        pieces = rows.column(3).to_pylist()
        data = np.frombuffer(b"".join(pieces), np.uint8)
        size = np.array([len(p) for p in pieces])
        begins = np.cumsum(size) - size
        windows = size - length + 1
        row = np.repeat(np.arange(len(size)), windows)
        at = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows) + begins[row]
        order, same = sort_suffixes(data, at, mini[row], length, shallow)
        repeated = np.zeros(len(data), bool)
        pairs = np.flatnonzero(same)
        repeated[order[pairs]] = repeated[order[pairs - 1]] = True
        repeated[at[weight[row] > 1]] = True
        hit = np.flatnonzero(repeated)
        if not len(hit):
            return _span_rows(mini, sid, hit, hit, hit)
        return _span_rows(mini, sid, *_runs(hit, begins, length))

    return distinct.select("mini", "sid", "weight", "bytes").repartition("mini").sortWithinPartitions("mini").mapInArrow(run, SPANS)


def _counted_repeats(distinct: DataFrame, length: int) -> DataFrame:
    """As ``_sorted_repeats`` for minimisers that are too large for a task: windows counted by hash."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for mini, sid, weight, piece in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                data = np.frombuffer(piece, np.uint8)
                a, z = grams(data, length), grams(data, length, _BYTE2)
                n = len(a)
                yield pa.RecordBatch.from_arrays(
                    [longs(a), longs(z), pa.array(np.full(n, mini)), pa.array(np.full(n, sid)), pa.array(np.arange(n, dtype=np.int32)),
                     pa.array(np.full(n, weight))], ["a", "z", "mini", "sid", "first", "weight"])

    windows = distinct.select("mini", "sid", "weight", "bytes").mapInArrow(run, "a long, z long, mini long, sid long, first int, weight long")
    windows = cut(windows, "suffix-windows")  # tables on both sides of the join, so that a hot window can be split
    again = cut(windows.groupBy("a", "z").agg(F.sum("weight").alias("times")).where("times > 1").drop("times"), "suffix-again")
    return windows.join(again.hint("merge"), ["a", "z"]).select("mini", "sid", "first", (F.col("first") + length).alias("last"))


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, shallow: int = SHALLOW, largest: int = LARGEST) -> DataFrame:
    """(k, n, spans): for texts (k a hash of the text, n its bytes, text) with windows that start anywhere else
    too, the covered byte ranges (first, last), neither sorted nor disjoint. Equal texts are one entry, covered whole."""
    if not 0 < gram <= length or length >= 1 << 16:
        raise ValueError("gram must be at most length, and length less than 65536")
    texts = texts.where(F.col("n") >= length)
    copies = texts.groupBy("k", "n").agg(F.count("*").alias("rows")).where("rows > 1").drop("rows")
    copies = copies.select("k", "n", F.lit(0).alias("first"), F.col("n").alias("last"))
    # tables on both sides of the joins, so that a hot minimiser or text can be split
    listed = cut(_listed(texts, length, gram), "suffix-listed")
    place = F.xxhash64("k", "n", "at")
    shared = cut(listed.groupBy("mini").agg(F.min(place).alias("a"), F.max(place).alias("z"), F.max("twice").alias("twice"))
                 .where("a <> z or twice").select("mini"), "suffix-shared")
    places = cut(listed.join(shared.hint("merge"), "mini").groupBy("k", "n").agg(F.collect_set(F.struct("mini", "at", "windows")).alias("places"))
                 .withColumnsRenamed({"k": "_k", "n": "_n"}), "suffix-places")
    drop(listed)
    drop(shared)
    met = texts.join(places.hint("merge"), (F.col("k") == F.col("_k")) & (F.col("n") == F.col("_n"))).select("k", "n", "text", "places")
    pieces = cut(_cut_out(met, length), "suffix-pieces")
    drop(places)
    distinct = cut(pieces.groupBy("mini", "sid", "bytes").agg(F.count("*").alias("weight")), "suffix-distinct")
    large = cut(distinct.groupBy("mini").agg(F.sum(F.octet_length("bytes")).alias("size")).where(F.col("size") > largest).select("mini"), "suffix-large")
    if large.isEmpty():
        spans = _sorted_repeats(distinct, length, shallow)
    else:
        spans = (_sorted_repeats(distinct.join(large.hint("merge"), "mini", "left_anti"), length, shallow)
                 .union(_counted_repeats(distinct.join(large.hint("merge"), "mini", "left_semi"), length)))
    spans = cut(spans, "suffix-spans")
    drop(distinct)
    own = pieces.select("mini", "sid", "k", "n", "at").join(spans.hint("merge"), ["mini", "sid"])
    own = own.select("k", "n", (F.col("at") + F.col("first")).alias("first"), (F.col("at") + F.col("last")).alias("last"))
    own = own.join(copies.select("k", "n").hint("merge"), ["k", "n"], "left_anti").union(copies)
    out = cut(own.groupBy("k", "n").agg(F.collect_list(F.struct("first", "last")).alias("spans")), "suffix-covered")
    drop(pieces)
    drop(spans)
    return out


def remove_repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shallow: int = SHALLOW, largest: int = LARGEST) -> DataFrame:
    """All rows of ``docs`` with ``_kept`` (binary: the text's bytes that stay), ``_n_bytes``, ``_n_removed`` and
    ``_n_spans`` (maximal removed runs); other columns pass through.

    Texts are UTF-8 bytes. A byte goes if a string of ``length`` bytes that covers it also starts anywhere
    else, in the same text or another row's; overlaps count, strings are judged on the input. So every
    text of at least ``length`` bytes that comes twice goes whole, rows that repeat (same id or none)
    too. Null and empty texts, and those shorter than ``length``, lose nothing. Texts of any length are
    looked at whole, a few MB at a time. An empty table gives an empty table. Two texts are taken for equal by
    a hash of 64 bits and their size. The names above, ``_k``, ``_n`` and ``_spans`` are taken.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keys = [F.xxhash64(text).alias("k"), F.octet_length(text).alias("n")]
    found = repeated_spans(docs.select(*keys, text.alias("text")), length, gram, shallow, largest)
    found = found.withColumnsRenamed({"k": "_k", "n": "_n", "spans": "_spans"})
    # spans grow with the texts: the same join at every size
    met = docs.join(found.hint("merge"), (keys[0] == F.col("_k")) & (keys[1] == F.col("_n")), "left")
    met = met.select(*[docs[c] for c in docs.columns], text.alias("_text"), "_spans")
    schema = docs.withColumns({"_kept": F.lit(b""), "_n_bytes": F.lit(0).cast("long"), "_n_removed": F.lit(0).cast("long"),
                               "_n_spans": F.lit(0).cast("long")}).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, spans = b.column(b.num_columns - 2), b.column(b.num_columns - 1)
            kept, size, gone, number = [], [], [], []
            for r in range(b.num_rows):
                raw = texts[r].as_buffer()
                raw = raw.to_pybytes() if raw is not None else b""
                parts, at, count = [], 0, 0
                end = -1
                for first, last in sorted((s["first"], s["last"]) for s in spans[r].as_py() or ()):
                    if first > end:
                        count += 1
                        parts.append(raw[at:first])
                    at = end = max(end, last)
                parts.append(raw[at:])
                kept.append(b"".join(parts))
                size.append(len(raw))
                gone.append(len(raw) - len(kept[-1]))
                number.append(count)
            own = [b.column(k) for k in range(b.num_columns - 2)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(kept, pa.binary()), pa.array(size, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(number, pa.int64())], [f.name for f in schema])

    return met.mapInArrow(run, schema)
