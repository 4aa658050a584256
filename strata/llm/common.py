"""Shared parts: scratch tables, word hashing over Arrow batches, bitmaps, grouping, components.

Word kernel. Words are the runs of bytes outside ``\\x20 \\x09-\\x0D``; as these are ASCII, the
split works on UTF-8 bytes. One numpy pass hashes every word of a slice of rows to 64 bits;
windows of k words are hashed from the word hashes by doubling. Two different words or
windows share a hash with probability 2^-64 a pair.

Scratch tables. ``cut`` writes a DataFrame as Parquet below ``spark.checkpoint.dir`` (one folder a
call, never reused) and reads it back; a lost executor then costs a re-read. Tables live
until ``drop`` is called or the owner of the checkpoint folder cleans it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE = np.random.default_rng(0x5EED).integers(1, 2**63, 256, dtype=np.int64).astype(U64)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_STEP = U64(0x9E3779B97F4A7C15)
_WORD_STEP = U64(0xD6E8FEB86659FD93)
SLICE_BYTES = 1 << 18


# -- tables -----------------------------------------------------------------------------

_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh scratch table and read it back (lineage ends there)."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    # what the write shuffled goes when it ends, not when the driver happens to collect its garbage
    before = spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_RELEASE)
        else:
            spark.conf.set(_RELEASE, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop(df: DataFrame) -> None:
    """Delete a table made by ``cut`` that no later plan reads."""
    spark, path = df.sparkSession, df._scratch
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- hashing ----------------------------------------------------------------------------

def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64 bits (wrapping arithmetic)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class Words:
    """Words of some rows: hashes, byte ranges, and the first word of each row.

    ``first`` has one entry more than rows; row r owns words first[r]:first[r + 1].
    """

    def __init__(self, data: np.ndarray, ends: np.ndarray, lower: bool = False):
        # ends: byte offset where each row's text ends; the first row starts at 0
        n = len(data)
        solid = ~_SPACE[data]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        row_at = np.concatenate(([0], ends))[:-1]
        row_at = row_at[row_at < n]
        begins[row_at] |= solid[row_at]
        self.start = np.flatnonzero(begins)
        self.first = np.concatenate(([0], np.searchsorted(self.start, ends)))
        self.data = data
        if not len(self.start):
            self.hash, self.stop = np.zeros(0, U64), self.start
            return
        letters = data[solid]
        at = np.flatnonzero(begins[solid])
        size = np.diff(np.append(at, len(letters)))
        self.stop = self.start + size
        place = np.arange(len(letters)) - np.repeat(at, size)
        power = np.cumprod(np.full(int(size.max()), _STEP, U64))
        value = (_BYTE_LOWER if lower else _BYTE)[letters] * power[place]
        self.hash = mix(np.add.reduceat(value, at) + size.astype(U64))

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on, and whether they end in the same row."""
        h = self.hash
        n = len(h)
        if n < k:
            return np.zeros(n, U64), np.zeros(n, bool)
        run, length, step = h, 1, _WORD_STEP
        out, done, factor = None, 0, U64(1)
        while True:
            if k & length:
                part = run[done:]
                out = part.copy() if out is None else out[: len(part)] + part[: len(out)] * factor
                done += length
                factor = U64((int(factor) * int(step)) & (2**64 - 1))
            if 2 * length > k:
                break
            run = run[:-length] + run[length:] * step
            step = U64((int(step) * int(step)) & (2**64 - 1))
            length *= 2
        out = mix(out[: n - k + 1])
        full = np.zeros(n, U64)
        full[: len(out)] = out
        last = np.repeat(self.first[1:], np.diff(self.first))
        return full, np.arange(n) + k <= last


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, byte ends of the rows) for runs of rows of about ``limit``
    bytes; one long text is a run of its own. Null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        end = min(end, n)
        yield row, end, data[offsets[row]: offsets[end]], offsets[row + 1: end + 1] - offsets[row]
        row = end


def word_slices(column: pa.Array, lower: bool = False) -> Iterator[tuple[int, int, Words]]:
    for row, end, data, ends in text_slices(column):
        yield row, end, Words(data, ends, lower)


def longs(values: np.ndarray) -> pa.Array:
    """Unsigned 64-bit values as Spark longs of the same bits."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))


# -- bitmaps ----------------------------------------------------------------------------

CHUNK = 1 << 18  # bits of a bitmap that one row carries


def bitmap_bits(rows: int, per_row: int = 16, least: int = 1 << 20, most: int = 1 << 31) -> int:
    """Power of two of at least ``per_row`` bits a row, never over ``most`` (256 MB): a proven
    bound on what is broadcast. Past it the bitmap lets more rows through; nothing is lost."""
    bits = least
    while bits < rows * per_row and bits < most:
        bits *= 2
    return bits


def probes(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit positions of each hash."""
    mask = U64(bits - 1)
    return hashes & mask, mix(hashes) & mask


def bitmap_rows(hashes: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (chunk, offsets) of the bits that ``hashes`` set."""
    at = np.unique(np.concatenate(probes(hashes, bits)))
    chunk = (at // U64(CHUNK)).astype(np.int64)
    edges = np.flatnonzero(np.diff(chunk, prepend=-1, append=-2))
    low = (at % U64(CHUNK)).astype("<u4")
    for k in range(0, len(edges) - 1, 64):
        some = range(k, min(k + 64, len(edges) - 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(chunk[edges[i]]) for i in some], pa.int64()),
             pa.array([low[edges[i]: edges[i + 1]].tobytes() for i in some], pa.binary())],
            ["chunk", "offsets"])


BITMAP_ROWS = "chunk long, offsets binary"


def repeat_rows(hashes: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (chunk, offsets) of one bit a hash, twice where two of ``hashes`` set it."""
    at, times = np.unique(hashes & U64(bits - 1), return_counts=True)
    for some in (at, at[times > 1]):
        chunk = (some // U64(CHUNK)).astype(np.int64)
        edges = np.flatnonzero(np.diff(chunk, prepend=-1, append=-2))
        low = (some % U64(CHUNK)).astype("<u4")
        yield pa.RecordBatch.from_arrays(
            [pa.array(chunk[edges[:-1]], pa.int64()),
             pa.array([low[a:z].tobytes() for a, z in zip(edges[:-1], edges[1:], strict=True)], pa.binary())], ["chunk", "offsets"])


def collect_bitmap(rows: DataFrame, bits: int, twice: bool = False) -> np.ndarray:
    """The bitmap that rows (chunk, offsets) describe: OR by chunk on the executors (``twice``: the bits
    that come at least twice), then bits / 8 bytes come to the driver (a fixed size)."""

    def union(key, part: pd.DataFrame) -> pd.DataFrame:
        flags, once = np.zeros(CHUNK, bool), np.zeros(CHUNK, bool)
        for raw in part.offsets:
            at = np.frombuffer(raw, "<u4")
            if twice:
                flags[at[once[at]]] = True
                once[at] = True
            else:
                flags[at] = True
        return pd.DataFrame({"chunk": [key[0]], "flags": [np.packbits(flags, bitorder="little").tobytes()]})

    out = np.zeros(bits // 8, np.uint8)
    size = CHUNK // 8
    for r in by_group(rows, ["chunk"], union, "chunk long, flags binary").toLocalIterator():
        out[r.chunk * size: r.chunk * size + size] = np.frombuffer(r.flags, np.uint8)[: len(out) - r.chunk * size]
    return out


def holds(bitmap: np.ndarray, hashes: np.ndarray, both: bool = True) -> np.ndarray:
    """Whether each hash may be in the bitmap (never False for one that is); ``both``: two bits a hash."""
    bits = len(bitmap) * 8
    found = np.ones(len(hashes), bool)
    for at in probes(hashes, bits)[: 2 if both else 1]:
        found &= (bitmap[at >> U64(3)] >> (at & U64(7)).astype(np.uint8)) & 1 == 1
    return found


def bitmap_of(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bitmap of a long column."""

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from bitmap_rows(np.asarray(b.column(0)).view(U64), bits)

    return collect_bitmap(df.select(F.col(column).cast("long")).dropna().mapInArrow(emit, BITMAP_ROWS), bits)


# -- groups -----------------------------------------------------------------------------

def by_group(df: DataFrame, keys: list[str], fn: Callable, schema: str) -> DataFrame:
    """``fn(key tuple, rows)`` for each group, streamed: rows are dealt by the keys and sorted, so a
    task holds one group at a time and thousands of small groups cost no call each into the JVM.
    Callers keep every group bounded."""

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        key = None
        ready: list[pd.DataFrame] = []
        for part in parts:
            if not len(part):
                continue
            codes = part[keys]
            change = np.flatnonzero((codes != codes.shift()).any(axis=1).to_numpy())
            change = np.unique(np.append(change, 0))
            for a, b in zip(change, np.append(change[1:], len(part)), strict=True):
                now = tuple(codes.iloc[a])
                if key is not None and now != key:
                    ready.append(fn(key, held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)))
                    held = []
                key = now
                held.append(part.iloc[a:b])
            if len(ready) >= 256 or sum(map(len, ready)) > 20_000:
                yield pd.concat(ready, ignore_index=True)
                ready = []
        if held:
            ready.append(fn(key, pd.concat(held, ignore_index=True)))
        if ready:
            yield pd.concat(ready, ignore_index=True)

    return df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys).mapInPandas(run, schema)


def unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the components of the pairs (i, j); ``root`` holds each entry's smallest known entry."""
    while len(i):
        a, b = root[i], root[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        if not len(i):
            break
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def _contract(edges: DataFrame) -> DataFrame:
    """The links (hi, lo) of each task as stars around its components' smallest nodes: no shuffle, no
    more rows than nodes or links, the same components."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(np.asarray(b.column(0)), np.asarray(b.column(1))) for b in batches if b.num_rows]
        if not parts:
            return
        hi, lo = (np.concatenate(x) for x in zip(*parts, strict=True))
        nodes, code = np.unique(np.concatenate([hi, lo]), return_inverse=True)
        root = np.arange(len(nodes))
        unite(root, code[: len(hi)], code[len(hi):])
        tied = np.flatnonzero(root != np.arange(len(nodes)))
        for k in range(0, len(tied), 100_000):
            some = tied[k: k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(nodes[root[some]])], ["hi", "lo"])

    return edges.mapInArrow(run, "hi long, lo long")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of undirected links between longs: one row (node, root) for every
    node with a link to another node; root is the smallest node reachable.

    Alternating large-star and small-star steps on Spark joins, each round written to a scratch
    table, until the links are stars (a logarithmic number of rounds); each task first contracts
    the links that it holds, so a node that many hang on has at most one link per other node and task.
    Null ends and self-links are ignored; no links give an empty table.
    """
    e = edges.select(F.greatest(a, b).cast("long").alias("hi"), F.least(a, b).cast("long").alias("lo")).dropna().where("hi <> lo")
    e = cut(_contract(e).distinct(), "cc")
    while True:
        # stars: no node hangs on two others, and none that others hang on hangs itself
        ends = e.select(F.col("hi").alias("u"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("lo", F.lit(0), F.lit(1)))
        loose = ends.groupBy("u").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).where("up > 1 or up = 1 and down > 0")
        if loose.isEmpty():
            break
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = cut(_contract(large), "cc")
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        met = large.join(low, "hi")
        small = met.select(F.col("hi"), F.col("m").alias("lo")).union(met.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
        new = cut(_contract(small).distinct(), "cc")
        drop(e)
        drop(large)
        e = new
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
