"""Substring dedup (10): fixed-block anchors, every rolling window as probe, maximal exact repeats.

Two documents that share ``window`` consecutive words share one of the aligned blocks of
``block`` words that cut one of them (2 * block - 1 <= window). So:

1. Aligned blocks of every document are indexed (a bitmap of their hashes, of bounded size).
2. Every rolling block-sized window probes the index. Probes that hit are grouped by hash;
   an anchor is one that is aligned somewhere and occurs in two documents.
3. Windows whose aligned blocks are all anchors are candidates (a window that repeats has only
   such blocks, in either document); runs of them are the maximal stretches that can repeat. A
   run that a smaller document has word for word is settled at once (copies).
4. The windows of the other runs are matched by hash over all documents, which is exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (BITMAP_ROWS, U64, Words, bitmap_bits, bitmap_of, bitmap_rows, collect_bitmap, cut, drop,
                               holds, longs, mix, word_slices)

# fixed value: what separates words
SPACES = "[\\x20\\x09-\\x0D]+"
RUNS = "doc_id long, first long, n long, hash long, words binary"


def _aligned(words: Words, block: int) -> np.ndarray:
    """Whether a block starts at each word."""
    at = np.arange(len(words.hash)) - np.repeat(words.first[:-1], np.diff(words.first))
    return at % block == 0


def _rows_of(words: Words) -> np.ndarray:
    return np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))


def _index(docs: DataFrame, block: int) -> np.ndarray:
    """Bitmap of the hashes of all aligned blocks."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = sum(int((np.diff(w.first) // block).sum()) for _, _, w in word_slices(b.column(1)))
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    blocks = docs.mapInArrow(count, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = bitmap_bits(blocks)

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for _, _, words in word_slices(b.column(1)):
                hashes, full = words.windows(block)
                held.append(hashes[full & _aligned(words, block)])
                size += len(held[-1])
                if size > 1_000_000:
                    yield from bitmap_rows(np.concatenate(held), bits)
                    held, size = [], 0
        if size:
            yield from bitmap_rows(np.concatenate(held), bits)

    return collect_bitmap(docs.mapInArrow(emit, BITMAP_ROWS), bits)


def _anchors(docs: DataFrame, block: int, index) -> DataFrame:
    """Hashes of blocks that are aligned in some document and occur in two."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0)
            for row, end, words in word_slices(b.column(1)):
                hashes, full = words.windows(block)
                hit = np.flatnonzero(full)
                hit = hit[holds(index.value, hashes[hit])]
                if not len(hit):
                    continue
                # one row per document and hash
                doc, code, own = _rows_of(words)[hit], hashes[hit], _aligned(words, block)[hit]
                order = np.lexsort((~own, code, doc))
                doc, code, own = doc[order], code[order], own[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])
                yield pa.RecordBatch.from_arrays(
                    [longs(code[new]), ids.slice(row, end - row).take(pa.array(doc[new])), pa.array(own[new])], ["hash", "doc_id", "own"])

    found = docs.mapInArrow(run, "hash long, doc_id long, own boolean")
    return (found.groupBy("hash").agg(F.min("doc_id").alias("_a"), F.max("doc_id").alias("_b"), F.max("own").alias("_own"))
            .where("_own and _a <> _b").select("hash"))


def _runs(docs: DataFrame, block: int, window: int, anchors) -> DataFrame:
    """Maximal stretches of words in whose windows all aligned blocks are anchors: (doc_id, first word,
    words, hash of the stretch, word hashes)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            for row, _, words in word_slices(b.column(1)):
                n = len(words.hash)
                hashes, full = words.windows(block)
                miss = np.zeros(n + 1, np.int64)
                own = np.flatnonzero(full & _aligned(words, block))
                miss[own[~holds(anchors.value, hashes[own])] + 1] = 1
                before = np.cumsum(miss)  # aligned blocks that are no anchors and start before each word
                last = np.repeat(words.first[1:], np.diff(words.first))
                at = np.flatnonzero(np.arange(n) + window <= last)
                at = at[before[at + window - block + 1] == before[at]]
                if not len(at):
                    continue
                doc = _rows_of(words)
                cut_at = np.flatnonzero((np.diff(at) != 1) | (np.diff(doc[at]) != 0)) + 1
                begins, ends = at[np.append(0, cut_at)], at[np.append(cut_at, len(at)) - 1] + window
                place = [(int(a), int(z)) for a, z in zip(begins, ends, strict=True)]
                whole = [int(mix(np.atleast_1d(mix(words.hash[a:z] + np.arange(z - a, dtype=U64) * U64(0x9E3779B97F4A7C15)).sum(dtype=U64) + U64(z - a))).view(np.int64)[0])
                         for a, z in place]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[row + int(doc[a])] for a, _ in place], pa.int64()),
                     pa.array([a - int(words.first[doc[a]]) for a, _ in place], pa.int64()),
                     pa.array([z - a for a, z in place], pa.int64()), pa.array(whole, pa.int64()),
                     pa.array([words.hash[a:z].tobytes() for a, z in place], pa.binary())],
                    ["doc_id", "first", "n", "hash", "words"])

    return docs.mapInArrow(run, RUNS)


def _windows(runs: DataFrame, window: int, picked) -> DataFrame:
    """(hash, doc_id, at): the windows of the runs whose h is in the bitmap."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(holds(picked.value, np.asarray(b.column(3)).view(U64))))
            for k in range(0, b.num_rows, 500):
                some = b.slice(k, 500)
                own = Words.__new__(Words)
                raw = some.column(2).to_pylist()
                size = np.array([len(r) // 8 for r in raw])
                own.hash = np.frombuffer(b"".join(raw), np.uint64)
                own.first = np.concatenate(([0], np.cumsum(size)))
                hashes, full = own.windows(window)
                at = np.arange(len(hashes)) - np.repeat(own.first[:-1], size) + np.repeat(np.asarray(some.column(1)), size)
                doc = np.repeat(np.asarray(some.column(0)), size)
                yield pa.RecordBatch.from_arrays([longs(hashes[full]), pa.array(doc[full]), pa.array(at[full])], ["hash", "doc_id", "at"])

    return runs.mapInArrow(run, "hash long, doc_id long, at long")


def _merged(pairs: DataFrame) -> DataFrame:
    """(doc_id, spans): the sorted disjoint spans that the rows (doc_id, first, end) cover. Rows come in order, so
    a task holds one document's disjoint spans, however many windows cover them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, held = None, []
        ids, lists = [], []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lists, pa.list_(pa.list_(pa.int64())))], ["doc_id", "spans"])

        for b in batches:
            if not b.num_rows:
                continue
            code, a, z = (np.asarray(b.column(k)) for k in range(3))
            for lo, hi in zip(*_edges(code), strict=True):
                if code[lo] != doc:
                    if held:
                        ids.append(doc)
                        lists.append(held)
                    doc, held = int(code[lo]), []
                first, last = a[lo:hi], np.maximum.accumulate(z[lo:hi])
                new = np.append(True, first[1:] > last[:-1])
                for x, y in zip(first[new].tolist(), last[np.append(np.flatnonzero(new)[1:], len(first)) - 1].tolist(), strict=True):
                    if held and x <= held[-1][1]:
                        held[-1][1] = max(held[-1][1], y)
                    else:
                        held.append([x, y])
                if len(ids) >= 2000:
                    yield batch()
                    ids, lists = [], []
        if held:
            ids.append(doc)
            lists.append(held)
        if ids:
            yield batch()

    return pairs.repartition("doc_id").sortWithinPartitions("doc_id", "first").mapInArrow(run, "doc_id long, spans array<array<long>>")


def _edges(code: np.ndarray) -> tuple[list[int], list[int]]:
    """Where the runs of equal values begin and end."""
    at = np.flatnonzero(np.diff(code)) + 1
    return [0, *at.tolist()], [*at.tolist(), len(code)]


def repeats(docs: DataFrame, window: int = 50, block: int = 25) -> DataFrame:
    """(doc_id, spans): the words of each document that a window also found in a document of smaller
    doc_id covers, as sorted disjoint [first, end) word ranges; documents without any are absent.
    Documents of null doc_id neither lose words nor make others lose any."""
    spark = docs.sparkSession
    if 2 * block - 1 > window:
        raise ValueError("a window must hold an aligned block: 2 * block - 1 <= window")
    docs = docs.where("doc_id is not null")
    index = spark.sparkContext.broadcast(_index(docs, block))
    anchors = cut(_anchors(docs, block, index), "repeat-anchors")
    index.unpersist()
    marks = spark.sparkContext.broadcast(bitmap_of(anchors, "hash", bitmap_bits(anchors.count(), per_row=32)))
    runs = cut(_runs(docs, block, window, marks), "repeat-runs")
    drop(anchors)
    # a run that a smaller document has whole repeats whole
    keys = runs.select("doc_id", "first", "n", "hash")
    first = keys.groupBy("hash", "n").agg(F.min("doc_id").alias("_doc"), F.max("doc_id").alias("_last")).where("_doc <> _last").drop("_last")
    first = cut(first, "repeat-copies")  # tables on both sides of the joins, so that AQE can split a hot run or window
    told = keys.join(first, ["hash", "n"], "left").select(
        "doc_id", "first", "n", F.coalesce(F.col("_doc") < F.col("doc_id"), F.lit(False)).alias("_copy"))
    told = cut(told, "repeat-told")
    copies = told.where("_copy").select("doc_id", "first", (F.col("first") + F.col("n")).alias("end"))
    # the other runs, by a bitmap (a copy that comes along is only compared once more)
    rest = told.where("not _copy").select(F.xxhash64("doc_id", "first").alias("h"))
    picked = spark.sparkContext.broadcast(bitmap_of(rest, "h", bitmap_bits(rest.count())))
    windows = _windows(runs.select("doc_id", "first", "words", F.xxhash64("doc_id", "first").alias("h")), window, picked)
    least = (windows.select("hash", "doc_id").groupBy("hash").agg(F.min("doc_id").alias("_doc"), F.max("doc_id").alias("_last"))
             .where("_doc <> _last").select("hash", "_doc"))
    least = cut(least, "repeat-least")
    again = (windows.join(least, "hash").where("_doc < doc_id")
             .select("doc_id", F.col("at").alias("first"), (F.col("at") + window).alias("end")))

    out = cut(_merged(copies.union(again)), "repeat-spans")
    for table in (runs, told, first, least):
        drop(table)
    return out


def remove_repeats(docs: DataFrame, window: int = 50, block: int = 25) -> DataFrame:
    """All rows of ``docs`` with ``_kept`` (the words that stay, joined by one space), ``_n_words``,
    ``_n_removed`` and ``_sha256`` (of the kept text); other columns pass through.

    Words: runs of bytes outside space, tab, line feed, vertical tab, form feed and carriage return. A
    word goes if a window of ``window`` words of its document that covers it also starts in a
    document of smaller doc_id; windows are judged on the input. Null and empty texts have no
    words. Rows that repeat a doc_id are one document to this rule (a window in both is not
    a repeat; what goes from one goes from each at the same word positions). Documents of null doc_id
    keep all words. Texts of any length are looked at whole. An empty table gives an empty table. The names above and ``_doc``, ``_spans``,
    ``_words`` and ``_left`` are taken.
    """
    found = repeats(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), window, block)
    found = found.withColumnsRenamed({"doc_id": "_doc", "spans": "_spans"})
    words = F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), SPACES), lambda w: w != "")
    # the words between the spans, each looked at once
    left = F.expr("""CASE WHEN _spans IS NULL THEN _words ELSE flatten(transform(sequence(0, size(_spans)), k ->
        slice(_words, CAST(coalesce(get(_spans, k - 1)[1], 0) + 1 AS int),
              CAST(greatest(0, least(coalesce(get(_spans, k)[0], size(_words)), size(_words)) - coalesce(get(_spans, k - 1)[1], 0)) AS int)))) END""")
    # spans grow with the documents: the same join at every size
    joined = docs.join(found.hint("merge"), docs.doc_id.cast("long") == found["_doc"], "left").withColumn("_words", words).withColumn("_left", left)
    told = joined.select(*[docs[c] for c in docs.columns], F.array_join("_left", " ").alias("_kept"),
                         F.size("_words").cast("long").alias("_n_words"), (F.size("_words") - F.size("_left")).cast("long").alias("_n_removed"))
    return told.withColumn("_sha256", F.sha2("_kept", 256))
