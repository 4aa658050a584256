"""Language ID (6): sparse multinomial logistic regression on TF-IDF character n-grams, trained
with follow-the-regularised-leader (proximal) under elastic-net penalties, then temperature
calibration.

A text's features are its hashed n-grams of one to three characters inside words: the share of
each among the text's n-grams times its inverse document frequency over all documents that may
be learned from. The weights are fitted on a bounded sample of them, in numpy on the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import by_group, word_slices
from strata.llm.subwords import WordTable, word_grams

BITS, LEAST_BITS = 16, 10
CELLS = 1 << 24  # weights of a model
LEAST, MOST = 1, 3
SCALE = 30.0  # of the features, so that the learning rate suits them
_PART = 1 << 13
LEAST_ROWS = 20  # of a language to learn from, where it has them


def bits_for(languages: int) -> int:
    """Bits of the feature hash: ``BITS``, and fewer where buckets x languages would be over ``CELLS``."""
    return max(LEAST_BITS, min(BITS, (CELLS // max(languages, 1)).bit_length() - 1))


def _counts(column: pa.Array, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, buckets, counts) of every text."""
    for row, end, words in word_slices(column):
        distinct, at, back = np.unique(words.hash, return_index=True, return_inverse=True)
        raw = words.data.tobytes()
        grams, first = word_grams([raw[a:z].decode(errors="replace") for a, z in zip(words.start[at].tolist(), words.stop[at].tolist(), strict=True)],
                                  LEAST, MOST, bits)
        for r in range(end - row):
            own, times = np.unique(back[words.first[r]: words.first[r + 1]], return_counts=True)
            size = first[own + 1] - first[own]
            place = np.repeat(first[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            total = np.bincount(grams[place], np.repeat(times, size), minlength=1 << bits)
            found = np.flatnonzero(total)
            yield row + r, found, total[found].astype(np.int64)


def document_frequencies(docs: DataFrame, bits: int = BITS) -> tuple[np.ndarray, int]:
    """Documents that hold each bucket, over all rows of ``docs``, and the number of rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros((1 << bits) + 1, np.int64), 0
        for b in batches:
            for row, end, words in word_slices(b.column(0)):
                distinct, at, back = np.unique(words.hash, return_index=True, return_inverse=True)
                raw = words.data.tobytes()
                grams, first = word_grams([raw[a:z].decode(errors="replace") for a, z in zip(words.start[at].tolist(), words.stop[at].tolist(), strict=True)],
                                          LEAST, MOST, bits)
                for r in range(end - row):
                    own = np.unique(back[words.first[r]: words.first[r + 1]])
                    size = first[own + 1] - first[own]
                    place = np.repeat(first[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                    seen = np.zeros(1 << bits, bool)
                    seen[grams[place]] = True
                    held[:-1] += seen
                    n += 1
        held[-1] = n
        parts = range(-(-len(held) // _PART))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(parts), pa.int64()), pa.array([held[p * _PART: (p + 1) * _PART].astype("<i8").tobytes() for p in parts], pa.binary())],
            ["part", "cells"])

    def add(key, part: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(raw, "<i8") for raw in part.cells)
        return pd.DataFrame({"part": [key[0]], "cells": [total.astype("<i8").tobytes()]})

    out = np.zeros((1 << bits) + 1, np.int64)
    rows = docs.select("text").mapInArrow(run, "part long, cells binary")
    for r in by_group(rows, ["part"], add, "part long, cells binary").toLocalIterator():
        cells = np.frombuffer(r.cells, "<i8")
        out[r.part * _PART: r.part * _PART + len(cells)] = cells
    return out[:-1], int(out[-1])


class Model:
    """Weights (buckets x languages), biases, temperature and IDF."""

    def __init__(self, languages: list[str], idf: np.ndarray, alpha=0.5, beta=1.0, l1=0.02, l2=0.02):
        self.languages, self.idf, self.bits = languages, idf, len(idf).bit_length() - 1
        k = len(languages)
        self.z, self.n = np.zeros((len(idf) + 1, k)), np.zeros((len(idf) + 1, k))  # the last row is the bias
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.temperature = 1.0

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) > self.l1, w, 0.0)

    def features(self, buckets: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.append(buckets, len(self.idf))
        x = np.append(SCALE * counts / max(1, counts.sum()) * self.idf[buckets], 1.0)
        return at, x

    def learn(self, buckets: np.ndarray, counts: np.ndarray, label: int) -> None:
        at, x = self.features(buckets, counts)
        w = self.weights(at)
        p = softmax(x @ w)
        p[label] -= 1
        g = x[:, None] * p
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - step * w
        self.n[at] += g * g

    def calibrate(self, logits: np.ndarray, labels: np.ndarray) -> None:
        """The temperature of least negative log-likelihood on texts that were not trained on."""
        grid = np.exp(np.linspace(np.log(0.5), np.log(20), 200))
        loss = [-np.log(softmax(logits / t)[np.arange(len(labels)), labels] + 1e-300).mean() for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(docs: DataFrame, sample_rows: int = 4000, epochs: int = 3) -> Model | None:
    """A model of every ``lang`` value of ``docs`` (doc_id, text, lang): document frequencies over all
    its rows, weights on about ``sample_rows`` distinct rows (at most twice as many, but
    ``LEAST_ROWS`` of each language), as many of each language, chosen by a hash of id and text; every
    fifth of those only sets the temperature. Rows that repeat are one. Many languages share fewer
    feature buckets (``bits_for``), so the model's memory is bounded. None if there is nothing to learn from."""
    known = docs.where("lang is not null and text is not null").withColumn("at", F.xxhash64("doc_id", "text"))
    counts = known.groupBy("lang").agg(F.approx_count_distinct("at", 0.02).alias("rows")).orderBy("lang").collect()
    if not counts:
        return None
    languages, bits = [r.lang for r in counts], bits_for(len(counts))
    quota = max(sample_rows / len(counts), LEAST_ROWS)
    shares = docs.sparkSession.createDataFrame([(r.lang, min(1.0, 1.1 * quota / max(r.rows, 1))) for r in counts], "lang string, share double")
    unit = F.pmod(F.xxhash64("at", F.lit("fit")), F.lit(1 << 30)) / float(1 << 30)
    most = int(2 * quota * len(counts)) + 1
    sample = (known.join(F.broadcast(shares), "lang").where(unit < F.col("share"))  # one row a language
              .select("at", "lang", "text").dropDuplicates(["at", "lang"]).orderBy("at", "lang").limit(most))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, buckets, times in _counts(b.column(2), bits):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(row, 1), b.column(1).slice(row, 1), pa.array([buckets.astype("<i4").tobytes()], pa.binary()),
                     pa.array([times.astype("<i4").tobytes()], pa.binary())], ["at", "lang", "buckets", "counts"])

    rows = sample.mapInArrow(run, "at long, lang string, buckets binary, counts binary").toPandas().sort_values(["at", "lang"], ignore_index=True)
    held, n = document_frequencies(known, bits)
    model = Model(languages, np.log((1 + n) / (1 + held)) + 1)
    label = rows.lang.map({v: k for k, v in enumerate(languages)}).to_numpy()
    x = [(np.frombuffer(a, "<i4"), np.frombuffer(c, "<i4")) for a, c in zip(rows.buckets, rows.counts, strict=True)]
    later = np.arange(len(x)) % 5 == 4
    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(np.flatnonzero(~later)):
            model.learn(*x[k], label[k])
    if later.any():
        logits = []
        for k in np.flatnonzero(later):
            at, v = model.features(*x[k])
            logits.append(v @ model.weights(at))
        model.calibrate(np.array(logits), label[later])
    return model


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with lang_pred and score appended (existing columns of these names are replaced).

    Texts that are null or have no letter get ``und`` and 0, as does every text where there is no
    model; score is the calibrated probability of the predicted language.
    """
    docs = docs.drop("lang_pred", "score")
    names = docs.columns
    text_at = names.index("text")
    schema = docs.withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema
    if model is not None:
        k, bits = len(model.languages), model.bits
        scaled = np.column_stack([SCALE * model.idf[:, None] * model.weights(slice(0, -1)) / model.temperature, np.ones(len(model.idf))])
        shared = docs.sparkSession.sparkContext.broadcast((model.languages, scaled, model.weights(slice(-1, None))[0] / model.temperature))

    def make(words: list[str]) -> np.ndarray:
        """Per word: what its n-grams add to each logit, their number, whether it has a letter."""
        table = shared.value[1]
        grams, first = word_grams(words, LEAST, MOST, bits)
        out = np.add.reduceat(table[grams], first[:-1])
        return np.column_stack([out, [any(map(str.isalpha, w)) for w in words]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(make)
        for b in batches:
            pred, score = ["und"] * b.num_rows, np.zeros(b.num_rows)
            for row, end, words in word_slices(b.column(text_at)) if model is not None else ():
                if not len(words.hash):
                    continue
                languages, _, bias = shared.value
                at, values = table.of(words)
                sums = np.vstack([np.zeros(values.shape[1]), np.cumsum(values[at], axis=0)])
                total = sums[words.first[1:]] - sums[words.first[:-1]]
                p = softmax(total[:, :k] / np.maximum(total[:, k: k + 1], 1) + bias)
                best = p.argmax(axis=1)
                for r in np.flatnonzero(total[:, k + 1] > 0.5):
                    pred[row + r], score[row + r] = languages[best[r]], p[r, best[r]]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())], [*names, "lang_pred", "score"])

    return docs.mapInArrow(run, schema)


def held_out(modulus: int, remainder: int):
    """Whether crc32(doc_id as text) mod ``modulus`` is ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def identify(docs: DataFrame, sample_rows: int = 4000) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document, learned from the text and lang of those
    whose crc32(doc_id as text) mod 3 is not 1 (rows of null id are not learned from).

    Repeated rows are predicted each; other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = fit(rows.where(F.col("doc_id").isNotNull() & ~held_out(3, 1)), sample_rows)
    out = predict(rows.select("doc_id", "text", held_out(3, 1).alias("held_out")), model)
    return out.select("doc_id", "held_out", "lang_pred", "score")
