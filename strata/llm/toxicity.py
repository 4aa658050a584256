"""Toxicity (5): subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its hashed character n-grams (and itself), so unseen misspellings share
vectors with words that were seen. A span of a few words is the average of the vectors of its
subwords; a linear softmax on it gives the span's class. A text is as toxic as its most toxic
span: in training, each labelled text stands by the span that the model so far scores highest
(multiple-instance learning), and vectors and softmax are updated together with Adagrad.

As the softmax is linear, a span's score is a sum over its words; each distinct word is scored once
a task, and a text of any length is scored by one pass of running sums over its words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import Words, text_slices, word_slices
from strata.llm.langid import held_out, softmax
from strata.llm.subwords import WordTable, word_grams

BITS, LEAST, MOST = 17, 3, 5
DIM, SPAN = 8, 4
THRESHOLD = 0.3


def _subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return word_grams(words, LEAST, MOST, BITS, whole=True)


class Corpus:
    """Texts as word numbers, and the subwords of each distinct word."""

    def __init__(self, texts: list[str]):
        column = pa.array(texts, pa.string())
        ids, first, vocabulary = [], [0], {}
        names: list[str] = []
        for _, _, data, ends in text_slices(column):
            words = Words(data, ends)
            distinct, at, back = np.unique(words.hash, return_index=True, return_inverse=True)
            raw = data.tobytes()
            number = np.zeros(len(distinct), np.int64)
            for k, (h, a, z) in enumerate(zip(distinct.tolist(), words.start[at].tolist(), words.stop[at].tolist(), strict=True)):
                if h not in vocabulary:
                    vocabulary[h] = len(names)
                    names.append(raw[a:z].decode(errors="replace"))
                number[k] = vocabulary[h]
            ids.append(number[back].astype(np.int32))
            first += (first[-1] + words.first[1:]).tolist()
        del vocabulary
        self.words = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        self.first = np.array(first)
        # a part of the words at a time, as the n-grams in the making take far more room than their buckets
        parts = [_subwords(names[k: k + 20_000]) for k in range(0, len(names), 20_000)]
        self.grams = np.concatenate([g.astype(np.int32) for g, _ in parts]) if parts else np.zeros(0, np.int32)
        self.size = np.concatenate([np.diff(b) for _, b in parts]) if parts else np.zeros(0, np.int64)
        self.begin = np.concatenate(([0], np.cumsum(self.size)))


def span_scores(value: np.ndarray, count: np.ndarray, first: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean of ``value`` per subword over the span of words that starts at each word, words whose
    span is whole or the text's only one). ``first``: first word of each text."""
    n = len(value)
    v, c = np.concatenate(([0.0], np.cumsum(value))), np.concatenate(([0], np.cumsum(count)))
    last = np.repeat(first[1:], np.diff(first))
    begin = np.repeat(first[:-1], np.diff(first))
    at = np.arange(n)
    end = np.minimum(at + span, last)
    whole = (at + span <= last) | (at == begin)
    return (v[end] - v[at]) / np.maximum(c[end] - c[at], 1), whole


def best_span(score: np.ndarray, whole: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Highest span score of each text (-inf for one without words)."""
    out = np.full(len(first) - 1, -np.inf)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        out[some] = np.maximum.reduceat(np.where(whole, score, -np.inf), first[some])
    return out


class Model:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.vectors = rng.normal(0, 0.1, (1 << BITS, DIM))
        self.softmax = rng.normal(0, 0.1, (DIM, 2))
        self.bias = np.zeros(2)
        self.vectors_seen = np.full(1 << BITS, 1e-6)
        self.softmax_seen, self.bias_seen = np.full((DIM, 2), 1e-6), np.full(2, 1e-6)
        self.slope, self.shift = 1.0, 0.0

    def word_values(self, grams: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Sum over each word's subwords of the logit difference of the classes."""
        return np.add.reduceat((self.vectors @ (self.softmax[:, 1] - self.softmax[:, 0]))[grams], begin[:-1]) if len(begin) > 1 else np.zeros(0)

    def logit(self, mean: np.ndarray) -> np.ndarray:
        return mean + self.bias[1] - self.bias[0]

    def step(self, corpus: Corpus, spans: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, rate: float) -> None:
        """One joint update on a batch of spans (arrays of word numbers)."""
        words = np.concatenate(spans)
        of = np.repeat(np.arange(len(spans)), [len(s) for s in spans])
        size = corpus.size[words]
        at = np.repeat(corpus.begin[words] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        grams, row = corpus.grams[at], np.repeat(of, size)
        count = np.bincount(row, minlength=len(spans))
        ids, code = np.unique(grams, return_inverse=True)
        mean = np.zeros((len(spans), DIM))
        for d in range(DIM):
            mean[:, d] = np.bincount(row, self.vectors[grams, d], minlength=len(spans)) / np.maximum(count, 1)
        p = softmax(mean @ self.softmax + self.bias)
        p[np.arange(len(spans)), labels] -= 1
        p *= weight[:, None] / len(spans)
        back = (p @ self.softmax.T) / np.maximum(count, 1)[:, None]
        grad = np.zeros((len(ids), DIM))
        for d in range(DIM):
            grad[:, d] = np.bincount(code, back[row, d], minlength=len(ids))
        g = mean.T @ p
        self.softmax_seen += g * g
        self.softmax -= rate * g / np.sqrt(self.softmax_seen)
        b = p.sum(axis=0)
        self.bias_seen += b * b
        self.bias -= rate * b / np.sqrt(self.bias_seen)
        self.vectors_seen[ids] += (grad * grad).mean(axis=1)
        self.vectors[ids] -= rate * grad / np.sqrt(self.vectors_seen[ids])[:, None]

    def train(self, corpus: Corpus, labels: np.ndarray, whole_epochs: int = 4, span_epochs: int = 6, batch: int = 64, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        texts = np.flatnonzero(np.diff(corpus.first))
        if not len(texts):
            return
        each = [corpus.words[corpus.first[k]: corpus.first[k + 1]] for k in range(len(labels))]
        share = np.clip(labels[texts].mean(), 1e-3, 1 - 1e-3)
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
        for epoch in range(whole_epochs + span_epochs):
            bags = each
            if epoch >= whole_epochs:  # the span that scores highest stands for its text
                value = self.word_values(corpus.grams, corpus.begin)[corpus.words]
                score, whole = span_scores(value, corpus.size[corpus.words], corpus.first, SPAN)
                score = np.where(whole, score, -np.inf)
                bags = []
                for k in range(len(labels)):
                    a, z = corpus.first[k], corpus.first[k + 1]
                    best = a + int(np.argmax(score[a:z])) if z > a else a
                    bags.append(corpus.words[best: min(best + SPAN, z)])
            rate = 0.3 if epoch < whole_epochs else 0.15
            order = rng.permutation(texts)
            for k in range(0, len(order), batch):
                some = order[k: k + batch]
                own = [bags[t] for t in some]
                lab = labels[some]
                if epoch >= whole_epochs:  # a random span of each clean text as well
                    clean = some[lab == 0]
                    for t in clean:
                        a, z = corpus.first[t], corpus.first[t + 1]
                        at = a + int(rng.integers(0, max(1, z - a - SPAN + 1)))
                        own.append(corpus.words[at: min(at + SPAN, z)])
                    lab = np.append(lab, np.zeros(len(clean), np.int64))
                    wgt = np.append(weight[some], weight[clean])
                else:
                    wgt = weight[some]
                self.step(corpus, own, lab, wgt, rate)

    def text_logits(self, corpus: Corpus) -> np.ndarray:
        value = self.word_values(corpus.grams, corpus.begin)[corpus.words]
        score, whole = span_scores(value, corpus.size[corpus.words], corpus.first, SPAN)
        return self.logit(best_span(score, whole, corpus.first))

    def calibrate(self, logits: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> None:
        """Logistic scaling of the highest span's logit on texts that were not trained on."""
        some = np.isfinite(logits)
        x, y, w = logits[some], labels[some], weight[some]
        if len(np.unique(y)) < 2:
            return
        spread = max(1e-6, x.std())
        u = (x - x.mean()) / spread
        a, b = 1.0, 0.0
        for _ in range(50):  # Newton steps with a small penalty, as the classes may be separable
            p = 1 / (1 + np.exp(-(a * u + b)))
            r = w * (p - y)
            h = w * p * (1 - p)
            grad = np.array([(r * u).sum() + 0.02 * a, r.sum() + 0.002 * b])
            hess = np.array([[(h * u * u).sum() + 0.02, (h * u).sum()], [(h * u).sum(), h.sum() + 0.002]])
            move = np.linalg.solve(hess, grad)
            a, b = a - np.clip(move[0], -2, 2), b - np.clip(move[1], -2, 2)
        if a > 0:
            self.slope, self.shift = a / spread, b - a * x.mean() / spread


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 6000, sample_bytes: int = 48 << 20) -> Model | None:
    """A model of ``labels.toxic`` (0 or 1) of the documents, fitted on about ``sample_rows`` labelled rows: half
    of each class where there are as many, chosen by a hash of the id. Rows that repeat are one; an id
    with many texts counts for at most as many rows as fit into twice ``sample_rows``, and texts for at
    most ``sample_bytes`` together (each for an eighth of it), so what the driver gathers is bounded.
    Every fifth row is kept back and sets the scale of the scores. None without labels of both classes."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)").distinct()
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    low = min(counts, key=lambda k: (counts[k], k))
    quota = {low: min(counts[low], sample_rows / 2)}
    quota[1 - low] = min(counts[1 - low], sample_rows - quota[low])
    share = {k: min(1.0, quota[k] / counts[k]) for k in counts}
    unit = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fit")), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.where(unit < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    # chosen is bounded by sample_rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = F.octet_length("text")
    rows = (texts.where(size <= sample_bytes // 8).join(F.broadcast(chosen), "doc_id").withColumn("_at", F.xxhash64("doc_id", "text"))
            .dropDuplicates(["_at", "toxic"]).orderBy("_at", "toxic").limit(2 * sample_rows))
    before = Window.partitionBy(F.lit(0)).orderBy("_at", "toxic").rowsBetween(Window.unboundedPreceding, 0)  # over these rows only
    rows = rows.withColumn("_bytes", F.sum(size).over(before)).where(F.col("_bytes") <= sample_bytes).select("doc_id", "toxic", "text")
    rows = rows.toPandas().sort_values(["doc_id", "toxic", "text"], ignore_index=True)
    if rows.toxic.nunique() < 2:
        return None
    label = rows.toxic.to_numpy(np.int64)
    later = np.zeros(len(rows), bool)
    for c in (0, 1):
        later[np.flatnonzero(label == c)[4::5]] = True
    model = Model()
    corpus = Corpus([t or "" for t in rows.text[~later]])
    model.train(corpus, label[~later])
    if later.any():
        test = Corpus([t or "" for t in rows.text[later]])
        weight = np.where(label[later] == 1, 1 / share[1], 1 / share[0])
        model.calibrate(model.text_logits(test), label[later], weight / weight.mean())
    return model


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` (with text) and a column score: the probability of class 1. A text without words is the
    empty bag, whose score is that of the softmax's bias; without a model every score is 0."""
    docs = docs.drop("score")
    names = docs.columns
    text_at = names.index("text")
    schema = docs.withColumn("score", F.lit(0.0)).schema
    if model is not None:
        worth = (model.vectors @ (model.softmax[:, 1] - model.softmax[:, 0])).astype(np.float64)
        shared = docs.sparkSession.sparkContext.broadcast((worth, model.bias[1] - model.bias[0], model.slope, model.shift))

    def make(words: list[str]) -> np.ndarray:
        grams, begin = _subwords(words)
        return np.column_stack([np.add.reduceat(shared.value[0][grams], begin[:-1]), np.diff(begin)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(make)
        for b in batches:
            out = np.zeros(b.num_rows)
            for row, end, words in word_slices(b.column(text_at)) if model is not None else ():
                _, bias, slope, shift = shared.value
                best = np.full(end - row, -np.inf)
                if len(words.hash):
                    at, values = table.of(words)
                    mean, whole = span_scores(values[at, 0], values[at, 1], words.first, SPAN)
                    best = best_span(mean, whole, words.first)
                best = np.where(np.isfinite(best), best, 0.0) + bias
                out[row:end] = 1 / (1 + np.exp(-np.clip(slope * best + shift, -500, 500)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64())], [*names, "score"])

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = 6000) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; learned only from labels of documents
    whose crc32(doc_id as text) mod 4 is not 2. predicted is 1 from a score of 0.3 on.

    Null texts are empty; a null doc_id is scored but not learned from; repeated rows are scored
    each; columns other than doc_id and text (labels: doc_id and toxic) are ignored.
    """
    model = fit(docs, labels.where(~held_out(4, 2)), sample_rows)
    out = score(docs.select("doc_id", F.col("text").cast("string").alias("text"), held_out(4, 2).alias("held_out")), model)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
