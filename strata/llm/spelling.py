"""Spelling variant grouping (13): vocabulary acceptor o one-edit transducer o vocabulary acceptor.

Two words one edit apart are ``x a y`` and ``x b y`` (a, b at most one code point): they share a prefix or a
suffix of half the shorter word's length. So the composition falls apart by initial states: the part
of the vocabulary's acceptor below the state that a prefix leads to, and the same below a suffix of
the reversed words. Such a part is a bucket (length class, prefix, suffix, cores).

1. Each word goes to the buckets of its length class and of the one below (pairs of lengths s and s + 1
   meet in class s). A pair is left to one bucket: ``x`` is their longest common prefix, and a suffix
   bucket answers for edits before its suffix's half only.
2. Buckets of too many words, or of long cores, are split again by half of their cores, until a core of
   one code point is left, so no task ever holds a bucket larger than the limit or the alphabet allows.
3. A task minimises a bucket's cores into an acyclic acceptor and walks the composition's states: before
   the edit both sides are in the same state, at the edit one or both take a symbol, and after it both
   must accept the same rest. Equal states accept equal rests, so shared suffixes are walked once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, drop

LARGEST = 20_000  # words of a bucket that one task composes
LONGEST = 200     # code points of a core
LEAST_LENGTH, LEAST_COUNT = 5, 3
# fixed values: what words are made of, what is lower-cased
NOT_LETTERS = "[^A-Za-zÀ-ÿ]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Acceptor:
    """Minimal acyclic acceptor of sorted distinct words: ``edges[state]`` maps symbols to states."""

    def __init__(self, words: list[str]):
        self.edges: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}
        self._rests: dict[tuple[int, int, int], list[str]] = {}
        self.start = self._state(words, 0, len(words), 0)

    def _state(self, words: list[str], lo: int, hi: int, depth: int) -> int:
        final = len(words[lo]) == depth
        edges = {}
        k = lo + final
        while k < hi:
            symbol, a = words[k][depth], k
            while k < hi and words[k][depth] == symbol:
                k += 1
            edges[symbol] = self._state(words, a, k, depth + 1)
        key = (final, *edges.items())
        state = self._known.get(key)
        if state is None:
            state = self._known[key] = len(self.edges)
            self.edges.append(edges)
            self.final.append(final)
        return state

    def rests(self, a: int, b: int, length: int) -> list[str]:
        """The words of this length that both states accept."""
        if length == 0:
            return [""] if self.final[a] and self.final[b] else []
        key = (a, b, length) if a <= b else (b, a, length)
        out = self._rests.get(key)
        if out is None:
            ahead, other = self.edges[a], self.edges[b]
            if len(other) < len(ahead):
                ahead, other = other, ahead
            out = []
            for symbol, to in ahead.items():
                if symbol in other:
                    out += [symbol + y for y in self.rests(to, other[symbol], length - 1)]
            self._rests[key] = out
        return out


def one_edit_pairs(words: list[str], short: int, most: int) -> Iterator[tuple[str, str]]:
    """Pairs of the sorted distinct words, of ``short`` and ``short + 1`` symbols, that are one edit apart: two
    of length ``short``, or one of each; the edit, at their longest common prefix, lies before ``most``."""
    acceptor = Acceptor(words)
    edges, rests = acceptor.edges, acceptor.rests
    walk = [(acceptor.start, "")]
    while walk:
        state, x = walk.pop()
        depth = len(x)
        if depth >= most:
            continue
        ahead = list(edges[state].items())
        left = short - depth
        for k, (a, to) in enumerate(ahead):
            # the longer word takes a, the shorter stays
            for y in rests(state, to, left):
                if y[:1] != a:
                    yield x + y, x + a + y
            if left:
                for b, other in ahead[k + 1:]:
                    for y in rests(to, other, left - 1):
                        yield x + a + y, x + b + y
            walk.append((to, x + a))


FOUND = "word string, n_near long, near_n long, near string"


def _compose(rows: DataFrame) -> DataFrame:
    """For each word of each bucket with near words there: how many, and the one of largest n."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def buckets() -> Iterator[tuple[tuple, dict[str, int]]]:
            key, held = None, {}
            for b in batches:
                cols = [b.column(k).to_pylist() for k in range(6)]
                for s, pre, suf, most, core, n in zip(*cols, strict=True):
                    if (s, pre, suf, most) != key:
                        if len(held) > 1:
                            yield key, held
                        key, held = (s, pre, suf, most), {}
                    held[core] = n
            if len(held) > 1:
                yield key, held

        out: list[tuple] = []
        for (s, pre, suf, most), held in buckets():
            best: dict[str, list] = {}
            for u, v in one_edit_pairs(sorted(held), s - len(pre) - len(suf), most):
                for word, near in ((u, v), (v, u)):
                    n = held[near]
                    now = best.get(word)
                    if now is None:
                        best[word] = [1, n, near]
                    else:
                        now[0] += 1
                        if n > now[1] or n == now[1] and near + suf < now[2] + suf:
                            now[1], now[2] = n, near
            out += [(pre + w + suf, k, n, pre + near + suf) for w, (k, n, near) in best.items()]
            if len(out) > 20_000:
                yield _rows(out)
                out = []
        if out:
            yield _rows(out)

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["word", "n_near", "near_n", "near"])

    dealt = rows.select("s", "pre", "suf", "most", "core", "n").repartition(*BUCKET).sortWithinPartitions(*BUCKET)
    return dealt.mapInArrow(run, FOUND)


BUCKET = ["s", "pre", "suf", "most"]


def _halves(rows: DataFrame) -> DataFrame:
    """The buckets' words, split by the first and by the last half of their cores."""
    core, most = F.col("core"), F.col("most")
    half = ((F.col("s") - F.length("pre") - F.length("suf")) / 2).cast("int")
    first = F.struct(F.concat("pre", F.left(core, half)).alias("pre"), F.col("suf"), (most - half).alias("most"),
                     F.substring(core, half + 1, F.length(core)).alias("core"))
    last = F.struct(F.col("pre"), F.concat(F.right(core, half), "suf").alias("suf"), F.least(most, half).alias("most"),
                    F.left(core, F.length(core) - half).alias("core"))
    return rows.select("s", "n", F.explode(F.array(first, last)).alias("to")).select("s", "to.*", "n").where("most > 0")


def near_words(words: DataFrame, largest: int = LARGEST, longest: int = LONGEST) -> DataFrame:
    """(word, n_near, near_n, near): words of a table (word, n), distinct and of two code points at least, with
    words one edit away: how many, and the one of largest n (ties: the least)."""
    s = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("s")
    rows = words.select(s, F.lit("").alias("pre"), F.lit("").alias("suf"), F.col("word").alias("core"), "n").where("s > 0")
    rows = _halves(rows.withColumn("most", F.col("s") + 1))
    parts = []
    while True:
        rows = cut(rows, "spelling-buckets")
        size = F.col("s") - F.length("pre") - F.length("suf")
        large = (rows.groupBy(*BUCKET).agg(F.count("*").alias("words"))
                 .where((F.col("words") > 1) & (size > 1) & ((F.col("words") > largest) | (size > longest))).drop("words"))
        large = cut(large, "spelling-large")
        if large.isEmpty():
            parts.append(rows)
            break
        parts.append(cut(rows.join(large.hint("merge"), BUCKET, "left_anti"), "spelling-buckets"))
        more = cut(_halves(rows.join(large.hint("merge"), BUCKET, "left_semi")), "spelling-buckets")
        drop(rows)
        rows = more
    found = None
    for part in parts:
        found = _compose(part) if found is None else found.union(_compose(part))
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near"))).alias("best")
    out = cut(found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best), "spelling-near")
    for part in parts:
        drop(part)
    return out.select("word", "n_near", (-F.col("best.n")).alias("near_n"), F.col("best.near").alias("near"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of a table (word, form) whose chains end: pointers jump until none moves."""
    up = cut(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = up.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        new = cut(up.join(on.hint("merge"), F.col("root") == F.col("_word"), "left")
                  .select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")), "spelling-roots")
        drop(up)
        up = new
        if up.where("moved").isEmpty():
            return up.select("word", "root")


def group_variants(words: DataFrame, largest: int = LARGEST, longest: int = LONGEST) -> DataFrame:
    """A vocabulary (word, n) with each word's likely correct form: (word, form, root, n, n_near, form_n).

    Words are near if exactly one inserted, deleted or replaced code point makes one the other; ``n_near``
    counts them. ``form`` is the near word of largest n (ties: the least in code-point order) if its n
    is at least twice the word's; else null. ``root`` follows forms to the last one (n doubles with each
    step, so chains end), and is the word itself without any. Words must be distinct; null and empty
    ones and null counts are left out; other columns are left alone. A word may have any length. An
    empty table gives an empty table.
    """
    words = cut(words.select("word", F.col("n").cast("long").alias("n")).where("word <> '' AND n IS NOT NULL"), "spelling-words")
    near = near_words(words, largest, longest).withColumnRenamed("word", "_word")
    met = words.join(near.hint("merge"), F.col("word") == F.col("_word"), "left")
    takes = F.col("near_n") >= 2 * F.col("n")
    told = cut(met.select("word", F.when(takes, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                          F.when(takes, F.col("near_n")).alias("form_n")), "spelling-forms")
    roots = _roots(told.where("form IS NOT NULL")).withColumnRenamed("word", "_word")
    return told.join(roots.hint("merge"), F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def runs(docs: DataFrame) -> DataFrame:
    """(doc_id, run): every maximal run of letters of the texts, A-Z lower-cased; null texts have none."""
    lower = F.translate("text", CAPITALS, CAPITALS.lower())
    return docs.select("doc_id", F.explode(F.split(lower, NOT_LETTERS)).alias("run")).where("run <> ''")


def mistyped(doc_id: Column, run: Column) -> Column:
    """The run without one code point where 97 divides the crc32 of ``doc_id:run`` (null id: empty)."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % 97 == 0, F.concat(F.left(run, at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(found: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the distinct words of a column ``word`` that are long and frequent enough."""
    return found.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)
