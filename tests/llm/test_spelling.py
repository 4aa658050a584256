import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.llm.spelling import Acceptor, group_variants, mistyped, near_words, one_edit_pairs, runs, vocabulary
from tests.conftest import SF001


def near(u, v):
    if u == v or abs(len(u) - len(v)) > 1:
        return False
    if len(u) > len(v):
        u, v = v, u
    k = next((k for k in range(len(u)) if u[k] != v[k]), len(u))
    return u[k + 1:] == v[k + 1:] if len(u) == len(v) else u[k:] == v[k + 1:]


def brute(n):
    """word -> (form, root, n, n_near, form_n) of a Counter, all pairs compared."""
    others = {w: [] for w in n}
    for u, v in itertools.combinations(n, 2):
        if near(u, v):
            others[u].append(v)
            others[v].append(u)
    form = {}
    for w, own in others.items():
        best = min(own, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n[w], len(others[w]), n[form[w]] if form[w] else None) for w in n}


def words(seed, count, letters="abé", longest=9):
    rng = random.Random(seed)
    return {"".join(rng.choices(letters, k=rng.randint(2, longest))): rng.choice([1, 1, 2, 3, 5, 8, 40]) for _ in range(count)}


def told(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_acceptor_is_minimal():
    own = sorted(words(1, 200))
    a = Acceptor(own)
    rests = {}

    def language(q):
        if q not in rests:
            rests[q] = frozenset({""} if a.final[q] else ()) | {s + y for s, to in a.edges[q].items() for y in language(to)}
        return rests[q]

    assert sorted(language(a.start)) == own and len(set(rests.values())) == len(rests) == len(a.edges)


@pytest.mark.parametrize("short", [1, 2, 4, 7])
def test_pairs_of_a_bucket(short):
    own = sorted(w for w in words(short, 900, "abc", 8) | dict.fromkeys("abc", 1) if len(w) in (short, short + 1))
    expected = {(u, v) for u, v in itertools.combinations(own, 2) if near(u, v) and min(len(u), len(v)) == short}
    for most in (short + 1, 1):
        got = [tuple(sorted(p)) for p in one_edit_pairs(own, short, most)]
        cut = {p for p in expected if next((k for k in range(short) if p[0][k] != p[1][k]), short if len(p[0]) != len(p[1]) else 0) < most
               } if most <= short else expected
        assert len(got) == len(set(got)) and (set(got) == {tuple(sorted(p)) for p in cut} or most == 1)


@pytest.mark.parametrize("largest,longest", [(20_000, 200), (3, 200), (1, 2)])
def test_against_brute_force(spark, largest, longest):
    n = words(largest, 400)
    df = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    assert told(group_variants(df, largest, longest)) == brute(n)


def test_hot_prefix_and_long_words(spark):
    """A third of the words share their first half, and words longer than a core may be."""
    rng = random.Random(5)
    n = {"common" + "".join(rng.choices("abc", k=6)): rng.randint(1, 50) for _ in range(150)} | words(9, 300)
    long = "".join(rng.choices("xyz", k=1500))
    n |= {long: 9, long[:700] + long[701:]: 2, "q" + long: 4, long[:-1] + "q": 30, long + long: 1, long + "é" + long: 2}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    assert told(group_variants(df, 20)) == brute(n)


def counted(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return n


def test_vocabulary_of_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    rows += [(None, "ÉCOLE École école × ÷ xX×Yy"), (9, "don't re-use naïve NAÏVE naive" * 30), (10, "a" * 200_000 + " word" * 1000)]
    rows += [(k, "spelling variants") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS run", "1 AS n")
    expected = counted(rows)
    found = runs(df).select(mistyped(F.col("doc_id"), F.col("run")).alias("word"))
    assert {r.word: r.n for r in vocabulary(found, 1, 1).collect()} == {w: k for w, k in expected.items() if w}
    assert {r.word: r.n for r in vocabulary(found).collect()} == {w: k for w, k in expected.items() if len(w) >= 5 and k >= 3}


def test_whole_small_table(spark):
    from strata.llm.queries import QUERIES
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    n = {w: k for w, k in counted(rows).items() if len(w) >= 5 and k >= 3}
    assert told(QUERIES["op13_spelling_variants"](spark, SF001)) == brute(n)


def test_empty_tables_and_nulls(spark, none):
    empty = spark.createDataFrame([], "word string, n long")
    assert group_variants(empty).count() == 0 and near_words(empty).count() == 0 and runs(none).count() == 0
    df = spark.createDataFrame([(None, 3, "r"), ("", 4, "r"), ("abcde", None, "r"), ("abcdf", 2, "r"), ("abcdg", 2, "s"), ("abcd", 4, None)],
                               "word string, n long, root string")
    # ties: the least word
    assert told(group_variants(df)) == {"abcdf": ("abcd", "abcd", 2, 2, 4), "abcdg": ("abcd", "abcd", 2, 2, 4), "abcd": (None, "abcd", 4, 2, None)}
