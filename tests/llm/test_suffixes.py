import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from strata.llm.queries import QUERIES
from strata.llm.suffixes import remove_repeated_bytes, sort_suffixes, stretches


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    times = Counter(b[k:k + length] for b in raw for k in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - length + 1):
            if times[b[k:k + length]] > 1:
                gone[k:k + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out.append((len(b), int(gone.sum()), int((gone[:-1] & ~gone[1:]).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def told(df):
    return {r.doc_id: (r["_n_bytes"], r["_n_removed"], r["_n_spans"], hashlib.sha256(r["_kept"]).hexdigest()) for r in df.collect()}


@pytest.mark.parametrize("length,shallow", [(200, 16), (12, 8), (30, 0), (40, 40)])
def test_suffix_order(length, shallow):
    rng = random.Random(length)
    part = [bytes(rng.choices(b"ab", k=rng.randint(1, 3 * length))) for _ in range(12)]
    raw = b"".join(rng.choice(part) + bytes(rng.choices(b"ab\xff", k=2)) for _ in range(40)) + b"a" * (2 * length)
    data, n = np.frombuffer(raw, np.uint8), len(raw) - length + 1
    group = np.sort(np.random.default_rng(1).integers(0, 3, n))
    order, same = sort_suffixes(data, np.arange(n), group, length, shallow)
    expected = sorted(range(n), key=lambda k: (group[k], raw[k:k + length]))
    assert [(group[k], raw[k:k + length]) for k in order] == [(group[k], raw[k:k + length]) for k in expected] and sorted(order) == list(range(n))
    assert [bool(x) for x in same] == [k > 0 and group[order[k]] == group[order[k - 1]] and raw[order[k]:order[k] + length] == raw[order[k - 1]:order[k - 1] + length]
                                       for k in range(n)]


def test_equal_windows_share_their_minimiser():
    rng = random.Random(3)
    own = bytes(rng.choices(b"abc", k=300))
    texts = [own, b"x" * 40, b"zz" + own[50:250] + b"y", own[:30] * 6]
    ends = np.cumsum([len(t) for t in texts])
    first, count, mini, twice, text = stretches(np.frombuffer(b"".join(texts), np.uint8), ends, 60, 10)
    raw, minis, own_twice = b"".join(texts), {}, {}
    for a, n, m, w, t in zip(first, count, mini, twice, text, strict=True):
        for k in range(a, a + n):
            assert ends[t] - len(texts[t]) <= k and k + 60 <= ends[t]
            minis.setdefault(raw[k:k + 60], []).append((m, a, w))
    assert sum(count) == sum(max(len(t) - 59, 0) for t in texts)
    for found in minis.values():
        assert len({m for m, _, _ in found}) == 1
        own_twice = {a for _, a, _ in found}
        assert len(found) == 1 or len(own_twice) > 1 or found[0][2]


def corpus(seed, length, n):
    rng = random.Random(seed)
    passages = ["".join(rng.choices("abcdé \n", k=rng.randint(length // 2, 4 * length))) for _ in range(8)]
    out = []
    for _ in range(n):
        own = ""
        for _ in range(rng.randint(0, 4)):
            own += rng.choice(passages) if rng.random() < 0.4 else "".join(rng.choices("abcdé \n", k=rng.randint(1, 2 * length)))
        out.append(own + ("=" * rng.randint(0, 3 * length) if rng.random() < 0.1 else ""))
    return out + out[:5]


@pytest.mark.parametrize("length,gram,largest", [(200, 32, 1 << 22), (30, 8, 1 << 22), (30, 8, 200), (24, 24, 0)])
def test_against_brute_force(spark, length, gram, largest):
    texts = corpus(length, length, 90)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = told(remove_repeated_bytes(df, length, gram, largest=largest))
    assert [got[k] for k in range(len(texts))] == brute(texts, length)
    assert any(0 < r < n and spans > 1 for n, r, spans, _ in got.values())


def test_whole_small_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    expected = dict(zip([r.doc_id for r in rows], brute([r.text for r in rows], 200), strict=True))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op12_suffix_array_dedup"](spark, sf).collect()}
    assert got == expected and sum(r[1] for r in got.values()) > 0


def test_nulls_repeated_rows_and_extra_columns(spark, documents, none):
    rows = remove_repeated_bytes(documents.selectExpr("*", "1 AS k", "2 AS n", "'x' AS spans"), 12, 4).collect()
    assert len(rows) == 8 and rows[0].k == 1 and rows[0].spans == "x"
    texts = [r.text for r in documents.collect()]
    assert sorted((r["_n_bytes"], r["_n_removed"], r["_n_spans"], hashlib.sha256(r["_kept"]).hexdigest()) for r in rows) == sorted(brute(texts, 12))
    assert remove_repeated_bytes(none).count() == 0
    twice = spark.createDataFrame([(None, "x" * 10 + "y" * 200)] * 2 + [(1, "z" * 199)] * 2, "doc_id long, text string")
    assert sorted((r["_n_removed"], r["_n_spans"]) for r in remove_repeated_bytes(twice).collect()) == [(0, 0), (0, 0), (210, 1), (210, 1)]


def test_very_long_text(spark, monkeypatch):
    rng = random.Random(1)
    long = "".join(rng.choices("abcdefgh", k=9_000_000))
    texts = [long, "x" + long[4_194_200:4_194_600] + "y", "q" * 1_000_000, long[-300:-50], "é" * 150]
    got = told(remove_repeated_bytes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    assert [got[k][1:3] for k in range(5)] == [(650, 2), (400, 1), (1_000_000, 1), (250, 1), (300, 1)]


def test_bad_sizes(spark, documents):
    with pytest.raises(ValueError):
        remove_repeated_bytes(documents, 10, 11)
