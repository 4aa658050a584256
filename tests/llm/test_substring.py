import hashlib
import random
import re

import pytest

from strata.llm.substring import remove_repeats


def brute(docs, window):
    words = {d: [x for x in re.split("[\x20\x09-\x0d]+", t or "") if x] for d, t in docs}
    first = {}
    for d in sorted(words):
        for k in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][k:k + window]), d)
    out = {}
    for d, own in words.items():
        gone = set()
        for k in range(len(own) - window + 1):
            if first[tuple(own[k:k + window])] < d:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        out[d] = (len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("window,block", [(50, 25), (8, 4), (9, 3)])
def test_against_brute_force(spark, window, block):
    rng = random.Random(window)
    word = lambda: rng.choice("abcdefghijklmnop") + rng.choice(["", "é", "z"])
    passages = [[word() for _ in range(rng.randint(window - 2, 3 * window))] for _ in range(12)]
    docs = []
    for k in range(120):
        own = []
        for _ in range(rng.randint(0, 5)):
            own += rng.choice(passages) if rng.random() < 0.5 else [word() for _ in range(rng.randint(1, window))]
        if rng.random() < 0.1:
            own += ["again"] * rng.randint(1, 3 * window)
        docs.append((k * 7 % 120, rng.choice([" ", "\n", "  "]).join(own)))
    rows = remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), window, block).collect()
    assert {r.doc_id: (r["_n_words"], r["_n_removed"], r["_sha256"]) for r in rows} == brute(docs, window)
    assert any(r["_n_removed"] for r in rows)


def test_edge_rows(spark, documents, none):
    rows = remove_repeats(documents, 4, 2).collect()
    assert len(rows) == 8 and {(r.doc_id, r["_n_removed"], r["_kept"]) for r in rows} == {
        (1, 0, "Alpha beta gamma delta epsilon."), (2, 0, ""), (3, 0, ""), (None, 0, "alpha beta"), (5, 5, ""), (6, 0, ""), (7, 0, "12 34 !!")}
    assert rows[0].score is not None  # other columns stay
    assert remove_repeats(none).count() == 0


def test_very_long_text(spark):
    rng = random.Random(1)
    words = [str(rng.random()) for _ in range(40_000)]
    docs = [(1, " ".join(words)), (2, " ".join(["x"] * 40 + words[100:30_000])), (3, "".join(words)), (4, "".join(words))]
    rows = {r.doc_id: r for r in remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert rows[2]["_kept"] == " ".join(["x"] * 40) and rows[1]["_n_removed"] == 0 and rows[4]["_n_removed"] == 0


def test_block_must_fit(spark, documents):
    with pytest.raises(ValueError):
        remove_repeats(documents, 10, 6)
