import numpy as np

from strata.llm import vectors
from strata.llm.vectors import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.9):
    ok = [k for k, (_, v) in enumerate(rows) if v is not None and len(v) == 16 and None not in v and np.isfinite(v).all() and np.any(v)]
    x = np.array([np.float32(rows[k][1]).astype(float) for k in ok])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    out = {v: (0, v) for v, _ in rows}
    root = vectors.spanning(near)
    for i, k in enumerate(ok):
        out[rows[k][0]] = (int(near[i].sum()), min(rows[ok[j]][0] for j in np.flatnonzero(root == root[i])))
    return out


def groups(rng, n, tight):
    base = rng.standard_normal((n, 16))
    rows = [base[rng.integers(0, n // 4)] + tight * rng.standard_normal(16) * rng.random() for _ in range(n)]
    return [(1000 + 3 * k, [float(np.float32(e)) for e in v]) for k, v in enumerate(rows)]


def compare(spark, rows, least_recall=1.0, **options):
    frame = spark.createDataFrame([(a, b, 0) for a, b in rows], SCHEMA).repartition(3)
    got = {r.vec_id: r for r in near_vectors(frame, **options).collect()}
    want = brute(rows)
    assert all(got[v].kept == (got[v].component_id == v) for v in got) and got.keys() == want.keys()
    assert all(got[v].n_links <= n for v, (n, _) in want.items())
    assert sum(r.n_links for r in got.values()) >= least_recall * sum(n for n, _ in want.values())
    if least_recall == 1.0:
        assert {v: (r.n_links, r.component_id) for v, r in got.items()} == want


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    odd = [(1, None), (2, []), (3, [0.0] * 16), (4, [1.0] * 15 + [None]), (5, [float("nan")] + [1.0] * 15), (6, [1.0] * 8), (7, [float("inf")] + [1.0] * 15)]
    rows = groups(rng, 400, 0.35) + odd
    rows += [(5000 + k, rows[k][1]) for k in range(20)] + [(6000 + k, [2 * e for e in rows[k][1]]) for k in range(10)]
    compare(spark, rows, leaf=1000)  # one leaf: exact
    compare(spark, rows, 0.99, leaf=64, trees=6, spill=0.1)


def test_leaves_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "LEAF_BLOCK", 40)
    compare(spark, groups(np.random.default_rng(4), 300, 0.3), leaf=1000)


def test_recall_on_the_table_with_near_copies(spark, sf):
    rng = np.random.default_rng(8)
    base = [r.embedding for r in spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()]
    rows = [(k, v) for k, v in enumerate(base)]
    for k in range(1500):  # cosines from about 0.85 to 1 with their originals
        v = np.array(base[k % 300]) + rng.random() * 0.08 * rng.standard_normal(64)
        rows.append((len(rows), [float(e) for e in v]))
    x = np.float32([v for _, v in rows]).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.9).sum() - len(x)
    got = near_vectors(spark.createDataFrame([(k, v, 0) for k, v in rows], SCHEMA), leaf=64).collect()
    assert want >= sum(r.n_links for r in got) >= 0.95 * want > 1000


def test_edge_tables(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 2), (None, [0.0, 1.0], None), (None, None, 3)], SCHEMA).withColumnRenamed("label", "rep")
    rows = near_vectors(frame).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0) for r in rows) == [(0, 0, 0), (0, 0, 0), (1, 1, 1), (1, 1, 1)]
    assert near_vectors(frame.limit(0)).count() == 0
    assert [r.n_links for r in near_vectors(frame.where("embedding is null")).collect()] == [0]


def planted(rng, n, dim, pairs, cosine=0.9):
    """Random unit vectors, the last ``pairs`` of them at exactly this cosine with the first."""
    x = rng.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    other = x[-pairs:] - (x[-pairs:] * x[:pairs]).sum(axis=1, keepdims=True) * x[:pairs]
    x[-pairs:] = cosine * x[:pairs] + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other, axis=1, keepdims=True)
    return x


def test_recall_in_any_dimension(spark):
    for dim, n, pairs in ((16, 6000, 600), (32, 6000, 600), (256, 3000, 300)):
        x = np.float32(planted(np.random.default_rng(dim), n, dim, pairs, 0.902))
        unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
        want = int((unit @ unit.T >= 0.9).sum()) - n
        frame = spark.createDataFrame([(k, v, 0) for k, v in enumerate(x.tolist())], SCHEMA)
        got = sum(r.n_links for r in near_vectors(frame, leaf=64).collect())
        assert want >= got >= 0.99 * want >= 1.98 * pairs, (dim, got, want)


def test_trees_divide_wide_vectors():
    x = planted(np.random.default_rng(5), 4000, 768, 100)
    forest = vectors.Forest(x, len(x), 1, 512, vectors.margin(0.9, 768), 8)
    assert len(set(sum(forest.leaves(x), []))) > 4


def test_large_leaves_are_divided_on_executors(spark, monkeypatch):
    """A sample far too small for the rows: leaves are divided in rounds, and nothing is lost by it."""
    monkeypatch.setattr(vectors, "NODE_SAMPLE", 150)
    monkeypatch.setattr(vectors, "LEAF_BLOCK", 100)
    led = []
    finer = vectors.finer_leaves
    monkeypatch.setattr(vectors, "finer_leaves", lambda *args: led.append(finer(*args)) or led[-1])
    n, pairs, dim, leaf = 6000, 600, 16, 40
    x = np.float32(planted(np.random.default_rng(dim), n, dim, pairs, 0.902))
    x[-1] = x[0]
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    frame = spark.createDataFrame([(k, v, 0) for k, v in enumerate(x.tolist())], SCHEMA).repartition(4)
    got = {r.vec_id: r for r in near_vectors(frame, leaf=leaf, sample_rows=100, spill=0.06).collect()}
    assert len(got) == n and all(got[k].n_links <= near[k].sum() for k in got)
    assert sum(r.n_links for r in got.values()) >= 0.97 * near.sum()
    assert got[0].n_links == got[n - 1].n_links and got[0].component_id == got[n - 1].component_id
    sizes = {r.leaf: r.n for r in led[0].select("leaf", "n").distinct().collect()}
    rows = led[0].groupBy("leaf").count().collect()
    assert len(sizes) == len(rows) > 100 and all(sizes[r["leaf"]] == r["count"] for r in rows)
    assert np.median(list(sizes.values())) <= 100


def test_leaves_that_no_cut_divides_stay_whole(spark, monkeypatch):
    monkeypatch.setattr(vectors, "NODE_SAMPLE", 150)
    monkeypatch.setattr(vectors, "LEAF_BLOCK", 100)
    rng = np.random.default_rng(6)
    tight = rng.standard_normal(16) + 0.001 * rng.standard_normal((400, 16))
    rows = groups(rng, 1200, 0.3) + [(9000 + k, [float(np.float32(e)) for e in v]) for k, v in enumerate(tight)]
    compare(spark, rows, 0.99, leaf=40, sample_rows=60, spill=0.1)
