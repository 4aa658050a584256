import random
import re
import time

from strata.llm import jaccard
from strata.llm.jaccard import jaccard_components


def brute(docs, percent, w):
    sets = []
    for _, text in docs:
        words = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
        sets.append({tuple(words[k:k + w]) for k in range(len(words) - w + 1)} if len(words) >= w else {tuple(words)} if words else set())
    root = list(range(len(docs)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for k, (doc, _) in enumerate(docs):
        least[find(k)] = min(least.get(find(k), doc), doc)
    return {doc: (len(sets[k]), least[find(k)]) for k, (doc, _) in enumerate(docs)}


def variants(seed, groups, copies, length, edits):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5)))
    line = [word() for _ in range(12)]
    docs = []
    for _ in range(groups):
        base = [word() for _ in range(rng.randint(*length))]
        for _ in range(rng.randint(1, copies)):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(len(own))] = word()
            if rng.random() < 0.3:
                own = line + own  # a passage that many share
            docs.append((len(docs), rng.choice([" ", "\n", " \t"]).join(own)))
    rng.shuffle(docs)
    return docs


def test_against_brute_force(spark):
    docs = variants(1, 60, 6, (1, 90), 4) + [(9000, None), (9001, ""), (9002, " \t\n"), (9003, "one two"), (9004, "One\vTWO"), (9005, "one two three")]
    for percent, w in ((85, 4), (80, 5)):
        rows = jaccard_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), percent, w).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(docs, percent, w)


def test_clusters_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 7)
    docs = variants(2, 4, 60, (60, 70), 5)
    rows = jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(docs, 85, 4)


def test_edge_rows(documents, none):
    rows = jaccard_components(documents).collect()
    assert len(rows) == 8
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert got == {1: (2, 1), 2: (0, 2), 3: (0, 3), None: (1, None), 5: (2, 1), 6: (0, 6), 7: (1, 7)}
    assert jaccard_components(none).count() == 0


def test_very_long_text(spark):
    rng = random.Random(5)
    words = [str(rng.random()) for _ in range(60_000)]
    docs = [(1, " ".join(words)), (2, " ".join(words[:55_000])), (3, "".join(words))]
    rows = jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {1: (59_997, 1), 2: (54_997, 1), 3: (1, 3)}


def test_long_lists_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LIST_BLOCK", 5)
    monkeypatch.setattr(jaccard, "SKIP", 2)
    docs = variants(3, 12, 40, (3, 70), 4)
    for percent in (85, 60, 100):
        rows = jaccard_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), percent).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(docs, percent, 4)


def may_link(x, y, percent=85):
    (n, p), (m, q) = x, y
    return 100 * min(n, m) >= percent * max(n, m) and min(n - p, m - q) >= -(-percent * (n + m) // (100 + percent))


def test_blocks_are_skipped_by_size_and_position(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LIST_BLOCK", 20)
    rng = random.Random(4)
    rows = [(7, k, n, rng.randint(0, n - jaccard.least_overlap(n, 85))) for k in range(2000) for n in [rng.randint(20, 2000)]]
    blocks = jaccard.list_blocks(spark.createDataFrame(rows, "shingle long, node long, n int, pos int").repartition(3), 85).collect()
    assert sorted((r.shingle, r.node, r.n, r.pos) for r in blocks) == sorted(rows)
    held = {}
    for r in blocks:
        held.setdefault(r.blk, []).append((r.n, r.pos))
    assert max(map(len, held.values())) <= 20
    met = {(r.a, r.b) for r in jaccard.meetings(spark.createDataFrame(blocks), 85).collect()}
    every = [(a, b) for a in held for b in held if a <= b]
    need = {(a, b) for a, b in every if any(may_link(x, y) for x in held[a] for y in held[b])}
    assert need <= met and len(met) < len(every) / 4
    # by position, beyond what sizes alone skip
    by_size = {(a, b) for a, b in every if any(100 * min(x[0], y[0]) >= 85 * max(x[0], y[0]) for x in held[a] for y in held[b])}
    assert len(met & by_size) < 0.8 * len(by_size)


def test_reach_is_the_bound_of_a_pair():
    for n in range(1, 40):
        for p in range(n):
            for m in range(1, 40):
                for q in (0, 1, m // 3):
                    both = jaccard.reach(n, p, 85) >= m and jaccard.reach(m, q, 85) >= n
                    assert both == may_link((n, p), (m, q))


def test_answers_skip_lists_and_carry_over():
    rng = random.Random(6)
    sets = []
    for _ in range(60):
        base = set(rng.sample(range(4000), rng.randint(5, 300)))
        for _ in range(rng.randint(1, 6)):
            sets.append((base - set(rng.sample(sorted(base), len(base) // 20))) | set(rng.sample(range(4000), 2)))
    sets = sorted((jaccard.np.array(sorted(s), jaccard.U64) for s in sets), key=len)
    block = jaccard.Block(sets, 85)
    links = {(k, int(j)) for k, others in block.answers() for j in others}
    found = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
             for both in [len(set(sets[i].tolist()) & set(sets[j].tolist()))] if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both)}
    assert links == found and found
    whole = jaccard.np.bincount((block.entries // len(sets)).astype(int))
    assert block.visited < sum(whole[s].sum() for s in block.sets) / 4


def test_large_unlike_sets_that_share_a_passage_are_no_candidates(spark, monkeypatch):
    rng = random.Random(11)
    line = [f"line{k}" for k in range(60)]
    docs = [(k, " ".join(line + [f"w{rng.randrange(10**9)}" for _ in range(6000 + k)])) for k in range(12)]
    told = []
    place = jaccard.place
    monkeypatch.setattr(jaccard, "_frequencies", lambda scan: jaccard.np.zeros(jaccard.CELLS, jaccard.np.uint8))  # as where all are as frequent
    monkeypatch.setattr(jaccard, "place", lambda clusters, sizes: told.append(clusters.count()) or place(clusters, sizes))
    rows = jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), 80, 5).collect()
    assert all(r.component_id == r.doc_id for r in rows)
    assert told == [0]


def test_sketches_differ_in_no_more_than_the_sets():
    rng = random.Random(12)
    draw = lambda n: {rng.getrandbits(64) for _ in range(n)}
    sets = []
    for n in (1, 2, 3, 5, 40, 300, 320, 2000, 2300):
        base = draw(n)
        sets += [base, draw(n), base - set(list(base)[: n // 10]), base | draw(n // 8)]
    sets = [s for s in sets if s]
    for percent in (50, 80, 85, 100):
        rows = [jaccard.sketch(jaccard.np.array(sorted(s), jaccard.U64), jaccard.sketch_bits(len(s), percent)) for s in sets]
        i, j = (jaccard.np.array(x) for x in zip(*((a, b) for a in range(len(sets)) for b in range(len(sets))), strict=True))
        order = jaccard.np.array(rng.sample(range(len(sets)), len(sets)))
        found = jaccard.Sketches(rows, order).differ(i, j)
        for a, b, d in zip(order[i], order[j], found, strict=True):
            assert d <= len(sets[a] ^ sets[b])


def test_copies_write_one_prefix(spark):
    docs = [(k, "a text that many documents hold word by word") for k in range(60)] + [(100, "another text of some words")]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(12)
    scan = jaccard._scan(rows, 4, 85)
    classes = scan.where("node is not null").groupBy("node").agg(jaccard.F.min("doc_id").alias("_doc"))
    frequency = spark.sparkContext.broadcast(jaccard._frequencies(scan))
    told = jaccard._prefixes(rows, 4, 85, frequency, jaccard._picked(classes)).groupBy("node", "shingle").count().collect()
    assert len({r.node for r in told}) == 2
    assert all(r["count"] == 1 for r in told)


def test_cut_leaves_no_shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {str(x) for x in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(blocks.getAllFiles()) if "shuffle_" in str(x)}
    before = held()
    made = jaccard.cut(spark.range(20_000).selectExpr("id", "id % 977 k").groupBy("k").count(), "released")
    end = time.time() + 10
    while held() - before and time.time() < end:
        time.sleep(0.2)
    assert not held() - before
    assert made.count() == 977
