from collections import Counter

from strata.llm.sharding import balanced_shards, exchange, quotas, shard_documents


def balanced(rows, shards=16):
    counts = Counter(r.shard for r in rows)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = shard_documents(docs).collect()
    balanced(rows)
    text = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(text) and all(r["size"] == len(text[r.doc_id].encode()) + 1 and r.law == "rows" and r.grown_shard is None for r in rows)
    where = {}
    for r in rows:
        where.setdefault(text[r.doc_id], set()).add(r.shard)
    assert all(len(s) == 1 for s in where.values())  # no group of copies is cut


def test_edge_rows(documents, none):
    rows = shard_documents(documents).collect()
    balanced(rows)
    assert len(rows) == 8
    assert {(r["size"], r.text_crc32) for r in rows if r.doc_id in (2, 3)} == {(1, 0)}
    assert shard_documents(none).count() == 0


def test_group_larger_than_a_shard(spark):
    nodes = spark.createDataFrame([(k, 7 if k % 3 == 0 else 1000 + k // 2) for k in range(600)], "id long, hub long")
    rows = balanced_shards(nodes, "hub", ["id"], 8).collect()
    balanced(rows, 8)
    assert len({r.shard for r in rows if r.hub == 7}) <= 4  # 200 rows in shards of 75: three full ones and a rest


def test_all_one_group(spark):
    rows = balanced_shards(spark.createDataFrame([(k, 1) for k in range(100)], "id long, hub long"), "hub", ["id"], 16).collect()
    balanced(rows)


def test_quotas_keep_the_counts():
    rows, cap = [10, 10, 11, 10], [10, 10, 11, 10]
    for free in ([3, 0, 5, 1], [0, 0, 0, 0], [10, 10, 11, 10]):
        wish = {(0, 1): 4, (1, 2): 3, (3, 0): 7, (2, 3): 6}
        take, back = quotas(rows, cap, free, wish)
        after = list(rows)
        for (a, b), n in take.items():
            assert n <= wish[a, b]
            after[a], after[b] = after[a] - n, after[b] + n
        gone = Counter()
        for a, b, n in back:
            after[a], after[b] = after[a] - n, after[b] + n
            gone[a] += n
        assert after == cap and all(gone[t] <= free[t] for t in gone)


def test_table_delivered_twice(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    few = spark.createDataFrame([(10**9 + k, f"alone {k}") for k in range(5)], "doc_id long, text string")
    for twice in (docs.unionByName(docs), docs.unionByName(docs).unionByName(few)):
        rows = shard_documents(twice).collect()
        balanced(rows)
        where = {}
        for r in rows:
            where.setdefault((r["size"], r.text_crc32), set()).add(r.shard)
        cut_groups = [s for s in where.values() if len(s) > 1]
        # exactly even shards can cut one group at each of 15 borders; all others are whole
        assert len(cut_groups) <= 15 and all(len(s) == 2 for s in cut_groups), len(cut_groups)


def test_copies_only(spark):
    pairs = [(k, k // 2) for k in range(1600)]  # 16 shards of 50 pairs: none has to be cut
    mixed = [(k, k // 2 if k < 800 else k // 5) for k in range(1600)]
    for nodes, most in ((pairs, 0), (mixed, 15)):
        rows = balanced_shards(spark.createDataFrame(nodes, "id long, hub long"), "hub", ["id"]).collect()
        balanced(rows)
        where = {}
        for r in rows:
            where.setdefault(r.hub, set()).add(r.shard)
        assert sum(len(s) > 1 for s in where.values()) <= most


def test_rounds_bring_groups_together(spark):
    """From a deal that knows nothing of groups, cut groups fall round by round, also without unlinked rows."""
    for nodes in ([(k, k // 4) for k in range(3200)], [(k, k // 3 if k % 3 and k < 2400 else 10_000 + k) for k in range(3200)]):
        cuts = []
        rows = balanced_shards(spark.createDataFrame(nodes, "id long, hub long"), "hub", ["id"], cuts=cuts).collect()
        balanced(rows)
        assert cuts[0] > 700 and cuts == sorted(cuts, reverse=True) and cuts[1] < cuts[0] / 2 and cuts[-1] < cuts[0] / 5, cuts
        where = {}
        for r in rows:
            where.setdefault(r.hub, set()).add(r.shard)
        assert sum(len(s) > 1 for s in where.values()) < 16


def test_very_long_texts(spark):
    docs = spark.createDataFrame([(k, ("x" * 3_000_000) + str(k % 2)) for k in range(6)], "doc_id long, text string")
    rows = shard_documents(docs, 2).collect()
    balanced(rows, 2)
    assert {r["size"] for r in rows} == {3_000_002} and len({(r.text_crc32, r.shard) for r in rows}) == 2


def best_cut(sizes, shards):
    """Fewest groups that have to be cut to fill equal shards, by trying every order of whole groups (small tables)."""
    from itertools import permutations
    room = sum(sizes) // shards
    best = len(sizes)
    for order in set(permutations(sizes)):
        cut, level = 0, 0
        for n in order:
            cut += level + n > room
            level = (level + n) % room
        best = min(best, cut)
    return best


def test_small_tables_against_every_arrangement(spark):
    for sizes in ([2, 2, 2, 2, 2, 2], [3, 3, 2, 2, 1, 1], [4, 1, 1, 1, 1, 4]):
        nodes = [(10 * g + k, g) for g, n in enumerate(sizes) for k in range(n)]
        rows = balanced_shards(spark.createDataFrame(nodes, "id long, hub long"), "hub", ["id"], 2).collect()
        balanced(rows, 2)
        where = {}
        for r in rows:
            where.setdefault(r.hub, set()).add(r.shard)
        assert best_cut(sizes, 2) <= sum(len(s) > 1 for s in where.values()) <= 1


def test_exchange_is_even_and_leaves_no_ring():
    wish = {(0, 1): 4, (1, 2): 3, (2, 0): 7, (1, 0): 2, (3, 0): 5, (2, 3): 1}
    take = exchange(wish)
    assert all(0 < n <= wish[m] for m, n in take.items())
    assert all(sum(n for (a, _), n in take.items() if a == t) == sum(n for (_, b), n in take.items() if b == t) for t in range(4))
    left = {m for m, n in wish.items() if n > take.get(m, 0)}
    while True:  # shards without a way in or out are on no ring
        inner = {(a, b) for a, b in left if any(y == a for _, y in left) and any(x == b for x, _ in left)}
        if inner == left:
            break
        left = inner
    assert not left and exchange({}) == {}
