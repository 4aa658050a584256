"""ALS: dense re-indexing of 64-bit ids and the scores of rated pairs."""

from pyspark.sql import functions as F

from strata.operators.recommend import als_scores, dense_ids, scored_pairs_per_user
from strata.plans import bindings
from tests.conftest import SF001


def test_dense_ids_are_a_bijection(spark):
    vals = spark.range(0, 5000).select((F.col("id") * 7_000_000_019).alias("big"))
    m = dense_ids(vals, "big", "ix", 8)
    rows = m.collect()
    assert sorted(r["ix"] for r in rows) == list(range(5000))
    assert len({r["big"] for r in rows}) == 5000
    # order-preserving: the rank follows the value
    assert [r["big"] for r in sorted(rows, key=lambda r: r["ix"])] == sorted(r["big"] for r in rows)


def test_als_with_ids_beyond_int_range(spark):
    r = bindings.ratings(spark, SF001)
    shifted = r.withColumn("item_id", F.col("item_id") + F.lit(10_000_000_000))
    scores = als_scores(shifted, "user_id", "item_id", "rating", max_iter=2)
    pairs = r.select("user_id", "item_id").distinct().count()
    assert scores.count() == pairs and scores.where("item_id < 10000000000").count() == 0
    per_user = scored_pairs_per_user(scores, "user_id").collect()
    assert sum(x["nb_paires"] for x in per_user) == pairs
    assert all(x["nb_scores"] == x["nb_paires"] and x["nb_negatifs"] == 0 for x in per_user)


def _factors(spark):
    from strata.operators.recommend import als_model
    return als_model(bindings.ratings(spark, SF001), "user_id", "item_id", "rating", max_iter=3)


def test_recommendations_against_all_items(spark):
    """Recall of the ten best of the index against the products of every user with every item, and exact scores."""
    from strata.operators.recommend import recommend
    pairs, users, items = _factors(spark)
    u, i = {r.user_id: r.factors for r in users.collect()}, {r.item_id: r.factors for r in items.collect()}
    rated = {(r.user_id, r.item_id) for r in pairs.collect()}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    best = {x: sorted(((-dot(f, g), y) for y, g in i.items() if (x, y) not in rated))[:10] for x, f in u.items()}
    for bits in (None, 5):
        told = {}
        for r in recommend(users, items, pairs, "user_id", "item_id", bits=bits).collect():
            told.setdefault(r.user_id, []).append((r["rank"], r.item_id, r.score))
            assert (r.user_id, r.item_id) not in rated and abs(r.score - dot(u[r.user_id], i[r.item_id])) < 1e-9
        hits = sum(len({y for _, y in best[x]} & {y for _, y, _ in told.get(x, [])}) for x in u)
        assert hits >= 0.9 * sum(map(len, best.values()))
        assert all([k for k, _, _ in sorted(rows)] == list(range(1, len(rows) + 1)) and [s for _, _, s in sorted(rows)] == sorted((s for _, _, s in rows), reverse=True)
                   for rows in told.values())


def test_scores_follow_the_ratings(spark):
    """A rank-one table is learned: scores near ratings, unrated pairs near the product."""
    from strata.operators.recommend import als_model, pair_scores, recommend
    rows = [(x, y, float(x * y)) for x in range(1, 13) for y in range(1, 13) if (x * 5 + y * 3) % 7]
    df = spark.createDataFrame(rows + rows[:9] + [(None, 1, 2.0), (1, None, 2.0), (1, 2, None)], "u long, i long, r double")
    pairs, users, items = als_model(df, "u", "i", "r", rank=4, max_iter=12, reg=0.01)
    scored = pair_scores(pairs, users, items, "u", "i").collect()
    assert len(scored) == len(rows) and sum(abs(r.score - r.rating) for r in scored) / len(scored) < 1.0
    told = recommend(users, items, pairs, "u", "i", k=3).collect()
    assert told and all((r.u * 5 + r.i * 3) % 7 == 0 and abs(r.score - r.u * r.i) < 0.25 * r.u * r.i + 2 for r in told)
    assert recommend(users, items.limit(0), pairs, "u", "i").count() == 0


def test_blocks_change_no_recommendation(spark, monkeypatch):
    """Buckets cut into small blocks of items and users, ties and rated pairs included, give the rows of whole buckets."""
    from strata.operators import recommend as r
    users = spark.createDataFrame([(x, [1.0 + x % 3, 0.5, 2.0]) for x in range(23)], "u long, factors array<double>")
    items = spark.createDataFrame([(y, [float(y % 4), 1.0, float(y % 5)]) for y in range(60)], "i long, factors array<double>")
    rated = spark.createDataFrame([(x, y, 1.0) for x in range(23) for y in range(60) if (x + y) % 7 == 0], "u long, i long, rating double")
    whole = sorted(map(tuple, r.recommend(users, items, rated, "u", "i", k=4).collect()))
    for name, size in (("BLOCK_ITEMS", 5), ("BLOCK_USERS", 4), ("BATCH_USERS", 2)):
        monkeypatch.setattr(r, name, size)
    assert whole and sorted(map(tuple, r.recommend(users, items, rated, "u", "i", k=4).collect())) == whole
    score = {(x, y): (1.0 + x % 3) * (y % 4) + 0.5 + 2.0 * (y % 5) for x in range(23) for y in range(60)}
    assert all((x + y) % 7 and abs(s - score[x, y]) < 1e-9 for x, y, s, _ in whole)
    for x in range(23):
        told = [(-s, y) for a, y, s, _ in sorted(whole, key=lambda w: w[3]) if a == x]
        assert told == sorted(told) and len(told) <= 4


def test_als_blocks_grow_with_the_ratings(spark, monkeypatch):
    from strata.operators import recommend
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(30) for i in range(20) if (u + i) % 2]
    ratings = spark.createDataFrame(rows, "u long, i long, r double")
    few = [f.rdd.getNumPartitions() for f in recommend.als_model(ratings, "u", "i", "r", rank=2, max_iter=1)[1:]]
    assert few == [10, 10]
    monkeypatch.setattr(recommend, "BLOCK_RATINGS", 20)
    pairs, users, items = recommend.als_model(ratings, "u", "i", "r", rank=2, max_iter=1)
    assert [f.rdd.getNumPartitions() for f in (users, items)] == [15, 15]
    assert (users.count(), items.count()) == (30, 20)
