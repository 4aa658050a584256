"""Collaborative filtering (ALS) on (user, item, rating) triples."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.expressions import count_where

INT_MAX = 2**31 - 1
# ALS deals the ratings into blocks, one a task: so many ratings a block, and no fewer blocks than Spark's default
BLOCK_RATINGS, LEAST_BLOCKS = 2_000_000, 10


def dense_ids(values: DataFrame, col: str, out_col: str, partitions: int) -> DataFrame:
    """(col, out_col) with out_col = 0..n-1 over the distinct values of ``col``.

    Distributed: the distinct values are range-partitioned, ranked inside their
    partition, and shifted by the row count of the partitions before them (a
    table of one row per partition). The mapping is checkpointed to the shared
    folder: range bounds come from a sample, so a recomputation must not draw
    different ones."""
    d = (values.select(col).where(F.col(col).isNotNull()).distinct()
         .repartitionByRange(partitions, col).withColumn("_pid", F.spark_partition_id()))
    d = d.withColumn("_r", F.row_number().over(Window.partitionBy("_pid").orderBy(col)))
    d = d.checkpoint(eager=True)
    per_part = d.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (d.join(F.broadcast(offsets), "_pid")   # one row per shuffle partition: bounded by that setting
            .select(col, (F.col("_off") + F.col("_r") - 1).cast("int").alias(out_col)))


def als_model(ratings: DataFrame, user: str, item: str, rating: str, rank: int = 8, max_iter: int = 5,
              reg: float = 0.1, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs, user factors, item factors) of an ALS model: (user, item, rating), (user, factors), (item, factors).

    Ratings are first reduced to one mean per (user, item) pair (partial
    aggregation). ALS needs 32-bit ids: ids are used as they are when
    they fit, else re-indexed densely (and mapped back). The blocks of users and items grow in number with
    the ratings, so that a task's share does not grow with them. The iterations cut lineage
    into the session's checkpoint folder."""
    from pyspark.ml.recommendation import ALS

    from strata.session import checkpoint_root

    spark = ratings.sparkSession
    checkpoint_root(spark)
    pairs = ratings.where(F.col(user).isNotNull() & F.col(item).isNotNull() & F.col(rating).isNotNull()).groupBy(user, item).agg(F.avg(rating).alias("rating"))
    bounds = pairs.agg(F.min(user).alias("u0"), F.max(user).alias("u1"),
                       F.min(item).alias("i0"), F.max(item).alias("i1"), F.count(F.lit(1)).alias("n")).first()
    blocks = max(LEAST_BLOCKS, -(-bounds["n"] // BLOCK_RATINGS))
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    maps = {}
    for c, lo, hi in ((user, bounds["u0"], bounds["u1"]), (item, bounds["i0"], bounds["i1"])):
        if lo is not None and (lo < 0 or hi > INT_MAX):
            maps[c] = dense_ids(pairs, c, f"_{c}_ix", n_parts)
    train = pairs
    for c, m in maps.items():
        train = train.join(m, c)
    train = train.select("*", F.col(f"_{user}_ix" if user in maps else user).cast("int").alias("_user"),
                         F.col(f"_{item}_ix" if item in maps else item).cast("int").alias("_item"))
    model = ALS(userCol="_user", itemCol="_item", ratingCol="rating", rank=rank, maxIter=max_iter,
                numUserBlocks=blocks, numItemBlocks=blocks,
                regParam=reg, seed=seed, nonnegative=True, coldStartStrategy="nan",
                checkpointInterval=2).fit(train)

    def named(factors: DataFrame, c: str) -> DataFrame:
        values = F.transform("features", lambda x: x.cast("double")).alias("factors")
        if c in maps:
            return factors.join(maps[c], F.col("id") == F.col(f"_{c}_ix")).select(c, values)
        return factors.select(F.col("id").cast(pairs.schema[c].dataType).alias(c), values)

    return pairs, named(model.userFactors, user), named(model.itemFactors, item)


def dot(a: str, b: str) -> Column:
    """Sum of the products of two arrays of doubles."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def pair_scores(pairs: DataFrame, users: DataFrame, items: DataFrame, user: str, item: str) -> DataFrame:
    """(user, item, rating, score) of every rated pair: joins of the pairs with the factors; no user
    is met with every item."""
    u, i = users.withColumnRenamed("factors", "_u"), items.withColumnRenamed("factors", "_i")
    return pairs.join(u, user, "left").join(i, item, "left").select(user, item, "rating", dot("_u", "_i").alias("score"))


def als_scores(ratings: DataFrame, user: str, item: str, rating: str,
               rank: int = 8, max_iter: int = 5, reg: float = 0.1, seed: int = 42) -> DataFrame:
    """(user, item, rating, score): the model's score of every rated pair."""
    pairs, users, items = als_model(ratings, user, item, rating, rank, max_iter, reg, seed)
    return pair_scores(pairs, users, items, user, item)


TABLES, BUCKET_ITEMS = 12, 200


# a block of work: so many items of a bucket, and so many users that look into it, so many at a time
BLOCK_ITEMS, BLOCK_USERS, BATCH_USERS = 4096, 4096, 64


def _signs(vector: Column, planes: list[list[float]]) -> Column:
    """Bucket number of a vector: one bit per hyperplane."""
    out = F.lit(0)
    for k, plane in enumerate(planes):
        side = F.aggregate(F.zip_with(vector, F.array(*[F.lit(x) for x in plane]), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        out = out + F.when(side > 0, 1 << k).otherwise(0)
    return out


def _dealt(rows: DataFrame, key: str, others: DataFrame, own: str, other: str) -> DataFrame:
    """Rows (t, b, ...) with their block: a bucket's rows are cut into ``own`` parts by their key, and each
    part meets each of the ``other`` parts of the other side. ``others``: (t, b, own, other) of every bucket."""
    parts = F.transform(F.sequence(F.lit(0), F.col(other) - 1), lambda n: n.cast("int"))
    return (rows.join(others, ["t", "b"]).withColumn("_own", F.pmod(F.xxhash64(key), F.col(own)).cast("int"))
            .withColumn("_other", F.explode(parts)).drop("items", "users"))


def _best_of_blocks(k: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (t, b, ip, up, kind, user, item, x) sorted by block, kind and user: a block's items (kind 0), then its
    users (kind 2), each after the items it has rated there (kind 1, with the same user). For each user
    the ``k`` items of highest score, ties to the smaller item, that it has not rated."""

    def best(items: np.ndarray, factors: np.ndarray, users: list[int], own: np.ndarray, rated: list[list[int]]) -> tuple:
        score = np.zeros((len(users), len(items)))
        for d in range(own.shape[1]):   # summed in the order of ``dot``
            score += own[:, d, None] * factors[d]
        taken = np.zeros(score.shape, bool)
        of, what = np.repeat(np.arange(len(users)), [len(x) for x in rated]), np.asarray([y for x in rated for y in x], np.int64)
        at = np.minimum(np.searchsorted(items, what), len(items) - 1)
        known = items[at] == what
        taken[of[known], at[known]] = True
        high = np.where(taken, -np.inf, np.where(np.isnan(score), np.inf, score))   # as Spark orders them
        free = ~taken
        if len(items) > k:
            free &= high >= np.partition(high, len(items) - k, axis=1)[:, len(items) - k, None]
        row, col = np.nonzero(free)
        order = np.lexsort((col, -high[row, col], ~np.isnan(score[row, col]), row))
        row, col = row[order], col[order]
        first = np.arange(len(row)) - np.searchsorted(row, row) < k
        row, col = row[first], col[first]
        return np.asarray(users, np.int64)[row], items[col], score[row, col]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, items, factors, holder, rated = None, [], [], None, []
        users, own, seen = [], [], []

        def found() -> Iterator[pa.RecordBatch]:
            nonlocal items, factors
            if users and len(items):
                if isinstance(items, list):   # the block's first users: items in order, factors side by side
                    ids = np.asarray(items, np.int64)
                    order = np.argsort(ids, kind="stable")
                    items, factors = ids[order], np.ascontiguousarray(np.asarray(factors)[order].T)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in best(items, factors, users, np.asarray(own), seen)], ["user", "item", "score"])
            users.clear(), own.clear(), seen.clear()

        for b in batches:
            keys = list(zip(*(b.column(n).to_pylist() for n in range(4)), strict=True))
            kinds, who, what = (b.column(n).to_pylist() for n in (4, 5, 6))
            at, values = b.column(7).offsets.to_numpy(), b.column(7).values.to_numpy(zero_copy_only=False)
            for r, key in enumerate(keys):
                if key != block:
                    yield from found()
                    block, items, factors, holder, rated = key, [], [], None, []
                if kinds[r] == 0:
                    items.append(what[r])
                    factors.append(values[at[r]: at[r + 1]])
                elif kinds[r] == 1:
                    if holder != who[r]:
                        holder, rated = who[r], []
                    rated.append(what[r])
                else:
                    users.append(who[r])
                    own.append(values[at[r]: at[r + 1]])
                    seen.append(rated if holder == who[r] else [])
                    if len(users) >= BATCH_USERS:
                        yield from found()
        yield from found()

    return run


def recommend(users: DataFrame, items: DataFrame, rated: DataFrame, user: str, item: str, k: int = 10,
              tables: int = TABLES, bits: int | None = None, seed: int = 7) -> DataFrame:
    """(user, item, score, rank): the ``k`` items of highest score that each user has not rated, of the candidates
    that an index over the item factors gives. No user is met with every item.

    The index: item factors less their mean (which ranks items the same for any one user), with a last
    coordinate that makes all of one length, so that the highest score is the smallest angle; ``tables``
    tables of ``bits`` random hyperplanes through the origin. A user looks into its own bucket of each
    table and those that differ in one bit. Candidates are scored exactly, ties go to the smaller
    item. More bits make buckets smaller, more tables find more. By default the bits are log2 of the items
    / ``BUCKET_ITEMS``; on random factors of rank 8 the ten best are then found with recall 0.99 among 20,000
    items (of which 47 % are scored) and 0.97 among 50,000 (23 %)."""
    width = "size(factors)"
    mean = (items.select(F.posexplode("factors").alias("at", "x")).groupBy("at").agg(F.avg("x").alias("x"))
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("_mean")))   # one row
    moved = items.join(F.broadcast(mean)).withColumn("_c", F.zip_with("factors", "_mean", lambda x, m: x - m))
    moved = moved.withColumn("_l", dot("_c", "_c"))
    longest = moved.agg(F.max("_l").alias("_longest"))   # one row
    rank = items.agg(F.max(F.expr(width)).alias("n"), F.count(F.lit(1)).alias("items")).first()   # the model's own size
    bits = max(3, round(math.log2(max(rank["items"], 1) / BUCKET_ITEMS))) if bits is None and rank["items"] else bits
    if not rank["items"]:
        return users.join(rated.select(user, item), user).select(user, item, F.lit(0.0).alias("score"), F.lit(0).alias("rank")).limit(0)
    moved = moved.join(F.broadcast(longest)).withColumn("_v", F.concat("_c", F.array(F.sqrt(F.greatest(F.col("_longest") - F.col("_l"), F.lit(0.0))))))
    rng = random.Random(seed)
    planes = [[[rng.gauss(0, 1) for _ in range(rank["n"] + 1)] for _ in range(bits)] for _ in range(tables)]
    codes = lambda v: F.array(*[_signs(v, p) for p in planes])
    index = moved.select(F.col(item).cast("long").alias("item"), F.col("factors").alias("x"), codes(F.col("_v")).alias("_ib"))
    probe = users.select(F.col(user).cast("long").alias("user"), F.col("factors").alias("x"), codes(F.concat("factors", F.array(F.lit(0.0)))).alias("_ub"))
    flips = F.array(F.lit(0), *[F.lit(1 << j) for j in range(bits)])
    own = index.select("item", "x", F.posexplode("_ib").alias("t", "b"))
    looks = (probe.select("user", "x", F.posexplode("_ub").alias("t", "_b"))
             .select("user", "x", "t", F.explode(F.transform(flips, lambda f: F.col("_b").bitwiseXOR(f))).alias("b")))
    # rated pairs count only where the user's look meets the item's bucket
    met = (rated.select(F.col(user).cast("long").alias("user"), F.col(item).cast("long").alias("item")).distinct()
           .join(index.select("item", "_ib"), "item").join(probe.select("user", "_ub"), "user")
           .select("user", "item", F.posexplode(F.zip_with("_ib", "_ub", lambda i, u: F.struct(i.alias("b"), (F.bit_count(i.bitwiseXOR(u)) <= 1).alias("met")))).alias("t", "at"))
           .where("at.met").select("user", "item", "t", "at.b"))
    # buckets differ in size: a large one is cut into blocks, so that a task holds one block's items
    parts = lambda n, of: F.ceil(F.count(F.lit(1)) / n).cast("int").alias(of)
    sizes = (own.groupBy("t", "b").agg(parts(BLOCK_ITEMS, "items"))
             .join(looks.groupBy("t", "b").agg(parts(BLOCK_USERS, "users")), ["t", "b"]))
    columns = lambda rows, ip, up, kind, of: rows.select("t", "b", F.col(ip).alias("ip"), F.col(up).alias("up"), F.lit(kind).alias("kind"), *of)
    none, empty = F.lit(None).cast("long"), F.lit(None).cast("array<double>")
    one = columns(_dealt(own, "item", sizes, "items", "users"), "_own", "_other", 0, [none.alias("user"), "item", "x"])
    two = columns(_dealt(looks, "user", sizes, "users", "items"), "_other", "_own", 2, ["user", none.alias("item"), "x"])
    ways = met.join(sizes, ["t", "b"]).withColumns({"_i": F.pmod(F.xxhash64("item"), F.col("items")).cast("int"), "_u": F.pmod(F.xxhash64("user"), F.col("users")).cast("int")})
    block = ["t", "b", "ip", "up"]
    work = one.unionByName(two).unionByName(columns(ways, "_i", "_u", 1, ["user", "item", empty.alias("x")]))
    work = (work.repartition(*block).sortWithinPartitions(*block, F.col("kind") > 0, "user", "kind")
            .select(*block, "kind", "user", "item", "x"))
    # at most k pairs a user and block are dealt again; the same pair from several tables is one: scores depend on the pair alone
    found = (work.mapInArrow(_best_of_blocks(k), "user long, item long, score double").repartition("user")
             .groupBy("user", "item").agg(F.max("score").alias("score"))
             .select(F.col("user").cast(users.schema[user].dataType).alias(user), F.col("item").cast(items.schema[item].dataType).alias(item), "score"))
    best = Window.partitionBy(user).orderBy(F.desc("score"), item)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def scored_pairs_per_user(scores: DataFrame, user: str) -> DataFrame:
    """Per user: rated pairs, pairs with a finite score, pairs scored below zero."""
    s = F.col("score")
    return scores.groupBy(user).agg(F.count(F.lit(1)).alias("nb_paires"),
                                    count_where(s.isNotNull() & ~F.isnan(s) & (F.abs(s) < float("inf"))).alias("nb_scores"),
                                    count_where(s < 0).alias("nb_negatifs"))
