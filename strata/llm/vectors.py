"""Embedding near-dedup (8): a forest of random-projection trees with spill overlap.

Every tree splits near the median of a random projection; vectors within a margin of a split go to
both sides. A vector so falls into a few leaves of each tree, and two similar vectors share
one with high probability (misses of different trees are independent). Within a leaf all
cosines are computed in double precision; a link is counted in the first leaf that its ends
share, so no pair is ever emitted: a leaf gives counts per vector and a spanning forest of its links.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import U64, by_group, components, cut, drop, mix

MOST_SHARED = 0.3  # of a node's vectors may go to both sides
LEAF_BLOCK = 2048  # vectors of a leaf that one task holds twice at most
LEVELS = 48  # of a tree at most, so that leaf ids are longs
NODE_SAMPLE = 4096  # vectors, as expected, on which a large leaf's own part of the tree is fitted


def margin(threshold: float, dim: int) -> float:
    """What is so near a cut that it goes to both sides: 0.54 standard deviations of the projected
    difference of two unit vectors at the threshold (0.03 at 0.9 and 64 dimensions), so that a cut
    parts as few of them in any dimension."""
    return 0.54 * max(2 - 2 * threshold, 1e-12) ** 0.5 / dim ** 0.5


def level_of(node: int) -> int:
    return (node + 1).bit_length() - 1


def divide(sample: np.ndarray, share: float, node: int, directions: np.ndarray, leaf: int, spill: float) -> dict[int, float]:
    """Cuts of the nodes from ``node`` down, fitted on a sample of its vectors that each stand for
    ``share``. Node k has the children 2k + 1 and 2k + 2; a node without a cut is a leaf, one with
    a cut of NaN is a leaf that no cut divides well."""
    cuts: dict[int, float] = {}
    todo = [(node, np.arange(len(sample)))]
    while todo:
        node, own = todo.pop()
        if len(own) * share <= leaf or len(own) < 16:
            continue
        level = level_of(node)
        if level == len(directions):
            cuts[node] = np.nan
            continue
        at = sample[own] @ directions[level]
        # of the central quantiles the one with the fewest vectors in the margin, so that a
        # tight group stays on one side
        tried = np.quantile(at, np.linspace(0.3, 0.7, 9))
        both = [int((np.abs(at - c) <= spill).sum()) for c in tried]
        best = int(np.argmin(both))
        if both[best] > MOST_SHARED * len(own):
            cuts[node] = np.nan
            continue
        middle = cuts[node] = float(tried[best])
        todo += [(2 * node + 1, own[at <= middle + spill]), (2 * node + 2, own[at >= middle - spill])]
    return cuts


def descend(x: np.ndarray, node: int, directions: np.ndarray, cuts: dict[int, float], spill: float) -> Iterator[tuple[int, np.ndarray]]:
    """The leaves from ``node`` down that rows of ``x`` fall into, each with its rows."""
    todo = [(node, np.arange(len(x)))]
    projected: dict[int, np.ndarray] = {}
    while todo:
        node, own = todo.pop()
        if not len(own):
            continue
        middle = cuts.get(node, np.nan)
        if np.isnan(middle):
            yield node, own
            continue
        level = level_of(node)
        if level not in projected:
            projected[level] = x @ directions[level]
        value = projected[level][own]
        todo += [(2 * node + 1, own[value <= middle + spill]), (2 * node + 2, own[value >= middle - spill])]


class Forest:
    """Trees over a sample: per level one random direction, per node a cut near the sample's median on
    it. A leaf's id is its node's number times the number of trees, plus its tree's number."""

    def __init__(self, sample: np.ndarray, rows: int, trees: int, leaf: int, spill: float, seed: int):
        rng = np.random.default_rng(seed)
        dim = sample.shape[1] if len(sample) else 1
        self.spill = spill
        self.trees: list[tuple[np.ndarray, dict[int, float]]] = []
        for _ in range(trees):
            directions = rng.standard_normal((LEVELS, dim))
            directions /= np.linalg.norm(directions, axis=1, keepdims=True)
            self.trees.append((directions, divide(sample, rows / max(1, len(sample)), 0, directions, leaf, spill)))

    def divisible(self, leaf: int) -> bool:
        """Whether a larger sample may divide the leaf further."""
        node, tree = divmod(leaf, len(self.trees))
        return node not in self.trees[tree][1]

    def leaves(self, x: np.ndarray) -> list[list[int]]:
        """Leaf ids of each row, over all trees."""
        out: list[list[int]] = [[] for _ in range(len(x))]
        for tree, (directions, cuts) in enumerate(self.trees):
            for node, own in descend(x, 0, directions, cuts, self.spill):
                for k in own:
                    out[k].append(node * len(self.trees) + tree)
        return out


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows, in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def unpacked(column: pd.Series, wide: bool) -> np.ndarray:
    """Unit vectors of packed rows."""
    return normal(np.vstack([np.frombuffer(v, "<f8" if wide else "<f4") for v in column]).astype(float))


def normal(x: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled first so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spanning(linked: np.ndarray) -> np.ndarray:
    """For a symmetric link matrix, each row's component as the smallest row in it."""
    n = len(linked)
    root = np.full(n, -1)
    for k in range(n):
        if root[k] >= 0:
            continue
        root[k] = k
        front = np.array([k])
        while len(front):
            near = linked[front].any(axis=0) & (root < 0)
            front = np.flatnonzero(near)
            root[front] = k
    return root


def _shared_before(leaf: int, members: list[np.ndarray]) -> np.ndarray:
    """Which pairs also share a leaf of smaller id."""
    every = np.concatenate(members) if members else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(members)), [len(m) for m in members])
    keep = every < leaf
    ids, code, count = np.unique(every[keep], return_inverse=True, return_counts=True)
    held = np.zeros((len(members), len(ids)), np.float32)
    held[row[keep], code] = 1
    held = held[:, count > 1]
    return held @ held.T > 0


def _compare(threshold: float, wide: bool):
    def run(key, part: pd.DataFrame) -> pd.DataFrame:
        leaf, first, second = (int(k) for k in key)
        part = part.sort_values("rep", kind="stable", ignore_index=True)
        x = unpacked(part.vector, wide)
        near = x @ x.T >= threshold
        np.fill_diagonal(near, False)
        if first != second:  # a pair of blocks: only links between the two are its own
            block = part.blk.to_numpy()
            near &= block[:, None] != block[None, :]
        new = near & ~_shared_before(leaf, [np.frombuffer(v, "<i8") for v in part.leaves]) if near.any() else near
        weight = part.copies.to_numpy(np.float64)
        count = (new @ weight).astype(np.int64)
        root = spanning(near)
        rep = part.rep.to_numpy(np.int64)
        some = (count > 0) | (root != np.arange(len(rep)))
        return pd.DataFrame({"rep": rep[some], "n": count[some], "to": rep[root[some]]})

    return run


def finer_leaves(equal: DataFrame, forest: Broadcast, large: Broadcast, most: int, wide: bool) -> DataFrame:
    """(rep, leaf, n): the leaves that take the place of the ``large`` ones (id -> vectors) of the
    forest, those of over ``most`` vectors, and how many vectors each has.

    A large leaf's part of the tree is fitted on a sample of its own vectors, one task a leaf, and
    its vectors are led down it in blocks, one task a block. Leaves that are still large
    go round again until each is small or no cut divides it well; a round makes leaves up to
    ``NODE_SAMPLE / 16`` times smaller, so the number of rounds is logarithmic. No sample, cut or count comes
    to the driver."""
    trees, spill, sample, block = len(forest.value.trees), forest.value.spill, NODE_SAMPLE, LEAF_BLOCK

    def enter(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                b = whole.slice(k, 1000)
                x = matrix(b.column(1))
                at = [(i, r) for r, own in enumerate(forest.value.leaves(normal(x))) for i in own if i in large.value]
                raw = [v.tobytes() for v in (x if wide else x.astype("<f4"))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i for i, _ in at], pa.int64()), pa.array([large.value[i] for i, _ in at], pa.int64()),
                     b.column(0).take(pa.array([r for _, r in at], pa.int64())), pa.array([raw[r] for _, r in at], pa.binary())],
                    ["leaf", "n", "rep", "vector"])

    def fit(key, part: pd.DataFrame) -> pd.DataFrame:
        node, tree = divmod(int(key[0]), trees)
        n = int(part.n.iloc[0])
        cuts = divide(unpacked(part.vector, wide), n / len(part), node, forest.value.trees[tree][0], most // 2, spill)
        return pd.DataFrame({"leaf": [key[0]], "n": [n], "nodes": [np.array(list(cuts), "<i8").tobytes()],
                             "cuts": [np.array(list(cuts.values()), "<f8").tobytes()]})

    def lead(key, part: pd.DataFrame) -> pd.DataFrame:
        node, tree = divmod(int(key[0]), trees)
        own, fitted = part[part.nodes.isna()], part[part.nodes.notna()]
        cuts: dict[int, float] = {}
        for f in fitted.itertuples():
            cuts.update(zip(np.frombuffer(f.nodes, "<i8").tolist(), np.frombuffer(f.cuts, "<f8").tolist(), strict=True))
        found = list(descend(unpacked(own.vector, wide), node, forest.value.trees[tree][0], cuts, spill)) if len(own) else []
        at = np.concatenate([rows for _, rows in found]) if found else np.zeros(0, np.int64)
        size = [len(rows) for _, rows in found]
        # a leaf that a cut of NaN ends, or that has no cuts at all, stays as it is
        return pd.DataFrame({"leaf": np.repeat(np.array([k * trees + tree for k, _ in found], np.int64), size),
                             "rep": own.rep.to_numpy(np.int64)[at], "vector": own.vector.to_numpy()[at],
                             "open": np.repeat(np.array([bool(cuts) and k not in cuts for k, _ in found], bool), size)})

    rows = cut(equal.select("rep", "v").mapInArrow(enter, "leaf long, n long, rep long, vector binary"), "vector-large")
    small = equal.sparkSession.createDataFrame([], "rep long, leaf long, n long")
    while not rows.isEmpty():
        chance = F.xxhash64("rep", "leaf") / F.lit(2.0**64) + 0.5
        fitted = cut(by_group(rows.where(chance * F.col("n") < sample), ["leaf"], fit, "leaf long, n long, nodes binary, cuts binary"), "vector-cuts")
        blocks = F.ceil(F.col("n") / block)
        tasks = (rows.withColumn("blk", F.pmod(F.xxhash64("rep"), blocks))
                 .unionByName(fitted.withColumn("blk", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))), allowMissingColumns=True))
        led = cut(by_group(tasks, ["leaf", "blk"], lead, "leaf long, rep long, vector binary, open boolean"), "vector-led")
        counted = led.join(led.groupBy("leaf").agg(F.count("*").alias("n")), "leaf")
        again = F.col("open") & (F.col("n") > most)
        small = small.unionByName(cut(counted.where(~again).select("rep", "leaf", "n"), "vector-small"))
        left = cut(counted.where(again).select("leaf", "n", "rep", "vector"), "vector-large")
        for used in (led, fitted, rows):
            drop(used)
        rows = left
    return small


def near_vectors(vectors: DataFrame, threshold: float = 0.9, trees: int = 5, leaf: int = 512, spill: float | None = None,
                 sample_rows: int = 20_000, seed: int = 8) -> DataFrame:
    """(vec_id, n_links, component_id, kept): links are pairs of cosine >= ``threshold`` that the forest
    finds; n_links counts other vectors linked directly, component_id is the smallest vec_id reachable.

    ``spill`` is the margin around a cut within which vectors go to both sides (as ``margin`` where not
    given). The upper levels of the trees are fitted on at most ``sample_rows`` usable vectors (smallest hashes of
    their values), the levels below, where a leaf has more vectors than a task compares whole, by ``finer_leaves``;
    every vector is indexed and compared. Equal vectors are one vector with a weight. Leaves of more
    than ``LEAF_BLOCK`` vectors are compared block by block, so groups of any size stay exact
    within bounded tasks. Vectors that are null, empty, zero, of another length than most or that hold
    null or non-finite components link with nothing. Rows that repeat a vec_id count as vectors
    of their own and get equal results; a null vec_id is never a component's id unless alone. Other
    columns are ignored; an empty table gives an empty table.
    """
    spark = vectors.sparkSession
    kind = vectors.schema["embedding"].dataType.elementType
    wide = not isinstance(kind, T.FloatType)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>" if wide else "array<float>").alias("v"))
    usable = (F.size("v") > 0) & F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf"))) & F.exists("v", lambda e: e != 0)
    rows = rows.withColumn("ok", F.coalesce(usable, F.lit(False)))
    size = rows.where("ok").groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if size is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    rows = rows.withColumn("ok", F.col("ok") & (F.size("v") == size[0]))
    # -0.0 and 0.0 are the same component
    zero = F.lit(0.0).cast(kind if wide else "float")
    rows = cut(rows.withColumn("v", F.transform("v", lambda e: e + zero)).withColumn("hash", F.when(F.col("ok"), F.xxhash64("v"))), "vectors")
    equal = cut(rows.where("ok").groupBy("hash", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
                .withColumn("rep", F.coalesce("least", "hash")), "vector-reps")
    n = equal.count()
    spill = margin(threshold, size["size"]) if spill is None else spill
    sample = equal.orderBy("hash", "rep").select("v").limit(sample_rows).toArrow().column(0).combine_chunks()
    fitted = Forest(normal(matrix(sample)), n, trees, leaf, spill, seed)
    forest = spark.sparkContext.broadcast(fitted)

    def leaves_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = forest.value.leaves(normal(matrix(b.column(0))))
            leaf_ids, count = np.unique(np.concatenate(own), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(leaf_ids.astype(np.int64)), pa.array(count)], ["leaf", "n"])

    # one row a leaf: as many as the forest has, which the sample bounds
    sizes = equal.select("v").mapInArrow(leaves_of, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n")).where("n > 1").collect()
    most = max(2 * leaf, LEAF_BLOCK)  # a leaf that one task compares whole is not worth more copies of its vectors
    large = {r.leaf: r.n for r in sizes if r.n > most and fitted.divisible(r.leaf)}
    blocks = spark.sparkContext.broadcast({r.leaf: -(-r.n // LEAF_BLOCK) for r in sizes if r.leaf not in large})
    divided = spark.sparkContext.broadcast(large)
    indexed = equal.select("rep", "v", "copies")
    if large:
        finer = finer_leaves(equal, forest, divided, most, wide).groupBy("rep").agg(F.collect_set(F.struct("leaf", "n")).alias("finer"))
        indexed = cut(indexed.join(finer, "rep", "left"), "vector-leaves")
    else:
        indexed = indexed.withColumn("finer", F.lit(None).cast("array<struct<leaf:long,n:long>>"))
    block = LEAF_BLOCK

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                b = whole.slice(k, 1000)
                x = matrix(b.column(1))
                own = forest.value.leaves(normal(x))
                raw = [v.tobytes() for v in (x if wide else x.astype("<f4"))]
                names = b.column(0).to_pylist()
                out: list[tuple] = []
                for r, (found_in, finer_in) in enumerate(zip(own, b.column(3).to_pylist(), strict=True)):
                    in_parts = {i: blocks.value.get(i, 0) for i in found_in if i not in divided.value}
                    in_parts |= {f["leaf"]: -(-f["n"] // block) if f["n"] > 1 else 0 for f in finer_in or ()}
                    every = np.array(sorted(in_parts), "<i8").tobytes()
                    for leaf_id, parts in in_parts.items():
                        blk = int(mix(np.array([names[r]], np.int64).view(U64))[0] % U64(parts)) if parts > 1 else 0
                        # a block alone, and with every other block of its leaf
                        for other in range(parts):
                            out.append((leaf_id, min(blk, other), max(blk, other), r, raw[r], every, blk))
                leaf_col, first, second, at, vector, every_leaf, blk_col = zip(*out, strict=True) if out else ([],) * 7
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, pa.int64()) for c in (leaf_col, first, second)], b.column(0).take(take), b.column(2).take(take),
                     pa.array(vector, pa.binary()), pa.array(every_leaf, pa.binary()), pa.array(blk_col, pa.int64())],
                    ["leaf", "a", "b", "rep", "copies", "vector", "leaves", "blk"])

    tasks = indexed.mapInArrow(
        index, "leaf long, a long, b long, rep long, copies long, vector binary, leaves binary, blk long")
    found = cut(by_group(tasks, ["leaf", "a", "b"], _compare(threshold, wide), "rep long, n long, to long"), "vector-links")
    links = found.groupBy("rep").agg(F.sum("n").alias("n"))
    roots = components(found.where("rep <> to"), "rep", "to").select(F.col("node").alias("rep"), "root")
    known = equal.join(links, "rep", "left").join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    told = known.join(least, "root").select(F.col("hash").alias("_hash"), F.col("v").alias("_v"),
                                           (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.join(told, (rows.hash == told["_hash"]) & (rows.v == told["_v"]), "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component_id", "vec_id").alias("component_id"),
                      F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"))
