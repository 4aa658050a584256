"""Sharding (2): balanced label propagation over documents that share a hub.

Documents with the same hub (here: equal texts) are neighbours. Labels are shards. The start is a
balanced deal by hash that knows nothing of hubs, but for hubs larger than a shard, which fill some. In every round each hub that is cut wishes its
documents into the shard where most of them are; wishes take place as far as the quotas allow,
against wishes that come the other way and unlinked documents that are sent back, so the row
counts of the shards differ by at most one after every round. Ties fall anew each round, so that
what had to wait meets other partners. What no exchange brings together in the end (row counts
are exact, so the last documents may find no partner) changes places once more: the rows of the hubs
that are still cut are laid hub after hub into the places that they hold. All of it is DataFrame
operations; the driver sees shard x shard counts only (256 numbers at 16 shards).
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import cut, drop


def dense_rank_in(df: DataFrame, keys: list[str], order: list[str], buckets: int, out: str) -> DataFrame:
    """Gapless number from 0 within ``keys`` without a task per key: rows are numbered within hash
    buckets of each key, and a prefix sum over the bucket counts adds the start of each bucket."""
    df = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = (df.groupBy(*keys, "_b").agg(F.count("*").alias("_n"))
              .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    within = Window.partitionBy(*keys, "_b").orderBy(*order)
    return (df.withColumn("_r", F.row_number().over(within)).join(starts, [*keys, "_b"])
            .withColumn(out, F.col("_r") - 1 + F.col("_start")).drop("_b", "_r", "_start"))


def run_of(rank: Column, sizes: list[int]) -> Column:
    """Which of the runs of these sizes a gapless rank from 0 lies in."""
    ends = list(accumulate(sizes))[:-1]
    return F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e <= rank)) if ends else F.lit(0)


def in_runs(rows: DataFrame, known: DataFrame, order: list[str], runs: list[int], buckets: int) -> DataFrame:
    """``rows`` of the hubs of ``known`` (hub, rows) with ``shard`` chosen anew: hub after hub in runs of the given
    sizes, one a shard. Each border of runs cuts one hub at most."""
    hubs = known.toDF("_hub", "_total").withColumn("_b", F.pmod(F.xxhash64("_hub"), F.lit(buckets)))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("_b").orderBy("_hub").rowsBetween(Window.unboundedPreceding, -1)
    # one row a bucket in the window without keys
    starts = hubs.groupBy("_b").agg(F.sum("_total").alias("_sum")).withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    hubs = hubs.withColumn("_into", F.coalesce(F.sum("_total").over(within), F.lit(0))).join(starts, "_b")
    hubs = hubs.select("_hub", (F.col("_start") + F.col("_into")).alias("_from"), "_total")
    hubs = hubs.withColumn("_first", run_of(F.col("_from"), runs)).withColumn("_last", run_of(F.col("_from") + F.col("_total") - 1, runs))
    hubs = cut(hubs.select("_hub", "_from", "_first", "_last"), "shard-runs")
    names = rows.columns
    rows = cut(rows.join(hubs, "_hub"), "shard-linked")
    whole = rows.where("_first = _last").withColumn("shard", F.col("_first"))
    # rows are numbered within the few hubs that lie on a border
    border = dense_rank_in(rows.where("_first < _last"), ["_hub"], order, buckets, "_at").withColumn("shard", run_of(F.col("_from") + F.col("_at"), runs))
    return whole.select(names).unionByName(border.select(names))


def exchange(wish: dict[tuple[int, int], int]) -> dict[tuple[int, int], int]:
    """The part of the wished moves (from, to) that needs no room: rounds a -> b -> .. -> a, taken as often as all
    of their wishes allow, until none is left (each uses a wish up). Shards are few, so this is a small table."""
    left = {m: n for m, n in wish.items() if n}

    def ring() -> list[int] | None:
        for start in sorted({a for a, _ in left}):
            path, seen = [start], {start}
            while path:  # depth first; a shard without a way on is left for good
                step = next((b for a, b in sorted(left) if a == path[-1] and (b not in seen or b in path)), None)
                if step is None:
                    path.pop()
                elif step in path:
                    return path[path.index(step):]
                else:
                    path.append(step)
                    seen.add(step)
        return None

    while (way := ring()) is not None:
        moves = list(zip(way, way[1:] + way[:1], strict=True))
        n = min(left[m] for m in moves)
        for m in moves:
            left[m] -= n
            if not left[m]:
                del left[m]
    return {m: n - left.get(m, 0) for m, n in wish.items() if n > left.get(m, 0)}


def quotas(rows: list[int], cap: list[int], free: list[int], wish: dict[tuple[int, int], int]):
    """How many of the wished moves (from, to) may take place, and the moves of unlinked documents
    that even the shards out again. Moves that others make up for take place at once; the other wishes
    into a shard shrink until its unlinked documents can make room; no move at all is always possible as
    the rows start even."""
    swaps = exchange(wish)
    take = {m: n - swaps.get(m, 0) for m, n in wish.items()}
    k = len(rows)
    while True:
        after = [rows[t] + sum(n for (_, b), n in take.items() if b == t) - sum(n for (a, _), n in take.items() if a == t) for t in range(k)]
        over = {t: after[t] - cap[t] - free[t] for t in range(k) if after[t] - cap[t] > free[t]}
        if not over:
            break
        for t, n in over.items():
            for move in sorted(m for m in take if m[1] == t):
                cut_by = min(n, take[move])
                take[move] -= cut_by
                n -= cut_by
    take = {m: n + swaps.get(m, 0) for m, n in take.items()}
    give = {t: after[t] - cap[t] for t in range(k) if after[t] > cap[t]}
    need = {t: cap[t] - after[t] for t in range(k) if after[t] < cap[t]}
    back: list[tuple[int, int, int]] = []
    for t in sorted(give):
        for s in sorted(need):
            n = min(give[t], need[s])
            if n:
                back.append((t, s, n))
                give[t] -= n
                need[s] -= n
    return {m: n for m, n in take.items() if n}, back


def balanced_shards(nodes: DataFrame, hub: str, order: list[str], shards: int = 16, rounds: int = 12,
                    cuts: list[int] | None = None) -> DataFrame:
    """``nodes`` with a column ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 within it).

    Row counts of shards differ by at most one. Rows of equal non-null ``hub`` are linked; a null
    hub links with nothing. ``order`` names columns that fix the order of rows (repeated rows
    are interchangeable). Of the hubs that fit in a shard at most shards - 1 are cut in the end,
    with or without unlinked documents; a hub larger than a shard
    fills one shard after another. Shards that still hold unlinked documents are the first targets,
    others take linked documents as far as linked ones leave. Propagation ends when
    no document can move, or after ``rounds``. ``cuts`` receives the number of cut hubs before each
    round and, last, after the rounds. An empty table gives an empty table.
    ``nodes`` may not have columns that begin with an underscore, or shard or slot.
    """
    nodes = cut(nodes, "shard-nodes")
    n = nodes.count()
    buckets = max(256, n // 5000)
    # linked: the hub occurs more than once
    known = nodes.where(F.col(hub).isNotNull()).groupBy(hub).agg(F.count("*").alias("_total")).where("_total > 1")
    known = cut(known, "shard-hubs")  # tables on both sides, so that AQE can split a hot hub
    state = (nodes.where(F.col(hub).isNotNull()).join(known, hub, "left")
             .select(*nodes.columns, F.when(F.col("_total") > 1, F.col(hub)).alias("_hub"))
             .unionByName(nodes.where(F.col(hub).isNull()).withColumn("_hub", F.col(hub))))
    cap = [n // shards + (t < n % shards) for t in range(shards)]
    state = cut(state, "shard-hubbed")
    # a hub larger than a shard fills shards of its own first (there are fewer such hubs than shards)
    large = {r[0]: r._total for r in known.where(F.col("_total") > cap[0]).orderBy(hub).collect()}
    own, left = {}, list(cap)
    for name, total in large.items():
        own[name] = []
        for t in reversed(range(shards)):
            if left[t] and left[t] == cap[t] and total >= cap[t]:
                own[name].append(t)
                total, left[t] = total - cap[t], 0
    rest = state
    if own:
        numbered = cut(dense_rank_in(state.where(F.col("_hub").isin(list(own))), ["_hub"], order, buckets, "_at"), "shard-large")
        shard = F.lit(None).cast("int")
        for name, places in own.items():
            run = run_of(F.col("_at"), [*[cap[t] for t in places], 0])
            place = F.element_at(F.array(*[F.lit(t) for t in places], F.lit(None).cast("int")), run + 1)
            shard = F.when(F.col("_hub") == name, place).otherwise(shard)
        numbered = numbered.withColumn("shard", shard).drop("_at")
        rest = state.where(F.col("_hub").isNull() | ~F.col("_hub").isin(list(own))).unionByName(numbered.where("shard is null").drop("shard"))
    rest = dense_rank_in(rest.withColumn("_one", F.lit(1)), ["_one"], order, buckets, "_at").drop("_one")
    rest = rest.withColumn("shard", run_of(F.col("_at"), left).cast("int")).drop("_at")
    state = cut(rest.unionByName(numbered.where("shard is not null")) if own else rest, "shard-state")
    cuts = [] if cuts is None else cuts
    for turn in range(rounds):
        seen = {r.shard: r for r in state.groupBy("shard").agg(F.count("*").alias("n"), F.count_if(F.col("_hub").isNull()).alias("free"),
                                                                F.min("_hub").alias("low"), F.max("_hub").alias("high")).collect()}
        rows = [seen[t].n if t in seen else 0 for t in range(shards)]
        free = [seen[t].free if t in seen else 0 for t in range(shards)]
        # a shard that one hub has to itself is done
        done = [t for t in seen if not seen[t].free and seen[t].low == seen[t].high]
        cells = state.where(F.col("_hub").isNotNull() & ~F.col("shard").isin(done)).groupBy("_hub", "shard").agg(F.count("*").alias("_n"))
        cells = cells.withColumn("_open", F.col("shard").isin([t for t in range(shards) if free[t] > 0]))
        best = (cells.groupBy("_hub").agg(F.max(F.struct("_open", "_n", F.xxhash64("_hub", "shard", F.lit(turn)).alias("_tie"), "shard")).alias("_best"), F.count("*").alias("_cells"))
                .where("_cells > 1").select("_hub", F.col("_best.shard").alias("_to")))
        best = cut(best, "shard-best")
        cuts.append(best.count())
        # rows without a hub take no part in the join: null keys would meet in one task
        wished = state.where("_hub is not null").join(best, "_hub", "left").withColumn(
            "_to", F.when((F.col("_to") != F.col("shard")) & ~F.col("shard").isin(done), F.col("_to")))
        wished = cut(wished.select(*state.columns, "_to"), "shard-wish")
        wish = {(r.shard, r["_to"]): r["count"] for r in wished.where("_to is not null").groupBy("shard", "_to").count().collect()}
        take, back = quotas(rows, cap, free, wish)
        if not take:
            drop(wished)
            break
        moved = wished.where("_to is not null")
        if take != wish:  # some wishes wait: the first by rank move
            moved = dense_rank_in(moved, ["shard", "_to"], order, buckets, "_at")
            limit = F.create_map(*[F.lit(x) for (a, b), k in take.items() for x in (a * shards + b, k)])
            may = F.col("_at") < F.coalesce(limit[F.col("shard") * shards + F.col("_to")], F.lit(0))
            moved = moved.withColumn("shard", F.when(may, F.col("_to")).otherwise(F.col("shard"))).drop("_at")
        else:
            moved = moved.withColumn("shard", F.col("_to"))
        stay = wished.where("_to is null")
        single = state.where("_hub is null")
        if back:
            single = dense_rank_in(single, ["shard"], order, buckets, "_at")
            target, passed = F.col("shard"), {}
            for t, s, k in back:
                low = passed.get(t, 0)
                passed[t] = low + k
                target = F.when((F.col("shard") == t) & F.col("_at").between(low, low + k - 1), F.lit(s)).otherwise(target)
            single = single.withColumn("shard", target).drop("_at")
        names = state.columns
        new = cut(moved.select(names).unionByName(stay.select(names)).unionByName(single.select(names))
                  .withColumn("shard", F.col("shard").cast("int")), "shard-state")
        drop(wished)
        drop(best)
        drop(state)
        state = new
    spread = state.where("_hub is not null").groupBy("_hub").agg(F.count("*").alias("_total"), F.min("shard").alias("_a"), F.max("shard").alias("_z"))
    spread = cut(spread, "shard-spread")
    cuts.append(spread.where("_a < _z").count())
    if cuts[-1]:
        # the cut hubs that fit in a shard, and some whole ones, so that each shard has a few places to lay out
        every = max(1, spread.count() // (64 * shards))
        picked = ((F.col("_a") < F.col("_z")) | (F.pmod(F.xxhash64("_hub", F.lit("whole")), F.lit(every)) == 0)) & (F.col("_total") <= cap[-1])
        picked = cut(spread.where(picked).select("_hub", "_total"), "shard-picked")
        some = cut(state.join(picked.hint("merge"), "_hub", "left_semi").select(state.columns), "shard-picked")
        sizes = {r.shard: r["count"] for r in some.groupBy("shard").count().collect()}
        laid = in_runs(some, picked, order, [sizes.get(t, 0) for t in range(shards)], buckets)
        rest = state.where("_hub is null").unionByName(state.where("_hub is not null").join(picked.hint("merge"), "_hub", "left_anti").select(state.columns))
        state = cut(laid.withColumn("shard", F.col("shard").cast("int")).unionByName(rest), "shard-state")
    return dense_rank_in(state.drop("_hub"), ["shard"], order, buckets, "slot")


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): documents in shards by the law
    ``rows``, equal texts together as far as it allows.

    Size: UTF-8 bytes of the text plus 1; a null text has size 1, checksum 0 and counts as equal to
    the empty text. Repeated rows and null ids are rows like others; other columns are ignored; texts
    of any length are read whole; an empty table gives an empty table.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    nodes = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        (F.octet_length(text) + 1).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("hub"))
    out = balanced_shards(nodes, "hub", ["doc_id", "hub"], shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                      F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
