"""Grouped analyses of the accident tables (silver -> gold).

Inputs are silver DataFrames; every builder is lazy. Exact distinct counts
use ``count_distinct`` (Spark splits it into a (group, key) aggregation and a
group aggregation, both partially aggregated), so a hot group never sends its
raw rows to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.expressions import (
    GRAV_HOSPITALISED, GRAV_KILLED, SERIOUS_MIN_SCORE, count_where, flag, safe_ratio, severity_score,
    weekday_from_parts,
)
from strata.operators import joins
from strata.operators.ranking import top_k

# Gold column names (gravite_max, nb_tues, taux_graves, ...) are fixed values: the
# tables' readers know them.
KEY = "num_acc"
STATS_MAX_GROUPS = 10_000  # group statistics of at most so many rows are broadcast


def with_severity_score(persons: DataFrame) -> DataFrame:
    return persons.withColumn("score_gravite", severity_score("grav"))


def severity_per_accident(persons: DataFrame) -> DataFrame:
    """One row per accident: max score, killed, hospitalised, persons, serious flag.

    Unknown codes keep a NULL score: an accident with only unknown codes has a
    NULL max and a NULL serious flag, but is still counted.
    """
    return (with_severity_score(persons).groupBy(KEY)
            .agg(F.max("score_gravite").alias("gravite_max"),
                 count_where(F.col("grav") == GRAV_KILLED).alias("nb_tues"),
                 count_where(F.col("grav") == GRAV_HOSPITALISED).alias("nb_hospitalises"),
                 F.count(F.lit(1)).alias("nb_usagers"))
            .withColumn("accident_grave", flag(F.col("gravite_max") >= SERIOUS_MIN_SCORE)))


def serious_flag(persons: DataFrame) -> DataFrame:
    """One row per accident: its serious flag. A maximum, so copies of a person don't matter."""
    return (with_severity_score(persons).groupBy(KEY).agg(F.max("score_gravite").alias("gravite_max"))
            .select(KEY, flag(F.col("gravite_max") >= SERIOUS_MIN_SCORE).alias("accident_grave")))


def severity_by_weather(accidents: DataFrame, severity: DataFrame) -> DataFrame:
    """Per weather code: distinct accidents, mean max severity, total killed."""
    return (accidents.select(KEY, "meteo").join(severity, KEY, "inner")
            .groupBy("meteo")
            .agg(F.count_distinct(KEY).alias("nb_accidents"),
                 F.avg("gravite_max").alias("gravite_moyenne"),
                 F.sum("nb_tues").cast("bigint").alias("total_tues"))
            .orderBy(F.desc("nb_accidents"), F.asc_nulls_last("meteo")))


def weather_surface(accidents: DataFrame, places: DataFrame, severity: DataFrame) -> DataFrame:
    """Per (weather, surface): distinct accidents and distinct serious accidents.

    Places are reduced to distinct (key, surface) pairs before the join, so an
    accident with two places of the same surface is counted once.
    """
    pairs = places.select(KEY, "etat_route").distinct()
    one = (accidents.select(KEY, "meteo").join(pairs, KEY, "inner")
           .join(severity.select(KEY, "accident_grave"), KEY, "inner")
           .select("meteo", "etat_route", KEY, "accident_grave").distinct())
    return (one.groupBy("meteo", "etat_route")
            .agg(F.count(F.lit(1)).alias("nb_accidents"),
                 count_where(F.col("accident_grave") == 1).alias("nb_graves"))
            .orderBy(F.desc("nb_accidents"), F.asc_nulls_last("meteo"), F.asc_nulls_last("etat_route")))


def departments_with_places(accidents: DataFrame, places: DataFrame, strategy: str = "auto",
                            places_bound_rows: int | None = None) -> DataFrame:
    """Distinct accidents with at least one place, per department.

    The n-side (places) is reduced to its distinct keys first; the join
    strategy is the experiment's variable (``shuffle`` / ``broadcast``)."""
    keys = joins.distinct_keys(places, KEY)
    joined = joins.keyed_inner_join(accidents.select(KEY, "dep"), keys, KEY,
                                    strategy=strategy, right_bound_rows=places_bound_rows)
    return (joined.groupBy("dep").agg(F.count_distinct(KEY).alias("nb_accidents"))
            .orderBy(F.desc("nb_accidents"), F.asc("dep")))


def department_hour(accidents: DataFrame, places: DataFrame) -> DataFrame:
    """Distinct accidents (with a place) per (department, hour); NULL hour kept."""
    keys = joins.distinct_keys(places, KEY)
    return (accidents.select(KEY, "dep", "heure_int").join(keys, KEY, "inner")
            .groupBy("dep", "heure_int").agg(F.count_distinct(KEY).alias("nb_accidents"))
            .orderBy(F.desc("nb_accidents"), F.asc("dep"), F.asc_nulls_last("heure_int")))


def department_serious_rate(accidents: DataFrame, severity: DataFrame) -> DataFrame:
    """Per department: distinct accidents, serious accidents, serious rate."""
    return (accidents.select(KEY, "dep").join(severity.select(KEY, "accident_grave"), KEY, "inner")
            .groupBy("dep")
            .agg(F.count_distinct(KEY).alias("total_accidents"),
                 F.sum("accident_grave").cast("bigint").alias("accidents_graves"))
            .withColumn("taux_graves", safe_ratio("accidents_graves", "total_accidents")))


def distinct_counts(places: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Exact distinct accidents per surface (places) and per vehicle category."""
    a = (places.groupBy(F.col("etat_route").alias("category"))
         .agg(F.count_distinct(KEY).alias("nb_accidents"))
         .withColumn("dimension", F.lit("etat_route")))
    b = (vehicles.groupBy(F.col("cat_veh").alias("category"))
         .agg(F.count_distinct(KEY).alias("nb_accidents"))
         .withColumn("dimension", F.lit("cat_veh")))
    return a.unionByName(b).select("dimension", "category", "nb_accidents")


def count_by_category(df: DataFrame, column: str, name: str = "nb") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def skew_profile(accidents: DataFrame, places: DataFrame, group: str = "dep") -> DataFrame:
    """Distribution of rows over ``group``: min / max / avg and max/avg ratio,
    once on joined rows (inflated by fan-out) and once on distinct accidents.
    The ratio is computed in Spark (NULL on empty input)."""
    per_group = (accidents.select(KEY, group).join(places.select(KEY), KEY, "inner")
                 .groupBy(group)
                 .agg(F.count(F.lit(1)).alias("joined_rows"),
                      F.count_distinct(KEY).alias("distinct_accidents")))
    long = per_group.select(group, F.stack(
        F.lit(2), F.lit("joined_rows"), F.col("joined_rows"),
        F.lit("distinct_accidents"), F.col("distinct_accidents")).alias("measure", "n"))
    return (long.groupBy("measure")
            .agg(F.min("n").alias("min_n"), F.max("n").alias("max_n"), F.avg("n").alias("avg_n"))
            .withColumn("ratio_max_avg", safe_ratio("max_n", "avg_n")))


def having_min_count(ratings: DataFrame, item: str, value: str, min_count: int, k: int) -> DataFrame:
    """Best items by mean rating among those with at least ``min_count`` ratings."""
    stats = (ratings.groupBy(item)
             .agg(F.avg(value).alias("note_moyenne"), F.count(F.lit(1)).alias("nb_votes"))
             .where(F.col("nb_votes") >= min_count))
    return top_k(stats, [F.desc("note_moyenne"), F.asc(item)], k)


def crosstab(df: DataFrame, row: str, column: str, values: list, prefix: str) -> DataFrame:
    """Counts of ``row`` x ``column`` with a column per listed value (no extra
    job to discover them) and one for every other value and NULL, so each row of
    ``df`` is counted once; absent combinations are 0."""
    listed = F.coalesce(F.col(column).isin(values), F.lit(False))
    return df.groupBy(row).agg(*[count_where(F.col(column) == v).alias(f"{prefix}{v}") for v in values],
                               count_where(~listed).alias(f"{prefix}autre"))


def user_profiles(persons: DataFrame) -> DataFrame:
    """Per (sex, user category): persons, killed, hospitalised, killed share."""
    return (persons.groupBy("sexe", "catu")
            .agg(F.count(F.lit(1)).alias("nb_usagers"),
                 count_where(F.col("grav") == GRAV_KILLED).alias("nb_tues"),
                 count_where(F.col("grav") == GRAV_HOSPITALISED).alias("nb_hospitalises"))
            .withColumn("part_tues", safe_ratio("nb_tues", "nb_usagers")))


def weekday_hour(accidents: DataFrame) -> DataFrame:
    """Accidents per (day of week, hour); day 1 = Sunday."""
    return (accidents.withColumn("jour_semaine", weekday_from_parts("an", "mois", "jour"))
            .groupBy("jour_semaine", "heure_int").agg(F.count(F.lit(1)).alias("nb_accidents")))


def yearly_change(accidents: DataFrame) -> DataFrame:
    """Accidents per year with the change from the previous year.

    The window has no partition, but its input is one row per year."""
    per_year = accidents.groupBy("an").agg(F.count(F.lit(1)).alias("nb_accidents"))
    w = Window.orderBy("an")
    prev = F.lag("nb_accidents").over(w)
    return (per_year.withColumn("variation", F.col("nb_accidents") - prev)
            .withColumn("variation_pct", F.round(safe_ratio(F.col("nb_accidents") - prev, prev) * 100, 6)))


def amount_by_hour(events: DataFrame, ts: str = "ts", amount: str = "value") -> DataFrame:
    """Per hour of day: events, total and mean amount (rounded to 6 digits so
    the result does not depend on summation order)."""
    return (events.groupBy(F.hour(ts).alias("heure"))
            .agg(F.count(F.lit(1)).alias("nb"),
                 F.round(F.sum(amount), 6).alias("total"),
                 F.round(F.avg(amount), 6).alias("moyenne")))


def unit_price(lines: DataFrame, dim: DataFrame, line_key: str, dim_key: str, group: str,
               price: str, qty: str) -> DataFrame:
    """Unit price (price / quantity, NULL for zero quantity) per dimension group.

    Eager aggregation: lines are first reduced to (count, sum, min, max) per
    dimension key (partial aggregation, one row per key), so the join with the
    dimension is dimension-sized instead of line-sized; the per-group mean is
    then sum / count of the merged partial sums."""
    up = safe_ratio(price, qty)
    per_key = (lines.withColumn("_up", up).groupBy(line_key)
               .agg(F.count("_up").alias("_n"), F.sum("_up").alias("_s"),
                    F.min("_up").alias("_mn"), F.max("_up").alias("_mx")))
    joined = per_key.join(dim, per_key[line_key] == dim[dim_key])
    return (joined.groupBy(group)
            .agg(F.sum("_n").cast("bigint").alias("nb"),
                 F.round(safe_ratio(F.sum("_s"), F.sum("_n")), 6).alias("prix_unitaire_moyen"),
                 F.round(F.min("_mn"), 6).alias("prix_unitaire_min"),
                 F.round(F.max("_mx"), 6).alias("prix_unitaire_max")))


def zscore_outliers(df: DataFrame, group: str, value: str, threshold: float) -> DataFrame:
    """Rows whose value is more than ``threshold`` sample standard deviations
    from their group mean. Group statistics are one row per group; up to
    ``STATS_MAX_GROUPS`` of them are computed at once and broadcast, so the rows
    are never shuffled by a hot group. More groups than that are joined by a shuffle
    that AQE can split."""
    stats = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.avg(value).alias("_mu"), F.stddev_samp(value).alias("_sd"))
    known = stats.limit(STATS_MAX_GROUPS + 1).collect()
    if len(known) <= STATS_MAX_GROUPS:
        stats = F.broadcast(df.sparkSession.createDataFrame(known, stats.schema))
    z = safe_ratio(F.col(value) - F.col("_mu"), F.col("_sd"))
    return (df.join(stats, group, "inner").withColumn("zscore", z)
            .where(F.abs(F.col("zscore")) > threshold)
            .withColumn("zscore", F.round("zscore", 4)).drop("_mu", "_sd"))


def schema_profile(df: DataFrame) -> DataFrame:
    """printSchema as data: (column_name, data_type, non_null) for every
    column, from one aggregate pass over the table."""
    fields = df.schema.fields
    wide = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    parts = []
    for i, f in enumerate(fields):
        parts += [F.lit(f.name), F.lit(f.dataType.simpleString()), F.col(f"c{i}")]
    return wide.select(F.stack(F.lit(len(fields)), *parts).alias("column_name", "data_type", "non_null"))


def numeric_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """describe(): count / mean / stddev / min / max per numeric column, one
    aggregate pass, then unpivoted to one row per column."""
    aggs = []
    for c in columns:
        aggs += [F.count(c).alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"),
                 F.stddev_samp(c).alias(f"{c}__stddev"),
                 F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max")]
    wide = df.agg(*aggs)
    parts = []
    for c in columns:
        parts += [F.lit(c), F.col(f"{c}__count"), F.round(f"{c}__mean", 6),
                  F.round(f"{c}__stddev", 6), F.col(f"{c}__min"), F.col(f"{c}__max")]
    return wide.select(F.stack(F.lit(len(columns)), *parts).alias(
        "column_name", "n", "mean", "stddev", "min_value", "max_value"))


def origin_destination_counts(lines: DataFrame, orders: DataFrame, customers: DataFrame,
                              suppliers: DataFrame) -> DataFrame:
    """Line counts per (supplier nation, customer nation).

    Join order chosen for size: each side resolves its nation first (lines by
    supplier, orders by customer), then the two meet once on the order key, so
    line-sized data is shuffled twice (by supplier, by order) instead of three
    times; the pair count is partially aggregated before its shuffle."""
    line_side = (lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
                 .select("l_orderkey", F.col("s_nationkey").alias("origine")))
    order_side = (orders.join(customers, orders.o_custkey == customers.c_custkey)
                  .select("o_orderkey", F.col("c_nationkey").alias("destination")))
    return (line_side.join(order_side, line_side.l_orderkey == order_side.o_orderkey)
            .groupBy("origine", "destination").agg(F.count(F.lit(1)).alias("nb")))


def mean_by(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Rows and mean of ``value`` (rounded to 6 digits) per group; NULL values do not
    count into the mean."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("nb"), F.round(F.avg(value), 6).alias(name))


def mean_duration_by_weekday(df: DataFrame, start: str, end: str) -> DataFrame:
    """Mean days from ``start`` to ``end`` per weekday of the start (1 = Sunday)."""
    days = F.datediff(F.col(end), F.col(start))
    return mean_by(df.select(F.dayofweek(start).alias("jour_semaine"), days.alias("_d")), "jour_semaine", "_d", "duree_moyenne")


def ratings_per_user(ratings: DataFrame, user: str, value: str) -> DataFrame:
    """Ratings of each user: number, mean, lowest and highest."""
    return ratings.groupBy(user).agg(F.count(F.lit(1)).alias("nb_notes"), F.round(F.avg(value), 6).alias("note_moyenne"),
                                     F.min(value).alias("note_min"), F.max(value).alias("note_max"))


def popularity_by_category(ratings: DataFrame, items: DataFrame, item: str, item_key: str, category: str, value: str) -> DataFrame:
    """Ratings, rated items and mean rating per category. Ratings are reduced to one
    row per item before they meet the items, so the join is item-sized."""
    per_item = ratings.groupBy(item).agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s"))
    return (per_item.join(items, per_item[item] == items[item_key]).groupBy(category)
            .agg(F.sum("_n").cast("bigint").alias("nb_notes"), F.count(F.lit(1)).alias("nb_articles"),
                 F.round(safe_ratio(F.sum("_s"), F.sum("_n")), 6).alias("note_moyenne")))


def unit_price_over_time(lines: DataFrame, area: str, day: str, price: str, qty: str) -> DataFrame:
    """Mean unit price per area and month."""
    return (lines.withColumn("_up", safe_ratio(price, qty)).groupBy(F.col(area), F.year(day).alias("an"), F.month(day).alias("mois"))
            .agg(F.count("_up").alias("nb"), F.round(F.avg("_up"), 6).alias("prix_unitaire_moyen")))
