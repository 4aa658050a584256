"""Query catalogue: one (spark, sf_dir) -> DataFrame builder per operator.

Each entry reads the driver's tables (or data Spark derives from them) over
their whole extent. Names match the keys of ``strata.plans.oracle.ORACLE``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import contracts
from strata.functions import expressions as fx
from strata.operators import aggregate as agg
from strata.operators import clean as cl
from strata.operators import joins, measure, recommend, skew
from strata.operators.quantiles import exact_quantiles
from strata.operators.ranking import rank_within_group, top_k
from strata.plans import bindings, layers
from strata.session import checkpoint_root, scratch_path
from strata.sources import files, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def silver(spark: SparkSession, d: str) -> Mapping[str, DataFrame]:
    return layers.silver_from_driver(spark, d)


def sets(spark: SparkSession, d: str) -> Mapping[str, DataFrame]:
    """Silver for analyses that copies of a row can't change."""
    return layers.sets_from_driver(spark, d)


# ---- step 1: the minimum slice -------------------------------------------------

@query("severity_per_accident")
def q_severity_per_accident(spark: SparkSession, d: str) -> DataFrame:
    """One row per accident: max severity score, killed, hospitalised, persons, serious flag."""
    return silver(spark, d)["severity"]


@query("enrich_severity_score")
def q_enrich_severity_score(spark: SparkSession, d: str) -> DataFrame:
    """Persons per (severity code, increasing score); unknown codes keep a NULL score."""
    p = agg.with_severity_score(silver(spark, d)["persons"])
    return p.groupBy("grav", "score_gravite").agg(F.count(F.lit(1)).alias("nb_usagers"))


@query("rank_departments_serious_rate")
def q_rank_departments(spark: SparkSession, d: str) -> DataFrame:
    """Top 20 departments by serious-accident rate (ties broken by department)."""
    return layers.top_departments(sets(spark, d))


# ---- step 3: the source pipeline's analyses -----------------------------------------

@query("join_severity_by_weather")
def q_join_severity_by_weather(spark: SparkSession, d: str) -> DataFrame:
    """Per weather code: distinct accidents, mean max severity, total killed."""
    s = silver(spark, d)
    return agg.severity_by_weather(s["accidents"], s["severity"])


@query("agg_weather_surface")
def q_agg_weather_surface(spark: SparkSession, d: str) -> DataFrame:
    """Per (weather, road surface): distinct accidents and distinct serious accidents."""
    s = sets(spark, d)
    return agg.weather_surface(s["accidents"], s["places"], s["severity"])


@query("join_departments_shuffle")
def q_join_departments_shuffle(spark: SparkSession, d: str) -> DataFrame:
    """Distinct accidents with a place per department; sort-merge join arm."""
    s = sets(spark, d)
    return agg.departments_with_places(s["accidents"], s["places"], strategy="shuffle")


@query("join_departments_broadcast")
def q_join_departments_broadcast(spark: SparkSession, d: str) -> DataFrame:
    """Same result; broadcast arm behind a proven row bound."""
    s = sets(spark, d)
    # proven bound: distinct place keys <= rows of the place source
    bound = joins.source_row_bound(spark, f"{d.rstrip('/')}/lineitem.parquet")
    return agg.departments_with_places(s["accidents"], s["places"], strategy="broadcast",
                                       places_bound_rows=bound)


@query("agg_department_hour")
def q_agg_department_hour(spark: SparkSession, d: str) -> DataFrame:
    """Distinct accidents with a place per (department, hour); NULL hour kept."""
    s = sets(spark, d)
    return agg.department_hour(s["accidents"], s["places"])


@query("agg_distinct_count")
def q_agg_distinct_count(spark: SparkSession, d: str) -> DataFrame:
    """Exact distinct accidents per road surface and per vehicle category."""
    s = sets(spark, d)
    return agg.distinct_counts(s["places"], s["vehicles"])


@query("agg_count_by_category")
def q_agg_count_by_category(spark: SparkSession, d: str) -> DataFrame:
    """Accidents per weather code."""
    return agg.count_by_category(silver(spark, d)["accidents"], "meteo", "nb_accidents")


@query("skew_profile")
def q_skew_profile(spark: SparkSession, d: str) -> DataFrame:
    """Min / max / mean rows per department and max/mean ratio, joined rows vs distinct accidents."""
    s = silver(spark, d)
    return agg.skew_profile(s["accidents"], s["places"], "dep")


@query("topk_groups")
def q_topk_groups(spark: SparkSession, d: str) -> DataFrame:
    """The five departments with most accidents."""
    counts = agg.count_by_category(silver(spark, d)["accidents"], "dep", "nb_accidents")
    return top_k(counts, [F.desc("nb_accidents"), F.asc("dep")], 5)


@query("having_min_count")
def q_having_min_count(spark: SparkSession, d: str) -> DataFrame:
    """Ten best-rated parts among those with at least five ratings."""
    return agg.having_min_count(bindings.ratings(spark, d), "item_id", "rating", 5, 10)


# ---- step 2: cleaning (over the all-text bronze with rule-chosen defects) ----------


@query("proj_select_rename")
def q_proj_select_rename(spark: SparkSession, d: str) -> DataFrame:
    """Projection with the business rename atm -> meteo."""
    return (bindings.accidents(spark, d).select("num_acc", "dep", "atm")
            .withColumnsRenamed({"atm": "meteo"}))


@query("clean_required_keys")
def q_clean_required_keys(spark: SparkSession, d: str) -> DataFrame:
    """Raw accidents whose key is present and not blank."""
    return cl.require_keys(bindings.dirty_accidents(spark, d), "num_acc")


@query("clean_year_range")
def q_clean_year_range(spark: SparkSession, d: str) -> DataFrame:
    """Raw accidents whose year reads as an integer within the plausible range."""
    lo, hi = bindings.PLAUSIBLE_YEARS
    return cl.year_range(bindings.dirty_accidents(spark, d), "an", lo, hi).select("num_acc", "an")


@query("clean_trim_codes")
def q_clean_trim_codes(spark: SparkSession, d: str) -> DataFrame:
    """Accidents per department after trimming padded codes."""
    t = cl.trim_codes(bindings.dirty_accidents(spark, d), "dep")
    return agg.count_by_category(t, "dep", "nb")


@query("enrich_hour")
def q_enrich_hour(spark: SparkSession, d: str) -> DataFrame:
    """Rows per hour derived from HH:MM text (NULL when the text has another shape)."""
    t = bindings.dirty_accidents(spark, d).withColumn("heure_int", fx.hour_from_hrmn("hrmn"))
    return t.groupBy("heure_int").agg(F.count(F.lit(1)).alias("nb"), F.count("hrmn").alias("nb_avec_texte"))


@query("enrich_hour_quality")
def q_enrich_hour_quality(spark: SparkSession, d: str) -> DataFrame:
    """Time field quality: missing, malformed, shape-valid but impossible hours."""
    t = bindings.dirty_accidents(spark, d).withColumn("heure_int", fx.hour_from_hrmn("hrmn"))
    return cl.hour_quality(t)


@query("enrich_safe_cast")
def q_enrich_safe_cast(spark: SparkSession, d: str) -> DataFrame:
    """Rows per year cast with try_cast (unreadable text -> NULL)."""
    t = bindings.dirty_accidents(spark, d).withColumn("an_int", fx.safe_int("an"))
    return agg.count_by_category(t, "an_int", "nb")


@query("dedup_full_row")
def q_dedup_full_row(spark: SparkSession, d: str) -> DataFrame:
    """Raw accidents without exact duplicate rows."""
    return cl.dedup_full_row(bindings.dirty_accidents(spark, d))


@query("clean_report")
def q_clean_report(spark: SparkSession, d: str) -> DataFrame:
    """Per table: raw, duplicate, rejected-by-reason and kept rows."""
    return layers.driver_report(spark, d)


@query("clean_reject_reasons")
def q_clean_reject_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Raw accidents per first failing cleaning rule (NULL = kept)."""
    t = cl.with_reject_reason(bindings.dirty_accidents(spark, d), layers.TEXT_ACCIDENT_RULES)
    return agg.count_by_category(t, "reject_reason", "nb")


@query("silver_from_text")
def q_silver_from_text(spark: SparkSession, d: str) -> DataFrame:
    """Typed, cleaned accident silver built from the all-text bronze."""
    return layers.silver_accidents_from_text(bindings.dirty_accidents(spark, d))


# ---- step 4: sources, sinks, reports ------------------------------------------------


_CSV_WRITE = {"header": True, "sep": files.CSV_SEP, "encoding": files.CSV_ENCODING,
              "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _write_csv(df, path, compression=None):
    w = df.write.mode("overwrite").options(**_CSV_WRITE)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


@query("src_csv_typed")
def q_src_csv_typed(spark: SparkSession, d: str) -> DataFrame:
    """Accident bronze written as semicolon ISO-8859-1 text, read back typed by contract."""
    path = scratch_path(spark, "csv-typed")
    _write_csv(bindings.dirty_accidents(spark, d), path)
    return files.read_csv_contract(spark, path, contracts.ACCIDENTS_TEXT)


@query("src_bad_cells")
def q_src_bad_cells(spark: SparkSession, d: str) -> DataFrame:
    """Per typed column: cells present but unreadable as the contract type."""
    # cells present as text but unreadable as their contract type (counted, not failed)
    return contracts.bad_cell_counts(bindings.dirty_accidents(spark, d), contracts.ACCIDENTS_TEXT)


@query("src_csv_contract")
def q_src_csv_contract(spark: SparkSession, d: str) -> DataFrame:
    """Same, from a file whose column order differs from the contract."""
    # the file's column order differs from the contract: binding is by name
    path = scratch_path(spark, "csv-contract")
    text = bindings.dirty_accidents(spark, d)
    _write_csv(text.select(*reversed(text.columns)), path)
    files.check_sources(spark, [path])
    return files.read_csv_contract(spark, path, contracts.ACCIDENTS_TEXT)


@query("ingest_row_counts")
def q_ingest_row_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows per bronze table."""
    raw = bindings.raw_tables(spark, d)
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("nb_rows"))
             for name, df in raw.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("sink_parquet_roundtrip")
def q_sink_parquet_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Gold weather table written as one Parquet file and read back."""
    s = silver(spark, d)
    path = scratch_path(spark, "gold-meteo")
    sinks.write_parquet(agg.severity_by_weather(s["accidents"], s["severity"]), path, files=1)
    return spark.read.parquet(path)


@query("sink_partitioned_roundtrip")
def q_sink_partitioned_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Silver accidents written partitioned by department, read back with the declared schema."""
    acc = silver(spark, d)["accidents"]
    path = scratch_path(spark, "silver-accidents-by-dep")
    sinks.write_partitioned(acc, path, ["dep"])
    # declared schema on read: partition values stay text ("07", not 7)
    return spark.read.schema(acc.schema).parquet(path).select(*acc.columns)


@query("profile_schema")
def q_profile_schema(spark: SparkSession, d: str) -> DataFrame:
    """Silver accident columns with type and non-NULL count."""
    return agg.schema_profile(silver(spark, d)["accidents"])


@query("run_metrics_rows")
def q_run_metrics_rows(spark: SparkSession, d: str) -> DataFrame:
    """Cleaning metrics as (step, table, metric, value) written to JSON and read back."""
    metrics = sinks.metrics_from_report(layers.driver_report(spark, d), "nettoyage")
    path = scratch_path(spark, "metrics")
    sinks.write_metrics_json(metrics, path)
    return sinks.read_metrics_json(spark, path)


# ---- fixed values: labels of the person severity codes ----
GRAV_LABELS = [(1, "indemne"), (2, "tue"), (3, "blesse hospitalise"), (4, "blesse leger")]


@query("enrich_code_labels")
def q_enrich_code_labels(spark: SparkSession, d: str) -> DataFrame:
    """Persons per severity code with its label (broadcast 4-row lookup)."""
    labels = spark.createDataFrame(GRAV_LABELS, "grav int, libelle string")
    persons = silver(spark, d)["persons"]
    j = joins.dimension_join(persons, labels.withColumnRenamed("grav", "code"), "grav", "code",
                             dim_rows=len(GRAV_LABELS), how="left")
    return (j.withColumn("libelle", F.coalesce("libelle", F.lit("inconnu")))
            .groupBy("grav", "libelle").agg(F.count(F.lit(1)).alias("nb_usagers")))


# ---- step 5: physical control -----------------------------------------------------


@query("cache_reuse_counts")
def q_cache_reuse_counts(spark: SparkSession, d: str) -> DataFrame:
    """Two counts from one scoped cache of silver accidents."""
    acc = silver(spark, d)["accidents"].select("num_acc", "meteo", "dep")
    checkpoint_root(spark)
    with measure.cached(acc) as c:
        a = c.groupBy(F.col("meteo").cast("string").alias("category")).agg(F.count(F.lit(1)).alias("nb"))
        b = c.groupBy(F.col("dep").alias("category")).agg(F.count(F.lit(1)).alias("nb"))
        out = (a.withColumn("dimension", F.lit("meteo"))
               .unionByName(b.withColumn("dimension", F.lit("dep"))))
        # both reads hit the cache; the small result is cut from the lineage
        # (reliable checkpoint in the shared folder) before the cache is released
        return out.checkpoint(eager=True)


@query("repartition_agg")
def q_repartition_agg(spark: SparkSession, d: str) -> DataFrame:
    """Joined rows per department, aggregated first, then laid out on 50 partitions."""
    s = silver(spark, d)
    joined = s["accidents"].select("num_acc", "dep").join(s["places"].select("num_acc"), "num_acc")
    return measure.aggregate_then_repartition(joined, "dep", 50)


# ---- step 6: documented variants ------------------------------------------------------

@query("dedup_by_key")
def q_dedup_by_key(spark: SparkSession, d: str) -> DataFrame:
    """One person per accident: the most severe (deterministic tie-break)."""
    p = agg.with_severity_score(silver(spark, d)["persons"])
    order = [F.desc_nulls_last("score_gravite"), F.asc("num_veh"), F.asc("catu"), F.asc("sexe"), F.asc("grav")]
    return cl.dedup_by_key(p, "num_acc", order)


@query("pushdown_partition_filter")
def q_pushdown_partition_filter(spark: SparkSession, d: str) -> DataFrame:
    """Accidents per weather in department 07 read through partition pruning."""
    acc = silver(spark, d)["accidents"]
    path = scratch_path(spark, "accidents-by-dep")
    sinks.write_partitioned(acc, path, ["dep"])
    back = spark.read.schema(acc.schema).parquet(path)
    # dep = '07' prunes to one folder (PartitionFilters)
    return (back.where(F.col("dep") == "07")
            .groupBy("meteo").agg(F.count(F.lit(1)).alias("nb_accidents")))


# ---- step 7: brief-level operators ----------------------------------------------------

@query("salted_agg")
def q_salted_agg(spark: SparkSession, d: str) -> DataFrame:
    """Rows and distinct accidents per department through a 16-way salted aggregate."""
    s = silver(spark, d)
    joined = s["accidents"].select("num_acc", "dep").join(s["places"].select("num_acc"), "num_acc")
    return measure.salted_aggregate(joined, "dep", "num_acc", 16)


@query("filter_compound")
def q_filter_compound(spark: SparkSession, d: str) -> DataFrame:
    """Persons per code under a compound AND / OR / NOT predicate."""
    p = silver(spark, d)["persons"]
    cond = ((F.col("grav") == 2) & (F.col("catu") == 1)) | ~(F.col("num_veh") < 5)
    return agg.count_by_category(p.where(cond), "grav", "nb")


@query("clean_na_drop_fill")
def q_clean_na_drop_fill(spark: SparkSession, d: str) -> DataFrame:
    """Accidents per hour with missing values filled, and with them dropped."""
    acc = silver(spark, d)["accidents"]
    # one pass: rows per (hour, time text) -- bounded by the distinct times --
    # then the NA rules on that small frame; both branches reuse its exchange
    per = acc.groupBy("heure_int", "hrmn").agg(F.count(F.lit(1)).alias("n"))
    filled = cl.na_drop_fill(per, fill={"heure_int": -1, "hrmn": "--:--"})
    dropped = cl.na_drop_fill(per, drop_subset=["hrmn"])
    return (filled.groupBy("heure_int").agg(F.sum("n").cast("bigint").alias("nb"))
            .withColumn("methode", F.lit("fill"))
            .unionByName(dropped.groupBy("heure_int").agg(F.sum("n").cast("bigint").alias("nb"))
                         .withColumn("methode", F.lit("drop"))))


@query("enrich_weekday")
def q_enrich_weekday(spark: SparkSession, d: str) -> DataFrame:
    """Raw accidents per day of week (impossible or unreadable dates -> NULL)."""
    t = bindings.dirty_accidents(spark, d)
    t = t.withColumn("jour_semaine", fx.weekday_from_parts(fx.safe_int("an"), fx.safe_int("mois"), fx.safe_int("jour")))
    return agg.count_by_category(t, "jour_semaine", "nb")


@query("enrich_hour_bucket")
def q_enrich_hour_bucket(spark: SparkSession, d: str) -> DataFrame:
    """Accidents per six-hour bucket of the day."""
    t = silver(spark, d)["accidents"].withColumn("tranche", fx.hour_bucket("heure_int"))
    return agg.count_by_category(t, "tranche", "nb")


@query("join_four_tables")
def q_join_four_tables(spark: SparkSession, d: str) -> DataFrame:
    """One row per accident with place, vehicle and person summaries (no fan-out)."""
    s = silver(spark, d)
    return joins.four_table_join(s["accidents"], s["places"], s["vehicles"], s["severity"])


@query("join_dimension_lookup")
def q_join_dimension_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Accidents per region through nation and region lookups."""
    acc = silver(spark, d)["accidents"].select("num_acc", "dep")
    nation = bindings.table(spark, d, "nation", ["n_nationkey", "n_regionkey"])
    region = bindings.table(spark, d, "region", ["r_regionkey", "r_name"])
    n_rows = joins.source_row_bound(spark, f"{d.rstrip('/')}/nation.parquet")
    r_rows = joins.source_row_bound(spark, f"{d.rstrip('/')}/region.parquet")
    dims = (joins.dimension_join(nation, region, "n_regionkey", "r_regionkey", r_rows)
            .select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("code_dep"), "r_name"))
    j = joins.dimension_join(acc, dims, "dep", "code_dep", n_rows)
    return j.groupBy("r_name").agg(F.count(F.lit(1)).alias("nb_accidents"))


@query("crosstab_pivot")
def q_crosstab_pivot(spark: SparkSession, d: str) -> DataFrame:
    """Department x weather cross-tabulation: a column per listed code, one for all others and NULL."""
    return agg.crosstab(silver(spark, d)["accidents"], "dep", "meteo", [1, 2, 3, 4, 5], "meteo_")


@query("agg_user_profiles")
def q_agg_user_profiles(spark: SparkSession, d: str) -> DataFrame:
    """Per (sex, user category): persons, killed, hospitalised, killed share."""
    return agg.user_profiles(silver(spark, d)["persons"])


@query("agg_weekday_hour")
def q_agg_weekday_hour(spark: SparkSession, d: str) -> DataFrame:
    """Accidents per (day of week, hour)."""
    return agg.weekday_hour(silver(spark, d)["accidents"])


@query("rank_within_group")
def q_rank_within_group(spark: SparkSession, d: str) -> DataFrame:
    """Top three departments per weather code."""
    counts = (silver(spark, d)["accidents"].groupBy("meteo", "dep")
              .agg(F.count(F.lit(1)).alias("nb_accidents")))
    return rank_within_group(counts, ["meteo"], [F.desc("nb_accidents"), F.asc("dep")], 3, "rang")


@query("udf_equivalence")
def q_udf_equivalence(spark: SparkSession, d: str) -> DataFrame:
    """The severity score natively, by Python UDFs, a pandas UDF and an Arrow UDF: rows per code, and those where each
    way gives the native score. Every row is scored in every way."""
    from strata.functions.udfs import WAYS
    t = silver(spark, d)["persons"].select("grav", fx.severity_score("grav").alias("native"), *[way("grav").alias(name) for name, way in WAYS.items()])
    return t.groupBy("grav").agg(F.count(F.lit(1)).alias("nb"),
                                 *[fx.count_where(F.col("native").eqNullSafe(F.col(name))).alias(f"nb_{name}_egal") for name in WAYS])


@query("upsert_latest")
def q_upsert_latest(spark: SparkSession, d: str) -> DataFrame:
    """Three deliveries merged by incremental upsert into a table partitioned by a text
    code, latest version wins: accidents up to 1998 as version 2, those from 1998 on as
    version 3 with some departments corrected (keys move between partitions), and a late
    older delivery (version 1) of the years 1997 to 1999 that changes nothing it finds."""
    acc = silver(spark, d)["accidents"]
    moved = F.when(F.col("num_acc") % 7 == 0, F.lit("07")).otherwise(F.col("dep"))
    first = acc.where(F.col("an").isNull() | (F.col("an") <= 1998)).withColumn("version", F.lit(2))
    second = acc.where(F.col("an") >= 1998).withColumn("dep", moved).withColumn("version", F.lit(3))
    late = acc.where(F.col("an").between(1997, 1999)).withColumn("dep", F.lit("99")).withColumn("version", F.lit(1))
    path = scratch_path(spark, "upsert")
    sinks.write_partitioned(first, path, ["dep"])
    for delivery in (second, late):
        sinks.upsert_partitions(spark, path, delivery, ["num_acc"], "dep", version="version")
    return spark.read.schema(first.schema).parquet(path).select(*first.columns)


FORMATS = ("csv", "json", "orc", "parquet")


@query("format_roundtrip_agg")
def q_format_roundtrip_agg(spark: SparkSession, d: str) -> DataFrame:
    """Accidents per weather after a round trip through CSV, JSON, ORC and Parquet."""
    acc = silver(spark, d)["accidents"].select("num_acc", "meteo", "dep")
    out = None
    for fmt in FORMATS:
        path = scratch_path(spark, f"fmt-{fmt}")
        w = acc.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            w = w.option("header", True)
        w.save(path)
        r = spark.read.format(fmt).schema(acc.schema)
        if fmt == "csv":   # header names are checked against the schema, not bound by position
            r = r.option("header", True).option("enforceSchema", False)
        part = (r.load(path).groupBy("meteo").agg(F.count(F.lit(1)).alias("nb"))
                .withColumn("format", F.lit(fmt)))
        out = part if out is None else out.unionByName(part)
    return out


@query("profile_numeric")
def q_profile_numeric(spark: SparkSession, d: str) -> DataFrame:
    """count / mean / stddev / min / max of the numeric accident columns."""
    return agg.numeric_profile(silver(spark, d)["accidents"], ["an", "mois", "jour", "heure_int", "meteo"])


# ---- step 8: data-inventory ideas ---------------------------------------------------------

@query("agg_yearly_change")
def q_agg_yearly_change(spark: SparkSession, d: str) -> DataFrame:
    """Accidents per year with the change from the previous year."""
    return agg.yearly_change(silver(spark, d)["accidents"])


@query("agg_revenue_by_hour")
def q_agg_revenue_by_hour(spark: SparkSession, d: str) -> DataFrame:
    """Events per hour of day with total and mean amount."""
    return agg.amount_by_hour(bindings.table(spark, d, "events", ["ts", "value"]))


@query("agg_unit_price")
def q_agg_unit_price(spark: SparkSession, d: str) -> DataFrame:
    """Unit price statistics per part type."""
    li = bindings.table(spark, d, "lineitem", ["l_partkey", "l_extendedprice", "l_quantity"])
    p = bindings.table(spark, d, "part", ["p_partkey", "p_type"])
    return agg.unit_price(li, p, "l_partkey", "p_partkey", "p_type", "l_extendedprice", "l_quantity")


@query("topk_pairs")
def q_topk_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Ten most frequent (supplier nation, customer nation) pairs."""
    pairs = agg.origin_destination_counts(
        bindings.table(spark, d, "lineitem", ["l_orderkey", "l_suppkey"]),
        bindings.table(spark, d, "orders", ["o_orderkey", "o_custkey"]),
        bindings.table(spark, d, "customer", ["c_custkey", "c_nationkey"]),
        bindings.table(spark, d, "supplier", ["s_suppkey", "s_nationkey"]))
    return top_k(pairs, [F.desc("nb"), F.asc("origine"), F.asc("destination")], 10)


@query("detect_outliers_zscore")
def q_detect_outliers_zscore(spark: SparkSession, d: str) -> DataFrame:
    """Events more than two standard deviations from their type's mean."""
    ev = bindings.table(spark, d, "events", ["event_id", "event_type", "value"])
    return agg.zscore_outliers(ev, "event_type", "value", 2.0)


@query("src_multifile_months")
def q_src_multifile_months(spark: SparkSession, d: str) -> DataFrame:
    """Accidents per month read back from one folder per month."""
    acc = silver(spark, d)["accidents"].select("num_acc", "an", "mois")
    path = scratch_path(spark, "monthly")
    sinks.write_partitioned(acc, path, ["an", "mois"])
    files.check_sources(spark, [f"{path}/an=*/mois=*"])
    back = spark.read.option("basePath", path).schema(acc.schema).parquet(f"{path}/an=*/mois=*")
    return back.groupBy("an", "mois").agg(F.count(F.lit(1)).alias("nb_accidents"))


@query("src_csv_gzip")
def q_src_csv_gzip(spark: SparkSession, d: str) -> DataFrame:
    """Accident bronze through gzip text (one task per file, spread after the read)."""
    path = scratch_path(spark, "csv-gzip")
    _write_csv(bindings.dirty_accidents(spark, d), path, compression="gzip")
    return files.read_gzip_csv(spark, path, contracts.ACCIDENTS_TEXT)


@query("json_event_props")
def q_json_event_props(spark: SparkSession, d: str) -> DataFrame:
    """Event JSON properties parsed with a declared schema and aggregated per type."""
    ev = bindings.table(spark, d, "events", ["event_type", "props"])
    j = files.parse_json_column(ev, "props", "k int")
    return j.groupBy("event_type").agg(F.count(F.lit(1)).alias("nb"), F.sum("j.k").cast("bigint").alias("somme_k"),
                                       F.min("j.k").alias("min_k"), F.max("j.k").alias("max_k"))


EVENT_DOC_SCHEMA = ("event_id bigint, meta struct<type: string, ts: timestamp_ntz>, "
                    "measures array<struct<name: string, v: double>>")


@query("src_json_nested")
def q_src_json_nested(spark: SparkSession, d: str) -> DataFrame:
    """Events as nested JSON documents (struct + array of measures), read back
    with a declared schema, measures exploded and summed per (type, name)."""
    ev = bindings.table(spark, d, "events", ["event_id", "ts", "event_type", "value", "props"])
    k = F.from_json("props", "k int").getField("k").cast("double")
    docs = ev.select("event_id", F.struct(F.col("event_type").alias("type"), "ts").alias("meta"),
                     F.array(F.struct(F.lit("value").alias("name"), F.col("value").alias("v")),
                             F.struct(F.lit("k").alias("name"), k.alias("v"))).alias("measures"))
    path = scratch_path(spark, "events-json")
    docs.write.mode("overwrite").json(path)
    back = files.read_json_lines(spark, path, EVENT_DOC_SCHEMA)
    m = back.select(F.col("meta.type").alias("event_type"), F.explode("measures").alias("m"))
    return (m.groupBy("event_type", F.col("m.name").alias("measure"))
            .agg(F.count(F.lit(1)).alias("nb"), F.round(F.sum("m.v"), 6).alias("total")))


@query("stream_windowed_counts")
def q_stream_windowed_counts(spark: SparkSession, d: str) -> DataFrame:
    """Events and amount per hour window and type from a file stream."""
    from strata.streaming import windowed
    out = scratch_path(spark, "stream-out")
    ckpt = scratch_path(spark, "stream-ckpt")
    # a glob (no basePath): matches the table whether it is one file or a folder
    windowed.run_windowed_counts(spark, f"{d.rstrip('/')}/events.parquet*", out, ckpt)
    return windowed.read_windowed_counts(spark, out)


@query("als_pair_scores")
def q_als_pair_scores(spark: SparkSession, d: str) -> DataFrame:
    """Per supplier: rated parts and those that an ALS model on quantities gives a score."""
    from strata.operators.recommend import als_scores, scored_pairs_per_user
    return scored_pairs_per_user(als_scores(bindings.ratings(spark, d), "user_id", "item_id", "rating"), "user_id")


@query("src_csv_multifile")
def q_src_csv_multifile(spark: SparkSession, d: str) -> DataFrame:
    """Text bronze in one folder of files whose columns differ in order (and one without
    the weather column), each bound by its own header."""
    path = scratch_path(spark, "csv-multi")
    text = bindings.dirty_accidents(spark, d)
    layouts = [("_part = 0", text.columns), ("_part = 1", list(reversed(text.columns))),
               ("_part = 2", [c for c in text.columns if c != "atm"])]
    dealt = text.withColumn("_part", F.pmod(F.xxhash64("num_acc", "jour"), F.lit(3)))
    for n, (part, columns) in enumerate(layouts):
        dealt.where(part).select(*columns).write.mode("append" if n else "overwrite").options(**_CSV_WRITE).csv(path)
    return files.read_csv_contract(spark, path, contracts.ACCIDENTS_TEXT).groupBy("an", "dep").agg(
        F.count(F.lit(1)).alias("nb"), F.sum("num_acc").alias("somme_cles"), F.count("hrmn").alias("nb_heures"))


@query("src_grown_months")
def q_src_grown_months(spark: SparkSession, d: str) -> DataFrame:
    """Yearly deliveries whose schema grew (the time from 1998 on, the weather from 2000 on),
    read with the wide schema: what a file does not have is NULL."""
    acc = silver(spark, d)["accidents"].select("num_acc", "an", "dep", "hrmn", "meteo")
    path = scratch_path(spark, "grown")
    acc.where("an < 1998 or an is null").drop("hrmn", "meteo").write.parquet(f"{path}/a")
    acc.where("an between 1998 and 1999").drop("meteo").write.parquet(f"{path}/b")
    acc.where("an >= 2000").write.parquet(f"{path}/c")
    back = files.read_grown_parquet(spark, [f"{path}/a", f"{path}/b", f"{path}/c"], acc.schema)
    return back.groupBy("an").agg(F.count(F.lit(1)).alias("nb"), F.count("hrmn").alias("nb_heures"), F.count("meteo").alias("nb_meteo"))


@query("missing_sources_rows")
def q_missing_sources_rows(spark: SparkSession, d: str) -> DataFrame:
    """Which sources are there: tables, a folder without files and a path that is not there."""
    empty = scratch_path(spark, "empty")
    spark.range(0).write.csv(empty)   # a folder with a success mark only
    found = {"orders": f"{d.rstrip('/')}/orders.parquet", "lineitem": f"{d.rstrip('/')}/lineitem.parquet",
             "empty": f"{empty}/*.csv", "absent": f"{d.rstrip('/')}/no_such_table.parquet"}
    missing = files.missing_paths(spark, list(found.values()))
    rows = spark.createDataFrame([(n, p in missing) for n, p in found.items()], "source string, absent boolean")
    counts = bindings.table(spark, d, "orders", ["o_orderkey"]).agg(F.count(F.lit(1)).alias("nb")).select(F.lit("orders").alias("source"), "nb")
    return rows.join(counts, "source", "left")


@query("write_status_rows")
def q_write_status_rows(spark: SparkSession, d: str) -> DataFrame:
    """Status of each table of a write in which one fails: the others are written."""
    s = silver(spark, d)
    path = scratch_path(spark, "status")
    tables = {"accidents": s["accidents"], "places": s["places"], "severity": s["severity"]}
    status = sinks.write_each(tables, path, partitions={"accidents": ["dep"], "places": ["no_such_column"]})
    rows = spark.createDataFrame([(n, state.split(":")[0]) for n, _, state in status], "table_name string, status string")
    written = None
    for name, folder, state in status:
        if state == "ok":
            part = spark.read.schema(tables[name].schema).parquet(folder).agg(F.count(F.lit(1)).alias("nb_lignes")).withColumn("table_name", F.lit(name))
            written = part if written is None else written.unionByName(part)
    return rows.join(written, "table_name", "left")


@query("cache_arms_equal")
def q_cache_arms_equal(spark: SparkSession, d: str) -> DataFrame:
    """The same aggregate with and without a cache: rows that differ between the arms (none)."""
    acc = silver(spark, d)["accidents"]
    checkpoint_root(spark)

    def reuse(df):
        return df.groupBy("meteo").agg(F.count(F.lit(1)).alias("nb"))

    with measure.cached(acc.select("num_acc", "meteo")) as c:
        warm = reuse(c).checkpoint(eager=True)
    return _arms({"cache": warm, "no_cache": reuse(acc)})


@query("aqe_arms_equal")
def q_aqe_arms_equal(spark: SparkSession, d: str) -> DataFrame:
    """Departments by serious rate with AQE on and off and other partition counts: equal rows."""
    from strata.sources.sinks import write_parquet
    arms = {}
    for aqe, n in (("true", 8), ("false", 8), ("false", 37)):
        path = scratch_path(spark, "aqe")
        with measure.settings(spark, {"spark.sql.adaptive.enabled": aqe, "spark.sql.shuffle.partitions": str(n)}):
            write_parquet(layers.top_departments(sets(spark, d)).select("dep", "total_accidents", "accidents_graves"), path, files=1)
        arms[f"aqe={aqe},partitions={n}"] = spark.read.parquet(path)
    return _arms(arms)


def _arms(arms: dict[str, DataFrame]) -> DataFrame:
    """Per arm: its rows, and how many rows it has that the first arm lacks, or lacks that the first arm has."""
    first = next(iter(arms.values()))
    out = None
    for name, df in arms.items():
        apart = df.exceptAll(first).union(first.exceptAll(df))
        part = (df.agg(F.count(F.lit(1)).alias("nb_lignes"))
                .crossJoin(apart.agg(F.count(F.lit(1)).alias("nb_differences")))   # one row each
                .withColumn("arm", F.lit(name)))
        out = part if out is None else out.unionByName(part)
    return out


@query("gold_departements")
def q_gold_departements(spark: SparkSession, d: str) -> DataFrame:
    """Gold departments built from silver tables that were written and read back."""
    s = sets(spark, d)
    path = scratch_path(spark, "silver")
    tables = {n: s[n] for n in ("accidents", "places")}
    sinks.write_all(tables, path, partitions={"accidents": ["dep"]})
    back = {n: spark.read.schema(df.schema).parquet(f"{path}/{n}") for n, df in tables.items()}
    return agg.departments_with_places(back["accidents"], back["places"])


@query("pipeline_files_gold")
def q_pipeline_files_gold(spark: SparkSession, d: str) -> DataFrame:
    """The whole file pipeline over the driver tables rendered as the four source files."""
    from strata.plans import accident_files
    paths = _render_files(spark, d)
    out = scratch_path(spark, "pipeline")
    accident_files.run_pipeline(spark, paths, out)
    return spark.read.parquet(f"{out}/gold/top_departements_graves")


def _render_files(spark: SparkSession, d: str) -> dict[str, str]:
    """The accident roles as the four semicolon files, years moved into the files' range."""
    acc = bindings.accidents(spark, d).select(
        F.col("num_acc").alias("Num_Acc"), "jour", "mois", (F.col("an") + 20).alias("an"), "hrmn", F.lit(1).alias("lum"), "dep", "atm")
    rows = bindings.lines(spark, d)
    veh = bindings.vehicle_columns(rows, bindings.parts(spark, d)).select(F.col("num_acc").alias("Num_Acc"), "num_veh", "cat_veh", "l_suppkey")
    per = bindings.person_columns(rows).select(F.col("num_acc").alias("Num_Acc"), "num_veh", "catu", "sexe", "grav", F.col("l_partkey").alias("id_usager"), "l_suppkey", "l_extendedprice")
    pla = bindings.place_columns(rows).select(F.col("num_acc").alias("Num_Acc"), F.when(F.col("surf") == "F", 1).otherwise(2).alias("surf"), F.col("l_suppkey").alias("voie"))
    out = {}
    for name, df in (("caracteristiques", acc), ("lieux", pla), ("vehicules", veh), ("usagers", per)):
        out[name] = scratch_path(spark, f"source-{name}")
        _write_csv(df, out[name])
    return out


# ---- the older layout: severity coded on the accident, department on the place ------------


@query("older_weather_surface")
def q_older_weather_surface(spark: SparkSession, d: str) -> DataFrame:
    """Older layout: distinct accidents and serious ones per (weather, surface)."""
    from strata.plans import older_layout
    return older_layout.weather_surface(older_layout.silver_from_driver(spark, d))


@query("older_department_hour")
def q_older_department_hour(spark: SparkSession, d: str) -> DataFrame:
    """Older layout: distinct accidents per (department of the place, hour)."""
    from strata.plans import older_layout
    return older_layout.department_hour(older_layout.silver_from_driver(spark, d))


@query("older_top_departments")
def q_older_top_departments(spark: SparkSession, d: str) -> DataFrame:
    """Older layout: top 20 departments by serious rate."""
    from strata.plans import older_layout
    return older_layout.top_departments(older_layout.silver_from_driver(spark, d))


# ---- further analyses ---------------------------------------------------------------------


@query("agg_tax_by_nation")
def q_agg_tax_by_nation(spark: SparkSession, d: str) -> DataFrame:
    """Mean extra charge (tax share of the price) per supplier nation: the tip by zone."""
    li = bindings.table(spark, d, "lineitem", ["l_suppkey", "l_extendedprice", "l_tax"])
    s = bindings.table(spark, d, "supplier", ["s_suppkey", "s_nationkey"])
    rows = li.join(s, li.l_suppkey == s.s_suppkey).select("s_nationkey", (F.col("l_extendedprice") * F.col("l_tax")).alias("_t"))
    return agg.mean_by(rows, "s_nationkey", "_t", "supplement_moyen")


@query("agg_duration_by_weekday")
def q_agg_duration_by_weekday(spark: SparkSession, d: str) -> DataFrame:
    """Mean days from order to shipment per weekday of the order."""
    o = bindings.table(spark, d, "orders", ["o_orderkey", "o_orderdate"])
    li = bindings.table(spark, d, "lineitem", ["l_orderkey", "l_shipdate"])
    return agg.mean_duration_by_weekday(o.join(li, o.o_orderkey == li.l_orderkey), "o_orderdate", "l_shipdate")


@query("agg_ratings_per_user")
def q_agg_ratings_per_user(spark: SparkSession, d: str) -> DataFrame:
    """Number, mean, lowest and highest rating of each user."""
    return agg.ratings_per_user(bindings.ratings(spark, d), "user_id", "rating")


@query("agg_popularity_by_category")
def q_agg_popularity_by_category(spark: SparkSession, d: str) -> DataFrame:
    """Ratings, rated parts and mean rating per part type."""
    return agg.popularity_by_category(bindings.ratings(spark, d), bindings.parts(spark, d), "item_id", "p_partkey", "p_type", "rating")


@query("agg_price_over_time")
def q_agg_price_over_time(spark: SparkSession, d: str) -> DataFrame:
    """Mean unit price per supplier nation and month of shipment."""
    li = bindings.table(spark, d, "lineitem", ["l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"])
    s = bindings.table(spark, d, "supplier", ["s_suppkey", "s_nationkey"])
    rows = li.join(s, li.l_suppkey == s.s_suppkey)
    return agg.unit_price_over_time(rows, "s_nationkey", "l_shipdate", "l_extendedprice", "l_quantity")


@query("clean_outlier_reasons")
def q_clean_outlier_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Orders and balances per first failing value rule: negative amounts, impossible dates."""
    o = bindings.table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    c = bindings.table(spark, d, "customer", ["c_custkey", "c_acctbal"])
    # the day of the month moved by the key's last digit: some dates do not exist
    rows = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("num_acc"), "c_acctbal", F.year("o_orderdate").alias("an"), F.month("o_orderdate").alias("mois"),
        (F.dayofmonth("o_orderdate") + (F.col("o_orderkey") % 10).cast("int")).alias("jour"))
    rules = cl.CleanRules(key="num_acc", nonnegative=("c_acctbal",), dates=(("an", "mois", "jour"),))
    return agg.count_by_category(cl.with_reject_reason(rows, rules), "reject_reason", "nb")


# ---- hot keys, exact quantiles, state, recommendations -------------------------------------


@query("agg_unit_price_quantiles")
def q_agg_unit_price_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Exact median, first and ninth decile of the unit price per supplier nation."""
    li = bindings.table(spark, d, "lineitem", ["l_suppkey", "l_extendedprice", "l_quantity"])
    s = bindings.table(spark, d, "supplier", ["s_suppkey", "s_nationkey"])
    rows = li.join(s, li.l_suppkey == s.s_suppkey).select("s_nationkey", fx.safe_ratio("l_extendedprice", "l_quantity").alias("_up"))
    return exact_quantiles(rows, "s_nationkey", "_up", {"decile_1": 0.1, "mediane": 0.5, "decile_9": 0.9})


@query("join_hot_key")
def q_join_hot_key(spark: SparkSession, d: str) -> DataFrame:
    """Events against their type's mean (few types, each a hot key) by the salted join: per type, events and those
    above the mean."""
    ev = bindings.table(spark, d, "events", ["event_id", "event_type", "value"])
    per_type = ev.groupBy("event_type").agg(F.avg("value").alias("moyenne"))
    met = skew.skew_join(ev, per_type, "event_type")
    return met.groupBy("event_type").agg(F.count(F.lit(1)).alias("nb"), fx.count_where(F.col("value") > F.col("moyenne")).alias("nb_au_dessus"))


@query("heavy_hitter_keys")
def q_heavy_hitter_keys(spark: SparkSession, d: str) -> DataFrame:
    """Part types that hold more than 1 % of the lines."""
    li = bindings.table(spark, d, "lineitem", ["l_partkey"])
    p = bindings.parts(spark, d)
    return skew.heavy_hitters(li.join(p, li.l_partkey == p.p_partkey), "p_type", 0.01)


def _arrivals(spark: SparkSession, d: str) -> str:
    """The events as files that arrive one after the other, shuffled by the event's number."""
    path = scratch_path(spark, "arrivals")
    ev = bindings.table(spark, d, "events")
    for k in range(4):
        ev.where(F.pmod(F.coalesce("event_id", F.lit(0)), F.lit(4)) == k).coalesce(1).write.mode("append").parquet(path)
    return path


@query("stream_stateful_counts")
def q_stream_stateful_counts(spark: SparkSession, d: str) -> DataFrame:
    """Events and amount per day window and type over four triggers, open windows in the state store; the delay is longer
    than the data, so nothing is late."""
    from strata.streaming import stateful
    out = scratch_path(spark, "state-out")
    stateful.run_stateful_counts(spark, _arrivals(spark, d), out, scratch_path(spark, "state-ckpt"), "1 day", "100000 days", 1, 8)
    return stateful.read_stateful_counts(spark, out)


@query("stream_late_rows")
def q_stream_late_rows(spark: SparkSession, d: str) -> DataFrame:
    """Per day window and type: events counted in state and events that came after their window was closed (by a
    watermark two days behind the latest event)."""
    from strata.streaming import stateful
    source, counts, late = _arrivals(spark, d), scratch_path(spark, "state-out"), scratch_path(spark, "late-out")
    stateful.run_stateful_counts(spark, source, counts, scratch_path(spark, "state-ckpt"), "1 day", "2 days", 1, 8)
    stateful.run_late_rows(spark, source, late, scratch_path(spark, "late-ckpt"), "1 day", "2 days", 1)
    return stateful.counted_and_late(spark, counts, late)


@query("als_recommend")
def q_als_recommend(spark: SparkSession, d: str) -> DataFrame:
    """The ten best unrated parts per supplier, from an ALS model and a candidate index over its part factors."""
    pairs, users, items = recommend.als_model(bindings.ratings(spark, d), "user_id", "item_id", "rating")
    return recommend.recommend(users, items, pairs, "user_id", "item_id")


@query("als_rated_scores")
def q_als_rated_scores(spark: SparkSession, d: str) -> DataFrame:
    """Rating and model score of every rated (supplier, part) pair."""
    return recommend.als_scores(bindings.ratings(spark, d), "user_id", "item_id", "rating")


@query("write_observed_counts")
def q_write_observed_counts(spark: SparkSession, d: str) -> DataFrame:
    """Raw, kept and rejected accidents per reason, counted in the pass that writes the kept ones."""
    rows = cl.with_reject_reason(bindings.dirty_accidents(spark, d), layers.TEXT_ACCIDENT_RULES)
    reason = F.col("reject_reason")
    tests = {r: reason == r for r in ("key_missing", "key_blank", "out_of_range_an")}
    path = scratch_path(spark, "observed")
    counts = sinks.write_kept(rows, path, reason.isNull(), tests)
    back = spark.read.schema(rows.schema).parquet(path).agg(F.count(F.lit(1)).alias("nb")).select(F.lit("written").alias("mesure"), "nb")
    return spark.createDataFrame(sorted(counts.items()), "mesure string, nb long").union(back)


@query("gold_incremental")
def q_gold_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Departments kept up to date from three deliveries: accidents up to 1996, those from 1996 on with some departments
    corrected, and every fifth accident with its score taken back."""
    from strata.plans import incremental
    s = silver(spark, d)
    rows = s["accidents"].select("num_acc", "dep", "an").join(s["severity"], "num_acc").select(
        "num_acc", "dep", "an", F.col("gravite_max").alias("score"), F.col("accident_grave").alias("grave"))
    corrected = rows.withColumn("dep", F.when(F.col("num_acc") % 7 == 0, F.lit("07")).otherwise(F.col("dep")))
    base, bucket = scratch_path(spark, "incremental"), F.col("num_acc") / 5000
    for number, delivery in enumerate((rows.where("an is null or an <= 1996"), corrected.where("an >= 1996"),
                                       corrected.where("num_acc % 5 = 0").withColumns({"score": F.lit(1), "grave": F.lit(0)}))):
        incremental.deliver(spark, base, number, delivery, bucket)
    return incremental.gold(spark, base)


@query("replace_partitions_switch")
def q_replace_partitions_switch(spark: SparkSession, d: str) -> DataFrame:
    """Accidents per department after a second delivery replaced whole departments by a switch of folders."""
    from strata.sources import versions
    acc = silver(spark, d)["accidents"].select("num_acc", "an", "dep")
    path = scratch_path(spark, "versions")
    table = "versions_" + path.rsplit("-", 1)[1]
    versions.create(spark, table, path, acc, "dep")
    versions.replace_partitions(spark, table, path, acc, "dep")
    versions.replace_partitions(spark, table, path, acc.where("dep < '05' and an >= 1995"), "dep")
    return spark.table(table).groupBy("dep").agg(F.count(F.lit(1)).alias("nb"), F.min("an").alias("premier_an"))


@query("pushdown_clustered")
def q_pushdown_clustered(spark: SparkSession, d: str) -> DataFrame:
    """A department's year and single accidents read from a layout by range with Bloom filters on the key."""
    from strata.sources import versions
    acc = silver(spark, d)["accidents"].select("num_acc", "dep", "an", "meteo")
    path = scratch_path(spark, "clustered")
    versions.write_clustered(acc, path, ["dep", "an"], bloom=["num_acc"])
    back = spark.read.schema(acc.schema).parquet(path)
    some = back.where("dep = '07' and an = 1996").groupBy("dep").agg(F.count(F.lit(1)).alias("nb"), F.sum("num_acc").alias("somme_cles"))
    one = back.where("num_acc in (1, 7, 33)").groupBy("dep").agg(F.count(F.lit(1)).alias("nb"), F.sum("num_acc").alias("somme_cles"))
    return some.withColumn("filtre", F.lit("rang")).unionByName(one.withColumn("filtre", F.lit("cle")))


@query("stream_static_join")
def q_stream_static_join(spark: SparkSession, d: str) -> DataFrame:
    """Events of a stream against a table of their users' mean amount, read anew in each trigger: per type, events and
    those above their user's mean."""
    from strata.streaming import enrich
    ev = bindings.table(spark, d, "events", ["user_id", "value"])
    static, out = scratch_path(spark, "static"), scratch_path(spark, "enriched")
    ev.where("user_id is not null").groupBy("user_id").agg(F.avg("value").alias("moyenne")).write.parquet(static)
    schema = "user_id long, moyenne double"
    enrich.run_enriched(spark, _arrivals(spark, d), static, schema, "user_id", out, scratch_path(spark, "enriched-ckpt"), 1)
    return enrich.read_enriched(spark, out, schema, "user_id").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("nb"), fx.count_where(F.col("value") > F.col("moyenne")).alias("nb_au_dessus"))


def main(argv: list[str] | None = None) -> None:
    """Run catalogue queries by name: write each to Parquet, or print n rows."""
    import argparse

    from strata.session import get_session
    ap = argparse.ArgumentParser(description="run catalogue queries over a folder of driver tables")
    ap.add_argument("names", nargs="*", help="query names (default: list them)")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=None, help="write each result to OUT/<name> as Parquet")
    ap.add_argument("--show", type=int, default=20, help="rows to print when not writing")
    ap.add_argument("--master", default=None)
    ap.add_argument("--profile", default=None, help="profile a Parquet path: schema, rows, preview")
    a = ap.parse_args(argv)
    if a.profile:
        spark = get_session("strata-profile", master=a.master, cluster=a.master is None)
        df = spark.read.parquet(a.profile)
        agg.schema_profile(df).show(len(df.columns), truncate=False)
        print("rows:", df.count())
        df.show(min(a.show, 5), truncate=False)
        spark.stop()
        return
    if not a.names:
        print("\n".join(sorted(QUERIES)))
        return
    unknown = [n for n in a.names if n not in QUERIES]
    if unknown:
        raise SystemExit(f"unknown query name(s): {', '.join(unknown)}")
    spark = get_session("strata-query", master=a.master, cluster=a.master is None)
    for n in a.names:
        df = QUERIES[n](spark, a.sf_dir)
        if a.out:
            sinks.write_parquet(df, f"{a.out.rstrip('/')}/{n}")
            print(f"{n}: written to {a.out.rstrip('/')}/{n}")
        else:
            print(f"== {n}")
            df.show(a.show, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
