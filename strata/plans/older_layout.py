"""The older layout of the accident files: severity is a code on the accident, time is
``heure``, the department is on the place.

Its serious accidents are those of severity 2 or more. The three gold tables mirror those
of the current layout; a place only adds the department, so accidents are reduced to one
row per key and department before they are counted.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import contracts
from strata.functions.expressions import count_where, hour_from_hrmn, safe_int, safe_ratio
from strata.operators.clean import CleanRules, clean
from strata.operators.ranking import rank_global
from strata.plans import bindings
from strata.plans.accident_files import YEAR_RANGE
from strata.sources import files

SERIOUS = 2  # fixed value: the least severity code of a serious accident
TOP = 20     # fixed value: ranked departments

ACCIDENT_RULES = CleanRules(key="num_acc", ranges={"an": YEAR_RANGE}, unique_key=True)
RULES = {"caracteristiques": ACCIDENT_RULES, "lieux": CleanRules(key="num_acc", required=("dep",), trim=("dep",)),
         "vehicules": CleanRules(key="num_acc"), "usagers": CleanRules(key="num_acc")}


def ingest(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The four files as text, bound by header; every missing file is named."""
    files.check_sources(spark, list(paths.values()))
    return {n: files.read_csv_text_contract(spark, p, contracts.OLDER_CONTRACTS[n]).withColumnRenamed("Num_Acc", "num_acc")
            for n, p in paths.items()}


def silver(raw: Mapping[str, DataFrame], accident_rules: CleanRules = ACCIDENT_RULES) -> dict[str, DataFrame]:
    """Cleaned tables with all their columns; accidents get the hour, the severity as a number and
    the analysis names of weather and surface."""
    acc = (clean(raw["caracteristiques"], accident_rules)
           .withColumns({"an": safe_int("an"), "heure_int": hour_from_hrmn("heure"), "gravite": safe_int("descr_grav"),
                         "meteo": F.col("atm"), "etat_route": F.col("surf")}))
    return {"accidents": acc, **{n: clean(raw[n], RULES[n]) for n in raw if n != "caracteristiques"}}


def weather_surface(tables: Mapping[str, DataFrame]) -> DataFrame:
    return (tables["accidents"].groupBy("meteo", "etat_route")
            .agg(F.count_distinct("num_acc").alias("nb_accidents"), count_where(F.col("gravite") >= SERIOUS).alias("nb_graves"))
            .orderBy(F.desc("nb_accidents"), F.asc_nulls_last("meteo"), F.asc_nulls_last("etat_route")))


def _with_department(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per accident and department of its places."""
    places = tables["lieux"].select("num_acc", "dep").distinct()
    return tables["accidents"].select("num_acc", "heure_int", "gravite").join(places, "num_acc")


def department_hour(tables: Mapping[str, DataFrame]) -> DataFrame:
    return (_with_department(tables).groupBy("dep", "heure_int").agg(F.count_distinct("num_acc").alias("nb_accidents"))
            .orderBy(F.desc("nb_accidents"), F.asc("dep"), F.asc_nulls_last("heure_int")))


def top_departments(tables: Mapping[str, DataFrame], k: int = TOP) -> DataFrame:
    stats = (_with_department(tables).groupBy("dep")
             .agg(F.count_distinct("num_acc").alias("total_accidents"), count_where(F.col("gravite") >= SERIOUS).alias("accidents_graves"))
             .withColumn("taux_graves", safe_ratio("accidents_graves", "total_accidents")))
    return rank_global(stats, [F.desc_nulls_last("taux_graves"), F.asc("dep")], k, "rang_dep")


def gold(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {"gravite_par_meteo": weather_surface(tables), "accidents_par_dep_heure": department_hour(tables),
            "top_departements_gravite": top_departments(tables)}


# a task holds the rows of about so many bytes of the source: the sort and the distinct keys of a task do
# not grow with the source, whatever the session's partitions are
TASK_BYTES = 8 * 1024 * 1024


def _by_key(rows: DataFrame, source_bytes: int) -> DataFrame:
    """Rows dealt by the accident key; what follows per key needs no further exchange."""
    n = max(rows.sparkSession.sparkContext.defaultParallelism, -(-source_bytes // TASK_BYTES))
    return rows.repartition(n, "num_acc")


def silver_from_driver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The older roles on the driver tables: the severity code is the order's priority digit modulo 4,
    the surface its status, the places' department the supplier's nation."""
    o = bindings.table(spark, sf_dir, "orders")
    e = bindings.table(spark, sf_dir, "events", ["event_id", "ts"])
    s = bindings.table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    li = bindings.lines(spark, sf_dir)
    digit = F.substring("o_orderpriority", 1, 1)
    acc = o.dropDuplicates().join(e, o.o_orderkey == e.event_id, "left").select(
        F.col("o_orderkey").cast("string").alias("num_acc"), (F.year("o_orderdate") + 20).cast("string").alias("an"),
        F.date_format("ts", "HH:mm").alias("heure"), digit.alias("atm"), F.col("o_orderstatus").alias("surf"),
        (digit.try_cast("int") % 4).cast("string").alias("descr_grav"))
    places = li.join(s, li.l_suppkey == s.s_suppkey).select(
        F.col("l_orderkey").cast("string").alias("num_acc"),
        F.concat(F.lit(" "), F.lpad(F.col("s_nationkey").cast("string"), 2, "0")).alias("dep"), "l_linenumber")
    # one count for both sides: their join meets equal parts
    size = sum(files.file_bytes(spark, f"{sf_dir.rstrip('/')}/{name}.parquet") for name in ("orders", "lineitem"))
    return silver({"caracteristiques": _by_key(acc, size), "lieux": _by_key(places, size)})
