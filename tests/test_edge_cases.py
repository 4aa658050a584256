"""Operators on empty and degenerate inputs."""

from pyspark.sql import functions as F

from strata.operators import aggregate as agg
from strata.operators import clean as cl
from strata.operators.ranking import rank_global
from strata.plans import layers


def empty_accidents(spark):
    return spark.createDataFrame([], "num_acc string, an string, mois string, jour string, hrmn string, "
                                     "dep string, atm string")


def test_clean_report_on_empty_table_is_zeros(spark):
    r = cl.clean_report(empty_accidents(spark), layers.TEXT_ACCIDENT_RULES, "accidents").first()
    assert (r["raw_rows"], r["duplicate_rows"], r["rejected_key"], r["rejected_range"], r["kept_rows"]) == (0, 0, 0, 0, 0)


def test_empty_silver_gives_empty_gold(spark):
    acc = layers.silver_accidents_from_text(empty_accidents(spark))
    persons = spark.createDataFrame([], "num_acc bigint, num_veh int, catu int, sexe int, grav int")
    sev = agg.severity_per_accident(persons)
    assert agg.severity_by_weather(acc, sev).count() == 0
    assert layers.top_departments({"accidents": acc, "severity": sev}).count() == 0
    places = spark.createDataFrame([], "num_acc bigint, etat_route string")
    assert agg.skew_profile(acc, places).count() == 0       # no group: no ratio row, no error


def test_rank_with_fewer_rows_than_k(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 1.0)], "dep string, taux double")
    rows = rank_global(df, [F.desc_nulls_last("taux"), F.asc("dep")], 20, "rang").orderBy("rang").collect()
    assert [(r["dep"], r["rang"]) for r in rows] == [("a", 1), ("c", 2), ("b", 3)]   # NULL rate last


def test_all_unknown_codes_accident_counts_but_is_not_serious(spark):
    persons = spark.createDataFrame([(1, 1, 1, 1, -1), (1, 2, 1, 1, -1)],
                                    "num_acc bigint, num_veh int, catu int, sexe int, grav int")
    r = agg.severity_per_accident(persons).first()
    assert (r["gravite_max"], r["nb_usagers"], r["accident_grave"]) == (None, 2, None)
