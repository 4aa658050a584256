"""Silver and gold builders over the accident roles (pure DataFrame builders).

``clean_tables`` and ``gold_tables`` never run an action; the file pipeline
(``accident_files.run_pipeline``) writes the layers. ``silver_from_driver``
binds the roles onto the driver's tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import contracts
from strata.contracts import apply_contract
from strata.functions.expressions import hour_from_hrmn
from strata.operators import aggregate as agg
from strata.operators.clean import CleanRules, clean, clean_report, dedup_full_row
from strata.operators.ranking import rank_global
from strata.plans import bindings

TOP_K_DEPARTMENTS = 20  # fixed value: the source ranks the top 20 departments

ACCIDENT_RULES = CleanRules(key="num_acc", trim=("dep",), unique_key=True)
# The all-text bronze: the key is tested as text (NULL, blank), the year for plausibility.
TEXT_ACCIDENT_RULES = CleanRules(key="num_acc", ranges={"an": bindings.PLAUSIBLE_YEARS}, trim=("dep",), unique_key=True)
PLACE_RULES = CleanRules(key="num_acc")
VEHICLE_RULES = CleanRules(key="num_acc")
PERSON_RULES = CleanRules(key="num_acc", required=("grav",))

RULES = {"accidents": ACCIDENT_RULES, "places": PLACE_RULES,
         "vehicles": VEHICLE_RULES, "persons": PERSON_RULES}


def silver_accidents(raw: DataFrame, rules: CleanRules = ACCIDENT_RULES, distinct: bool = False) -> DataFrame:
    return (clean(raw, rules, distinct=distinct)
            .withColumn("heure_int", hour_from_hrmn("hrmn"))
            .withColumn("meteo", F.col("atm")))


def silver_accidents_from_text(text: DataFrame, rules: CleanRules = TEXT_ACCIDENT_RULES) -> DataFrame:
    """Text bronze -> typed silver: rules on the raw cells, then the contract's
    try_cast typing, then derived columns."""
    typed = apply_contract(clean(text, rules), contracts.ACCIDENTS_TEXT)
    return typed.withColumn("heure_int", hour_from_hrmn("hrmn")).withColumn("meteo", F.col("atm"))


def silver_places(raw: DataFrame, distinct: bool = False) -> DataFrame:
    return clean(raw, PLACE_RULES, distinct=distinct).withColumn("etat_route", F.col("surf"))


def silver_vehicles(raw: DataFrame, distinct: bool = False) -> DataFrame:
    return clean(raw, VEHICLE_RULES, distinct=distinct)


def silver_persons(raw: DataFrame, distinct: bool = False) -> DataFrame:
    return clean(raw, PERSON_RULES, distinct=distinct)


def clean_tables(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    persons = silver_persons(raw["persons"])
    return {
        "accidents": silver_accidents(raw["accidents"]),
        "places": silver_places(raw["places"]),
        "vehicles": silver_vehicles(raw["vehicles"]),
        "persons": persons,
        "severity": agg.severity_per_accident(persons),
    }


def driver_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaning report of the text accidents and the three n-sides over the
    driver tables; duplicates are counted on whole source rows."""
    rows = bindings.lines(spark, sf_dir)
    parts = [clean_report(bindings.dirty_accidents(spark, sf_dir), TEXT_ACCIDENT_RULES, "accidents"),
             clean_report(rows, PLACE_RULES, "places", columns=bindings.place_columns),
             clean_report(rows, VEHICLE_RULES, "vehicles", columns=lambda r: bindings.vehicle_columns(r, bindings.parts(spark, sf_dir))),
             clean_report(rows, PERSON_RULES, "persons", columns=bindings.person_columns)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cleaning_report(raw: dict[str, DataFrame], rules: dict[str, CleanRules] = RULES) -> DataFrame:
    parts = [clean_report(raw[name], rules[name], name) for name in raw]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def top_departments(silver: dict[str, DataFrame], k: int = TOP_K_DEPARTMENTS) -> DataFrame:
    stats = agg.department_serious_rate(silver["accidents"], silver["severity"])
    return rank_global(stats, [F.desc_nulls_last("taux_graves"), F.asc("dep")], k, "rang_dep")


def gold_tables(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "meteo": agg.severity_by_weather(silver["accidents"], silver["severity"]),
        "departements": agg.departments_with_places(silver["accidents"], silver["places"]),
        "top_departements_graves": top_departments(silver),
    }


class LazyTables(Mapping):
    """DataFrames built on first access, so a query only plans the tables it
    uses (this saves the driver-side analysis of unused tables)."""

    def __init__(self, factories: dict[str, Callable[[], DataFrame]]):
        self._factories = factories
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._factories[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._factories)

    def __len__(self) -> int:
        return len(self._factories)


def silver_from_driver(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """Silver roles over the driver tables, built lazily.

    The three n-sides share one scan and one exchange by the accident key (equal
    plans, so Spark reuses the exchange): whole rows become distinct there, and the
    per-key work of each role follows without a further exchange."""
    # the accident key has many values: a third of the lines never share one
    rows = dedup_full_row(bindings.lines(spark, sf_dir), "l_orderkey")
    tables = LazyTables({
        # one row per key is kept, so copies need no dedup of their own
        "accidents": lambda: silver_accidents(bindings.accidents(spark, sf_dir), distinct=True),
        "places": lambda: silver_places(bindings.place_columns(rows), True).select(*bindings.PLACE, "etat_route"),
        "vehicles": lambda: silver_vehicles(bindings.vehicle_columns(rows, bindings.parts(spark, sf_dir)), True).select(*bindings.VEHICLE),
        "persons": lambda: silver_persons(bindings.person_columns(rows), True).select(*bindings.PERSON),
        # severity is built on the same persons frame as tables["persons"]
        "severity": lambda: agg.severity_per_accident(tables["persons"]),
    })
    return tables


def sets_from_driver(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """The silver roles for analyses that copies can't change (a maximum, distinct
    keys): built on the needed columns of all lines, without the dedup of whole rows.

    ``accidents`` is the silver table; ``severity`` has the serious flag of each
    accident, ``places`` distinct (key, surface), ``vehicles`` distinct (key, category)."""
    lines = bindings.lines(spark, sf_dir)
    persons = silver_persons(bindings.person_columns(lines), True)
    return LazyTables({
        "accidents": lambda: silver_from_driver(spark, sf_dir)["accidents"],
        "severity": lambda: agg.serious_flag(persons),
        "places": lambda: silver_places(bindings.place_columns(lines), True).select("num_acc", "etat_route").distinct(),
        "vehicles": lambda: silver_vehicles(bindings.vehicle_columns(lines, bindings.parts(spark, sf_dir)), True).select("num_acc", "cat_veh").distinct(),
    })
