"""Table contracts: declared columns, target types, required flags.

Delimited text is read as all-string and bound to the contract **by header
name** (never by position); each column is then typed with ``try_cast`` so an
unreadable cell becomes NULL instead of failing the job. A missing column is
an error that names every missing column at once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}


@dataclass(frozen=True)
class Column:
    name: str
    type: str = "string"
    required: bool = False
    decimal_comma: bool = False


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[Column, ...]

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, _TYPES[c.type], not c.required) for c in self.columns])


class ContractError(ValueError):
    pass


def check_columns(df: DataFrame, contract: Contract) -> None:
    missing = [c for c in contract.names if c not in df.columns]
    if missing:
        raise ContractError(f"table {contract.name}: missing column(s) {', '.join(missing)}")


def typed_column(col: Column):
    c = F.col(col.name)
    if col.type == "string":
        return c.alias(col.name)
    text = F.trim(c.cast("string"))
    if col.decimal_comma:
        text = F.regexp_replace(text, ",", ".")
    return text.try_cast(col.type).alias(col.name)


def apply_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Select the contract's columns by name, typed with try_cast."""
    check_columns(df, contract)
    return df.select(*[typed_column(c) for c in contract.columns])


def bad_cell_counts(df: DataFrame, contract: Contract, weight: str | None = None) -> DataFrame:
    """Per column: cells present as text but unreadable as the target type
    (``weight``: a column that says how often each row came)."""
    check_columns(df, contract)
    aggs = []
    for c in contract.columns:
        if c.type == "string":
            continue
        raw = F.col(c.name)
        bad = raw.isNotNull() & (F.length(F.trim(raw)) > 0) & typed_column(c).isNull()
        times = F.col(weight) if weight else F.lit(1)
        aggs.append(F.coalesce(F.sum(F.when(bad, times).otherwise(0)), F.lit(0)).cast("bigint").alias(c.name))
    wide = df.agg(*aggs)
    names = [c.name for c in contract.columns if c.type != "string"]
    parts = []
    for n in names:
        parts += [F.lit(n), F.col(n)]
    return wide.select(F.stack(F.lit(len(names)), *parts).alias("column_name", "bad_cells"))


# ---- contracts of the accident data ---------------------------------------
# The accident bronze as the pipeline consumes it (text columns bound by name).
ACCIDENTS_TEXT = Contract("accidents", (
    Column("num_acc", "bigint", required=True), Column("an", "int"), Column("mois", "int"),
    Column("jour", "int"), Column("hrmn", "string"), Column("dep", "string"), Column("atm", "int"),
))

# Source files of the real accident data (the four tables, semicolon CSV).
CARACTERISTIQUES = Contract("caracteristiques", (
    Column("Num_Acc", "string", required=True), Column("jour", "int"), Column("mois", "int"),
    Column("an", "int"), Column("hrmn", "string"), Column("lum", "int"), Column("dep", "string"),
    Column("atm", "int"),
))
LIEUX = Contract("lieux", (Column("Num_Acc", "string", required=True), Column("surf", "int")))
VEHICULES = Contract("vehicules", (
    Column("Num_Acc", "string", required=True), Column("num_veh", "string"), Column("cat_veh", "string"),
))
USAGERS = Contract("usagers", (
    Column("Num_Acc", "string", required=True), Column("num_veh", "string"), Column("catu", "string"),
    Column("sexe", "string"), Column("grav", "int"),
))
# The older layout of the same data (time as `heure`, coded severity on the
# accident, department and coordinates on the place table).
CARACTERISTIQUES_V1 = Contract("caracteristiques", (
    Column("Num_Acc", "string", required=True), Column("an", "int"), Column("jour", "string"),
    Column("heure", "string"), Column("dep", "string"), Column("agglo", "string"), Column("atm", "string"),
    Column("surf", "string"), Column("catr", "string"), Column("circ", "string"),
    Column("descr_grav", "string"),
))
LIEUX_V1 = Contract("lieux", (
    Column("Num_Acc", "string", required=True), Column("com", "string"), Column("dep", "string"),
    Column("lat", "double", decimal_comma=True), Column("long", "double", decimal_comma=True),
    Column("catv", "string"),
))

VEHICULES_V1 = Contract("vehicules", (
    Column("Num_Acc", "string", required=True), Column("num_veh", "string"), Column("cat_veh", "string"),
    Column("obs", "string"), Column("obsm", "string"), Column("choc", "string"), Column("manv", "string"),
))
USAGERS_V1 = Contract("usagers", (
    Column("Num_Acc", "string", required=True), Column("num_veh", "string"), Column("catu", "string"),
    Column("sexe", "string"), Column("trajet", "string"), Column("locp", "string"),
))

OLDER_CONTRACTS = {c.name: c for c in (CARACTERISTIQUES_V1, LIEUX_V1, VEHICULES_V1, USAGERS_V1)}
SOURCE_CONTRACTS = {c.name: c for c in (CARACTERISTIQUES, LIEUX, VEHICULES, USAGERS)}
