"""Road-accident roles bound onto the driver's relational tables.

The accident pipeline needs four related tables keyed by the accident number.
On the driver's star schema they are derived as follows (all lazily, with
only the needed columns read from Parquet):

* accidents (one row per key): ``orders`` joined to ``customer``; the year,
  month and day come from the order date, the department is the customer's
  nation as two-character text, the weather code is the leading digit of the
  order priority, and the ``HH:MM`` time comes from the event with the same id
  (left join: accidents without an event have no time).
* places (n per key): ``lineitem`` (road surface = line status).
* persons (n per key): ``lineitem``; the person severity code ``grav`` is
  derived from (return flag, line status).
* vehicles (n per key): ``lineitem`` joined to ``part`` (vehicle category =
  part type).

Roles are projections of whole source rows: duplicates are dropped on the source
rows first (``layers.silver_from_driver``), so rows that differ only in a column no
role reads stay apart.

``dirty_accidents`` adds reproducible defects (missing keys, unreadable and
implausible years, padded codes, badly shaped times, re-delivered rows) chosen by rules on
the row values, so that the cleaning operators have work on every table size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Plausible accident years (inclusive); only the text bronze holds others.
PLAUSIBLE_YEARS = (1990, 2030)


# Declared schemas of the driver tables: reading with a schema skips footer
# inference at plan time, and only the requested columns are declared.
_SIMPLE_TYPES = {"int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
                 "string": T.StringType(), "timestamp_ntz": T.TimestampNTZType()}


def _struct(ddl: str) -> T.StructType:
    """``"a int, b string"`` -> StructType (flat columns only; no session needed)."""
    fields = [part.strip().split() for part in ddl.split(",")]
    return T.StructType([T.StructField(n, _SIMPLE_TYPES[t], True) for n, t in fields])


TABLE_SCHEMAS: dict[str, T.StructType] = {
    name: _struct(ddl) for name, ddl in {
        "region": "r_regionkey int, r_name string",
        "nation": "n_nationkey int, n_name string, n_regionkey int",
        "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
        "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
                 "p_retailprice double"),
        "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                   "o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                     "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                     "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "events": ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
                   "props string"),
    }.items()
}


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """A driver table with only ``columns`` (declared schema when known)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    full = TABLE_SCHEMAS.get(name)
    if full is None:
        df = spark.read.parquet(path)
        return df.select(*columns) if columns else df
    if columns:
        by_name = {f.name: f for f in full.fields}
        missing = [c for c in columns if c not in by_name]
        if missing:
            raise ValueError(f"table {name}: unknown column(s) {missing}")
        return spark.read.schema(T.StructType([by_name[c] for c in columns])).parquet(path)
    return spark.read.schema(full).parquet(path)


def _grav_from_flags(returnflag: Column, linestatus: Column) -> Column:
    # R/F -> killed, R/O -> hospitalised, A/* -> light, N/F -> unharmed, N/O -> unknown (-1)
    return (F.when((returnflag == "R") & (linestatus == "F"), F.lit(2))
            .when(returnflag == "R", F.lit(3))
            .when(returnflag == "A", F.lit(4))
            .when(linestatus == "F", F.lit(1))
            .otherwise(F.lit(-1)))


def accidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accident role: num_acc, an, mois, jour, hrmn, dep, atm."""
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
    c = table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    e = table(spark, sf_dir, "events", ["event_id", "ts"])
    return (o.join(c, o.o_custkey == c.c_custkey, "inner")
            .join(e, o.o_orderkey == e.event_id, "left")
            .select(
                F.col("o_orderkey").alias("num_acc"),
                F.year("o_orderdate").alias("an"),
                F.month("o_orderdate").alias("mois"),
                F.dayofmonth("o_orderdate").alias("jour"),
                F.date_format("ts", "HH:mm").alias("hrmn"),
                F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("dep"),
                F.substring("o_orderpriority", 1, 1).try_cast("int").alias("atm"),
            ))


def dirty_accidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accident bronze as delimited text would carry it: every column STRING,
    with defects chosen by rules on the row values:

    * key missing for status P + priority 5, key blank for status P + priority 4;
    * year unreadable (``n/a``) for status O + priority 5, a century late for
      status P + priority 3;
    * department padded with spaces for status F + priority 2;
    * time written without its leading zero for error events;
    * rows of status F + priority 1 delivered twice.
    """
    o = table(spark, sf_dir, "orders",
              ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"])
    c = table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    e = table(spark, sf_dir, "events", ["event_id", "ts", "event_type"])
    st, pr = F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)
    dep = F.lpad(F.col("c_nationkey").cast("string"), 2, "0")
    key = F.col("o_orderkey").cast("string")
    base = (o.join(c, o.o_custkey == c.c_custkey, "inner")
            .join(e, o.o_orderkey == e.event_id, "left")
            .select(
                F.when((st == "P") & (pr == "5"), F.lit(None).cast("string"))
                 .when((st == "P") & (pr == "4"), F.lit("   "))
                 .otherwise(key).alias("num_acc"),
                F.when((st == "O") & (pr == "5"), F.lit("n/a"))
                 .when((st == "P") & (pr == "3"), (F.year("o_orderdate") + 100).cast("string"))
                 .otherwise(F.year("o_orderdate").cast("string")).alias("an"),
                F.lpad(F.month("o_orderdate").cast("string"), 2, "0").alias("mois"),
                F.lpad(F.dayofmonth("o_orderdate").cast("string"), 2, "0").alias("jour"),
                F.when(F.col("event_type") == "error", F.date_format("ts", "H:mm"))
                 .otherwise(F.date_format("ts", "HH:mm")).alias("hrmn"),
                F.when((st == "F") & (pr == "2"), F.concat(F.lit(" "), dep, F.lit(" ")))
                 .otherwise(dep).alias("dep"),
                pr.alias("atm"),
                # re-delivered rows appear twice: one pass, rows multiplied in place
                F.explode(F.when((st == "F") & (pr == "1"), F.array(F.lit(1), F.lit(2)))
                          .otherwise(F.array(F.lit(1)))).alias("_copy"),
            ))
    return base.drop("_copy")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole rows behind the places, persons and vehicles."""
    return table(spark, sf_dir, "lineitem")


def place_columns(rows: DataFrame) -> DataFrame:
    """Place role (n per accident): num_acc, surf, supp."""
    return rows.withColumns({"num_acc": F.col("l_orderkey"), "surf": F.col("l_linestatus"), "supp": F.col("l_suppkey")})


def person_columns(rows: DataFrame) -> DataFrame:
    """Person role (n per accident): num_acc, num_veh, catu, sexe, grav."""
    return rows.withColumns({
        "num_acc": F.col("l_orderkey"),
        "num_veh": F.col("l_linenumber"),
        "catu": F.when(F.col("l_linenumber") == 1, F.lit(1)).otherwise(F.lit(2)),
        "sexe": F.when(F.col("l_discount") < 0.05, F.lit(1)).otherwise(F.lit(2)),
        "grav": _grav_from_flags(F.col("l_returnflag"), F.col("l_linestatus")),
    })


def vehicle_columns(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Vehicle role (n per accident): num_acc, num_veh, cat_veh. The category comes
    from the part by a lookup after the rows are distinct (null-safe, so that no null
    test goes below the dedup and all roles keep one plan for the whole rows)."""
    named = parts.where("p_partkey is not null").select("p_partkey", F.col("p_type").alias("cat_veh"))
    return (rows.withColumns({"num_acc": F.col("l_orderkey"), "num_veh": F.col("l_linenumber")})
            .join(named, F.col("l_partkey").eqNullSafe(F.col("p_partkey")), "inner"))


PLACE = ["num_acc", "surf", "supp"]
PERSON = ["num_acc", "num_veh", "catu", "sexe", "grav"]
VEHICLE = ["num_acc", "num_veh", "cat_veh"]


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part", ["p_partkey", "p_type"])


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, item, rating) from lineitem: supplier rates part with the quantity."""
    li = table(spark, sf_dir, "lineitem", ["l_suppkey", "l_partkey", "l_quantity"])
    return li.select(F.col("l_suppkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
                     F.col("l_quantity").alias("rating"))


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four bronze tables of the pipeline, as a dict (like a multi-file
    ingest): whole source rows with the columns of their role."""
    rows = lines(spark, sf_dir)
    return {
        "accidents": accidents(spark, sf_dir),
        "places": place_columns(rows),
        "vehicles": vehicle_columns(rows, parts(spark, sf_dir)),
        "persons": person_columns(rows),
    }
