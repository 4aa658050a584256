"""Property tests of the column expressions against small Python models.

Each hypothesis example is a whole list evaluated in one Spark job."""

import re
from datetime import date

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from strata.functions import expressions as fx

HHMM = re.compile(r"^[0-9]{2}:[0-9]{2}$")


def model_hour(s):
    return int(s[:2]) if s is not None and HHMM.search(s) else None


def model_score(g):
    return {2: 4, 3: 3, 4: 2, 1: 1}.get(g)


def model_date(y, m, d):
    try:
        return date(y, m, d) if None not in (y, m, d) and y >= 1 else None
    except ValueError:
        return None


hour_text = st.one_of(st.none(), st.text(alphabet="0123456789: x", max_size=6),
                      st.from_regex(r"\A[0-9]{2}:[0-9]{2}\Z"))


@settings(max_examples=8, deadline=None)
@given(st.lists(hour_text, min_size=1, max_size=100))
def test_hour_from_hrmn(spark, values):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("h", T.StringType())]))
    got = [r[0] for r in df.select(fx.hour_from_hrmn("h")).collect()]
    assert got == [model_hour(v) for v in values]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-3, 9)), min_size=1, max_size=50))
def test_severity_score_and_flag(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "g int")
    rows = df.select(fx.severity_score("g").alias("s"), fx.flag(fx.severity_score("g") >= 3).alias("f")).collect()
    assert [r["s"] for r in rows] == [model_score(v) for v in values]
    assert [r["f"] for r in rows] == [None if model_score(v) is None else int(model_score(v) >= 3) for v in values]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 5)), st.one_of(st.none(), st.integers(-5, 5))),
                min_size=1, max_size=50))
def test_safe_ratio_never_raises(spark, pairs):
    df = spark.createDataFrame(pairs, "a int, b int")
    got = [r[0] for r in df.select(fx.safe_ratio("a", "b")).collect()]
    assert got == [None if a is None or b in (None, 0) else a / b for a, b in pairs]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(1990, 2030), st.integers(0, 13), st.integers(0, 32)), min_size=1, max_size=50))
def test_date_from_parts_null_for_impossible_dates(spark, parts):
    df = spark.createDataFrame(parts, "y int, m int, d int")
    got = [r[0] for r in df.select(fx.date_from_parts("y", "m", "d")).collect()]
    assert got == [model_date(*p) for p in parts]


def test_hour_bucket_edges(spark):
    df = spark.createDataFrame([(h,) for h in (None, 0, 5, 6, 11, 12, 17, 18, 23, 24)], "h int")
    got = [r[0] for r in df.select(fx.hour_bucket("h")).collect()]
    assert got == [None, "night", "night", "morning", "morning", "afternoon", "afternoon",
                   "evening", "evening", None]


def test_decimal_comma(spark):
    df = spark.createDataFrame([("48,85",), ("2.35",), ("n/a",), (None,)], "t string")
    assert [r[0] for r in df.select(fx.decimal_comma("t")).collect()] == [48.85, 2.35, None, None]
