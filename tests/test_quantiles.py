"""Exact quantiles against a sort of each group."""

import math
import random

import pytest
from pyspark.sql import functions as F

from strata.operators.quantiles import exact_quantiles
from tests.test_skew import plan

FRACTIONS = {"low": 0.0, "q1": 0.25, "median": 0.5, "p99": 0.99, "high": 1.0}


def brute(rows):
    groups = {}
    for g, v in rows:
        if v is not None and not math.isnan(v):
            groups.setdefault(g, []).append(v)
    return {g: (len(vs), *[sorted(vs)[max(1, math.ceil(q * len(vs))) - 1] for q in FRACTIONS.values()]) for g, vs in groups.items()}


@pytest.mark.parametrize("buckets", [2, 7, 1024])
def test_against_sorting(spark, buckets):
    rng = random.Random(buckets)
    rows = [(rng.choice(["hot"] * 4 + ["a", "b", None]), rng.choice([rng.gauss(0, 1), rng.lognormvariate(0, 8), 1.5, -0.0, None, float("nan")]))
            for _ in range(3000)]
    rows += [("one", 7.0), ("ties", 2.0), ("ties", 2.0), ("none", None), ("far", 1.7e308), ("far", -1.7e308), ("far", 5e-324)]
    df = spark.createDataFrame(rows, "g string, v double").selectExpr("*", "1 AS lo", "'x' AS name").repartition(5)
    got = {r.g: tuple(r)[1:] for r in exact_quantiles(df, "g", "v", FRACTIONS, buckets).collect()}
    assert got == brute(rows)


def test_empty_table(spark):
    assert exact_quantiles(spark.createDataFrame([], "g string, v double"), "g", "v", FRACTIONS).count() == 0


def test_no_group_is_sorted_or_collected(spark, monkeypatch):
    """A pass ships counts per group and bucket, whatever a group holds."""
    from strata.operators import quantiles
    plans = []
    whole = quantiles._table
    monkeypatch.setattr(quantiles, "_table", lambda df, label: (plans.append(plan(df)), whole(df, label))[1])
    df = spark.range(200_000).select(F.lit("hot").alias("g"), F.rand(1).alias("v"))
    exact_quantiles(df, "g", "v", {"median": 0.5}, 64).collect()
    passes = [p for p in plans if "partial_count" in p and "Window" in p]
    assert passes and not any("collect_list" in p or "percentile" in p for p in plans)
