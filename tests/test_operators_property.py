"""Operators against brute-force pandas models on random inputs (hypothesis)."""

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import aggregate as agg
from strata.operators import clean as cl
from strata.operators import measure
from strata.operators.ranking import rank_within_group

SCORE = {2: 4, 3: 3, 4: 2, 1: 1}

person = st.tuples(st.integers(0, 6), st.integers(1, 3), st.one_of(st.none(), st.integers(-1, 5)))
text_row = st.tuples(st.sampled_from([None, "", "  ", "1", "2", "3", "x"]),
                     st.sampled_from([None, "2004", "2005", "2030", "2031", "n/a"]))


@settings(max_examples=6, deadline=None)
@given(st.lists(person, min_size=1, max_size=40))
def test_severity_per_accident_matches_pandas(spark, rows):
    df = spark.createDataFrame(rows, "num_acc long, num_veh int, grav int")
    got = {r["num_acc"]: (r["gravite_max"], r["nb_tues"], r["nb_hospitalises"], r["nb_usagers"], r["accident_grave"])
           for r in agg.severity_per_accident(df).collect()}
    pdf = pd.DataFrame(rows, columns=["num_acc", "num_veh", "grav"])
    want = {}
    for k, g in pdf.groupby("num_acc"):
        scores = [SCORE[v] for v in g["grav"] if v in SCORE]
        mx = max(scores) if scores else None
        want[k] = (mx, int((g["grav"] == 2).sum()), int((g["grav"] == 3).sum()), len(g),
                   None if mx is None else int(mx >= 3))
    assert got == want


@settings(max_examples=6, deadline=None)
@given(st.lists(text_row, min_size=1, max_size=40))
def test_clean_report_matches_pandas(spark, rows):
    rules = cl.CleanRules(key="k", ranges={"an": (2005, 2030)})
    df = spark.createDataFrame(rows, "k string, an string")
    r = cl.clean_report(df, rules, "t").first()
    distinct = set(rows)

    def key_ok(k):
        return k is not None and k.strip() != ""

    def year_ok(a):
        try:
            return 2005 <= int(a.strip()) <= 2030
        except (AttributeError, ValueError):
            return False
    want = (len(rows), len(rows) - len(distinct),
            sum(not key_ok(k) for k, _ in distinct),
            sum(key_ok(k) and not year_ok(a) for k, a in distinct),
            sum(key_ok(k) and year_ok(a) for k, a in distinct))
    assert (r["raw_rows"], r["duplicate_rows"], r["rejected_key"], r["rejected_range"], r["kept_rows"]) == want
    kept = cl.clean(df, rules).collect()
    assert len(kept) == want[4]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 9), st.integers(0, 3)), min_size=1, max_size=50))
def test_dedup_by_key_and_rank_within_group_match_pandas(spark, rows):
    df = spark.createDataFrame(rows, "g int, v int, w int")
    order = [F.desc("v"), F.asc("w")]
    got = sorted(tuple(r) for r in cl.dedup_by_key(df, "g", order).collect())
    pdf = pd.DataFrame(rows, columns=["g", "v", "w"]).sort_values(["g", "v", "w"], ascending=[True, False, True])
    want = sorted(tuple(int(x) for x in t) for t in pdf.drop_duplicates("g").itertuples(index=False))
    assert got == want
    top2 = sorted((r["g"], r["v"], r["w"], r["rang"]) for r in rank_within_group(df, ["g"], order, 2, "rang").collect())
    pdf["rang"] = pdf.groupby("g").cumcount() + 1
    want2 = sorted(tuple(int(x) for x in t) for t in pdf[pdf["rang"] <= 2].itertuples(index=False))
    assert top2 == want2


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 30)), min_size=1, max_size=60),
       st.integers(1, 8))
def test_salted_aggregate_matches_pandas(spark, rows, salts):
    df = spark.createDataFrame(rows, "dep string, num_acc long")
    got = {r["dep"]: (r["nb_lignes"], r["nb_accidents"]) for r in measure.salted_aggregate(df, "dep", "num_acc", salts).collect()}
    pdf = pd.DataFrame(rows, columns=["dep", "num_acc"])
    want = {k: (len(g), g["num_acc"].nunique()) for k, g in pdf.groupby("dep")}
    assert got == want
