"""Salted join: equal rows to the plain join, evenly filled tasks; task figures from the event log."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from strata.operators import skew
from tests.test_skew import skewed


@pytest.mark.parametrize("how", ["inner", "left"])
def test_equals_the_plain_join(spark, how):
    fact = skewed(spark, 30_000).union(spark.createDataFrame([(1, None, 1), (2, "unknown", 2), (2, "unknown", 2)], "num_acc long, dep string, meteo int"))
    dim = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("dep"), "id").union(
        spark.createDataFrame([("00", -1), ("00", -2), (None, -3)], "dep string, id long"))
    got = skew.skew_join(fact, dim, "dep", how, salts=8)
    want = fact.join(dim, "dep", how).select(*got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() > 30_000


def test_heavy_hitters(spark):
    rows = {r.dep: r.nb for r in skew.heavy_hitters(skewed(spark, 30_000), "dep", 0.01).collect()}
    assert rows == {"00": 10_000}
    assert skew.heavy_hitters(skewed(spark, 10).limit(0), "dep").count() == 0


def test_only_inner_and_left(spark):
    with pytest.raises(ValueError):
        skew.skew_join(skewed(spark, 10), skewed(spark, 10), "dep", "full")


RUN = """
import sys
from strata.session import get_session
log, how = sys.argv[1:]
spark = get_session("log", master="local[4]", shuffle_partitions=16, extra={
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + log, "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
    "spark.sql.adaptive.enabled": "false", "spark.checkpoint.dir": log + "-ckpt"})
from strata.operators import skew
from tests.test_skew import skewed
fact = skewed(spark, 60_000)
dim = fact.select("dep").distinct()
met = skew.skew_join(fact, dim, "dep", salts=32) if how == "salted" else fact.join(dim.hint("merge"), "dep")
met.write.format("noop").mode("overwrite").save()
spark.stop()
"""


def test_tasks_even_out(spark, tmp_path):
    """The largest task of the join falls by the salt, by Spark's own event log."""
    largest = {}
    for how in ("plain", "salted"):
        log = tmp_path / how
        log.mkdir()
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        subprocess.run([sys.executable, "-c", RUN, str(log), how], check=True, cwd=root, env={**os.environ, "PYTHONPATH": root}, timeout=300,
                       stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
        stages = skew.task_balance(spark, str(log)).collect()
        assert stages and all(s.max_rows is None or s.max_rows >= s.median_rows for s in stages)
        largest[how] = max(s.max_rows or 0 for s in stages)
        lines = [json.loads(x) for f in log.iterdir() for x in f.read_text().splitlines()]
        ends = [x for x in lines if x["Event"] == "SparkListenerTaskEnd"]
        assert sum(s.tasks for s in stages) == len(ends)
    assert largest["plain"] > 20_000 and largest["salted"] < largest["plain"] / 2
