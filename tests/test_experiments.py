"""The measured experiments run end to end and their arms agree (sf0.001, one run)."""

from strata.plans import experiments
from tests.conftest import SF001


def test_broadcast_vs_shuffle(spark):
    r = experiments.broadcast_vs_shuffle(spark, SF001, runs=1)
    assert r["equal_results"] is True and set(r) >= {"shuffle", "broadcast"}


def test_repartition_vs_plain(spark):
    r = experiments.repartition_vs_plain(spark, SF001, runs=1)
    assert r["equal_results"] is True
    assert r["skew_profile"]["joined_rows"]["max_n"] >= r["skew_profile"]["joined_rows"]["min_n"]


def test_aqe_sweep_restores_conf(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    r = experiments.aqe_sweep(spark, SF001, runs=1, partitions=(4,))
    assert r["equal_results"] is True
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_format_sizes(spark):
    r = experiments.format_sizes(spark, SF001)
    assert r["parquet/zstd"]["bytes"] < r["json/none"]["bytes"]


def test_pushdown_bytes(spark):
    r = experiments.pushdown_bytes(spark, SF001, runs=1)
    assert r["equal_results"] is True
    assert 0 < r["bytes_read_with_filter"] < r["bytes_total"]
