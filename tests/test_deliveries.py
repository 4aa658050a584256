"""Gold from deliveries against a rebuild; counts of the writing pass; header probe of folders."""

import gzip
import os
import random

from pyspark.sql import functions as F

from strata import contracts
from strata.plans import incremental
from strata.session import scratch_path
from strata.sources import files, sinks

ROW = "num_acc long, dep string, score int, grave int"


def rebuilt(rows):
    out = {}
    for dep, score, grave in rows.values():
        out.setdefault(dep, []).append((score, grave or 0))
    return {d: (len(v), sum(g for _, g in v), max((s for s, _ in v if s is not None), default=None),
                round(sum(s for s, _ in v if s is not None) / n, 6) if (n := sum(s is not None for s, _ in v)) else None) for d, v in out.items()}


def told(spark, base):
    return {r.dep: tuple(r)[1:] for r in incremental.gold(spark, base).collect()}


def test_deliveries_equal_a_rebuild(spark, monkeypatch):
    rng, base, now = random.Random(1), scratch_path(spark, "inc"), {}
    bucket = F.col("num_acc") / 100
    for number in range(4):
        keys = rng.sample(range(number * 150, number * 150 + 300), 120)
        rows = [(k, rng.choice(["01", "2A", None, "hot", "hot"]), rng.choice([1, 2, 4, None]), rng.choice([0, 1, None])) for k in keys]
        touched = incremental.deliver(spark, base, number, spark.createDataFrame(rows, ROW), bucket)
        now |= {k: tuple(r) for k, *r in rows}
        assert told(spark, base) == rebuilt(now) and touched == sorted({k // 100 for k in keys})
    stored = {r.num_acc: (r.dep, r.score, r.grave) for r in incremental.silver(spark, base).collect()}
    assert stored == now
    # a group that loses its last accident goes
    incremental.deliver(spark, base, 4, spark.createDataFrame([(k, "new", 3, 1) for k in now], ROW), bucket)
    assert told(spark, base) == {"new": (len(now), len(now), 3, 3.0)}


def test_a_broken_delivery_is_run_again(spark, monkeypatch):
    base, bucket = scratch_path(spark, "inc"), F.col("num_acc") / 10
    first = spark.createDataFrame([(k, "01", 2, 0) for k in range(40)], ROW)
    second = spark.createDataFrame([(k, "02", 4, 1) for k in range(20, 60)], ROW)
    incremental.deliver(spark, base, 0, first, bucket)
    incremental.deliver(spark, base, 1, second, bucket)
    whole = told(spark, base)
    incremental.deliver(spark, base, 1, second, bucket)   # as after a break: counts and rows stay as they are
    assert told(spark, base) == whole == {"01": (20, 0, 2, 2.0), "02": (40, 40, 4, 4.0)}
    assert incremental.silver(spark, base).count() == 60


def test_a_delivery_reads_touched_buckets_only(spark):
    base, bucket = scratch_path(spark, "inc"), F.col("num_acc") / 10
    incremental.deliver(spark, base, 0, spark.createDataFrame([(k, "01", 2, 0) for k in range(100)], ROW), bucket)
    read = incremental.silver(spark, base, [3])
    assert {f.rsplit("/", 2)[1] for f in read.select("num_acc").where(F.col("key_bucket") == 3).inputFiles()} >= {"key_bucket=3"}
    assert "PartitionFilters: [" in read._jdf.queryExecution().toString() and read.count() == 10


def test_counts_of_the_writing_pass(spark):
    df = spark.range(1000).withColumn("bad", F.when(F.col("id") % 10 == 0, F.lit(True)).when(F.col("id") % 3 == 0, F.lit(False)))
    path = scratch_path(spark, "kept")
    counts = sinks.write_kept(df, path, ~F.col("bad"), {"bad": F.col("bad"), "unknown": F.col("bad").isNull()})
    kept = df.where("not bad").count()
    assert counts == {"raw": 1000, "kept": kept, "bad": 100, "unknown": 900 - kept} and spark.read.parquet(path).count() == kept
    assert sinks.write_kept(df.limit(0), scratch_path(spark, "kept"), ~F.col("bad"), {}) == {"raw": 0, "kept": 0}


CONTRACT = contracts.ACCIDENTS_TEXT
NAMES = ["Num_Acc", "num_acc"]


def folder(tmp_path, rows=3, zipped=False):
    """Two layouts under names with blanks, per cent signs, accents and brackets."""
    out = tmp_path / "a folder % été"
    out.mkdir()
    for k, name in enumerate(("one 1", "deux%202", "trois é", "four [4]")):
        header = CONTRACT.names if k % 2 else list(reversed(CONTRACT.names))
        cells = dict.fromkeys(header, "1")
        text = ";".join(header) + "\n" + "".join(";".join({**cells, "num_acc": str(10 * k + n)}[c] for c in header) + "\n" for n in range(rows))
        raw = text.encode("iso-8859-1")
        (out / f"{name}.csv{'.gz' if zipped else ''}").write_bytes(gzip.compress(raw) if zipped else raw)
    return str(out)


def test_folders_of_any_file_name(spark, tmp_path):
    for zipped in (False, True):
        sub = tmp_path / str(zipped)
        sub.mkdir()
        path = folder(sub, zipped=zipped)
        layouts = files.header_layouts(spark, path, files.CSV_ENCODING)
        assert sorted(len(v) for v in layouts.values()) == [2, 2]
        rows = files.read_csv_contract(spark, path, CONTRACT).collect()
        assert sorted(r.num_acc for r in rows) == sorted(10 * k + n for k in range(4) for n in range(3)) and all(r.an == 1 for r in rows)


def test_the_probe_does_not_read_files_whole(spark, tmp_path):
    """Lines that reach Python per file: one, however long the file."""
    path = folder(tmp_path, rows=200_000)
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    seen = spark.sparkContext.accumulator(0)
    whole = files._first_rows

    def counted(batches):
        def each():
            for b in batches:
                seen.add(b.num_rows)
                yield b
        yield from whole(each())

    files._first_rows = counted
    try:
        layouts = files.header_layouts(spark, path, files.CSV_ENCODING)
    finally:
        files._first_rows = whole
    assert len(layouts) == 2 and seen.value == 4
    assert before == {k: spark.conf.get(k, None) for k in before} and os.path.getsize(os.path.join(path, "one 1.csv")) > 1_000_000
