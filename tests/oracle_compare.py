"""Compare catalogue queries with their DuckDB oracle (row count, schema, values).

Usable from pytest (``compare``) and as a script:
``python -m tests.oracle_compare [sf_dir] [name ...]``.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

SPARK_TO_DUCK = {
    "IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
    "BooleanType": "BOOLEAN", "TimestampNTZType": "TIMESTAMP", "DateType": "DATE",
    "ShortType": "SMALLINT", "ByteType": "TINYINT", "FloatType": "FLOAT", "TimestampType": "TIMESTAMP WITH TIME ZONE",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def compare(spark, con, name: str, builder, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = builder(spark, sf_dir)
    cols = sorted(sdf.columns)
    srows = [tuple(_norm(r[c]) for c in cols) for r in sdf.collect()]
    t1 = time.time()
    out = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows_raw = rel.fetchall()
    out["duck_rows"] = len(drows_raw)
    if sorted(dcols) != cols:
        out["status"] = f"COLUMNS differ spark={cols} duck={sorted(dcols)}"
        return out
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(_norm(r[i]) for i in idx) for r in drows_raw]
    # types
    dtypes = {d[0]: str(d[1]) for d in rel.description}
    stypes = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, f.dataType.simpleString())
              for f in sdf.schema.fields}
    bad_types = {c: (stypes[c], dtypes[c]) for c in cols if stypes[c] != dtypes[c]}
    if sorted(srows) != sorted(drows):
        s, d = set(srows), set(drows)
        out["status"] = "VALUES differ"
        out["only_spark"] = sorted(s - d)[:3]
        out["only_duck"] = sorted(d - s)[:3]
    elif bad_types:
        out["status"] = f"TYPES differ {bad_types}"
    else:
        out["status"] = "match"
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from strata.session import get_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = get_session("oracle-compare", master="local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for n in (names or list(qs)):
        try:
            r = compare(spark, con, n, qs[n], sqls.get(n), sf_dir)
        except Exception as e:  # report and continue
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("match", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
