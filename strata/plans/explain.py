"""Summarise the physical plan of every catalogue query (plan review aid).

``python -m strata.plans.explain [sf_dir] > PLANS.md`` prints one markdown row
per query: shuffles by kind, join strategies, partial aggregates, partial
window limits, Python evaluation and the columns read per scan. Auto-broadcast
is switched off so the plans are the ones a large input gets (size-guarded
hints still apply).
"""

from __future__ import annotations

import re
import sys

SKIP = {"stream_windowed_counts", "als_pair_scores"}  # a stream run / an iterative fit, not one plan


def plan_text(df) -> str:
    """The physical plan as ``df.explain()`` prints it (before execution)."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def summarise(plan: str) -> dict:
    scans = re.findall(r"FileScan (\w+) \[([^\]]*)\][^\n]*?\(\d+ paths\)\[[^\]]*/([\w.-]+?)(?:\.parquet)?[,\]]", plan)
    return {
        "hash": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range": len(re.findall(r"Exchange rangepartitioning", plan)),
        "single": len(re.findall(r"Exchange SinglePartition", plan)),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "partial_agg": len(re.findall(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_", plan)),
        "wgl_partial": len(re.findall(r"WindowGroupLimit[^\n]*Partial", plan)),
        "python": "yes" if "EvalPython" in plan else "",
        "scans": ", ".join(sorted(f"{t.split('-')[0]}({len(cols.split(','))})" for _, cols, t in scans)),
    }


def main(argv: list[str]) -> None:
    sys.path.insert(0, ".")
    from strata.plans.catalog import QUERIES
    from strata.session import get_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    spark = get_session("plans", master="local[8]", shuffle_partitions=16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    print(f"# Physical plans at a glance ({sf_dir}, auto-broadcast off)\n")
    print("Shuffles by kind, joins by strategy, partial aggregates and partial window limits "
          "(map-side work before a shuffle), Python evaluation, and scans as table(columns read). "
          "These are the plans before execution: AQE re-plans at run time (coalesced partitions, "
          "runtime broadcasts of small shuffled sides, reuse of identical exchanges such as the two "
          "branches of `clean_na_drop_fill`).\n")
    print("| query | hash | range | single | SMJ | BHJ | partial agg | partial limit | python | scans |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, q in sorted(QUERIES.items()):
        if name in SKIP:
            continue
        s = summarise(plan_text(q(spark, sf_dir)))
        print(f"| `{name}` | {s['hash']} | {s['range']} | {s['single']} | {s['smj']} | {s['bhj']} | "
              f"{s['partial_agg']} | {s['wgl_partial']} | {s['python']} | {s['scans']} |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
