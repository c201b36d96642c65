"""Write PLANS.md: the executed physical plan shape of every registered query
(exchanges, broadcasts, join strategies, window limits, scans, Python nodes)."""

from __future__ import annotations

import os
import re
import sys


def shape(plan: str) -> dict:
    scans = re.findall(r"Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/(\w+)\.parquet\]", plan)
    return {
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": sorted({m for m in re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|"
                                               r"BroadcastNestedLoopJoin|CartesianProduct)", plan)}),
        "group_limit": "WindowGroupLimit" in plan,
        "scans": {t: scans.count(t) for t in sorted(set(scans))},
        "python": any(n in plan for n in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas",
                                           "FlatMapGroupsInPandas")),
    }


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from stagewise.plans import registry as E
    from stagewise.session import get_spark
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = get_spark("local[8]")
    lines = ["# PLANS — executed plan shape of every registered query",
             "",
             f"Generated by `python tests/plan_report.py` on `{sf_dir}` (AQE final plans, the initial ones",
             "left out).  Exchanges count shuffles (hash/range/single); scans count parquet reads per table.",
             "",
             "| query | exchanges | broadcasts | joins | group limit | scans | python |",
             "|---|---|---|---|---|---|---|"]
    for k, build in E.queries().items():
        df = build(spark, sf_dir)
        df.collect()                                          # the final plan; the initial one stands behind it
        s = shape(df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
        scans = ", ".join(f"{t}×{n}" for t, n in s["scans"].items())
        lines.append(f"| `{k}` | {s['exchanges']} | {s['broadcasts']} | {', '.join(s['joins']) or '—'} | "
                     f"{'yes' if s['group_limit'] else ''} | {scans} | {'YES' if s['python'] else 'no'} |")
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(out, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    print(out)


if __name__ == "__main__":
    main()
