"""Per-query physical plan summary -> PLANS.md (exchanges, joins, Python
nodes, scan columns), from the executed adaptive plans.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summarize(plan: str) -> dict:
    return {
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "broadcast_joins": len(re.findall(r"BroadcastHashJoin", plan)),
        "sort_merge_joins": len(re.findall(r"SortMergeJoin", plan)),
        "python": sorted(set(re.findall(r"(MapInPandas|FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython)", plan))),
        "scans": sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from scorewright.session import get_session
    from scorewright.plans.registry import ORACLES, QUERIES, load_all
    load_all()
    spark = get_session("local[8]")
    print(f"# Physical plans ({os.path.basename(sf_dir)}, after execution, AQE final plans)\n")
    print("Exchanges = shuffles (hash/range); joins by strategy; Python = Python operators in the plan; "
          "scans = pruned parquet read schemas. Inputs that a query writes itself (materialised tables) "
          "show up as their own scans.\n")
    print("| query | oracle | exchanges | broadcast joins | sort-merge joins | Python | scanned columns |")
    print("|---|---|---|---|---|---|---|")
    for name in sorted(QUERIES):
        try:
            df = QUERIES[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            plan = df._jdf.queryExecution().executedPlan().toString()
            s = summarize(plan)
            scans = "; ".join(x.replace("struct<", "").rstrip(">")[:90] for x in s["scans"])
            print(f"| {name} | {'O' if name in ORACLES else 'R'} | {s['exchanges']} | {s['broadcast_joins']} | "
                  f"{s['sort_merge_joins']} | {', '.join(s['python']) or '-'} | {scans} |", flush=True)
        except Exception as exc:  # noqa: BLE001
            print(f"| {name} | error: {type(exc).__name__} | | | | | |", flush=True)


if __name__ == "__main__":
    main()
