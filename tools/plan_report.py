"""Write PLANS.md: a per-query summary of the final (adaptive) physical
plans — shuffles, broadcasts, join strategies, windows, scans and their
pushed filters — as the record of the plan review.

    python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starkit.plans.catalog import QUERIES  # noqa: E402
from starkit.session import get_session  # noqa: E402


def final_plan(df) -> str:
    df.collect()  # executes through the DataFrame's own query execution -> final adaptive plan
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def summarise(p: str) -> dict:
    """Count node kinds of the *final* adaptive plans only (the formatted
    text also lists each initial plan) using the per-node detail blocks."""
    head, _, details = p.partition("\n\n\n")
    final_ids, mode = set(), "final"
    for ln in head.splitlines():
        if "== Initial Plan ==" in ln:
            mode = "initial"
        elif "== Final Plan ==" in ln or "Subqueries" in ln:
            mode = "final"
        for m in re.finditer(r"\((\d+)\)", ln):
            if mode == "final":
                final_ids.add(m.group(1))
    nodes, shuffles, scans, pushed = Counter(), Counter(), Counter(), []
    for block in re.split(r"\n(?=\(\d+\) )", details):
        m = re.match(r"\((\d+)\) (\w[\w ]*?)(?: \[codegen id : \d+\])?\s*\n", block)
        if not m or m.group(1) not in final_ids:
            continue
        kind = m.group(2).strip()
        nodes[kind] += 1
        if kind == "Exchange":
            a = re.search(r"Arguments: (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", block)
            shuffles[a.group(1) if a else "other"] += 1
        if kind.startswith("Scan"):
            loc = re.search(r"Location: \w+ \[[^\]]*?/([\w.]+)\]", block)
            scans[loc.group(1) if loc else kind] += 1
            f = re.search(r"PushedFilters: \[([^\]]*)\]", block)
            if f and f.group(1):
                pushed.append(f.group(1))
    return {"nodes": nodes, "shuffles": shuffles, "scans": scans, "pushed": pushed}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    print("# PLANS — final adaptive plans per catalogue query\n")
    print(f"Generated by `tools/plan_report.py` on `{sf_dir}` (local[8], 8 shuffle partitions, AQE on).")
    print("Shuffles = Exchange nodes by partitioning; BHJ/SMJ = broadcast-hash / sort-merge joins;")
    print("WGL = WindowGroupLimit (top-1 per key, partial before the shuffle); scans list the files read.\n")
    print("| Query | Shuffles | BHJ | SMJ | BNLJ | Windows | WGL | Scans | Pushed filters |")
    print("| --- | --- | ---: | ---: | ---: | ---: | ---: | --- | --- |")
    for name in sorted(QUERIES):
        s = summarise(final_plan(QUERIES[name](spark, sf_dir)))
        n = s["nodes"]
        sh = ", ".join(f"{k.replace('partitioning', '')} {v}" for k, v in sorted(s["shuffles"].items())) or "–"
        scans = ", ".join(f"{k.removesuffix('.parquet')}" + (f"×{v}" if v > 1 else "")
                          for k, v in sorted(s["scans"].items())) or "–"
        pushed = "; ".join(sorted(set(s["pushed"])))[:160] or "–"
        print(f"| `{name}` | {sh} | {n.get('BroadcastHashJoin', 0)} | {n.get('SortMergeJoin', 0)} | "
              f"{n.get('BroadcastNestedLoopJoin', 0)} | {n.get('Window', 0)} | {n.get('WindowGroupLimit', 0)} | "
              f"{scans} | {pushed} |", flush=True)


if __name__ == "__main__":
    main(sys.argv)
