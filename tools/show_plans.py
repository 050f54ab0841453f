"""Summarise the executed (adaptive, final) physical plan of queries.

usage: python tools/show_plans.py [sf_dir] [name ...]
For each query: exchanges by kind, join strategies, partial per-key limits,
skew-split joins, and the Parquet scans with their pruned schema and pushed
filters.  Runs each query once (noop sink) so AQE's final plan is shown.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.plans.queries import all_queries  # noqa: E402
from tillroll.session import local_session  # noqa: E402


def summarise(formatted: str) -> list[str]:
    """Parse ``explain('formatted')`` of an executed (final) adaptive plan."""
    tree = formatted.split("== Final Plan ==", 1)[-1].split("== Initial Plan ==", 1)[0]
    final_ids = set(re.findall(r"\((\d+)\)", tree))
    nodes = re.split(r"\n\((\d+)\) ", formatted)
    blocks = [nodes[i + 1] for i in range(1, len(nodes) - 1, 2) if nodes[i] in final_ids]
    ex = Counter(); joins = Counter(); scans = []; partial = partial_aggs = skew = 0
    for b in blocks:
        head = b.split("\n", 1)[0].strip()
        if head.startswith("Exchange"):
            m = re.search(r"Arguments: (\w+)", b)
            ex[m.group(1) if m else "?"] += 1
        elif head.endswith("Join") or "Join " in head:
            t = re.search(r"Join type: (\w+)", b)
            joins[(head.split()[0], t.group(1) if t else "?")] += 1
            skew += "isSkewJoin: true" in b
        elif head.startswith("WindowGroupLimit") and "Partial" in b:
            partial += 1
        elif "Aggregate" in head and re.search(r"Functions \[\d+\]: \[partial_", b):
            partial_aggs += 1
        elif head.startswith("Scan parquet"):
            cols = re.search(r"ReadSchema: struct<(.*)>", b)
            pushed = re.search(r"PushedFilters: (\[.*\])", b)
            loc = re.search(r"Location: \w+ \[[^\]]*/([^/\]]+)\]", b)
            scans.append(f"scan {loc.group(1) if loc else '?'}: "
                         f"{len(cols.group(1).split(',')) if cols else '?'} cols read, "
                         f"PushedFilters: {pushed.group(1) if pushed else '[]'}")
    out = ["exchanges: " + ", ".join(f"{k} x{v}" for k, v in sorted(ex.items())),
           "joins: " + ", ".join(f"{j} {t} x{v}" for (j, t), v in sorted(joins.items())),
           f"partial per-key limits before a shuffle: {partial}",
           f"partial (map-side) aggregations: {partial_aggs}",
           f"skew-split joins: {skew}"]
    return out + scans


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or ["mart_daily_sales", "mart_state_performance", "dq_gate_valid",
                             "dq_gate_quarantine", "dq_ranked_orders", "fct_order_items"]
    spark = local_session(8, 16)
    qs = all_queries()
    for name in names:
        df = qs[name](spark, sf)
        df._jdf.queryExecution().toRdd().count()
        print(f"### {name}\n```")
        formatted = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        for line in summarise(formatted):
            print(line)
        print("```\n")


if __name__ == "__main__":
    main()
