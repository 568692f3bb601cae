"""Summarise the final (AQE) physical plans of all jobs of every catalogue query into PLANS.md.

Usage: python tools/check_oracle.py --events DIR [sf_dir]; python tools/plan_report.py DIR > PLANS.md
Reads the event log of that run.  Counts per query, over every plan it executed (tables written
on the way, fits, lookups and the result): shuffles by kind, broadcasts, reused exchanges, join
strategies, aggregates, windows, Python evaluation nodes, and scans with pushed filters.
"""

import glob
import json
import re
import sys

PATTERNS = [
    ("hash shuffle", r"Exchange hashpartitioning"),
    ("range shuffle", r"Exchange rangepartitioning"),
    ("single-partition shuffle", r"Exchange SinglePartition"),
    ("broadcast", r"BroadcastExchange"),
    ("reused", r"ReusedExchange"),
    ("BHJ", r"BroadcastHashJoin"),
    ("SMJ", r"SortMergeJoin"),
    ("BNLJ", r"BroadcastNestedLoopJoin"),
    ("cartesian", r"CartesianProduct"),
    ("hash agg", r"HashAggregate\(keys=\[[^\]]"),
    ("sort agg", r"SortAggregate"),
    ("window", r"\bWindow \["),
    ("group limit", r"WindowGroupLimit"),
    ("python", r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas|MapInArrow|FlatMap(?:Co)?GroupsInArrow"),
]


SQL = "org.apache.spark.sql.execution.ui.SparkListenerSQL"


def nodes(info: dict) -> list[str]:
    own = [] if info["nodeName"] == "AdaptiveSparkPlan" else [info["simpleString"]]
    return own + [x for child in info["children"] for x in nodes(child)]


def summarise(plans: list[list[str]]) -> dict:
    text = "\n".join(x for plan in plans for x in plan)
    out = {k: len(re.findall(p, text)) for k, p in PATTERNS}
    out["pushed filters"] = len(re.findall(r"PushedFilters: \[(?!\])", text))
    out["scans"] = text.count("FileScan")
    return {"plans": len(plans)} | out


def main():
    executed: dict[int, tuple[str, list[str]]] = {}
    for path in glob.glob(f"{sys.argv[1]}/*"):
        for line in open(path):
            event = json.loads(line)
            if event["Event"] == SQL + "ExecutionStart":
                executed[event["executionId"]] = event["description"], nodes(event["sparkPlanInfo"])
            elif event["Event"] == SQL + "AdaptiveExecutionUpdate":  # the last one is the final plan
                executed[event["executionId"]] = executed[event["executionId"]][0], nodes(event["sparkPlanInfo"])
    by_query: dict[str, list] = {}
    for name, plan in executed.values():
        if name.startswith("query "):
            by_query.setdefault(name[6:], []).append(plan)
    cols = ["plans"] + [k for k, _ in PATTERNS] + ["pushed filters", "scans"]
    print("# Physical plans of the query catalogue\n")
    print("Final AQE plans at `sf0.01` (`tools/plan_report.py`), counted per node type over all plans that a "
          "query executes. Single-row global aggregates (counts, sizes, accuracies) show one "
          "single-partition shuffle of partial states each. Small frames built from "
          "literals or the catalog (rules, ranges, offsets, one row per partition) "
          "account for the broadcasts.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|---" * (len(cols) + 1) + "|")
    for name, plans in by_query.items():
        s = summarise(plans)
        print(f"| {name} | " + " | ".join(str(s[c]) if s[c] else "" for c in cols) + " |")


if __name__ == "__main__":
    main()
