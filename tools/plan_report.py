"""Write PLANS.md: the final (adaptive) physical plan shape of every headline query.

For each query over the day-partitioned store: shuffles by kind, broadcasts, top-k
nodes, codegen stages, and per scan the columns read, pushed filters and partition
filters. usage: python tools/plan_report.py [sf_dir] [out.md]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import headline  # noqa: E402
from stationlake.session import get_spark  # noqa: E402
from stationlake.sources.fixtures import readings  # noqa: E402
from stationlake.sources.store import read_store, write_store  # noqa: E402


def final_only(plan: str) -> str:
    """Drop every '== Initial Plan ==' block (top level and inside subqueries)."""
    keep, skip_indent = [], None
    for line in plan.split("\n"):
        indent = len(line) - len(line.lstrip(" :|+-"))
        if skip_indent is not None:
            if indent > skip_indent:
                continue
            skip_indent = None
        if "== Initial Plan ==" in line:
            skip_indent = indent
            continue
        keep.append(line)
    return "\n".join(keep)


def summarize(plan: str) -> dict:
    final = final_only(plan)
    scans = []
    for line in final.split("\n"):
        if "FileScan parquet" in line:
            cols = re.search(r"FileScan parquet \[([^\]]*)\]", line)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            part = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", line)
            scans.append({
                "columns": cols.group(1).split(",") if cols else [],
                "pushed": (pushed.group(1)[:160] if pushed else ""),
                "partition": "yes" if part and part.group(1).strip() else "no",
            })
    seen = set()
    uniq = []
    for s in scans:
        k = (tuple(c.split("#")[0] for c in s["columns"]), s["pushed"].split("#")[0], s["partition"])
        if k not in seen:
            seen.add(k)
            uniq.append(s)
    def distinct(pattern: str) -> int:
        # a reused subquery is printed again at each use; its exchanges keep their plan id
        return len(set(re.findall(pattern + r".*?\[plan_id=(\d+)\]", final)))

    return {
        "hash shuffles": distinct(r"Exchange hashpartitioning"),
        "range shuffles": distinct(r"Exchange rangepartitioning"),
        "single-partition": distinct(r"Exchange SinglePartition"),
        "broadcasts": distinct(r"BroadcastExchange"),
        "joins": sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)", final))),
        "top-k": "TakeOrderedAndProject" in final,
        "codegen stages": len(set(re.findall(r"\*\((\d+)\)", final))),
        "python": bool(re.search(r"ArrowEvalPython|BatchEvalPython", final)),
        "scans": uniq,
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(os.path.dirname(os.path.dirname(
        os.path.abspath(__file__))), "PLANS.md")
    spark = get_spark("local[8]", 8, extra={"spark.sql.maxMetadataStringLength": "4000"})
    path = os.path.join(tempfile.mkdtemp(prefix="stationlake-plans-"), "store")
    write_store(readings(spark, sf_dir), path)
    store = read_store(spark, path)
    lines = ["# PLANS", "",
             f"Final adaptive plans of the headline queries over the day-partitioned store built from "
             f"`{sf_dir}` (generated by `tools/plan_report.py`). Jobs, stages and tasks are those that "
             f"ran (status tracker) while the result was computed; the latest event time is a subquery "
             f"over the newest day and counted here.", ""]
    sc = spark.sparkContext
    tracker = sc.statusTracker()
    for name, fn in headline(store).items():
        df = fn()
        sc.setJobGroup(name, name)
        df.collect()
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(name)]
        stages = [st for j in jobs if j for st in j.stageIds]
        infos = [tracker.getStageInfo(st) for st in stages]
        ran = [i for i in infos if i and i.numTasks > 0]
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        lines.append(f"## {name}")
        lines.append("")
        lines.append(f"- executed: {len(jobs)} jobs, {len(ran)} stages, "
                     f"{sum(i.numTasks for i in ran)} tasks (subqueries included); "
                     f"shuffle kinds: {', '.join(k for k in ('hash', 'range') if s[k + ' shuffles']) or 'none'}; "
                     f"broadcast exchanges: {'yes' if s['broadcasts'] else 'no'}; "
                     f"joins: {', '.join(s['joins']) or 'none'}")
        lines.append(f"- top-k node: {'yes' if s['top-k'] else 'no'}; codegen stages: {s['codegen stages']}; "
                     f"Python evaluation: {'yes' if s['python'] else 'no'}")
        for scan in s["scans"]:
            cols = ", ".join(c.split("#")[0] for c in scan["columns"])
            pushed = re.sub(r"#\d+", "", scan["pushed"])
            lines.append(f"- scan reads [{cols}]; partition filter: {scan['partition']}; pushed: [{pushed}]")
        lines.append("")
    with open(out, "w") as f:
        f.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
