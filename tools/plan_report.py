"""Write PLANS.md: a summary of the executed physical plan of each headline query.

For every query: shuffles (exchanges, reused exchanges), join strategies, aggregates, windows,
Python stages, and what reached each Parquet scan (pushed filters, read schema).  Two settings:
the session defaults at sf0.1, and broadcast joins disabled, which is what the plans look like
when no side is small (the 100 TB case).  Run: ``python tools/plan_report.py``.  A development tool for small scale factors: it collects each
result so the frame's own adaptive plan reaches its final form.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from bench import HEADLINE  # noqa: E402
from framewright.plans.catalog import load_all  # noqa: E402
from framewright.session import local_session  # noqa: E402

SF = os.environ.get("PLAN_SF_DIR", "/root/testdata/sf0.1")


def summarise(plan: str) -> dict:
    plan = plan.split("== Initial Plan ==")[0]          # the final adaptive plan only
    own = "\n".join(line for line in plan.splitlines() if "ReusedExchange" not in line)
    count = lambda pat, text=own: len(re.findall(pat, text))
    scans = []
    for line in plan.splitlines():
        if "FileScan parquet" in line:
            table = re.search(r"/([a-z_]+)\.parquet", line)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            schema = re.search(r"ReadSchema: struct<([^>]*)>", line)
            scans.append((table.group(1) if table else "?", pushed.group(1) if pushed else "",
                          schema.group(1) if schema else ""))
    return {
        "shuffles": count(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin"),
        "reused": count(r"ReusedExchange", plan),
        "broadcasts": count(r"BroadcastExchange"),
        "joins": sorted(set(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)"
                                       r"(?: \[[^\]]*\], \[[^\]]*\],)? ?(\w+)?", plan))),
        "aggregates": count(r"HashAggregate|ObjectHashAggregate|SortAggregate"),
        "windows": count(r"\bWindow \["),
        "python": count(r"EvalPython|ArrowEvalPython|BatchEvalPython"),
        "scans": scans,
    }


def main() -> None:
    spark = local_session()
    catalog = load_all()
    out = ["# PLANS", "", "Executed physical plans of the headline queries (generated by `tools/plan_report.py`).",
           "*Default*: session defaults at sf0.1.  *No broadcast*: `spark.sql.autoBroadcastJoinThreshold=-1`, the",
           "shape of the plan when no join side is small, as at 100 TB.  Shuffles count hash, range, single-partition",
           "and round-robin exchanges; reused exchanges are shuffles Spark performs once for two consumers.",
           "Probe jobs that run when a query is built are not part of its plan: `ranked_purchases` first counts",
           "rows per group (one partial aggregate); with no group above its bound it is then the single window.", ""]
    for name in HEADLINE:
        if name.startswith("stream_"):
            continue
        out += [f"## `{name}`", "", "| setting | shuffles | reused | broadcasts | joins | aggregates | windows | Python |",
                "| --- | --- | --- | --- | --- | --- | --- | --- |"]
        scans = None
        for label, threshold in (("default", None), ("no broadcast", "-1")):
            if threshold:
                spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            try:
                df = catalog[name].build(spark, SF)
                df.collect()
                s = summarise(df._jdf.queryExecution().executedPlan().toString())
            finally:
                spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            joins = ", ".join(f"{a} {b}".strip() for a, b in s["joins"]) or "—"
            out.append(f"| {label} | {s['shuffles']} | {s['reused']} | {s['broadcasts']} | {joins} | "
                       f"{s['aggregates']} | {s['windows']} | {s['python']} |")
            scans = scans or s["scans"]
        out += ["", "| scan | pushed filters | columns read |", "| --- | --- | --- |"]
        for table, pushed, schema in scans or []:
            cols = ", ".join(c.split(":")[0] for c in schema.split(",") if c)
            out.append(f"| {table} | {pushed or '—'} | {cols} |")
        out.append("")
    spark.stop()
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
