"""Time the direct and the skew-safe forms on a table where one key holds a third of the rows.

Builds (with Spark, into a scratch folder) ten copies of sf0.1 lineitem in which every third row
has supplier 1 and one ship date: one (supplier, day) group then holds a third of the rows.
Prints one JSON line: per form the best wall time of three runs, and from Spark's event log (written to
the scratch folder) the longest single task and the summed task time of one run.  The longest task is
what bounds a stage when there are many more cores than groups.  Run:
``python tools/skew_demo.py [scratch_dir]``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from framewright.operators import joins, windows  # noqa: E402
from framewright.session import local_session  # noqa: E402


def task_stats(log_dir: str) -> dict:
    """Longest task and summed task time per job group, from the event log."""
    stage_group, tasks = {}, {}
    paths = [os.path.join(d, f) for d, _, names in os.walk(log_dir) for f in names if f.startswith("events")]
    for path in sorted(paths):                   # rolling event log: a folder of event files
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    info = ev["Task Info"]
                    tasks.setdefault(ev["Stage ID"], []).append(info["Finish Time"] - info["Launch Time"])
    out = {}
    for sid, durations in tasks.items():
        group = stage_group.get(sid)
        if group:
            g = out.setdefault(group, {"longest_task_ms": 0, "task_ms": 0})
            g["longest_task_ms"] = max(g["longest_task_ms"], max(durations))
            g["task_ms"] += sum(durations)
    return out


def best(f, runs=3):
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        f().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t0)
    return round(min(times), 3)


def main() -> None:
    scratch = sys.argv[1] if len(sys.argv) > 1 else tempfile.mkdtemp(prefix="fw-skew-demo-")
    # AQE splits a skewed partition only above 256 MB by default; the demo's data is ~1000x smaller
    # than a cluster's, so the thresholds are scaled down with it.
    log_dir = os.path.join(scratch, "eventlog")
    os.makedirs(log_dir, exist_ok=True)
    spark = local_session(extra={"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4m",
                                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
                                 "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false"})
    src = spark.read.parquet(os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1") + "/lineitem.parquet")
    big = (src.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_shipdate")
           .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(9))))      # ten copies of each row
           .withColumn("hot", F.xxhash64("l_orderkey", "l_linenumber", "copy") % 3 == 0)
           .select((F.col("l_orderkey") * 10 + F.col("copy")).alias("l_orderkey"), "l_linenumber",
                   F.when(F.col("hot"), F.lit(1)).otherwise(F.col("l_suppkey")).alias("l_suppkey"),
                   "l_quantity",
                   F.when(F.col("hot"), F.lit("1996-01-01").cast("date")).otherwise(F.to_date("l_shipdate"))
                   .alias("ship_date")))
    path = os.path.join(scratch, "lineitem_hot")
    big.repartition(16).write.mode("overwrite").parquet(path)     # 16 files: parallel scans
    li = spark.read.parquet(path)
    rows, hot = li.count(), li.where("l_suppkey = 1 AND ship_date = DATE '1996-01-01'").count()

    keys = ["l_suppkey", "ship_date"]
    suppliers = li.select("l_suppkey").distinct().withColumnRenamed("l_suppkey", "s_key")
    forms = {
        "rank_window": lambda: windows.ranked_report_window(li, keys, "l_quantity"),
        "rank_counts": lambda: windows.ranked_report(li, keys, "l_quantity", method="counts"),
        "rank_slices": lambda: windows.ranked_report(li, keys, "l_quantity"),
        "full_join_spark": lambda: joins.outer_join(suppliers, li, [("s_key", "l_suppkey")], "full", skew_safe=False),
        "full_join_skew_safe": lambda: joins.outer_join(suppliers, li, [("s_key", "l_suppkey")], "full"),
    }
    res = {"rows": rows, "hot_group_rows": hot}
    for name, build in forms.items():
        res[name] = {"best_s": best(build)}
    for name, build in forms.items():            # one tagged run per form for the task statistics
        spark.sparkContext.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("other", "other")
    spark.stop()
    for name, stats in task_stats(log_dir).items():
        if name in res:
            res[name].update(stats)
    print(json.dumps(res))


if __name__ == "__main__":
    main()
