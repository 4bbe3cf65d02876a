"""Scaling probe: the skewed workload of ``skew_probe.py`` at 1x and 10x.

The 10x table replicates every lineitem row ten times (``explode`` of a
10-element sequence, each copy with its own id), keeping one key with a third
of all rows. Reports wall time and the largest task's input per operator,
from Spark's event log in a fresh scratch folder. Prints a Markdown table.

Usage: python scripts/scale_probe.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="regpanel-scale-", dir="/tmp")
    logdir = os.path.join(scratch, "events")
    os.makedirs(logdir)
    from pyspark.sql import functions as F

    from regpanel.operators import intervals as iv
    from regpanel.session import build_session
    spark = build_session(shuffle_partitions=32, scratch_dir=os.path.join(scratch, "ckpt"),
                          extra={"spark.eventLog.enabled": "true",
                                 "spark.eventLog.dir": "file:" + logdir,
                                 "spark.eventLog.compress": "false",
                                 "spark.eventLog.rolling.enabled": "false"})
    li = spark.read.parquet(f"{sf}/lineitem.parquet")

    def table(copies):
        base = li.select("*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("_copy"))
        return base.select(
            F.when(F.col("l_orderkey") % 3 == 0, F.lit(0))
             .otherwise(F.col("l_orderkey") * 100 + F.col("_copy")).alias("k"),
            F.col("l_shipdate").alias("ts"),
            F.xxhash64(*li.columns, "_copy").alias("uid"),
            F.when(F.col("l_partkey") % 4 == 0, F.col("l_quantity")).alias("v"),
            "l_returnflag")

    ops = {
        "W1 buckets": lambda d: iv.next_known_fill(d, "k", ["ts", "uid"], "v", "f"),
        "W1 per-key window": lambda d: iv.next_known_fill(d, "k", ["ts", "uid"], "v", "f",
                                                         method="window"),
        "W2 hull": lambda d: iv.state_hull(d, ["k", "l_returnflag"], "ts", carry=["v"],
                                           tiebreak=["uid"]),
        "W3 latest": lambda d: iv.latest_revision(d, ["k"], "ts", tiebreak=["uid"]),
    }
    spark.sparkContext.setJobDescription("warm-up")
    ops["W1 buckets"](table(1).limit(1000)).write.format("noop").mode("overwrite").save()
    walls = {}
    for copies in (1, 10):
        d = table(copies)
        for name, op in ops.items():
            label = f"{name} x{copies}"
            spark.sparkContext.setJobDescription(label)
            t0 = time.perf_counter()
            op(d).write.format("noop").mode("overwrite").save()
            walls[label] = time.perf_counter() - t0
    spark.stop()

    stage_desc, reads = {}, {}
    for path in glob.glob(os.path.join(logdir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path, encoding="utf-8", errors="replace") as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    for sid in ev.get("Stage IDs", []):
                        stage_desc[sid] = desc
                elif ev.get("Event") == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    r = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    reads.setdefault(stage_desc.get(ev["Stage ID"]), []).append(r)

    print(f"Scale probe on {sf}/lineitem, one key = a third of all rows, 32 partitions.\n")
    print("| operator | wall s (x1) | wall s (x10) | ratio | max task records (x1) | "
          "max task records (x10) |")
    print("|---|---|---|---|---|---|")
    for name in ops:
        a, b = walls[f"{name} x1"], walls[f"{name} x10"]
        ra = max(reads.get(f"{name} x1", [0]))
        rb = max(reads.get(f"{name} x10", [0]))
        print(f"| {name} | {a:.2f} | {b:.2f} | {b / a:.1f} | {ra} | {rb} |")


if __name__ == "__main__":
    main()
