"""Skew probe: one key holds a third of all rows.

Builds a table from lineitem (whole table) where every row with
``l_orderkey % 3 = 0`` gets key 0, runs the operators that group or order by
that key, and reads per-task shuffle input and duration from Spark's event
log (written to a fresh scratch folder). Prints a Markdown table.

Usage: python scripts/skew_probe.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="regpanel-skew-", dir="/tmp")
    logdir = os.path.join(scratch, "events")
    os.makedirs(logdir)
    from pyspark.sql import functions as F

    from regpanel.operators import intervals as iv
    from regpanel.operators.quality import spearman
    from regpanel.session import build_session
    spark = build_session(shuffle_partitions=16, scratch_dir=os.path.join(scratch, "ckpt"),
                          extra={"spark.eventLog.enabled": "true",
                                 "spark.eventLog.dir": "file:" + logdir,
                                 "spark.eventLog.compress": "false",
                                 "spark.eventLog.rolling.enabled": "false"})
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    df = li.select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey")).alias("k"),
        F.col("l_shipdate").alias("ts"),
        F.xxhash64(*li.columns).alias("uid"),
        F.when(F.col("l_partkey") % 4 == 0, F.col("l_quantity")).alias("v"),
        "l_quantity", "l_extendedprice", "l_returnflag")

    total_rows = df.count()
    hot_rows = df.filter(F.col("k") == 0).count()
    runs = {
        "W1 next-known fill, order buckets (default)":
            lambda: iv.next_known_fill(df, "k", ["ts", "uid"], "v", "f"),
        "W1 next-known fill, per-key window": lambda: iv.next_known_fill(
            df, "k", ["ts", "uid"], "v", "f", method="window"),
        "W2 state hull (aggregate)": lambda: iv.state_hull(
            df, ["k", "l_returnflag"], "ts", carry=["v"], tiebreak=["uid"]),
        "W3 latest revision (row_number = 1, map-side partial limit)":
            lambda: iv.latest_revision(df, ["k"], "ts", tiebreak=["uid"]),
        "W3 latest revision (aggregate)": lambda: iv.latest_revision(
            df, ["k"], "ts", tiebreak=["uid"], method="aggregate"),
        "A12 Spearman by key (order buckets)": lambda: spearman(
            df, "l_quantity", "l_extendedprice", ["k"]),
    }
    # Warm-up (JIT), not reported.
    spark.sparkContext.setJobDescription("warm-up")
    iv.next_known_fill(df.limit(1000), "k", ["ts", "uid"], "v", "f", method="bucketed") \
        .write.format("noop").mode("overwrite").save()
    walls = {}
    for name, make in runs.items():
        spark.sparkContext.setJobDescription(name)
        t0 = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        walls[name] = time.perf_counter() - t0
    spark.stop()

    stage_desc, tasks = {}, {}
    for path in glob.glob(os.path.join(logdir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path, encoding="utf-8", errors="replace") as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    for sid in ev.get("Stage IDs", []):
                        stage_desc[sid] = desc
                elif kind == "SparkListenerTaskEnd":
                    info, m = ev["Task Info"], ev.get("Task Metrics") or {}
                    rd = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    dur = info["Finish Time"] - info["Launch Time"]
                    tasks.setdefault(ev["Stage ID"], []).append((rd, dur))

    print(f"Skew probe on {sf}/lineitem: one key holds {hot_rows} of {total_rows} rows. "
          "Largest task input = most shuffle records read by one task in any stage "
          "of the operator.\n")
    print("| operator | wall s | stages | largest task input (records) | "
          "largest / hot-key rows | largest stage: max / median task |")
    print("|---|---|---|---|---|---|")
    for name in runs:
        stages = [sid for sid in tasks if stage_desc.get(sid) == name]
        reads = {sid: [r for r, _ in tasks[sid]] for sid in stages}
        reads = {sid: r for sid, r in reads.items() if max(r) > 0}
        if not reads:
            print(f"| {name} | {walls[name]:.2f} | 0 | - | - | - |")
            continue
        sid = max(reads, key=lambda x: max(reads[x]))
        top = max(reads[sid])
        med = statistics.median(reads[sid]) or 1
        print(f"| {name} | {walls[name]:.2f} | {len(reads)} | {top} | "
              f"{top / hot_rows:.2f} | {top / med:.1f} |")


if __name__ == "__main__":
    main()
