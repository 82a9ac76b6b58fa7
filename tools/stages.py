"""Write STAGES.md: per-stage tasks, time, input and shuffle bytes of headline queries.

Runs the queries with Spark's event log written to a fresh scratch folder and
summarises the StageCompleted events, to show what crosses each shuffle.

    python tools/stages.py [sf_dir] [scratch_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

QUERIES = ["parse_good", "views_per_user", "views_per_country", "top_products_per_user",
           "sliding_top_products", "log_volume_per_minute", "prefix_dictionary"]


def _metric(info: dict, name: str) -> int:
    for acc in info.get("Accumulables", []):
        if acc.get("Name") == name:
            return int(acc.get("Value", 0))
    return 0


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    scratch = argv[2] if len(argv) > 2 else tempfile.mkdtemp(prefix="run-stages-", dir="/tmp")
    from hitlens.registry import BATCH_QUERIES
    from hitlens.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": scratch,
        "spark.eventLog.compress": "false"})
    for name in QUERIES:
        spark.sparkContext.setJobGroup(name, name)
        BATCH_QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    rows, group = [], {}
    paths = sorted(p for p in glob.glob(os.path.join(scratch, "**", "*"), recursive=True)
                   if os.path.isfile(p) and not os.path.basename(p).startswith("appstatus"))
    for path in paths:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    for sid in ev.get("Stage IDs", []):
                        group[sid] = props.get("spark.jobGroup.id", "?")
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    if info.get("Failure Reason"):
                        continue
                    rows.append((group.get(info["Stage ID"], "?"), info["Stage ID"],
                                 info["Number of Tasks"],
                                 info.get("Completion Time", 0) - info.get("Submission Time", 0),
                                 _metric(info, "internal.metrics.input.recordsRead"),
                                 _metric(info, "internal.metrics.shuffle.write.recordsWritten"),
                                 _metric(info, "internal.metrics.shuffle.write.bytesWritten")))
    out = ["# Stages", "",
           f"Completed stages of headline queries at `{sf_dir}`, local[8], from Spark's event log "
           "(written by `tools/stages.py`). Rows written to a shuffle show the map-side combine: "
           "aggregating stages ship one row per key and partition, not one per line.", "",
           "| query | stage | tasks | ms | input rows | shuffle rows written | shuffle bytes written |",
           "|---|---|---|---|---|---|---|"]
    for r in sorted(rows, key=lambda r: (QUERIES.index(r[0]) if r[0] in QUERIES else 99, r[1])):
        out.append("| " + " | ".join(str(x) for x in r) + " |")
    with open(os.path.join(ROOT, "STAGES.md"), "w") as fh:
        fh.write("\n".join(out) + "\n")


if __name__ == "__main__":
    main(sys.argv)
