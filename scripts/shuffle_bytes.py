"""Shuffle bytes and records written per registered query, from Spark's event log.

usage: python scripts/shuffle_bytes.py EVENT_LOG_DIR [SF_DIR] [name ...]
"""

from __future__ import annotations

import glob
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shuffle_totals(event_dir: str) -> dict[str, tuple[int, int]]:
    stage_group: dict[int, str] = {}
    totals: dict[str, tuple[int, int]] = {}
    for path in glob.glob(os.path.join(event_dir, "*", "events_*")):
        with open(path) as fh:
            for line in fh:
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in e["Stage IDs"]:
                        stage_group[sid] = g
                elif e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                    g = stage_group.get(e["Stage ID"])
                    w = e["Task Metrics"]["Shuffle Write Metrics"]
                    b, r = totals.get(g, (0, 0))
                    totals[g] = (b + w["Shuffle Bytes Written"], r + w["Shuffle Records Written"])
    return totals


def main() -> None:
    from shopstream.plans.registry import QUERIES
    from shopstream.session import build_session

    event_dir = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    names = sys.argv[3:] or ["window_stats", "window_stats_expand", "window_stats_approx"]
    spark = build_session(master="local[8]", extra_conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir,
        "spark.eventLog.compress": "false"})
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()
    for name, (b, r) in shuffle_totals(event_dir).items():
        if name in names:
            print(f"{name}: shuffle_write_bytes={b} records={r}")


if __name__ == "__main__":
    main()
