"""Per-operator SQL metrics of the last query in a Spark event log (no UI needed).

Usage: python scripts/plan_metrics.py <event-log-file> [min_ms]
Prints the plan tree of every SQL execution with its time metrics (duration, sort time, ...).
"""

from __future__ import annotations

import json
import os
import sys


def _open(f):
    if f.endswith(".zstd"):
        import io
        import zstandard
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(f, "rb")), encoding="utf-8")
    return open(f, encoding="utf-8")


def main():
    path = sys.argv[1]
    min_ms = float(sys.argv[2]) if len(sys.argv) > 2 else 50
    plans, values = {}, {}
    files = [path] if os.path.isfile(path) else sorted(
        os.path.join(path, f) for f in os.listdir(path) if f.startswith("events"))
    lines = (ln for f in files for ln in _open(f))
    for line in lines:
        e = json.loads(line)
        ev = e.get("Event", "")
        if ev.endswith("SparkListenerSQLExecutionStart") or ev.endswith("SparkListenerSQLAdaptiveExecutionUpdate"):
            plans[e["executionId"]] = e["sparkPlanInfo"]
        elif ev == "SparkListenerStageCompleted":
            for acc in e["Stage Info"].get("Accumulables", []):
                try:
                    values[acc["ID"]] = values.get(acc["ID"], 0) + float(acc["Value"])
                except (TypeError, ValueError):
                    pass
        elif ev.endswith("SparkListenerDriverAccumUpdates"):
            for aid, v in e["accumUpdates"]:
                values[aid] = values.get(aid, 0) + float(v)

    def walk(node, depth):
        ms = []
        for m in node.get("metrics", []):
            v = values.get(m["accumulatorId"])
            if v and m["metricType"] in ("timing", "nsTiming"):
                v = v / 1e6 if m["metricType"] == "nsTiming" else v
                if v >= min_ms:
                    ms.append(f"{m['name']}={v:.0f}ms")
            elif v and m["name"] in ("number of output rows",):
                ms.append(f"rows={int(v)}")
        print("  " * depth + node["nodeName"][:60] + ("  [" + ", ".join(ms) + "]" if ms else ""))
        for c in node.get("children", []):
            walk(c, depth + 1)

    for eid in sorted(plans)[-int(sys.argv[3]) if len(sys.argv) > 3 else -1:]:
        print(f"=== execution {eid}")
        walk(plans[eid], 0)


if __name__ == "__main__":
    main()
