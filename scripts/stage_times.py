"""Per-stage wall times of registered queries, from Spark's event log.

Usage: python scripts/stage_times.py [sf_dir] name [name ...]
Runs each query through the ``noop`` sink with the event log written to a
new scratch folder (no UI, no server) and prints stages that took > 0.5 s.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from linkqueries.queries import QUERIES  # noqa: E402
from privlink.session import REQUIRED_CONF  # noqa: E402


def _lines(path):
    if path.endswith(".zstd"):
        import zstandard

        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(path, "rb")), encoding="utf-8")
    return open(path, encoding="utf-8")


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="privlink-stages-")
    ev = os.path.join(scratch, "events")
    os.makedirs(ev)
    b = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", ev)
        .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoint"))
    )
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for name in args:
        spark.sparkContext.setJobDescription(name)
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.perf_counter() - t0:.2f} s")
    spark.stop()
    desc = {}
    for path in glob.glob(os.path.join(ev, "**", "*"), recursive=True):
        if os.path.isdir(path) or "appstatus" in path or path.endswith(".crc"):
            continue
        for line in _lines(path):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                d = (e.get("Properties") or {}).get("spark.job.description")
                for s in e["Stage IDs"]:
                    desc[s] = d
            elif e["Event"] == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                took = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
                if took > 0.5:
                    print(f"  {desc.get(si['Stage ID'])}: stage {si['Stage ID']}, {si['Number of Tasks']} tasks, {took:.2f} s")


if __name__ == "__main__":
    main()
