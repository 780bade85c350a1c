"""Stage timeline of one registered query from Spark's event log (no UI, no server).

usage: python scripts/profile_stages.py <query> [sf_dir]
The event log goes to a fresh scratch folder; prints start offset, duration and
task count per stage of the measured run (a warm-up run comes first).
"""

from __future__ import annotations

import glob
import io
import json
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import zstandard  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from tillwise.registry import QUERIES  # noqa: E402
from tillwise.session import JOB_CONF  # noqa: E402


def main() -> None:
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    b = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "16g")
         .config("spark.sql.shuffle.partitions", "8").config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.dir", log_dir))
    for k, v in JOB_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["calendar_features"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    t0 = time.time() * 1000
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    total = time.time() * 1000 - t0
    spark.stop()
    stages = []
    for f in glob.glob(f"{log_dir}/*/events_*") + glob.glob(f"{log_dir}/*.zstd"):
        raw = open(f, "rb")
        text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
        for line in text:
            try:
                e = json.loads(line)
            except ValueError:
                continue
            if e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                if si["Submission Time"] >= t0:
                    stages.append((si["Submission Time"] - t0, si["Completion Time"] - si["Submission Time"],
                                   si["Stage ID"], si["Number of Tasks"]))
    print(f"{name}: {total:.0f} ms wall, {len(stages)} stages, event log in {log_dir}")
    for s in sorted(stages):
        print("start %6d ms  dur %6d ms  stage %4d  tasks %d" % s)


if __name__ == "__main__":
    main()
