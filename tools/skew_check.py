"""Measure how a hot key is processed, on data where one key holds a third
of all rows:

* ``rank``: ranking rows inside groups with a plain window vs the
  range-split form (``operators.ordered.row_number_split``);
* ``nullkey``: a sort-merge lookup where the hot key is null, with and
  without the null-key salt of ``operators.facts.lookup``.

Task durations come from Spark's event log, written to a fresh scratch
folder.  Prints, per variant: wall time, number of tasks, longest task and
the longest task's share of all task time in the ranking stages.

    python tools/skew_check.py [rows] [rank|nullkey]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from starkit.operators.facts import lookup  # noqa: E402
from starkit.operators.ordered import row_number_split  # noqa: E402
from starkit.session import get_session  # noqa: E402


def task_stats(log_dir: str, job_group: str) -> dict:
    """Durations of the tasks of the jobs tagged with ``job_group``."""
    stages, durations = set(), []
    for path in glob.glob(f"{log_dir}/**/events_*", recursive=True):
        with open(path, "rb") as fh:
            raw = fh.read()
        if path.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(raw).read()
        events = [json.loads(line) for line in raw.decode().splitlines() if line.strip()]
        for e in events:
            if e["Event"] == "SparkListenerJobStart" and \
                    (e.get("Properties") or {}).get("spark.jobGroup.id") == job_group:
                stages.update(e["Stage IDs"])
        for e in events:
            if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stages:
                info = e["Task Info"]
                durations.append(info["Finish Time"] - info["Launch Time"])
    durations.sort()
    total = sum(durations) or 1
    return {"tasks": len(durations), "max_task_ms": durations[-1] if durations else 0,
            "max_share": round(durations[-1] / total, 3) if durations else 0.0}


def main(argv):
    rows = int(argv[1]) if len(argv) > 1 else 9_000_000
    case = argv[2] if len(argv) > 2 else "rank"
    log_dir = tempfile.mkdtemp(prefix="run-skew-", dir="/tmp")
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir}
    if case == "nullkey":  # force sort-merge joins: the dimension is "large"
        extra.update({"spark.sql.autoBroadcastJoinThreshold": "-1",
                      "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    spark = get_session("local[8]", 32, extra=extra)
    results = {}
    if case == "rank":
        df = (spark.range(rows)
              .select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
                          F.concat(F.lit("g"), (F.col("id") % 5000).cast("string"))).alias("g"),
                      (F.abs(F.xxhash64("id")) % 100000).alias("v"), "id"))
        order = [F.col("v").desc(), F.col("id").asc()]
        variants = [
            ("window", lambda: df.withColumn("rk", F.row_number().over(Window.partitionBy("g").orderBy(*order)))),
            ("split", lambda: row_number_split(df, ["g"], order, "rk")),
        ]
    else:
        fact = spark.range(rows).select(
            F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 1_000_000).alias("nk"), "id")
        dim = spark.range(1_000_000).select(F.col("id").alias("nk"), F.md5(F.col("id").cast("string")).alias("sk"))
        variants = [
            ("unsalted", lambda: lookup(fact, dim, "nk", "nk", "sk", null_key_spread=0)),
            ("salted", lambda: lookup(fact, dim, "nk", "nk", "sk")),
        ]
    for name, build in variants:
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        results[name] = {"wall_s": round(time.perf_counter() - t0, 2)}
    spark.sparkContext.setJobGroup("", "")
    spark.stop()
    for name in results:
        results[name].update(task_stats(log_dir, name))
    print(json.dumps({"case": case, "rows": rows, "hot_share": 1 / 3, **results}))


if __name__ == "__main__":
    main(sys.argv)
