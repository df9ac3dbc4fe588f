"""Hot-key probe: a third of all price rows moved onto one code, then the
per-code forward fill run with and without month segments; and a third of
the rows made copies of one (code, date), then keep-first run as a
map-side-combined aggregate and as a row_number window.  Task sizes come
from Spark's event log (written to a fresh scratch folder, no UI).

    python tools/skew_probe.py [sf_dir]

Prints, per variant, the largest number of shuffle records one task read
and the wall time.
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

from bourse.operators.keys import keep_first  # noqa: E402
from bourse.operators.series import ffill  # noqa: E402
from bourse.plans import adapters as A  # noqa: E402
from bourse.session import get_session  # noqa: E402


def task_records(log_dir: str) -> dict[int, list[int]]:
    """Shuffle records read per task, grouped by job group description."""
    out: dict[int, list[int]] = {}
    stage_job: dict[int, int] = {}
    for path in glob.glob(f"{log_dir}/**", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = int(ev["Properties"].get("spark.job.description", "-1")
                                             if ev["Properties"].get("spark.job.description", "")
                                             .isdigit() else -1)
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    rec = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    out.setdefault(stage_job.get(ev["Stage ID"], -1), []).append(rec)
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="bourse-eventlog-", dir="/tmp")
    # 64 reducers and no coalescing, so the hash spread is visible at small scale
    spark = get_session("local[8]", 64, extra={"spark.eventLog.enabled": "true",
                                              "spark.sql.adaptive.coalescePartitions.enabled":
                                                  "false",
                                              "spark.eventLog.dir": log_dir,
                                              "spark.eventLog.compress": "false",
                                              "spark.eventLog.rolling.enabled": "false"})
    p = A.prices(spark, sf)
    # one code takes every third order: a third of all rows on one key
    hot = p.withColumn("code", F.when(F.col("rid") % 3 == 0, F.lit("000001"))
                       .otherwise(F.col("code")))
    base = hot   # (code, date) repeats: order by (date, rid), no dedup
    n_hot = base.filter(F.col("code") == "000001").count()
    results = {}
    for job_id, (label, seg) in enumerate([("segmented (month)", "month"),
                                           ("unsegmented", None)], start=1):
        spark.sparkContext.setJobDescription(str(job_id))
        t0 = time.perf_counter()
        ffill(base, "code", ["date", "rid"], ["close"], segment=seg) \
            .write.format("noop").mode("overwrite").save()
        results[job_id] = (label, time.perf_counter() - t0)
    # a group of copies: every third order becomes a copy of one (code, date)
    copies = p.withColumn("code", F.when(F.col("rid") % 3 == 0, F.lit("000001"))
                          .otherwise(F.col("code"))) \
              .withColumn("date", F.when(F.col("rid") % 3 == 0, F.lit("1995-01-02").cast("date"))
                          .otherwise(F.col("date")))
    w = Window.partitionBy("code", "date").orderBy("rid")
    for job_id, (label, fn) in enumerate([
            ("keep-first (min_by)", lambda: keep_first(copies, ["code", "date"], ["rid"])),
            ("keep-first (row_number)", lambda: copies.withColumn(
                "rn", F.row_number().over(w)).filter("rn = 1").drop("rn"))], start=3):
        spark.sparkContext.setJobDescription(str(job_id))
        t0 = time.perf_counter()
        fn().write.format("noop").mode("overwrite").save()
        results[job_id] = (label, time.perf_counter() - t0)
    spark.sparkContext.setJobDescription(None)
    spark.stop()
    recs = task_records(log_dir)
    print(f"rows on the hot code (and, below, copies of one (code, date)): {n_hot}")
    for job_id, (label, secs) in results.items():
        r = recs.get(job_id, [0])
        print(f"{label:20s} max shuffle records per task {max(r):7d}  "
              f"tasks {len(r):4d}  wall {secs:.2f}s")


if __name__ == "__main__":
    main()
