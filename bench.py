"""Benchmark: run every composed job (``pip_*``) on one scale factor and print
one JSON line with per-query wall-clock seconds.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is fully materialised (its own writes, then a ``noop`` write of the
returned frame).  One untimed run of the flagship on the smallest data warms
the JVM first; that run is not part of any number.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bourse.plans.catalog import QUERIES  # noqa: E402
from bourse.plans.jobs import snp_stock_frame  # noqa: E402
from bourse.session import get_session  # noqa: E402

WARM_DIR = "/root/testdata/sf0.001"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:]]
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus,
                        extra={"spark.driver.memory": "16g"})
    if os.path.isdir(WARM_DIR):
        snp_stock_frame(spark, WARM_DIR).write.format("noop").mode("overwrite").save()

    names = only or [k for k in QUERIES if k.startswith("pip_") and not k.endswith("_rejects")]
    times, rows = {}, {}
    for name in names:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        rows[name] = df.count()
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    rate = {k: round(rows[k] / times[k]) if times[k] else None for k in times}
    print(json.dumps({"metric": "pip_total_wall", "value": total, "unit": "sec",
                      "queries": times, "rows": rows, "rows_per_sec": rate,
                      "total_rows_per_sec": round(sum(rows.values()) / total) if total else None,
                      "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
