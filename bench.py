"""Benchmark: run every registered query on ``$BENCH_SF_DIR`` and print one JSON line.

Each query is executed in full through the ``noop`` sink (all rows computed,
nothing collected to the driver). A short warm-up runs first so JVM start-up
and first codegen are not charged to the first query.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma list, default all), BENCH_REPEAT (default 3, median of n; a query
     that has taken LONG seconds in all is not run again)
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlight.plans.catalog import load_all  # noqa: E402
from ledgerlight.session import build_session  # noqa: E402


LONG = 12.0


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="ledgerlight-bench",
                          extra={"spark.driver.memory": "16g"})
    reg = load_all()
    names = [n for n in reg if not only or n in only]

    for warm in ("error_ratio", "finalise"):
        if warm in reg:
            run(reg[warm].build(spark, sf_dir))

    times: dict[str, float] = {}
    for name in names:
        took = []
        while len(took) < repeat and sum(took) < LONG:
            t0 = time.perf_counter()
            run(reg[name].build(spark, sf_dir))
            took.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(took), 3)
    spark.stop()

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
