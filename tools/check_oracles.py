"""Run every registered query against its DuckDB oracle (like the driver's gate).

usage: python tools/check_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tests"))

from ledgerlight.plans.catalog import load_all  # noqa: E402
from ledgerlight.session import build_session  # noqa: E402
from oracle import compare, duck  # noqa: E402


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    extra = {"spark.driver.memory": "8g"}
    if os.environ.get("CHECK_TZ"):            # results must not depend on the session zone
        extra["spark.sql.session.timeZone"] = os.environ["CHECK_TZ"]
    spark = build_session("local[8]", shuffle_partitions=8, extra=extra)
    con = duck(sf_dir)
    reg = load_all()
    bad = 0
    for name, q in reg.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = q.build(spark, sf_dir)
            if q.sql is None:
                n = df.count()
                ok, msg = True, f"{n} rows (no oracle)"
            else:
                ok, msg = compare(df, con, q.sql)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:24s} {time.time() - t0:6.2f}s  {msg}", flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
