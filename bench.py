"""Time every registered query; prints one JSON line.

Each query is built and fully computed twice in one session. The second time counts, so
session start-up and code generation of the first run do not.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from nearfield.plans import REGISTRY  # noqa: E402
from nearfield.session import local_session, ship_with_tasks  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    ship_with_tasks()
    spark = local_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")

    times, failed = {}, {}
    for name, (run, _) in REGISTRY.items():
        if only and name not in only:
            continue
        try:
            for _ in range(2):
                start = time.perf_counter()
                run(spark, sf_dir).write.format("noop").mode("overwrite").save()
                times[name] = round(time.perf_counter() - start, 3)
        except Exception as e:  # one broken query must not hide the others
            failed[name] = str(e)[:300]
            times.pop(name, None)
    out = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": cpus,
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
