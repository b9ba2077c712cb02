"""Benchmark: curate the test tables once, then run every registered query.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_MEM (driver heap, default 4g). Prints one JSON line.
Each query is executed fully with the no-op sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    mem = os.environ.get("BENCH_MEM", "4g")
    extra_conf = dict(kv.split("=", 1) for kv in os.environ.get("BENCH_CONF", "").split(",") if "=" in kv)
    from kassa.session import build_session
    spark = build_session(f"local[{cpus}]", app="kassa-bench", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": mem, "spark.ui.showConsoleProgress": "false", **extra_conf})
    spark.sparkContext.setLogLevel("ERROR")
    from kassa.plans.curated import curated_from_testdata
    from kassa.plans.queries import REGISTRY

    timings: dict[str, float] = {}
    t0 = time.time()
    curated_from_testdata(spark, sf_dir)  # build + materialise once per session
    timings["curate"] = round(time.time() - t0, 3)
    only = [a for a in sys.argv[1:]]
    for name, fn in REGISTRY.items():
        if only and name not in only:
            continue
        print(f"running {name}", file=sys.stderr, flush=True)
        t = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - t, 3)
    total = round(sum(timings.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_time_all_queries", "value": total, "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": cpus}))
    from kassa.session import release
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
