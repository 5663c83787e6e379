"""Time the headline queries: one JSON line on stdout."""

import json
import os
import sys
import time

from thermocline.plans.catalog import QUERIES
from thermocline.session import build_session

HEADLINE = [
    "qc_share_good", "qc_all_tests", "clean_chain", "correct_physics_chain", "correct_optics_chain", "correct_oxygen_lag",
    "sync_sensors", "detect_profiles", "grid_profiles", "grid_time_bins", "section_mixed_layer_depth", "measurement_long",
    "wide_view", "idempotent_load", "profile_tests",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", "bench",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in (sys.argv[1:] or HEADLINE)]
    QUERIES["flag_merge"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm up
    times = {}
    for name in names:
        start = time.perf_counter()
        # noop writes every row of the result without keeping it
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total wall time of headline queries", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
