"""Headline queries on local cores; prints one JSON line. Each is run once to warm up; of the next three runs the median counts.

Queries over LONG seconds in the first run are timed once more only.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skyfold.plans.registry import REGISTERED  # noqa: E402
from skyfold.session import build_session  # noqa: E402

LONG = 5
HEADLINE = [
    "unique_catalog", "match_1arcsec", "radius_pairs", "nearest_ref", "calibrated_mags", "coadd_mag", "coadd_coords", "best_epoch", "derive_zeropoints", "healpix_index",
    "kde_mode", "split_states", "nearest_other", "colour_locus", "calibrate_exposures", "calibrate_whole", "depth_map",
]


def run_query(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTERED[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(cores, "skyfold-bench", shuffle_partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        first = run_query(spark, name, sf_dir)
        seconds[name] = median(run_query(spark, name, sf_dir) for _ in range(1 if first > LONG else 3))
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf")}))


if __name__ == "__main__":
    main()
