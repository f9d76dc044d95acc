"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver). Prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odspark.registry import all_queries  # noqa: E402
from odspark.session import get_session  # noqa: E402
from odspark.sources.fixtures import ORDER, fixture, register_fixtures  # noqa: E402

HEADLINE = [
    "zone_counts",          # flagship: J1 → J8 → J4 → F4 → per-site zone counts
    "j1_request_pairs",     # J1 all origin-destination pairs
    "f6_request_chunks",    # F6 chunk ids without a single-partition window
    "j3_remaining",         # J3 resume anti join
    "v1_scd2_diff",         # V1 SCD2 diff
    "v5_snapshot",          # V5 publish snapshot
    "w29_car_ways",         # W29 car rule chain over all ways
    "b_bicycle_ways",       # bicycle rule chain
    "e2_car_edges",         # E1/E2 directed car edges
    "d1_industrial_speed",  # D1 grid-bucket distance join
    "e6_routes",            # E6 many-to-many shortest durations
    "e5_snap_postal",       # E5 nearest network node of every postal point
    "l4_match_refs",        # L4 relation refs per way
    "t1_stream_answers",    # T1-T4 request folder as a stream
    "e7_route_answers",     # E7 route answers of every request pair
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    register_fixtures(spark, sf_dir)
    # JVM warm-up (class loading, first job), not part of any query
    spark.range(1000).selectExpr("sum(id)").collect()
    for name in ORDER:  # input tables are written before the clock starts
        fixture(spark, sf_dir, name)
    qs = all_queries()
    names = [a for a in sys.argv[1:]] or HEADLINE
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
