"""Time the monthly job step by step on about 11 million trips.

    python tools/bench_jobs.py [table_dir] [copies] [work_dir]

The trips are the order book of ``table_dir`` repeated ``copies`` times (19
copies of sf0.1 are 11.4 million rows), first written as headerless text, so
that every step starts from files as the published timings did.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripflow.operators import counts, enrich  # noqa: E402
from tripflow.plans import jobs  # noqa: E402
from tripflow.session import build_session  # noqa: E402
from tripflow.sinks import tables  # noqa: E402
from tripflow.sources import files, orderbook  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 19
    root = sys.argv[3] if len(sys.argv) > 3 else tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session(
        "bench-jobs", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def step(name, action):
        started = time.perf_counter()
        result = action()
        seconds[name] = round(time.perf_counter() - started, 2)
        return result

    zones = orderbook.zones(spark, sf_dir).cache()
    zones.count()
    text = enrich.with_text_times(orderbook.raw_trips(spark, sf_dir))
    many = text.selectExpr("*", f"explode(sequence(1, {copies})) AS copy")
    step("prepare_text", lambda: many.drop("copy").write.csv(f"{root}/raw_text"))

    raw = files.read_trips_text(spark, f"{root}/raw_text")
    counted = step("clean", lambda: jobs.run_clean(spark, raw, f"{root}/clean/trips"))
    clean = files.read_trips(spark, f"{root}/clean/trips")
    step("enrich", lambda: jobs.run_enrich(spark, clean, zones, f"{root}/clean/trips_enriched"))
    fact = files.read_fact(spark, f"{root}/clean/trips_enriched")
    step("count_fact", fact.count)
    for name, result in jobs.answers(fact, zones, orderbook.AIRPORT_ZONES).items():
        step(name, lambda r=result, n=name: tables.store(r, f"{root}/results/{n}"))
    for name in jobs.answers(fact, zones):
        stored = spark.read.parquet(f"{root}/results/{name}")
        step(f"export_{name}", lambda r=stored, n=name: tables.export_text(r, f"{root}/export/{n}", True))
    step("trips_per_zone_hour", lambda: tables.store(counts.trips_per_zone_hour(clean), f"{root}/zone_hour"))
    print(json.dumps({"rows": counted, "seconds": seconds, "work_dir": root}))
    spark.stop()


if __name__ == "__main__":
    main()
