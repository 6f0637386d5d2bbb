"""Times the ten answers and the ingest; prints one JSON line.

The tables come from ``$BENCH_SF_DIR``. The derived offers (partsupp) are
written once beforehand, untimed, as the answers expect stored tables. Each
answer runs once cold and then ``$BENCH_RUNS`` times; the time reported is the
median of those. A run builds the plan and writes the whole result to Spark's
``noop`` sink.
"""

from __future__ import annotations

import json
import logging
import os
import statistics
import sys
import time
from datetime import date

from salesloom.checks.landing import land
from salesloom.plans import ANSWERS
from salesloom.session import fresh_folder, local_session, scratch
from salesloom.sources.given import GivenTables
from salesloom.sources.ingest import ingest

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CORES = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    logging.disable(logging.WARNING)
    spark = local_session(CORES, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    with scratch(spark):
        measure(spark)
    spark.stop()


def measure(spark) -> None:
    offers = fresh_folder(spark, "offers")
    given = GivenTables(spark, FOLDER)
    given["partsupp"].write.parquet(offers)
    tables = GivenTables(spark, FOLDER, offers)

    cold, warm, spread = {}, {}, {}
    for name, answer in ANSWERS.items():
        if len(sys.argv) > 1 and not name.startswith(tuple(sys.argv[1:])):
            continue

        def run(answer=answer):
            with scratch(spark):
                answer(tables).write.format("noop").mode("overwrite").save()

        cold[name] = round(timed(run), 3)
        times = [timed(run) for _ in range(RUNS)]
        warm[name] = round(statistics.median(times), 3)
        spread[name] = [round(min(times), 3), round(max(times), 3)]

    ingest_time = None
    if len(sys.argv) == 1:
        source, staging = land(given), fresh_folder(spark, "staging")
        ingest_time = round(timed(lambda: ingest(spark, source, staging, date(2024, 9, 5))), 3)
    print(
        json.dumps(
            {
                "metric": "sum of the ten answers, median warm run each",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cold": cold,
                "spread": spread,
                "ingest_eight_tables": ingest_time,
                "cores": CORES,
            }
        )
    )


if __name__ == "__main__":
    main()
