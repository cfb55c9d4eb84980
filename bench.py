"""Time the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from costseries.plans import QUERIES  # noqa: E402
from costseries.session import get_spark  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WANTED = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]


def run(build, spark) -> float:
    start = time.perf_counter()
    build(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = get_spark(
        "bench",
        f"local[{CPUS}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in QUERIES if not WANTED or any(n.startswith(w) for w in WANTED)]
    run(QUERIES[names[0]].build, spark)  # start-up and code generation of the first plan
    times = {n: round(run(QUERIES[n].build, spark), 3) for n in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
