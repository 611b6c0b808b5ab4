"""Time the registered queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder and ``BENCH_CPUS`` the local cores.
Every query computes its whole result; the rows go to the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from clickloom.plans.queries import QUERIES
from clickloom.session import build_session


def run(query, spark, sf_dir: str) -> float:
    begin = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - begin, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus,
        spark_driver_memory="16g",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["word_count_sorted"], spark, sf_dir)  # start-up cost, not reported
    names = sys.argv[1:] or list(QUERIES)
    seconds = {name: run(QUERIES[name], spark, sf_dir) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
