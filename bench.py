"""Time the catalogue's queries and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from docketry.queries.catalogue import queries
from docketry.session import with_settings


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("docketry-bench")
    builder = builder.config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    spark = with_settings(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    chosen = sys.argv[1:] or list(queries())
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds, failed = {}, {}
    for name in chosen:
        start = time.perf_counter()
        try:
            queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        except Exception as error:  # noqa: BLE001 - one failure must not hide the other timings
            failed[name] = f"{type(error).__name__}: {error}"[:200]
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    line = {"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}
    print(json.dumps({**line, "failed": failed} if failed else line))


if __name__ == "__main__":
    main()
