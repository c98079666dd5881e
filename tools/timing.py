"""Split a query's time into building, planning and running.

    python tools/profile.py [folder of tables] query names...
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from docketry.queries.catalogue import queries  # noqa: E402
from docketry.session import with_settings  # noqa: E402


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(queries())
    builder = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    builder = builder.config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
    spark = with_settings(builder.config("spark.ui.showConsoleProgress", "false")).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        for _ in range(2):
            marks = [time.time()]
            df = queries()[name](spark, sf_dir)
            marks.append(time.time())
            df._jdf.queryExecution().executedPlan()
            marks.append(time.time())
            df.write.format("noop").mode("overwrite").save()
            marks.append(time.time())
            build, plan, run = [b - a for a, b in zip(marks, marks[1:])]
            print(f"{name:26s} build {build:6.2f} plan {plan:6.2f} run {run:6.2f}", flush=True)


if __name__ == "__main__":
    main()
