"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Every query builds its own stage tables; the second of two runs is reported, so that the start
of the JVM is not.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import Observation
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barscreen.plans.catalog import QUERIES  # noqa: E402
from barscreen.plans.catalog.base import forget_stored  # noqa: E402
from barscreen.session import build_session  # noqa: E402

HEADLINE = (
    "slot_bars", "day_bars", "session_hourly_bars", "split_adjusted_bars", "trailing_measures",
    "hourly_volume", "daily_volume", "hourly_volatility", "daily_features", "hourly_features",
    "supplier_features", "supplier_daily_features",
    "capped_candidates", "universe", "event_table", "missed_announcements", "matched_controls",
    "exit_walk", "outcomes", "verdict", "label_draw",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "barscreen-bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.sql.files.maxPartitionBytes": "2m",
            "spark.sql.files.openCostInBytes": "256k",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="spark-", dir="/tmp"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, rows = {}, {}
    for name in names:
        for _ in range(2):
            forget_stored()
            start = time.time()
            seen = Observation()
            built = QUERIES[name](spark, folder).observe(seen, F.count(F.lit(1)).alias("rows"))
            built.write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.time() - start, 3)
            rows[name] = seen.get["rows"]
        print(name, seconds[name], rows[name], file=sys.stderr, flush=True)
    lineitems = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": total, "unit": "sec",
                "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "lineitem_rows": lineitems, "rows": rows,
                "rows_per_second": {n: round(rows[n] / seconds[n]) for n in seconds},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
