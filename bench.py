"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every dense row is made: results go to the noop sink, or through an aggregate where only candles are asked for."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tickloom.functions.greeks import with_greeks  # noqa: E402
from tickloom.operators.bridge import bridge  # noqa: E402
from tickloom.operators.candles import resample_candles  # noqa: E402
from tickloom.operators.densify import densify  # noqa: E402
from tickloom.operators.reports import symbol_profile  # noqa: E402
from tickloom.plans.views import tickers  # noqa: E402


def main() -> None:
    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(4 * int(cpus)))
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def write(df):
        df.write.format("noop").mode("overwrite").save()

    def users():
        return tickers(spark, sf, "user_id")

    cases = {
        "symbol_profile": lambda: write(symbol_profile(users())),
        "greeks": lambda: write(with_greeks(users())),
        "densify": lambda: write(densify(users())),
        "bridge_basic": lambda: write(bridge(densify(users()))),
        "resample_5min": lambda: write(resample_candles(bridge(densify(users())))),
        "bridge_trend": lambda: write(bridge(densify(users()), "trend_following")),
    }
    tickers(spark, sf).agg(F.count("*")).first()  # starts the executors
    rows = densify(users()).count()
    took = {}
    for name, run in cases.items():
        began = time.time()
        run()
        took[name] = round(time.time() - began, 3)
    total = round(sum(took.values()), 3)
    rates = {k: round(rows / took[k]) for k in ("densify", "bridge_basic", "resample_5min", "bridge_trend")}
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": took, "sf": Path(sf).name.removeprefix("sf"), "dense_rows": rows, "dense_rows_per_sec": rates}))


if __name__ == "__main__":
    main()
