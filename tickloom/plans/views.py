"""The tables of the engine as views of the events table: one ticker a symbol and minute, the last event winning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: First second and length of the market year that time to maturity counts down.
START, MATURITY_SECONDS, YEAR_SECONDS = "2024-01-01 00:00:00", 7_689_600, 31_536_000


def tickers(spark: SparkSession, sf_dir: str, symbol: str = "event_type") -> DataFrame:
    """symbol: event_type (5 symbols) or user_id (one a user)."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    minute = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    last = F.max(F.struct("event_id", "user_id", "value", "props")).alias("e")
    rows = events.groupBy(F.col(symbol).cast("string").alias("symbol"), minute.alias("date")).agg(last).select("symbol", "date", "e.*")
    price, odd = F.col("value"), F.col("event_id") % 2 == 1
    volume = F.when(F.col("event_id") % 11 != 0, F.get_json_object("props", "$.k").cast("double"))
    iv = price / 100
    return rows.select(
        "symbol", "date", iv.alias("iv"), (price + 100).alias("underlying_price"),
        ((F.lit(MATURITY_SECONDS) - F.timestamp_diff("SECOND", F.lit(START).cast("timestamp_ntz"), "date")) / YEAR_SECONDS).alias("time_to_maturity"),
        (F.lit(100.0) + (F.col("user_id") % 20) * 10).alias("strike"), F.when(odd, "p").otherwise("c").alias("callput"), F.lit(0.01).alias("interest_rate"),
        F.when(F.col("user_id") % 7 != 0, price / 10).alias("mark_price"), (price + 100).alias("index_price"), volume.alias("volume"), (volume * iv * 100).alias("quote_volume"),
        F.col("event_id").cast("string").alias("record_time"),
    )
