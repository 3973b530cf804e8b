"""Candles of N minutes from one-minute candles, and what describes and checks candles."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frequency_minutes(freq: str) -> int:
    """5 of 5min or 5m; anything else is an error."""
    if not (m := re.fullmatch(r"(\d+)m(?:in)?", freq)) or not int(m[1]):
        raise ValueError(f"unknown frequency {freq}")
    return int(m[1])


def require_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    if missing := [c for c in cols if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def candle_aggregates() -> list:
    known = lambda c: F.col(c).isNotNull()
    return [
        F.min_by("open", F.when(known("open"), F.col("timestamp"))).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", F.when(known("close"), F.col("timestamp"))).alias("close"),
        F.coalesce(F.sum("volume"), F.lit(0)).alias("volume"),
        F.count("*").alias("n_rows"),
    ]


def resample_candles(df: DataFrame, freq: str = "5min") -> DataFrame:
    """Candles of buckets (from 1970 on) that have a row for every minute."""
    n = frequency_minutes(freq)
    require_columns(df, ["symbol", "timestamp", "open", "high", "low", "close", "volume"])
    out = df.groupBy("symbol", F.window("timestamp", f"{n} minutes").alias("w")).agg(*candle_aggregates()).where(F.col("n_rows") >= n)
    return out.select("symbol", F.col("w.start").alias("timestamp"), "open", "high", "low", "close", "volume", F.lit(freq).alias("frequency"), F.lit(n).alias("source_candles"))


def validate_candles(df: DataFrame) -> DataFrame:
    """symbol, valid, reason, n_bad: whether any candle has a wrong order, a negative volume or a missing price."""
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    wrong, negative, missing = (h < l) | (h < o) | (h < c) | (l > o) | (l > c), F.col("volume") < 0, o.isNull() | h.isNull() | l.isNull() | c.isNull()
    no = lambda test: F.coalesce(test, F.lit(False))
    found = df.groupBy("symbol").agg(F.count_if(no(wrong)).alias("a"), F.count_if(no(negative)).alias("b"), F.count_if(missing).alias("c"), F.count_if(no(wrong) | no(negative) | missing).alias("n_bad"))
    reason = F.when(F.col("a") > 0, "wrong order of prices").when(F.col("b") > 0, "negative volume").when(F.col("c") > 0, "missing price")
    return found.select("symbol", reason.isNull().alias("valid"), reason.alias("reason"), "n_bad")


def reconstruction_stats(source: DataFrame, out: DataFrame) -> DataFrame:
    """Per symbol: candles in and out, compression, spans in minutes, coverage, volumes and their drift."""

    def side(df: DataFrame, name: str) -> DataFrame:
        span = F.timestamp_diff("MINUTE", F.min("timestamp"), F.max("timestamp"))
        return df.groupBy("symbol").agg(F.count("*").alias(f"{name}_candles"), span.alias(f"{name}_minutes"), F.sum("volume").alias(f"{name}_volume"))

    both = side(source, "source").join(side(out, "out"), "symbol", "left")
    n = F.coalesce("out_candles", F.lit(0))
    return both.select(
        "symbol", "source_candles", n.alias("out_candles"), F.round(F.try_divide(F.col("source_candles"), n), 6).alias("compression"), "source_minutes", "out_minutes",
        F.round(F.try_divide(F.col("out_minutes"), F.col("source_minutes")), 6).alias("coverage"),
        F.round("source_volume", 2).alias("source_volume"), F.round("out_volume", 2).alias("out_volume"),
        F.round(F.abs(1 - F.try_divide(F.col("out_volume"), F.col("source_volume"))), 6).alias("volume_drift"),
    )


def candle_shape(df: DataFrame) -> DataFrame:
    """df with spread, body, direction and the spread as a share of the source price if there is one."""
    out = df.withColumns({"spread": F.round(F.col("high") - F.col("low"), 4), "body": F.round(F.abs(F.col("close") - F.col("open")), 4), "direction": F.when(F.col("close") >= F.col("open"), "green").otherwise("red")})
    return out.withColumn("spread_share", F.round(F.try_divide(F.col("high") - F.col("low"), F.col("source_price")), 8)) if "source_price" in df.columns else out
