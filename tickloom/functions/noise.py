"""Noise from a counter: a row's state is a 32-bit hash of seed, symbol and time, its draws are hashes of the state and
their number. So a draw is the same whatever the partitioning or order, and costs a few integer operations inside generated
code. Symbols with the same CRC-32 share their noise."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def seconds(ts: str) -> Column:
    """Seconds from 1970 of a timestamp without a zone."""
    return F.expr(f"timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', {ts})")


def with_state(df: DataFrame, seed: int, name: str = "__r", symbol: str = "symbol", ts: str | None = "timestamp") -> DataFrame:
    """df with the state of each row, from symbol and, if ts is given, time. Rows with a null symbol, or a null time, are
    alike in it."""
    parts = [F.lit(seed).cast("long"), F.crc32(F.col(symbol)), *([seconds(ts)] if ts else [])]
    return df.withColumn(name, F.hash(*parts))


def uniform(state: Column, i: int) -> Column:
    """The i-th uniform draw of a state, from 0 to below 1."""
    return F.hash(state, F.lit(i)).cast("long").bitwiseAND(F.lit(4294967295)) / F.lit(4294967296.0)


def between(u: Column, low: Column | float, high: Column | float) -> Column:
    low = low if isinstance(low, Column) else F.lit(low)
    return low + u * (high - low)


def exponential(u: Column, mean: float) -> Column:
    return -F.lit(mean) * F.ln(1 - u)


def normal(u: Column, v: Column) -> Column:
    """Box-Muller."""
    return F.sqrt(-2 * F.ln(1 - u)) * F.cos(F.lit(2 * math.pi) * v)
