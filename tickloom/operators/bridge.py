"""One-minute candles from dense points. All noise comes from a hash (functions.noise), so strategies without a memory
are plain column expressions. Those with one need their last closes only: their rows are dealt out by symbol, sorted
within tasks and read once, in Arrow batches; a symbol of any length needs no more memory than a batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.cluster import ship
from tickloom.functions import noise

#: Closes that a candle may depend on.
MEMORY = 5
#: Weight of the trend of the last closes in a close.
TREND = 0.72
#: Numbers of the draws beside the four of prices.
DRAW_VOLUME, DRAW_WIDTH = 4, 5


def choose_price(df: DataFrame, share: float = 0.8) -> DataFrame:
    """symbol and column: the first of underlying, mark and index price of which more than share is there, else the
    first that exists."""
    there = [c for c in ("underlying_price", "mark_price", "index_price") if c in df.columns]
    shares = df.groupBy("symbol").agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in there])
    pick = F.coalesce(*[F.when(F.col(c) > share, F.lit(c)) for c in there], F.lit(there[0]))
    return shares.select("symbol", pick.alias("price_column"))


def base_price(df: DataFrame) -> Column:
    """Underlying, else mark, else index; zero and NaN count as missing."""
    there = [F.nullif(F.col(c).cast("double"), F.lit(float("nan"))) for c in ("underlying_price", "mark_price", "index_price") if c in df.columns]
    return F.coalesce(*[F.nullif(c, F.lit(0.0)) for c in there[:-1]], there[-1])


def repaired_volume(volume: Column, u: Column, mean: float = 50.0) -> Column:
    """Volumes that are missing or not above zero are drawn anew."""
    return F.greatest(F.when(volume > 0, volume).otherwise(noise.exponential(u, mean)), F.lit(0.0))


def volume_repair(df: DataFrame, seed: int = 42) -> DataFrame:
    """df with its volume repaired; timestamp names the draw."""
    drawn = noise.uniform(F.col("__r"), DRAW_VOLUME)
    return noise.with_state(df, seed).withColumn("volume", F.round(repaired_volume(F.col("volume").cast("double"), drawn), 6)).drop("__r")


def _finish(df: DataFrame, open_: Column, high: Column, low: Column, close: Column, noisy: bool = False) -> DataFrame:
    """noisy: the prices hold noise, so that none lies half way between two roundings and binary rounding does."""
    r = (lambda c: F.floor(c * 10_000 + 0.5) / 10_000) if noisy else (lambda c: F.round(c, 4))
    drawn = noise.uniform(F.col("__r"), DRAW_VOLUME)
    return df.select(
        "symbol", "timestamp", r(open_).alias("open"), r(high).alias("high"), r(low).alias("low"), r(close).alias("close"), F.round(repaired_volume(F.col("__volume"), drawn), 6).alias("volume"), F.col("__b").alias("source_price")
    )


def _basic(df: DataFrame) -> DataFrame:
    b, s = F.col("__b"), F.col("__b") * 0.001
    o, c = (b + noise.between(F.col(u), -s / 3, s / 3) for u in ("__u0", "__u1"))
    df = df.withColumns({"__o": o, "__c": c})
    o, c = F.col("__o"), F.col("__c")
    return _finish(df, o, F.greatest(o, c) + F.col("__u2") * s / 2, F.least(o, c) - F.col("__u3") * s / 2, c, True)


def _midpoint(df: DataFrame) -> DataFrame:
    b, s = F.col("__b"), F.col("__b") * 0.001
    return _finish(df, b + noise.between(F.col("__u0"), -s / 4, s / 4), b + s / 2, b - s / 2, b + noise.between(F.col("__u1"), -s / 4, s / 4))


def _simple(df: DataFrame) -> DataFrame:
    b, s = F.col("__b"), F.col("__b") * 0.001
    return _finish(df, b, b + s / 2, b - s / 2, b + noise.between(F.col("__u0"), -s / 2, s / 2))


def _recursion(step: Callable[[np.ndarray, np.ndarray], np.ndarray], names: list[str], out: list[str]):
    """Adds __close and the closes before each row (columns out, the latest first) to batches whose first column is
    symbol. step(values of names, closes before each row as MEMORY columns, NaN where there is none) gives the rows'
    closes. Each pass takes the closes of the pass before; where a pass changes nothing all closes are right, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, np.full(MEMORY, np.nan)  # the last symbol and its last closes
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            symbols = batch.column(0).dictionary_encode()
            code = symbols.indices.to_numpy(zero_copy_only=False)
            first = np.maximum.accumulate(np.where(np.concatenate([[True], code[1:] != code[:-1]]), np.arange(n), 0))
            age = np.arange(n) - first  # rows of the symbol before this one in the batch
            if symbols.dictionary[code[0]].as_py() != last:
                held = np.full(MEMORY, np.nan)
            values = np.stack([batch.column(batch.schema.names.index(c)).to_numpy(zero_copy_only=False) for c in names], axis=1)
            closes = np.zeros(n)
            while True:
                past = np.stack([np.concatenate([held, closes])[MEMORY - lag : MEMORY - lag + n] for lag in range(1, MEMORY + 1)], axis=1)
                past[(age[:, None] < np.arange(1, MEMORY + 1)) & (first[:, None] > 0)] = np.nan
                found = step(values, past)
                if np.array_equal(found, closes, equal_nan=True):
                    break
                closes = found
            size = int(age[-1]) + 1
            held = np.concatenate([held if first[-1] == 0 else np.full(MEMORY, np.nan), closes[n - size :]])[-MEMORY:]
            last = symbols.dictionary[code[-1]].as_py()
            added = [pa.array(past[:, i], from_pandas=True) for i in range(len(out))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(closes), *added], [*batch.schema.names, "__close", *out])

    return run


def _with_closes(df: DataFrame, step, names: list[str], lags: int) -> DataFrame:
    """df with __close of the recursion and the closes before it: __before1 the latest."""
    ship(df.sparkSession)
    out = [f"__before{i}" for i in range(1, lags + 1)]
    rows = df.select("symbol", *[c for c in df.columns if c != "symbol"]).repartition("symbol").sortWithinPartitions("symbol", "timestamp")
    schema = ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes), *(f"{c} double" for c in ["__close", *out])])
    return rows.mapInArrow(_recursion(step, names, out), schema)


def _rounded(x: np.ndarray) -> np.ndarray:
    return np.floor(x * 10_000 + 0.5) / 10_000


def _spread_step(rows: np.ndarray, past: np.ndarray) -> np.ndarray:
    b, n = rows.T
    return np.where(np.isnan(past[:, 0]), _rounded(b + n), _rounded(b * 1.15 + n - past[:, 0] * 0.15))


def trend(past: np.ndarray) -> np.ndarray:
    """(latest - oldest) / number of the last closes, 0 of fewer than two."""
    n = (~np.isnan(past)).sum(1)
    oldest = past[np.arange(len(past)), np.maximum(n, 1) - 1]
    return np.where(n < 2, 0.0, (past[:, 0] - oldest) / np.maximum(n, 1))


def _trend_step(rows: np.ndarray, past: np.ndarray) -> np.ndarray:
    return _rounded(rows[:, 0] + trend(past) * TREND)


def _spread(df: DataFrame) -> DataFrame:
    """close(t) = round(1.15 b + n - 0.15 close(t-1), 4)."""
    b, s = F.col("__b"), F.col("__s")
    df = df.withColumn("__s", b * 0.002 * noise.between(noise.uniform(F.col("__r"), DRAW_WIDTH), 0.5, 1.5))
    df = df.withColumn("__n", noise.between(F.col("__u1"), -s / 3, s / 3)).drop("__u1")
    df = _with_closes(df, _spread_step, ["__b", "__n"], 1)
    bias = F.coalesce((b - F.col("__before1")) * 0.3, F.lit(0.0))
    df = df.withColumns({"__o": b + noise.between(F.col("__u0"), -s / 3, s / 3) + bias * 0.2, "__c": F.col("__close")})
    o, c = F.col("__o"), F.col("__c")
    df = df.withColumns({"__h": F.greatest(o, c) + F.col("__u2") * s / 2, "__l": F.least(o, c) - F.col("__u3") * s / 2})
    narrow = F.col("__h") - F.col("__l") < b * 0.0005
    mid = (o + c) / 2
    return _finish(df, o, F.when(narrow, mid + b * 0.00025).otherwise(F.col("__h")), F.when(narrow, mid - b * 0.00025).otherwise(F.col("__l")), c)


def _trend(df: DataFrame) -> DataFrame:
    """close(t) = round(b + 0.72 trend + e, 4), trend from the last five closes."""
    b, e = F.col("__b"), F.col("__e")
    df = df.withColumn("__e", noise.normal(F.col("__u0"), F.col("__u1")) * 0.001 * b).drop("__u0", "__u1", "__u2", "__u3")
    df = _with_closes(df.withColumn("__x", b + e), _trend_step, ["__x"], MEMORY)
    past = [F.col(f"__before{i}") for i in range(1, MEMORY + 1)]
    known = sum(p.isNotNull().cast("int") for p in past)
    df = df.withColumn("__trend", F.when(known < 2, 0.0).otherwise((past[0] - F.coalesce(*reversed(past))) / known))
    t, c = F.col("__trend"), F.col("__close")
    o, up = b + t * 0.6 + e, F.col("__trend") > 0
    return _finish(df, o, F.greatest(o, c) + F.abs(t) * F.when(up, 0.5).otherwise(0.2), F.least(o, c) - F.abs(t) * F.when(up, 0.2).otherwise(0.5), c)


STRATEGIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "basic": _basic,
    "price_midpoint": _midpoint,
    "price_as_midpoint": _midpoint,
    "simple_spread": _simple,
    "spread_simulation": _spread,
    "trend_following": _trend,
}


def bridge(dense: DataFrame, strategy: str = "basic", seed: int = 42, ts_col: str = "date") -> DataFrame:
    """symbol, timestamp, open, high, low, close, volume, source_price of every point with a base price above zero and a
    time. An unknown strategy is simple_spread."""
    volume = F.col("volume").cast("double") if "volume" in dense.columns else F.lit(None).cast("double")
    rows = dense.select("symbol", F.col(ts_col).alias("timestamp"), base_price(dense).alias("__b"), volume.alias("__volume")).where("__b > 0 and timestamp is not null")
    rows = noise.with_state(rows, seed).withColumns({f"__u{i}": noise.uniform(F.col("__r"), i) for i in range(4)})
    return STRATEGIES.get(strategy, _simple)(rows)


def cleanup_candles(df: DataFrame) -> DataFrame:
    """Numbers from whatever type, rows with a missing price out."""
    prices = ["open", "high", "low", "close"]
    numbers = {c: F.nullif(F.col(c).try_cast("double"), F.lit(float("nan"))) for c in [*prices, "volume"] if c in df.columns}
    return df.withColumns(numbers).dropna(subset=prices)


def quality_gate(df: DataFrame, max_spread: float = 0.1) -> DataFrame:
    """symbol, valid, reason: the first rule that any candle of the symbol breaks."""
    o, h, l, c, p = (F.col(x) for x in ("open", "high", "low", "close", "source_price"))
    rules = {
        "high below low": h < l,
        "high below open or close": (h < o) | (h < c),
        "low above open or close": (l > o) | (l > c),
        "spread too wide": F.try_divide(h - l, p) > max_spread,
        "price not above zero": F.least(o, h, l, c) <= 0,
    }
    found = df.groupBy("symbol").agg(*[F.coalesce(F.bool_or(test), F.lit(False)).alias(name) for name, test in rules.items()])
    reason = F.coalesce(*[F.when(F.col(f"`{name}`"), F.lit(name)) for name in rules])
    return found.select("symbol", reason.isNull().alias("valid"), reason.alias("reason"))
