"""Candles, bridge strategies, gates, Greeks."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.functions.greeks import normal_cdf, with_greeks
from tickloom.operators import bridge as B
from tickloom.operators import candles as C

T0 = datetime(2023, 3, 20)
CANDLE = "symbol string, timestamp timestamp_ntz, open double, high double, low double, close double, volume double, source_price double"


def minutes(spark, values, symbol="s", start=0):
    return spark.createDataFrame([(symbol, T0 + timedelta(minutes=start + i), v, v + 1 if v is not None else None, v - 1 if v is not None else None, v, 2.0, v) for i, v in enumerate(values)], CANDLE)


def test_only_complete_buckets_stay(spark):
    got = C.resample_candles(minutes(spark, [float(i) for i in range(14)])).orderBy("timestamp").collect()
    assert [(r.open, r.high, r.low, r.close, r.volume, r.source_candles) for r in got] == [(0, 5, -1, 4, 10, 5), (5, 10, 4, 9, 10, 5)]


def test_first_and_last_skip_nulls_and_no_volume_is_zero(spark):
    df = minutes(spark, [None, 2.0, 3.0, 4.0, None]).withColumn("volume", F.lit(None).cast("double"))
    (r,) = C.resample_candles(df).collect()
    assert (r.open, r.close, r.volume) == (2, 4, 0)


def test_buckets_count_from_1970(spark):
    got = C.resample_candles(minutes(spark, [1.0] * 30), "7min").orderBy("timestamp").collect()
    assert [r.timestamp for r in got][0] == T0 + timedelta(minutes=1)


@pytest.mark.parametrize(("freq", "n"), [("5min", 5), ("15m", 15)])
def test_frequencies(freq, n):
    assert C.frequency_minutes(freq) == n


@pytest.mark.parametrize("freq", ["1h", "min", "0min", "-5min", ""])
def test_other_frequencies_are_errors(freq):
    with pytest.raises(ValueError):
        C.frequency_minutes(freq)


def test_missing_columns_are_errors(spark):
    with pytest.raises(ValueError, match="close"):
        C.resample_candles(minutes(spark, [1.0]).drop("close"))


BASE = {"open": 100.0, "high": 101.0, "low": 99.0, "close": 100.5, "volume": 1.0, "source_price": 100.0}


@pytest.mark.parametrize(
    ("change", "gate", "valid"),
    [
        ({}, None, None),
        ({"high": 98.0}, "high below low", "wrong order of prices"),
        ({"high": 100.2}, "high below open or close", "wrong order of prices"),
        ({"low": 100.2}, "low above open or close", "wrong order of prices"),
        ({"high": 115.0}, "spread too wide", None),
        ({"low": -1.0, "high": 101.0, "source_price": 10_000.0}, "price not above zero", None),
        ({"volume": -1.0}, None, "negative volume"),
        ({"close": None}, None, "missing price"),
    ],
)
def test_checks_of_candles(spark, change, gate, valid):
    good = ("s", T0, *BASE.values())
    bad = ("s", T0 + timedelta(minutes=1), *{**BASE, **change}.values())
    df = spark.createDataFrame([good, bad], CANDLE)
    assert [r.reason for r in B.quality_gate(df).collect()] == [gate]
    (r,) = C.validate_candles(df).collect()
    assert (r.reason, r.n_bad, r.valid) == (valid, int(valid is not None), valid is None)


def dense(spark, n=60):
    rows = [("s", T0 + timedelta(minutes=i), 100 + math.sin(i), None if i % 3 else 5.0) for i in range(n)]
    return spark.createDataFrame(rows, "symbol string, date timestamp_ntz, underlying_price double, volume double")


@pytest.mark.parametrize("strategy", [*B.STRATEGIES, "unknown"])
def test_strategies_keep_candles_in_order(spark, strategy):
    df = B.bridge(dense(spark), strategy)
    assert df.count() == 60
    assert df.where("high < low or high < open or high < close or low > open or low > close or volume <= 0").isEmpty()
    again = B.bridge(dense(spark).repartition(7), strategy)
    assert df.exceptAll(again).isEmpty()
    assert not df.exceptAll(B.bridge(dense(spark), strategy, seed=1)).isEmpty()


def test_names_of_strategies(spark):
    assert B.bridge(dense(spark), "unknown").exceptAll(B.bridge(dense(spark), "simple_spread")).isEmpty()
    assert B.bridge(dense(spark), "price_midpoint").exceptAll(B.bridge(dense(spark), "price_as_midpoint")).isEmpty()


def draws(spark, n=60):
    from tickloom.functions import noise

    df = noise.with_state(dense(spark, n).withColumn("timestamp", F.col("date")), 42)
    return df.select("underlying_price", *[noise.uniform(F.col("__r"), i).alias(f"u{i}") for i in (0, 1, 2, 3, 5)]).orderBy("timestamp").collect()


def test_spread_simulation_is_the_whole_recursion(spark):
    close, want = None, []
    for r in draws(spark):
        b = r.underlying_price
        s = b * 0.002 * (0.5 + r.u5)
        bias = 0.0 if close is None else 0.3 * (b - close)
        close = round(b + (-s / 3 + r.u1 * 2 * s / 3) + 0.5 * bias, 4)
        want.append(close)
    got = [r.close for r in B.bridge(dense(spark), "spread_simulation").orderBy("timestamp").collect()]
    assert got == pytest.approx(want, abs=1.01e-4)


def test_trend_following_is_the_whole_recursion(spark):
    closes, want = [], []
    for r in draws(spark, 300):
        b = r.underlying_price
        last = closes[-5:]
        trend = (last[-1] - last[0]) / len(last) if len(last) > 1 else 0.0
        e = math.sqrt(-2 * math.log(1 - r.u0)) * math.cos(2 * math.pi * r.u1) * 0.001 * b
        closes.append(round(b + 0.72 * trend + e, 4))
        want.append(closes[-1])
    got = [r.close for r in B.bridge(dense(spark, 300), "trend_following").orderBy("timestamp").collect()]
    assert got == pytest.approx(want, abs=1.01e-4)


@pytest.mark.parametrize("strategy", ["trend_following", "spread_simulation"])
def test_closes_go_on_from_batch_to_batch(spark, strategy):
    """Symbols that end and go on at any place of an Arrow batch have the closes that one batch gives."""
    rows = dense(spark, 40)
    many = rows.withColumn("symbol", F.explode(F.array(*map(F.lit, "abc")))).where("symbol <> 'b' or minute(date) % 13 < 3").coalesce(1)
    whole = B.bridge(many, strategy).collect()
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    try:
        for n in (1, 3, 7):
            spark.conf.set(conf, n)
            assert sorted(B.bridge(many, strategy).collect()) == sorted(whole)
    finally:
        spark.conf.set(conf, before)


def test_base_price_skips_zero(spark):
    df = spark.createDataFrame([(0.0, 5.0, 6.0), (None, 0.0, 6.0), (None, None, 0.0), (3.0, 5.0, 6.0)], "underlying_price double, mark_price double, index_price double")
    assert [r[0] for r in df.select(B.base_price(df)).collect()] == [5.0, 6.0, 0.0, 3.0]


@pytest.mark.parametrize(("n", "column"), [(4, "mark_price"), (5, "underlying_price")])
def test_price_needs_more_than_its_share(spark, n, column):
    df = spark.createDataFrame([("s", 1.0 if i < n else None, 2.0) for i in range(5)], "symbol string, underlying_price double, mark_price double")
    assert [r.price_column for r in B.choose_price(df).collect()] == [column]
    none = df.withColumn("mark_price", F.lit(None).cast("double"))
    assert [r.price_column for r in B.choose_price(none).collect()] == ["underlying_price"]


def test_cleanup_reads_numbers(spark):
    df = spark.createDataFrame([("s", "1", "2", "0.5", "1", "x"), ("s", "bad", "2", "0.5", "1", "1"), ("s", "NaN", "2", "0.5", "1", "1")], "symbol string, open string, high string, low string, close string, volume string")
    (r,) = B.cleanup_candles(df).collect()
    assert (r.open, r.volume) == (1.0, None)


def test_stats_of_resampling(spark):
    source = minutes(spark, [1.0] * 12)
    (r,) = C.reconstruction_stats(source, C.resample_candles(source)).collect()
    assert (r.source_candles, r.out_candles, r.compression, r.source_volume, r.out_volume) == (12, 2, 6.0, 24.0, 20.0)
    (r,) = C.reconstruction_stats(source, C.resample_candles(source).limit(0)).collect()
    assert (r.out_candles, r.compression, r.out_volume) == (0, None, None)


def cdf(x):
    return 0.5 * math.erfc(-x / math.sqrt(2))


def test_normal_distribution(spark):
    df = spark.range(-90, 91).select((F.col("id") / 10).alias("x"))
    for r in df.select("x", normal_cdf(F.col("x")).alias("p")).collect():
        assert r.p == pytest.approx(cdf(r.x), abs=1e-15)


@pytest.mark.parametrize("kind", ["c", "call", "p"])
def test_greeks(spark, kind):
    s, k, t, v, r = 105.0, 100.0, 0.4, 0.3, 0.02
    d1 = (math.log(s / k) + (r + v * v / 2) * t) / (v * math.sqrt(t))
    d2, density, call = d1 - v * math.sqrt(t), math.exp(-d1 * d1 / 2) / math.sqrt(2 * math.pi), kind != "p"
    sign = 1 if call else -1
    want = {
        "delta": sign * cdf(sign * d1),
        "gamma": density / (s * v * math.sqrt(t)),
        "theta": (-s * density * v / (2 * math.sqrt(t)) - sign * r * k * math.exp(-r * t) * cdf(sign * d2)) / 365,
        "vega": s * density * math.sqrt(t) / 100,
        "rho": sign * k * t * math.exp(-r * t) * cdf(sign * d2) / 100,
    }
    df = spark.createDataFrame([(s, k, t, v, r, kind), (s, k, t, 0.0, r, kind), (None, k, t, v, r, kind)], "underlying_price double, strike double, time_to_maturity double, iv double, interest_rate double, callput string")
    one, zero, none = with_greeks(df).collect()
    for name, x in want.items():
        assert one[name] == pytest.approx(x, rel=1e-12)
        assert zero[name] is None and none[name] is None
    legacy = with_greeks(df, legacy_put_rho=True).first()
    assert legacy.rho == pytest.approx(abs(want["rho"]))


def test_draws_are_uniform_and_unlike_from_row_to_row(spark):
    """Means, the share below a quarter, neighbours in time, draws of a row and symbols beside each other."""
    import numpy as np

    from tickloom.functions import noise

    rows = spark.range(40_000).selectExpr("cast(id % 2 as string) as symbol", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, cast(id div 2 as int)) as timestamp")
    rows = noise.with_state(rows, 7).select("symbol", *[noise.uniform(F.col("__r"), i).alias(f"u{i}") for i in range(10)]).where("true").orderBy("symbol", "timestamp")
    got = rows.toPandas()
    u = got[[f"u{i}" for i in range(10)]].to_numpy()
    assert (u >= 0).all() and (u < 1).all() and abs(u.mean(0) - 0.5).max() < 0.01 and abs((u < 0.25).mean(0) - 0.25).max() < 0.015
    one, two = u[:20_000], u[20_000:]
    seen = [np.corrcoef(u.T) - np.eye(10), np.corrcoef(one[1:].T, one[:-1].T)[:10, 10:], np.corrcoef(one.T, two.T)[:10, 10:]]
    assert max(abs(x).max() for x in seen) < 0.04
    assert len(np.unique(u[:, 0])) > 39_900


def test_draws_of_null_symbols_and_times(spark):
    from tickloom.functions import noise

    rows = spark.createDataFrame([(None, None), ("", None), (None, None)], "symbol string, timestamp timestamp_ntz")
    got = [r.u for r in noise.with_state(rows, 7).select(noise.uniform(F.col("__r"), 0).alias("u")).collect()]
    assert got[0] == got[2] and all(0 <= u < 1 for u in got)


def test_state_of_a_stream_has_as_many_partitions_as_its_rows_are_worth(spark, tmp_path, monkeypatch):
    from tickloom.streaming import candles as X

    key, path, cores = "spark.sql.shuffle.partitions", str(tmp_path / "in"), spark.sparkContext.defaultParallelism
    before = spark.conf.get(key)
    rows = spark.range(600).select(
        F.concat(F.lit("s"), F.col("id") % 3).alias("symbol"), F.timestamp_seconds(F.col("id").cast("long") * 1200).alias("timestamp"), *[F.col("id").cast("double").alias(c) for c in ("open", "high", "low", "close", "volume")]
    ).withColumn("timestamp", F.explode(F.sequence("timestamp", F.expr("timestamp + interval 4 minutes"), F.expr("interval 1 minute"))))
    try:
        spark.conf.set(key, str(16 * cores))
        slices, _ = X.write_in_order(X.with_closing_row(rows, "7 days"), path, "3 days")
        n = X.state_partitions(rows, slices)
        assert n == cores
        source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
        ended = X.run_to_end(X.stream_candles(source, "5min", "3 days"), str(tmp_path / "out"), str(tmp_path / "state"), n)
        assert spark.conf.get(key) == str(16 * cores)
        monkeypatch.setattr(X, "STATE_ROWS", 100)
        assert X.state_partitions(rows, slices) == -(-3000 // (slices * 100))
        monkeypatch.setattr(X, "STATE_ROWS", 1)
        assert X.state_partitions(rows, slices) == 16 * cores
    finally:
        spark.conf.set(key, before)
    done = [s for p in ended.recentProgress for s in p.stateOperators]
    assert done and all(s.numShufflePartitions == n and not s.numRowsDroppedByWatermark for s in done)
    got, want = spark.read.parquet(str(tmp_path / "out")), C.resample_candles(rows)
    assert want.count() == 600 and got.exceptAll(want.select(got.columns)).isEmpty() and got.count() == 600
