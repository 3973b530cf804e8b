"""The whole run: tickers to dense rows to one-minute candles to N-minute candles, one commit a stage, with a ledger from
which a run that was stopped goes on."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.cluster import saved, scratch
from tickloom.functions import noise
from tickloom.operators.bridge import bridge, quality_gate
from tickloom.operators.candles import frequency_minutes, resample_candles
from tickloom.operators.densify import densify
from tickloom.operators.ledger import batch_outcomes, bridge_outcomes, candle_outcomes, closing_rows, densify_outcomes, opening_rows, resume_symbols
from tickloom.sources.schemas import SPECS
from tickloom.sources.store import Store
from tickloom.sources.tables import append_interpolated, conform, enforce, read_interpolated, read_tickers

#: Buckets of a stage's ledger, which has a row a symbol.
LEDGER_BUCKETS = 16
#: Minutes of a walk that one task adds up.
WALK_BLOCK = 360


def synthetic_candles(spark: SparkSession, symbols: list[str] | DataFrame, start: str = "2023-03-20 09:00:00", hours: int = 24, seed: int = 42, base: float = 25_000.0, block: int = WALK_BLOCK) -> DataFrame:
    """One-minute random-walk candles of each symbol: open is the close before, closes add up hashed normal steps. The
    sum runs in blocks of so many minutes, each in a task of its own: their totals are added up first, a row a block."""
    names = spark.createDataFrame([(s,) for s in symbols], "symbol string") if isinstance(symbols, list) else symbols.select("symbol").distinct()
    minutes = hours * 60
    blocks = names.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit((minutes - 1) // block))))
    u = lambda i: noise.uniform(F.col("state"), i)
    # prices in whole hundredths, so that sums do not depend on their order
    first = F.round(F.round(F.lit(base) + noise.normal(u(8), u(9)) * 500, 2) * 100).cast("long")

    def rows(of: DataFrame) -> DataFrame:
        out = of.withColumn("id", F.explode(F.sequence(F.col("block") * block, F.least(F.col("block") * block + block, F.lit(minutes)) - 1)))
        out = out.withColumn("timestamp", F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id")))
        return noise.with_state(out, seed, "state").withColumn("step", F.round(F.round(noise.normal(u(0), u(1)) * 10, 2) * 100).cast("long"))

    totals = rows(blocks).groupBy("symbol", "block").agg(F.sum("step").alias("total"))
    before = Window.partitionBy("symbol").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = noise.with_state(totals, seed, "state", ts=None)
    offsets = offsets.select("symbol", "block", (first + F.coalesce(F.sum("total").over(before), F.lit(0))).alias("offset"))
    own = Window.partitionBy("symbol", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    out = rows(offsets).withColumn("sum", F.col("offset") + F.sum("step").over(own))
    out = out.withColumns({"close": F.col("sum") / 100.0, "open": (F.col("sum") - F.col("step")) / 100.0})
    wick = lambda a, b: F.abs(noise.normal(u(a), u(b)) * 3)
    return out.select(
        "symbol", "timestamp", "open", F.round(F.greatest("open", "close") + wick(2, 4), 2).alias("high"), F.round(F.least("open", "close") - wick(3, 5), 2).alias("low"), "close",
        F.round(noise.exponential(u(6), 50.0), 4).alias("volume"),
    )


def batch_store(spark: SparkSession, root: str, table: str, batch_id: int) -> Store:
    """A stage's table of one batch, in buckets by symbol."""
    spec = SPECS[table]
    return Store(spark, f"{root}/{table}/batch_id={batch_id}", spec.schema, ("symbol",), spec.key[:2], int(spark.conf.get("spark.sql.shuffle.partitions")))


def ledger_store(spark: SparkSession, root: str, stage: str) -> Store:
    """A stage's ledger: the last batch of every symbol."""
    return Store(spark, f"{root}/ledger/{stage}", SPECS["ledger"].schema, ("symbol",), buckets=LEDGER_BUCKETS)


def _of(rows: DataFrame, symbols: DataFrame | None) -> DataFrame:
    return rows if symbols is None else rows.join(symbols, "symbol", "left_semi")


def run_interpolation(tickers: DataFrame, root: str, batch_id: int, symbols: DataFrame | None = None, **options) -> DataFrame:
    """The dense rows of a batch, or of some of its symbols, into the batch's table; outcomes by symbol."""
    tickers = _of(tickers, symbols)
    # as many tasks as buckets: sizes of sparse rows would say too few, as the dense rows are made after the shuffle
    n = int(tickers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    append_interpolated(densify(tickers.repartition(n, "symbol"), **options), f"{root}/dense", batch_id, tickers.select("symbol") if symbols is None else symbols)
    gates = {k: v for k, v in options.items() if k in ("min_points", "max_span_days", "max_points")}
    return densify_outcomes(tickers, _of(read_interpolated(tickers.sparkSession, f"{root}/dense", batch_id), symbols), **gates)


def _put(rows: DataFrame, root: str, table: str, batch_id: int, symbols: DataFrame) -> DataFrame:
    """The stage's table with rows in the place of all rows of symbols. Rows are shuffled once, by symbol as the buckets
    are: so a bucket is written by one task, and a key's rows stand in one."""
    store = batch_store(rows.sparkSession, root, table, batch_id)
    store.replace(enforce(rows.repartition("symbol"), SPECS[table], dealt=True)[0], symbols, dealt=True, writer=("stage", (store.taken("stage") or 0) + 1))
    return store.read()


def run_bridge(spark: SparkSession, root: str, batch_id: int, strategy: str = "basic", seed: int = 42, symbols: DataFrame | None = None) -> DataFrame:
    """Candles of the batch, without symbols that fail the gate; outcomes by symbol."""
    dense = _of(read_interpolated(spark, f"{root}/dense", batch_id), symbols)
    with scratch(spark) as save:
        candles = save(bridge(dense, strategy, seed, "timestamp"), "candles")
        gate = saved(quality_gate(candles), "gate")
        good = candles.join(gate.where("not valid"), "symbol", "left_anti")
        minute = _put(conform(good, SPECS["minute"].schema, SPECS["minute"].defaults), root, "minute", batch_id, dense.select("symbol") if symbols is None else symbols)
    return bridge_outcomes(dense, _of(minute, symbols), gate)


def run_candles(spark: SparkSession, root: str, batch_id: int, freq: str = "5min", symbols: DataFrame | None = None) -> DataFrame:
    minute = _of(batch_store(spark, root, "minute", batch_id).read(), symbols)
    out = conform(resample_candles(minute, freq).withColumn("batch_id", F.lit(batch_id)), SPECS["candles"].schema)
    candles = _put(out, root, "candles", batch_id, minute.select("symbol") if symbols is None else symbols)
    return candle_outcomes(minute, _of(candles, symbols), frequency_minutes(freq))


def run_stage(ledger: Store, batch_id: int, symbols: DataFrame, work: Callable[[DataFrame | None], DataFrame]) -> DataFrame:
    """Opens the batch for those of symbols that it does not have yet, lets work(symbols) process what is pending or
    failed (None: all of them), closes these with its outcomes, and gives the outcomes of the whole batch. A batch that is
    complete costs a look at the ledger. work replaces what it has written before, so that a run that ended between its
    commit and the ledger's is repeated without a trace."""
    began, kinds = _now(), {f.name: f.dataType.simpleString() for f in ledger.schema}
    known = ledger.read().where(F.col("batch_id") == batch_id)
    first = known.isEmpty()
    ledger.upsert(opening_rows(symbols if first else symbols.join(known, "symbol", "left_anti"), batch_id, kinds))
    todo = saved(resume_symbols(ledger.read(), batch_id), "resume")
    if not todo.isEmpty():
        outcomes = saved(work(None if first else todo), "outcomes")
        ended = _now()
        ledger.upsert(closing_rows(outcomes.withColumn("processing_time_seconds", F.lit((ended - began).total_seconds())), batch_id, kinds, F.lit(began), F.lit(ended)))
    return batch_outcomes(ledger.read(), batch_id)


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def run_pipeline(spark: SparkSession, tickers: DataFrame | str, root: str, batch_id: int, strategy: str = "basic", freq: str = "5min", seed: int = 42, **options) -> dict[str, DataFrame]:
    """Outcomes of each stage that ran; stops after the first stage without a success. Each stage keeps a ledger below
    root: a run of a batch that was stopped, or that left errors, goes on with the symbols that are not done, and ends
    with the tables of a run that was never stopped. tickers: the path of a table, which is read where it is, or rows,
    which are computed once and kept until the run ends, as the first stage reads them several times."""
    if not isinstance(tickers, str):
        with scratch(spark) as save:
            return _run_stages(spark, save(tickers, "tickers"), root, batch_id, strategy, freq, seed, **options)
    return _run_stages(spark, read_tickers(spark, tickers), root, batch_id, strategy, freq, seed, **options)


def _run_stages(spark: SparkSession, tickers: DataFrame, root: str, batch_id: int, strategy: str, freq: str, seed: int, **options) -> dict[str, DataFrame]:
    stages = {
        "interpolation": lambda s: run_interpolation(tickers, root, batch_id, s, **options),
        "bridge": lambda s: run_bridge(spark, root, batch_id, strategy, seed, s),
        "candles": lambda s: run_candles(spark, root, batch_id, freq, s),
    }
    out, symbols = {}, tickers.where("symbol is not null")
    for name, stage in stages.items():
        out[name] = run_stage(ledger_store(spark, root, name), batch_id, symbols, stage)
        symbols = out[name].where("status = 'success'").select("symbol")
        if symbols.isEmpty():
            break
    return out
