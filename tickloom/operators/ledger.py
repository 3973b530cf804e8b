"""The run ledger: outcomes by symbol, batches, progress and throughput. All of it is data; times are arguments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.densify import symbol_gates
from tickloom.sources.tables import dedupe_last, upsert


def _n(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy("symbol").agg(F.count("*").alias(name))


def densify_outcomes(source: DataFrame, dense: DataFrame, **gates) -> DataFrame:
    """symbol, status, reason, input_rows, output_rows of every symbol of source."""
    both = symbol_gates(source, **gates).select("symbol", F.col("rows").alias("input_rows"), "gate").join(_n(dense, "output_rows"), "symbol", "left")
    reason = F.coalesce("gate", F.when(F.col("output_rows").isNull(), "nothing after interpolation"))
    return both.select("symbol", F.when(reason.isNull(), "success").otherwise("skipped").alias("status"), reason.alias("reason"), "input_rows", F.coalesce("output_rows", F.lit(0)).alias("output_rows"))


def bridge_outcomes(dense: DataFrame, minute: DataFrame, gate: DataFrame | None = None) -> DataFrame:
    """As above; gate (symbol, valid, reason): symbols whose candles failed it are errors."""
    both = _n(dense, "input_rows").join(_n(minute, "output_rows"), "symbol", "left")
    reason = F.when(F.col("output_rows").isNull(), "no base price")
    error = F.lit(False)
    if gate is not None:
        both = both.join(gate.select("symbol", F.col("valid").alias("__valid"), F.col("reason").alias("__why")), "symbol", "left")
        error = F.coalesce(~F.col("__valid"), F.lit(False))
        reason = F.coalesce(F.when(error, F.col("__why")), reason)
    status = F.when(error, "error").when(reason.isNull(), "success").otherwise("skipped")
    return both.select("symbol", status.alias("status"), reason.alias("reason"), "input_rows", F.coalesce("output_rows", F.lit(0)).alias("output_rows"))


def candle_outcomes(minute: DataFrame, candles: DataFrame, minutes: int) -> DataFrame:
    """Fewer rows than minutes: skipped; no complete bucket: error."""
    both = _n(minute, "input_rows").join(_n(candles, "output_rows"), "symbol", "left")
    short = F.col("input_rows") < minutes
    reason = F.when(short, "too few rows").when(F.col("output_rows").isNull(), "no complete group")
    status = F.when(short, "skipped").when(F.col("output_rows").isNull(), "error").otherwise("success")
    return both.select("symbol", status.alias("status"), reason.alias("reason"), "input_rows", F.coalesce("output_rows", F.lit(0)).alias("output_rows"))


def stage_totals(outcomes: DataFrame) -> DataFrame:
    """One row: symbols by status, rows in and out, percent that succeeded."""
    of = lambda s: F.count_if(F.col("status") == s)
    rate = F.round(F.try_divide(of("success") * 100.0, F.count("*")), 2)
    return outcomes.agg(
        of("success").alias("n_success"), of("error").alias("n_error"), of("skipped").alias("n_skipped"), F.coalesce(F.sum("input_rows"), F.lit(0)).alias("input_rows"),
        F.coalesce(F.sum("output_rows"), F.lit(0)).alias("output_rows"), rate.alias("success_rate"),
    )


def opening_rows(symbols: DataFrame, batch_id: int, kinds: dict[str, str]) -> DataFrame:
    """A pending row, with the columns of kinds, for every symbol."""
    values = {"symbol": F.col("symbol"), "status": F.lit("pending"), "batch_id": F.lit(batch_id)}
    return symbols.select("symbol").distinct().select(*[values.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()])


def open_batch(ledger: DataFrame, symbols: DataFrame, batch_id: int) -> DataFrame:
    """The ledger with every symbol pending in the new batch, times, rows and error cleared."""
    return upsert(ledger, opening_rows(symbols, batch_id, dict(ledger.dtypes)), ["symbol"])


def closing_rows(outcomes: DataFrame, batch_id: int, kinds: dict[str, str], started: Column | None = None, completed: Column | None = None) -> DataFrame:
    """The outcomes (one row a symbol) as ledger rows: success is completed, error and skipped stay."""
    known = outcomes.columns
    values = {
        "symbol": F.col("symbol"),
        "status": F.when(F.col("status") == "success", "completed").otherwise(F.col("status")),
        "error_message": F.col("reason"),
        "batch_id": F.lit(batch_id),
        "started_at": started if started is not None else F.lit(None),
        "completed_at": completed if completed is not None else F.lit(None),
    }
    one = dedupe_last(outcomes, ["symbol"], ["status"])
    return one.select(*[values.get(c, F.col(c) if c in known else F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()])


def close_batch(ledger: DataFrame, outcomes: DataFrame, batch_id: int, started: Column | None = None, completed: Column | None = None) -> DataFrame:
    """The ledger with the outcomes of a batch."""
    return upsert(ledger, closing_rows(outcomes, batch_id, dict(ledger.dtypes), started, completed), ["symbol"])


def batch_outcomes(ledger: DataFrame, batch_id: int) -> DataFrame:
    """The closed rows of a batch as outcomes: the way back from closing_rows()."""
    done = ledger.where((F.col("batch_id") == batch_id) & (F.col("status") != "pending"))
    status = F.when(F.col("status") == "completed", "success").otherwise(F.col("status"))
    return done.select("symbol", status.alias("status"), F.col("error_message").alias("reason"), "input_rows", "output_rows")


def latest_batch(ledger: DataFrame) -> DataFrame:
    return ledger.agg(F.max("batch_id").alias("batch_id"))


def progress_summary(ledger: DataFrame, batch_id: int | None = None) -> DataFrame:
    """status (total for all), symbols, rows in and out, seconds in all and on average, percent of the symbols."""
    rows = ledger if batch_id is None else ledger.where(F.col("batch_id") == batch_id)
    out = rows.rollup("status").agg(
        F.count("*").alias("n_symbols"), F.sum("input_rows").alias("input_rows"), F.sum("output_rows").alias("output_rows"), F.round(F.sum("processing_time_seconds"), 4).alias("total_seconds"),
        F.round(F.avg("processing_time_seconds"), 4).alias("avg_seconds"), F.grouping("status").alias("__all"),
    )
    out = out.withColumn("status", F.when(F.col("__all") == 1, "total").otherwise(F.col("status"))).drop("__all")
    total = F.max(F.when(F.col("status") == "total", F.col("n_symbols"))).over(Window.partitionBy())  # a row a status
    return out.withColumn("percent", F.round(F.try_divide(F.col("n_symbols") * 100.0, total), 2))


def resume_symbols(ledger: DataFrame, batch_id: int) -> DataFrame:
    return ledger.where((F.col("batch_id") == batch_id) & F.col("status").isin("pending", "error")).select("symbol")


def failed_symbols(ledger: DataFrame, batch_id: int) -> DataFrame:
    return ledger.where((F.col("batch_id") == batch_id) & (F.col("status") == "error")).select("symbol", "error_message")


def throughput(snapshots: DataFrame, low: float = 100.0) -> DataFrame:
    """snapshots (batch_id, taken_at, done_symbols, pending_symbols, output_rows) with rows a second, symbols a minute,
    minutes left and an alert where rows a second are known and below low."""
    w = Window.partitionBy("batch_id").orderBy("taken_at")
    dt = F.timestamp_diff("SECOND", F.lag("taken_at").over(w), "taken_at")
    out = snapshots.withColumns({"__dt": dt, "__rows": F.col("output_rows") - F.lag("output_rows").over(w), "__done": F.col("done_symbols") - F.lag("done_symbols").over(w)})
    out = out.withColumn("rows_per_second", F.round(F.try_divide(F.col("__rows"), F.col("__dt")), 4)).withColumn("symbols_per_minute", F.round(F.try_divide(F.col("__done") * 60.0, F.col("__dt")), 4))
    out = out.withColumn("minutes_left", F.round(F.try_divide(F.col("pending_symbols"), F.try_divide(F.col("__done") * 60.0, F.col("__dt"))), 4))
    return out.withColumn("alert", F.when(F.col("rows_per_second") < low, "low throughput")).drop("__dt", "__rows", "__done")
