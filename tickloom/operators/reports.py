"""Symbol selection, profiles and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.sources.tables import head_per_symbol, union_all


def symbols_in_range(df: DataFrame, start: str | None, end: str | None, ts_col: str = "date") -> DataFrame:
    """Symbols with a row from start to end, both included; all symbols unless both are given."""
    if start is not None and end is not None:
        df = df.where(F.col(ts_col).between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))
    return df.select("symbol").distinct()


def first_symbols(df: DataFrame, k: int | None) -> DataFrame:
    """The first k symbols by name, or all."""
    found = df.select("symbol").distinct()
    return found if k is None else found.orderBy("symbol").limit(k)


def symbols_of_batch(df: DataFrame, batch_id: int) -> DataFrame:
    return df.where(F.col("batch_id") == batch_id).select("symbol").distinct()


def restrict(df: DataFrame, symbols: list[str] | DataFrame) -> DataFrame:
    """Rows of these symbols; short lists reach the scan as a filter."""
    if isinstance(symbols, DataFrame):
        return df.join(symbols, "symbol", "left_semi")
    return df.where(F.col("symbol").isin(symbols))


def pending_symbols(source: DataFrame, done: DataFrame) -> DataFrame:
    """Symbols of source that are not in done, of which one row a symbol and task is shuffled."""
    return source.select("symbol").distinct().join(done.select("symbol").distinct(), "symbol", "left_anti")


def symbols_in_both(a: DataFrame, b: DataFrame, k: int = 5) -> DataFrame:
    return a.select("symbol").distinct().join(b, "symbol", "left_semi").orderBy("symbol").limit(k)


def compare_series(raw: DataFrame, dense: DataFrame) -> DataFrame:
    """symbol, date, both volatilities and their difference where both series have a point."""
    a = raw.select("symbol", "date", F.col("iv").cast("double").alias("raw_iv"))
    b = dense.where(~F.col("is_interpolated")).select("symbol", "date", F.col("iv").alias("dense_iv"))
    return a.join(b, ["symbol", "date"]).select("symbol", "date", "raw_iv", F.round("dense_iv", 8).alias("dense_iv"), F.round(F.col("raw_iv") - F.col("dense_iv"), 8).alias("difference"))


def pipeline_status(tables: dict[str, DataFrame]) -> DataFrame:
    """table, n_rows, n_symbols of each table."""
    return union_all([df.agg(F.count("*").alias("n_rows"), F.count_distinct("symbol").alias("n_symbols")).select(F.lit(name).alias("table"), "n_rows", "n_symbols") for name, df in tables.items()])


def table_profile(tables: dict[str, tuple[DataFrame | None, str]]) -> DataFrame:
    """table, exists, n_rows, n_symbols, first, last of each table; tables: name to (table or null, time column)."""
    out = []
    for name, (df, ts) in tables.items():
        if df is None:
            continue
        stats = df.agg(F.count("*").alias("n_rows"), F.count_distinct("symbol").alias("n_symbols"), F.min(ts).alias("first"), F.max(ts).alias("last"))
        out.append(stats.select(F.lit(name).alias("table"), F.lit(True).alias("exists"), "*"))
    missing = [name for name, (df, _) in tables.items() if df is None]
    if missing and out:
        nothing = out[0].sparkSession.createDataFrame([(m, False, 0, 0) for m in missing], "table string, exists boolean, n_rows bigint, n_symbols bigint")
        out.append(nothing.withColumns({"first": F.lit(None).cast("timestamp_ntz"), "last": F.lit(None).cast("timestamp_ntz")}))
    return union_all(out)


def symbol_breakdown(dense: DataFrame, k: int = 10) -> DataFrame:
    """The k symbols with the most rows: rows, first, last, minutes between."""
    span = F.timestamp_diff("MINUTE", F.min("date"), F.max("date")).alias("minutes")
    return dense.groupBy("symbol").agg(F.count("*").alias("n_rows"), F.min("date").alias("first"), F.max("date").alias("last"), span).orderBy(F.desc("n_rows"), "symbol").limit(k)


def candle_breakdown(df: DataFrame) -> DataFrame:
    return df.groupBy("symbol").agg(F.count("*").alias("n_candles"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"), F.round(F.sum("volume"), 2).alias("total_volume"))


def candle_quality(df: DataFrame) -> DataFrame:
    """One row: how many candles keep each rule, mean spread and volume."""
    o, h, l, c, v = (F.col(x) for x in ("open", "high", "low", "close", "volume"))
    return df.agg(
        F.count("*").alias("total"), F.count_if(h >= l).alias("valid_high_low"), F.count_if((h >= o) & (h >= c)).alias("valid_high"), F.count_if((l <= o) & (l <= c)).alias("valid_low"),
        F.count_if(v >= 0).alias("valid_volume"), F.round(F.avg(h - l), 4).alias("avg_spread"), F.round(F.avg(v), 2).alias("avg_volume"),
    )


def size_class(n: Column) -> Column:
    return F.when(n < 1000, "small").when(n < 10_000, "medium").when(n < 50_000, "large").otherwise("xlarge")


def symbol_profile(df: DataFrame) -> DataFrame:
    """Per symbol, the largest first: rows, first, last, distinct dates, span in hours, growth on the grid, size."""
    stats = df.groupBy("symbol").agg(F.count("*").alias("n_rows"), F.min("date").alias("first"), F.max("date").alias("last"), F.count_distinct("date").alias("n_dates"))
    stats = stats.withColumn("span_hours", F.timestamp_diff("SECOND", "first", "last") / 3600)
    stats = stats.withColumn("factor", F.greatest(F.lit(1), F.floor(F.try_divide(F.col("span_hours") * 60, F.col("n_dates")))).cast("long"))
    out = stats.withColumn("complexity", F.col("n_rows") * F.col("factor")).withColumn("size_class", size_class(F.col("n_rows")))
    return out.withColumn("span_hours", F.round("span_hours", 4)).orderBy(F.desc("complexity"), "symbol")


def hourly_density(df: DataFrame) -> DataFrame:
    """Points a symbol and hour."""
    return df.groupBy("symbol", F.date_trunc("hour", "date").cast("timestamp_ntz").alias("hour")).agg(F.count("*").alias("n_points"))


def most_populated(df: DataFrame) -> DataFrame:
    return df.groupBy("symbol").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "symbol").limit(1).select("symbol")


def sample_comparison(minute: DataFrame, candles: DataFrame, n_minute: int = 10, n_candles: int = 2) -> DataFrame:
    """First minute and first N-minute candles of the symbol with the most candles, by time."""
    symbol = most_populated(candles)
    columns = ["symbol", "timestamp", "frequency", "open", "high", "low", "close", "volume"]
    small = head_per_symbol(minute.join(symbol, "symbol", "left_semi"), n_minute).withColumn("frequency", F.lit("1min")).select(*columns)
    large = head_per_symbol(candles.join(symbol, "symbol", "left_semi"), n_candles).select(*columns)
    return small.unionByName(large).orderBy("timestamp", "frequency")


def stage_ratios(status: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """from_table, to_table and the ratio of their rows for each pair of pipeline_status."""
    named = status.agg(F.map_from_entries(F.collect_list(F.struct("table", "n_rows"))).alias("m"))
    rows = F.array(*[F.struct(F.lit(a).alias("from_table"), F.lit(b).alias("to_table"), F.round(F.try_divide(F.try_element_at("m", F.lit(b)), F.try_element_at("m", F.lit(a))), 6).alias("ratio")) for a, b in pairs])
    return named.select(F.inline(rows))


def stage_progress(status: DataFrame, pairs: list[tuple[str, str]], minutes_per_symbol: float = 0.5) -> DataFrame:
    """stage (the table it fills), done, total, percent, remaining minutes."""
    named = status.agg(F.map_from_entries(F.collect_list(F.struct("table", "n_symbols"))).alias("m"))
    rows = F.array(*[F.struct(F.lit(b).alias("stage"), F.try_element_at("m", F.lit(b)).alias("done"), F.try_element_at("m", F.lit(a)).alias("total")) for a, b in pairs])
    out = named.select(F.inline(rows))
    left = F.greatest(F.col("total") - F.col("done"), F.lit(0))
    return out.withColumn("percent", F.round(F.try_divide(F.col("done") * 100.0, F.col("total")), 2)).withColumn("remaining_minutes", left * minutes_per_symbol)


def volume_summary(df: DataFrame) -> DataFrame:
    """n_rows, n_symbols and whole rows a symbol."""
    stats = df.agg(F.count("*").alias("n_rows"), F.count_distinct("symbol").alias("n_symbols"))
    return stats.withColumn("rows_per_symbol", F.expr("n_rows div nullif(n_symbols, 0)"))
