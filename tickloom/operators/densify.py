"""Sparse tickers to a one-minute grid: linear interpolation by position and forward fill.

The grid is never joined: each anchor (a row on its symbol's grid) makes the rows up to the next anchor by
explode(sequence). Only the sparse rows are shuffled, once, by symbol; the dense rows are born map-side after it. The
gates are an aggregate with map-side combine. Their bounds on a symbol's span and grid can be taken off (None): no step
holds a grid, or more of a gap than its days and the minutes of one of them.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.cluster import saved

NUMERIC = ("iv", "underlying_price", "time_to_maturity")
FILL = ("strike", "callput", "interest_rate", "mark_price", "index_price", "volume", "quote_volume", "record_time")
REQUIRED = ("symbol", "iv", "underlying_price", "time_to_maturity")
DAY = 1440  # minutes


def _minutes(a: Column, b: Column) -> Column:
    """Whole minutes from a to b."""
    return F.timestamp_diff("MINUTE", a, b)


def symbol_gates(df: DataFrame, min_points: int = 10, max_span_days: int | None = 30, max_points: int | None = 100_000) -> DataFrame:
    """symbol, rows, first, last and gate (null, or why the symbol is left out). A bound of None leaves no symbol out."""
    stats = df.where("symbol is not null and date is not null").groupBy("symbol").agg(F.count("*").alias("rows"), F.min("date").alias("first"), F.max("date").alias("last"))
    span = F.timestamp_diff("SECOND", "first", "last")
    gate = F.when(F.col("rows") < min_points, F.lit("too few rows"))
    if max_span_days is not None:
        gate = gate.when(span > max_span_days * 86400, F.lit("span too long"))
    if max_points is not None:
        gate = gate.when(_minutes(F.col("first"), F.col("last")) + 1 > max_points, F.lit("grid too long"))
    return stats.withColumn("gate", gate)


def ffill(df: DataFrame, cols: list[str], order: list[str], partition: str = "symbol", pieces: int | None = None) -> DataFrame:
    """cols with nulls replaced by the last value before them. Rows are dealt out by ranges of (partition, order), so that
    pieces (shuffle partitions, if not given) are of about equal size however many rows a symbol has, and each is filled
    by itself; what a piece does not know comes from the last values of the symbol's pieces before it. Rows of equal
    order stand in one piece, in any order. The first piece's leading nulls stay."""
    n = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    with_piece = df.repartitionByRange(n, partition, *order).withColumn("__piece", F.spark_partition_id())
    rows = saved(with_piece, "pieces")  # the pieces stay as they are
    at = F.struct(*order)
    last = rows.groupBy(F.col(partition).alias("__of"), F.col("__piece").alias("__p")).agg(*[F.max(F.when(F.col(c).isNotNull(), F.struct(at.alias("at"), F.col(c).alias("v")))).alias(f"__{c}") for c in cols])
    before = Window.partitionBy("__of").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # a row a piece
    carried = last.select("__of", "__p", *[F.last(f"__{c}", ignorenulls=True).over(before)["v"].alias(f"__{c}") for c in cols])
    own = Window.partitionBy(partition, "__piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(carried, F.col(partition).eqNullSafe(F.col("__of")) & (F.col("__piece") == F.col("__p")), "left")
    return rows.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(own), f"__{c}") for c in cols}).select(*df.columns)


def _anchors(df: DataFrame, numeric, fill, min_points: int, max_span_days: int | None, max_points: int | None, align: str) -> DataFrame:
    """The rows on their symbols' grids, filled, each with the values of the next (__next_...), the minutes up to it
    (__step) and the last number of the rows that it makes, counted from 0 (__last)."""
    df = df.where("symbol is not null and date is not null").select("symbol", "date", *[F.col(c).cast("double").alias(c) for c in numeric], *fill)
    if align == "floor":
        df = df.withColumn("date", F.date_trunc("minute", "date").cast("timestamp_ntz"))
    gates = symbol_gates(df, min_points, max_span_days, max_points).where("gate is null").select("symbol", F.col("first").alias("__t0"), F.col("last").alias("__t1"))
    rows = df.join(gates, "symbol").where(F.timestamp_diff("MICROSECOND", "__t0", "date") % 60_000_000 == 0)
    ties = [*fill, *numeric]
    w = Window.partitionBy("symbol").orderBy("date", *ties)
    behind = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("__gap", _minutes(F.col("date"), F.lead("date").over(w)))
    rows = rows.withColumn("__step", F.greatest(F.col("__gap"), F.lit(1)))
    rows = rows.withColumn("__pos", F.coalesce(F.sum("__step").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # what lies ahead is met first from the other end: a frame from here to the end would be read anew for every row
    ahead = Window.partitionBy("symbol").orderBy(F.desc("__pos")).rowsBetween(Window.unboundedPreceding, 0)
    points = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), F.col("__pos").alias("p"))) for c in numeric}
    # columns of their own: Spark computes a window anew for each field that is taken from it
    rows = rows.withColumns({**{f"__a_{c}": F.last(points[c], ignorenulls=True).over(behind) for c in numeric}, **{c: F.last(c, ignorenulls=True).over(behind) for c in fill}})
    rows = rows.withColumns({f"__b_{c}": F.last(points[c], ignorenulls=True).over(ahead) for c in numeric})
    here = {}
    for c in numeric:
        a, b = F.col(f"__a_{c}"), F.col(f"__b_{c}")
        between = a["v"] + (b["v"] - a["v"]) / F.nullif(b["p"] - a["p"], F.lit(0)) * (F.col("__pos") - a["p"])
        here[c] = F.coalesce(F.col(c), between, a["v"])
    rows = rows.withColumns(here).drop(*[f"__{x}_{c}" for x in "ab" for c in numeric])
    # seen from the other end the next row is the one before, and the rows need not be sorted back
    rows = rows.withColumns({f"__next_{c}": F.lag(c).over(Window.partitionBy("symbol").orderBy(F.desc("__pos"))) for c in numeric})
    return rows.withColumn("__last", F.when(F.col("__gap").isNotNull(), F.col("__step") - 1).otherwise(_minutes(F.col("date"), F.col("__t1"))))


def _value(c: str, k: Column) -> Column:
    """Column c of the k-th row that an anchor makes."""
    return F.coalesce(F.col(c) + (F.col(f"__next_{c}") - F.col(c)) / F.col("__step") * k, F.col(c))


def densify(df: DataFrame, numeric=NUMERIC, fill=FILL, min_points: int = 10, max_span_days: int | None = 30, max_points: int | None = 100_000, align: str = "exact") -> DataFrame:
    """One row a symbol and minute (more where an anchor's date stands several times), with is_interpolated.

    align: exact drops rows off the grid of the symbol's first row, floor cuts dates to the minute first. Nulls of the
    numeric columns are interpolated at anchors by position; leading ones stay null and their rows go."""
    numeric, fill = [c for c in numeric if c in df.columns], [c for c in fill if c in df.columns]
    out = _anchors(df, numeric, fill, min_points, max_span_days, max_points, align)
    # by day, then by minute: a gap of years is no long array
    out = out.withColumn("__day", F.explode(F.sequence(F.lit(0), F.floor(F.col("__last") / DAY).cast("int"))))
    out = out.withColumn("__minute", F.explode(F.sequence(F.lit(0), F.least(F.col("__last") - F.col("__day").cast("long") * DAY, F.lit(DAY - 1)).cast("int"))))
    k = F.col("__day").cast("long") * DAY + F.col("__minute")
    out = out.select(
        "symbol", (F.col("date") + F.make_dt_interval(days=F.col("__day"), mins=F.col("__minute"))).alias("date"), *[_value(c, k).alias(c) for c in numeric], *fill, (k > 0).alias("is_interpolated")
    )
    return out.dropna(subset=[c for c in REQUIRED if c in out.columns])


def dense_symbols(df: DataFrame, numeric=NUMERIC, fill=FILL, min_points: int = 10, max_span_days: int | None = 30, max_points: int | None = 100_000, align: str = "exact") -> DataFrame:
    """The symbols of densify()'s rows, without making these: whether a row stays is the same for all that an anchor makes
    after its first, so its first two tell."""
    numeric, fill = [c for c in numeric if c in df.columns], [c for c in fill if c in df.columns]
    rows = _anchors(df, numeric, fill, min_points, max_span_days, max_points, align)

    def stays(k: int) -> Column:
        values = [_value(c, F.lit(k)) for c in numeric if c in REQUIRED]
        return functools.reduce(Column.__and__, [v.isNotNull() & ~F.isnan(v) for v in values], F.col("__last") >= k)

    return rows.where(stays(0) | stays(1)).select("symbol").distinct()


def split_points(dense: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(original points, interpolated points)"""
    return dense.where(~F.col("is_interpolated")), dense.where("is_interpolated")
