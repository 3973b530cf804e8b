"""Scans, appends, upserts and constraints of the tables, kept as Parquet folders."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.cluster import has_files
from tickloom.sources.schemas import SPECS, TICKERS, Spec

CANDLE_COLUMNS = ("symbol", "timestamp", "open", "high", "low", "close", "volume")


def read_tickers(spark: SparkSession, path: str) -> DataFrame:
    """The 13 columns of the source, whatever else the files hold."""
    return spark.read.parquet(path).select(*TICKERS.names)


def read_tickers_jdbc(spark: SparkSession, url: str, table: str, column: str, lower: str, upper: str, partitions: int, **options) -> DataFrame:
    """The source in a database, read in ranges of one column."""
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=partitions, properties={"fetchsize": "10000", **options}).select(*TICKERS.names)


def batches(spark: SparkSession, path: str) -> list[int]:
    """The batches below path, each of which is a Store."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []
    return sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))


def read_interpolated(spark: SparkSession, path: str, batch_id: int | None = None) -> DataFrame:
    """Dense rows with their date as timestamp; of one batch if given, which reads that batch's files only."""
    from tickloom.sources.store import Store

    found = [n for n in batches(spark, path) if batch_id in (None, n)]
    rows = [Store(spark, f"{path}/batch_id={n}").read() for n in found] or [spark.createDataFrame([], SPECS["dense"].schema)]
    return union_all(rows).withColumnRenamed("date", "timestamp")


def read_candles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*CANDLE_COLUMNS)


def latest_rows(df: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Of several batches of a symbol the rows of its latest."""
    newest = df.groupBy("symbol").agg(F.max(batch).alias("__batch"))
    return df.join(newest, (df["symbol"] == newest["symbol"]) & df[batch].eqNullSafe(newest["__batch"]), "left_semi")


def to_decimal(c: Column, kind: T.DataType) -> Column:
    """Null where the value is NaN or does not fit."""
    c = F.when(F.isnan(c.cast("double")), None).otherwise(c)
    return c.try_cast(kind)


def _cast(c: Column, was: T.DataType, kind: T.DataType) -> Column:
    """c once and no more: a conversion to decimal costs more than all else that is done to a row."""
    if was == kind:
        return c
    if not isinstance(kind, T.DecimalType) or isinstance(was, T.DecimalType):
        return c.try_cast(kind)
    return F.nanvl(c, F.lit(None).cast("double")).try_cast(kind) if isinstance(was, T.DoubleType) else to_decimal(c, kind)


def conform(df: DataFrame, schema: T.StructType, defaults: dict[str, object | Column] | None = None) -> DataFrame:
    """Exactly the columns of schema: those that df has, cast, and for the others the default or null."""
    defaults = defaults or {}
    there, out = {f.name: f.dataType for f in df.schema}, []
    for f in schema:
        if f.name in there:
            c = _cast(F.col(f.name), there[f.name], f.dataType)
        else:
            d = defaults.get(f.name)
            c = (d if isinstance(d, Column) else F.lit(d)).cast(f.dataType)
        out.append(c.alias(f.name))
    return df.select(*out)


def append_interpolated(df: DataFrame, path: str, batch_id: int, symbols: DataFrame | None = None) -> None:
    """Adds dense rows to a batch, in files clustered by symbol and date. Symbols (those of df, if not given) that the
    batch has already are replaced, so that the same rows may be added again. Rows that are shuffled by symbol, as
    densify's are, are written as they are dealt."""
    from tickloom.sources.store import Store

    spec, spark = SPECS["dense"], df.sparkSession
    rows = conform(df.withColumn("batch_id", F.lit(batch_id)), spec.schema, spec.defaults)
    store = Store(spark, f"{path}/batch_id={batch_id}", spec.schema, ("symbol",), ("symbol", "date"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    store.replace(enforce(rows, spec)[0], symbols, dealt=True, writer=("append", (store.taken("append") or 0) + 1))


def _reason(spec: Spec) -> Column:
    tests = [(F.col(c).isNull(), f"{c} is null") for c in spec.not_null]
    if spec.candle:
        tests += [
            (F.col("high") < F.col("low"), "high below low"),
            ((F.col("high") < F.col("open")) | (F.col("high") < F.col("close")), "high below open or close"),
            ((F.col("low") > F.col("open")) | (F.col("low") > F.col("close")), "low above open or close"),
            (F.col("volume") < 0, "negative volume"),
        ]
    return F.coalesce(*(F.when(test, F.lit(text)) for test, text in tests))


def enforce(df: DataFrame, spec: Spec, dealt: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows that the table takes, rows that it rejects with the reason). Rows with values that do not fit their
    decimal count as null there; of rows that share the key all but one (the first that breaks no rule, by the other
    columns) are rejected as duplicates. Keys are counted with map-side combine; only rows of a key that stands several
    times are ranked. dealt: rows are shuffled by columns of the key already; all are ranked where they stand, computed once
    and not shuffled again."""
    rows = conform(df, spec.schema, spec.defaults).withColumn("reason", _reason(spec))
    w = Window.partitionBy(*spec.key).orderBy(F.col("reason").isNotNull(), *[c for c in spec.schema.names if c not in spec.key])
    ranked = lambda df: df.withColumn("__n", F.row_number().over(w)).withColumn("reason", F.coalesce("reason", F.when(F.col("__n") > 1, "duplicate key"))).drop("__n")
    if spec.key and dealt:
        rows = ranked(rows)
    elif spec.key:
        again = rows.groupBy(*[F.col(c).alias(f"__{c}") for c in spec.key]).agg(F.count("*").alias("__n")).where("__n > 1").drop("__n")
        same = functools.reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in spec.key])
        rows = rows.join(again, same, "left_anti").unionByName(ranked(rows.join(again, same, "left_semi")))
    return rows.where("reason is null").drop("reason"), rows.where("reason is not null")


def dedupe_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of rows with equal keys the last by order; one row a key meets the others in partial aggregation."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("__last")
    return df.groupBy(*keys).agg(last).select(*[F.col(c) if c in keys else F.col("__last")[c].alias(c) for c in df.columns])


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], policy: str = "update", update_cols: list[str] | None = None) -> DataFrame:
    """existing with incoming (one row a key) merged in by keys: update (only update_cols of rows that exist, if
    given) or ignore. A new table: write it to a new folder, never over the one it is read from."""
    if policy == "ignore":
        return existing.unionByName(incoming.join(existing, keys, "left_anti").select(*existing.columns))
    if policy != "update":
        raise ValueError(f"unknown policy {policy}")
    rest = [c for c in existing.columns if c not in keys]
    changed = set(update_cols or rest)
    old = existing.select(*keys, F.struct(*rest).alias("__old"))
    new = incoming.select(*keys, F.struct(*rest).alias("__new"))
    both = old.join(new, keys, "full_outer")
    pick = lambda c: F.when(F.col("__new").isNull(), F.col("__old")[c]).when(F.col("__old").isNull(), F.col("__new")[c]).otherwise(F.col("__new" if c in changed else "__old")[c])
    return both.select(*[F.col(c) if c in keys else pick(c).alias(c) for c in existing.columns])


def init_tables(spark: SparkSession, root: str, reset: bool = False) -> DataFrame:
    """Empty tables where there are none (reset: everywhere). table and created of each."""
    made = []
    for name, spec in SPECS.items():
        path = f"{root}/{name}"
        there = has_files(spark, path)
        if reset or not there:
            spark.createDataFrame([], spec.schema).write.mode("overwrite").parquet(path)
        made.append((name, reset or not there))
    return spark.createDataFrame(made, "table string, created boolean")


def write_snapshot(df: DataFrame, path: str) -> None:
    """Appends rows as JSON lines."""
    df.write.mode("append").json(path)


def head_per_symbol(df: DataFrame, n: int, order: str = "timestamp") -> DataFrame:
    """The first n rows of each symbol; the rank filter lets Spark cut before the shuffle."""
    w = Window.partitionBy("symbol").orderBy(order)
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)
