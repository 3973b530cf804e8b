"""Candles and upserts on streams."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.cluster import scratch
from tickloom.operators.candles import candle_aggregates, frequency_minutes
from tickloom.sources.store import Store

#: Rows of a micro-batch that a partition of its state is worth: every micro-batch opens and commits the store of each.
STATE_ROWS = 50_000


def stream_candles(stream: DataFrame, freq: str = "5min", watermark: str = "10 minutes") -> DataFrame:
    """resample_candles on a stream of one-minute candles; timestamp must be a TIMESTAMP. A bucket is given once the
    watermark has passed it; rows later than that are dropped."""
    n = frequency_minutes(freq)
    out = stream.withWatermark("timestamp", watermark).groupBy("symbol", F.window("timestamp", f"{n} minutes").alias("w")).agg(*candle_aggregates()).where(F.col("n_rows") >= n)
    return out.select("symbol", F.col("w.start").alias("timestamp"), "open", "high", "low", "close", "volume", F.lit(freq).alias("frequency"), F.lit(n).alias("source_candles"))


def write_in_order(rows: DataFrame, path: str, length: str, column: str = "timestamp") -> tuple[int, int]:
    """Writes rows to a folder for a file stream, slice by slice of so long a time: files of a later slice are younger, and
    a file stream takes the oldest files first. Rows of a slice are dealt to as many files as they are worth. A stream
    whose watermark is at least as long as a slice finds no row late, however its micro-batches cut the files. The numbers
    of slices and files."""
    spark = rows.sparkSession
    with scratch(spark) as save:
        slices = save(rows.withColumn("__slice", F.window(column, length)["start"].cast("long")), "slices", "__slice")  # a slice is read by itself
        starts = [r[0] for r in slices.select("__slice").distinct().orderBy("__slice").collect()]  # a row a slice
        for at in starts:
            slices.where(F.col("__slice").eqNullSafe(F.lit(at))).drop("__slice").write.mode("append").parquet(path)
    return len(starts), len(spark.read.schema(rows.schema).parquet(path).inputFiles()) if starts else 0


def state_partitions(rows: DataFrame, batches: int) -> int:
    """Partitions of the state of a stream that takes rows in so many micro-batches: as many as these are worth, at least
    one a core and at most the shuffle's."""
    spark = rows.sparkSession
    worth = -(-rows.count() // (max(1, batches) * STATE_ROWS))
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(spark.sparkContext.defaultParallelism, worth))


@contextmanager
def spilling_state(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Streams that start within keep their state in RocksDB, on the executors' disks, instead of their heaps, and commit
    what a micro-batch changed, not the whole state. partitions of it: the shuffle's, if not given."""
    kinds = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        **({"spark.sql.shuffle.partitions": str(partitions)} if partitions else {}),
    }
    before = {key: spark.conf.get(key, None) for key in kinds}
    for key, kind in kinds.items():
        spark.conf.set(key, kind)
    try:
        yield
    finally:
        for key, kind in before.items():
            spark.conf.unset(key) if kind is None else spark.conf.set(key, kind)


def run_to_end(found: DataFrame, out: str, state: str, partitions: int | None = None):
    """Writes a stream's rows to Parquet until its source has no more. The ended query."""
    with spilling_state(found.sparkSession, partitions):
        query = found.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    return query


def with_closing_row(minute: DataFrame, after: str = "1 day") -> DataFrame:
    """minute and one row without symbol or prices so long after its last: as the end of a stream it takes the watermark
    past every window before it, and its own window never has enough rows."""
    end = minute.agg(F.max("timestamp").alias("timestamp")).where("timestamp is not null").select((F.col("timestamp") + F.expr(f"interval {after}")).alias("timestamp"))
    return minute.unionByName(end, allowMissingColumns=True)


def upsert_stream(stream: DataFrame, root: str, keys: list[str], order: list[str], policy: str = "update", checkpoint: str | None = None, buckets: int = 64, per_trigger: str | None = None):
    """A query that merges every micro-batch into the Store below root, one commit a micro-batch. The commit names the
    stream's checkpoint and the micro-batch, so that one that runs again is taken once; readers see whole micro-batches
    only. Of rows with equal keys in a micro-batch the last by order counts; between micro-batches the later one.
    per_trigger: a micro-batch each such interval; without it, all that is there and then an end."""
    where = checkpoint or f"{root}/_stream"
    store = Store(stream.sparkSession, root, stream.schema, tuple(keys), buckets=buckets)

    def merge(batch: DataFrame, n: int) -> None:
        store.upsert(batch, policy, order=order, writer=(where, n))

    writer = stream.writeStream.foreachBatch(merge).outputMode("update").option("checkpointLocation", where)
    return (writer.trigger(processingTime=per_trigger) if per_trigger else writer.trigger(availableNow=True)).start()


def read_upserted(spark: SparkSession, root: str) -> DataFrame:
    """The table below root, as the last micro-batch left it."""
    return Store(spark, root).read()
