"""What every job needs from the cluster: shared folders, the shipped package, saved tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset on a local master (tests) a new temporary one. Other
    masters must set it: their executors do not see the driver's folders."""
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir", None) or spark.conf.get("tickloom.shared.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        found = f"file://{tempfile.mkdtemp(prefix='spark-shared-')}"
        spark.conf.set("tickloom.shared.dir", found)
    return found.rstrip("/")


def _written(df: DataFrame, path: str, *by: str) -> DataFrame:
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet below the shared folder and reads it again: later steps start from files that every
    executor can reach, so that a lost executor costs no earlier step."""
    return _written(df, f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}")


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or folder of any file system that Spark reads; none there is no error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether path is a file, or a folder that is not empty, of any file system that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(where) and len(files.listStatus(where)) > 0


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """saved() into a folder of its own that goes with the block: what outlives it must be saved elsewhere. Columns named
    after the name get folders of their own."""
    base = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
    try:
        yield lambda df, name, *by: _written(df, f"{base}/{name}-{uuid.uuid4().hex}", *by)
    finally:
        delete(spark, base)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once for each Spark application."""
    sc = spark.sparkContext
    if getattr(sc, "_tickloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="spark-ship-")) / "tickloom-src.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, Path("tickloom") / p.relative_to(root))
    sc.addPyFile(str(archive))
    sc._tickloom_shipped = True
