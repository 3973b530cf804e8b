"""Tables kept as bucketed Parquet files under a manifest, with atomic commits.

    root/_manifest/<version>.json    what each bucket consists of, the schema, and how far each writer has come
    root/data/<commit>/__bucket=<b>  rows of one bucket that one commit wrote, sorted

A row's bucket is pmod(hash(by), buckets), as Spark's own shuffle deals rows out: rows that were shuffled by the same
columns are written without another shuffle. A commit writes its files first and then one manifest, by a rename that
fails where that version exists: readers follow the newest manifest and see all of a commit or nothing, and of two writers
of one version one starts again from the other's. A commit rewrites only buckets that it touches. Files that no manifest
kept names any more go after KEEP further commits, so that a read that has begun can end.

A writer that names itself and a number has its commit taken once: it may run again after any failure."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.cluster import delete, scratch
from tickloom.sources.tables import dedupe_last, upsert

#: Versions, besides the newest, whose files stay.
KEEP = 1
#: Commits of which a bucket consists before it is written anew.
MOST_COMMITS = 16


class Store:
    """The table below root: rows of schema in buckets by the columns by, sorted by sort in each file. Where it is there
    already, its own schema, columns and number of buckets hold."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | None = None, by: tuple[str, ...] = (), sort: tuple[str, ...] = (), buckets: int = 64):
        self.spark, self.root = spark, root.rstrip("/")
        if (found := self._newest()) is None:
            if schema is None or not by:
                raise ValueError(f"no table at {root}")
            found = {"version": 0, "schema": schema.jsonValue(), "by": list(by), "sort": list(sort or by), "n_buckets": buckets, "buckets": {}, "writers": {}}
            if not self._put(found):
                found = self._newest()
        self.schema = T.StructType.fromJson(found["schema"])
        self.by, self.sort, self.buckets = found["by"], found["sort"], found["n_buckets"]

    # --- manifests

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        where, fs = self._fs(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._names(f"{self.root}/_manifest") if n.endswith(".json")]

    def _load(self, version: int) -> dict:
        where, fs = self._fs(f"{self.root}/_manifest/{version:012d}.json")
        with_ = fs.open(where)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(with_, "UTF-8"))
        finally:
            with_.close()

    def _newest(self) -> dict | None:
        found = self.versions()
        return self._load(found[-1]) if found else None

    def _put(self, manifest: dict) -> bool:
        """Whether this writer made the version."""
        jvm = self.spark._jvm
        temp, fs = self._fs(f"{self.root}/_manifest/.{uuid.uuid4().hex}")
        out = fs.create(temp, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        to, _ = self._fs(f"{self.root}/_manifest/{manifest['version']:012d}.json")
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(to).toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)  # none: never over another
        try:
            files.rename(fs.makeQualified(temp), fs.makeQualified(to), options)
        except Py4JJavaError as e:
            fs.delete(temp, False)
            if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True

    # --- reading

    def bucket(self, columns: list[str] | None = None) -> Column:
        return F.pmod(F.hash(*(columns or self.by)), F.lit(self.buckets))

    def _rows(self, manifest: dict, buckets: set[int] | None = None) -> DataFrame:
        paths = [f"{self.root}/data/{c}/__bucket={b}" for b, commits in sorted(manifest["buckets"].items(), key=lambda x: int(x[0])) if buckets is None or int(b) in buckets for c in commits]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self, version: int | None = None) -> DataFrame:
        """All rows as the newest manifest, or that of a version that is still kept, has them."""
        return self._rows(self._newest() if version is None else self._load(version))

    def read_group(self, *values) -> DataFrame:
        """The rows whose columns by have these values: one bucket's files, of which Parquet's statistics skip the most."""
        literals = [F.lit(v).cast(self.schema[c].dataType) for c, v in zip(self.by, values, strict=True)]
        own = self.spark.range(1).select(F.pmod(F.hash(*literals), F.lit(self.buckets))).first()[0]
        rows = self._rows(self._newest(), {own})
        for c, v in zip(self.by, literals, strict=True):
            rows = rows.where(F.col(c) == v)
        return rows

    def taken(self, writer: str) -> int | None:
        """The number of the writer's last commit."""
        return self._newest()["writers"].get(writer)

    # --- writing

    def _write(self, rows: DataFrame, dealt: bool, writer: tuple[str, int] | None) -> tuple[str, set[int]]:
        """(folder below data, buckets) of rows. dealt: those of a bucket stand in a few tasks already."""
        commit = f"{_tag(writer)}{uuid.uuid4().hex}"
        rows = rows.select(*self.schema.names).withColumn("__bucket", self.bucket())
        rows = rows if dealt else rows.repartition(self.buckets, *self.by)
        rows.sortWithinPartitions("__bucket", *self.sort).write.partitionBy("__bucket").parquet(f"{self.root}/data/{commit}")
        buckets = {int(n.partition("=")[2]) for n in self._names(f"{self.root}/data/{commit}") if n.startswith("__bucket=")}
        if not buckets:  # no manifest will name it
            delete(self.spark, f"{self.root}/data/{commit}")
        return commit, buckets

    def _clear(self, writer: tuple[str, int] | None) -> None:
        """Removes what the writer wrote in runs that ended before their commit. A writer runs once at a time."""
        if writer:
            live = {c for v in self.versions() for commits in self._load(v)["buckets"].values() for c in commits}
            for n in self._names(f"{self.root}/data"):
                if n.startswith(_tag(writer)) and n not in live:
                    delete(self.spark, f"{self.root}/data/{n}")

    def _done(self, writer: tuple[str, int] | None) -> bool:
        return bool(writer) and self._newest()["writers"].get(writer[0], writer[1] - 1) >= writer[1]

    def _commit(self, change: Callable[[dict], tuple[dict[int, list[str]], list[str]]], writer: tuple[str, int] | None) -> bool:
        """change(manifest) gives the new commits of the buckets that it touches, and the folders that it wrote. Whether
        there was anything to do."""
        while True:
            old = self._newest()
            touched, folders = change(old)
            new = old | {"version": old["version"] + 1, "buckets": {b: c for b, c in (old["buckets"] | {str(b): c for b, c in touched.items()}).items() if c}}
            new["writers"] = old["writers"] | ({writer[0]: writer[1]} if writer else {})
            if self._put(new):
                self.vacuum()
                return bool(touched)
            for f in folders:
                delete(self.spark, f"{self.root}/data/{f}")

    def vacuum(self, keep: int = KEEP) -> None:
        """Removes manifests but the newest and keep before it, and the buckets that only the removed ones name."""
        found = self.versions()
        old, kept = found[: -keep - 1], found[-keep - 1 :]
        if not old:
            return
        pairs = lambda versions: {(c, b) for v in versions for b, commits in self._load(v)["buckets"].items() for c in commits}
        live = pairs(kept)
        commits = {c for c, _ in live}
        for c, b in pairs(old) - live:
            delete(self.spark, f"{self.root}/data/{c}" + ("" if c not in commits else f"/__bucket={b}"))
        for v in old:
            delete(self.spark, f"{self.root}/_manifest/{v:012d}.json")

    def upsert(self, incoming: DataFrame, policy: str = "update", update_cols: list[str] | None = None, order: list[str] | None = None, writer: tuple[str, int] | None = None) -> bool:
        """Merges rows in by the key by: policy and update_cols as sources.tables.upsert. order: of rows with equal keys
        the last by these columns counts; without it incoming has one row a key. writer: (name, number)."""
        if self._done(writer):
            return False
        self._clear(writer)
        with scratch(self.spark) as save:
            one = save(dedupe_last(incoming.select(*self.schema.names), self.by, order) if order else incoming.select(*self.schema.names), "incoming")
            touched = {r[0] for r in one.select(self.bucket().alias("b")).distinct().collect()}  # at most the buckets

            def change(old: dict):
                if not touched:
                    return {}, []
                there = touched & {int(b) for b in old["buckets"]}
                rows = upsert(self._rows(old, there), one, self.by, policy, update_cols) if there else one
                commit, buckets = self._write(rows, False, writer)
                return {b: [commit] if b in buckets else [] for b in touched}, [commit]

            return self._commit(change, writer)

    def replace(self, rows: DataFrame, groups: DataFrame | None = None, by: list[str] | None = None, dealt: bool = False, writer: tuple[str, int] | None = None) -> bool:
        """Puts rows in the place of all rows of their groups: of equal columns by (the table's own by; a part of the rows
        that has a group has all of it). groups: the groups that go, also those without a row; without it those of
        rows. Running it again changes nothing. dealt: rows are shuffled by the table's columns already."""
        if self._done(writer):
            return False
        self._clear(writer)
        by = by or self.by
        commit, buckets = self._write(rows, dealt, writer)
        fresh = {b: [commit] for b in buckets}
        gone = (groups if groups is not None else self._rows({"buckets": fresh})).select(*by).distinct()

        def change(old: dict):
            there = {int(b): commits for b, commits in old["buckets"].items()}
            hit = self._rows(old).select(*by).join(gone, by, "left_semi").select(self.bucket()).distinct().collect() if there else []  # at most the buckets
            hit = {r[0] for r in hit} | {b for b in fresh if len(there.get(b, [])) >= MOST_COMMITS}
            rest, left = self._write(self._rows(old, hit).join(gone, by, "left_anti"), True, writer) if hit else (None, set())
            kept = lambda b: ([rest] if b in left else []) if b in hit else there.get(b, [])
            return {b: [*fresh.get(b, []), *kept(b)] for b in hit | set(fresh)}, [rest] if rest else []

        return self._commit(change, writer)


def _tag(writer: tuple[str, int] | None) -> str:
    return hashlib.sha256(writer[0].encode()).hexdigest()[:12] + "-" if writer else ""
