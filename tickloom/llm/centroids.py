"""Centroid clustering by bit planes.

A vector's components become the integers floor(scale * x). Bit j of all its components, in two's complement, is packed
into a plane: one 64-bit word for 64 components, ceil(d / 64) words for d. The dot product of two vectors is the sum over
pairs of planes of 2^(i + j) times the number of bits that both planes have (negative where just one of them is a sign
plane), so AND and popcount give exact dot products, and with the squared lengths exact distances.

Planes are saved once; each round is one map over them, in which tasks find the nearest centroids and add up their
clusters. The driver holds the k centroids only. Sums travel as limbs of 24 bits of the components, so that no sum
passes 64 bits below 2^39 vectors. A vector has as many planes as its largest component needs; where a distance might
pass 64 bits it is computed in Python's integers.

Vectors that are null, of another length, or hold a component that is null, NaN or infinite are left out. Equal ids are
vectors of their own; among equal ids the start takes that with the smaller components, null ids come last. Fewer vectors
than centroids: as many centroids as vectors. A distance or inertia beyond 64 bits is null. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.cluster import saved, scratch, ship

LIMB = 24
#: Vectors of a block in tasks.
BLOCK = 2048
_MOST = 2**63 - 1
_PLANES = "vec_id long, width int, planes binary"


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x); as Python's integers where 64 bits might not do."""
    x = x.astype(np.float64)
    if np.abs(x).max(initial=0) < 2.0**62 / scale:
        return np.floor(x * scale).astype(np.int64)
    out = np.empty(x.size, object)
    out[:] = [int(v) * scale if abs(v) >= 2.0**53 else math.floor(v * scale) for v in x.ravel().tolist()]
    return out.reshape(x.shape)


def width(q: np.ndarray) -> int:
    """Bits of two's complement that all of q need, one at least."""
    return max([1, *((int(v) if v >= 0 else -int(v) - 1).bit_length() + 1 for v in (q.max(initial=0), q.min(initial=0)))])


def pack(q: np.ndarray, bits: int) -> np.ndarray:
    """Planes of each row of q: rows x bits x words of 64 components."""
    n, d = q.shape
    words = -(-d // 64)
    out = np.zeros((n, bits, words), np.uint64)
    for j in range(bits):
        one = np.zeros((n, words * 64), np.uint8)
        one[:, :d] = ((q >> j) & 1).astype(np.uint8)
        out[:, j] = np.packbits(one, axis=1, bitorder="little").view(np.uint64)
    return out


def unpack(planes: np.ndarray, d: int) -> np.ndarray:
    """Rows x planes x d bits."""
    n, bits, words = planes.shape
    return np.unpackbits(np.ascontiguousarray(planes).view(np.uint8).reshape(n, bits, 8 * words), axis=2, bitorder="little")[:, :, :d]


def weights(bits: int) -> list[int]:
    return [*(1 << j for j in range(bits - 1)), -(1 << (bits - 1))]


def dots(x: np.ndarray, y: np.ndarray, kind=np.int64) -> np.ndarray:
    """Dot products of each row of planes x with each of y."""
    out = np.zeros((len(x), len(y)), kind)
    for i, a in enumerate(weights(x.shape[1])):
        for j, b in enumerate(weights(y.shape[1])):
            both = np.bitwise_count(x[:, i, None, :] & y[None, :, j, :]).sum(2, dtype=kind) if x.shape[2] > 1 else np.bitwise_count(x[:, i] & y[:, j, 0][None]).astype(kind)
            out += both * (a * b)
    return out


class Centroids:
    """Integer centroids as planes, for the nearest of them."""

    def __init__(self, values: list[list[int]], d: int):
        self.d, q = d, np.empty((len(values), d), object)
        for i, row in enumerate(values):
            q[i] = row
        self.width = width(q)
        self.planes = pack(q if self.width > 62 else q.astype(np.int64), self.width)
        self.squares = [sum(v * v for v in row) for row in values]

    def nearest(self, planes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the nearest centroid of each row; the smaller number where several are."""
        narrow = 2 * max(self.width, planes.shape[1]) + self.d.bit_length() < 63  # then every distance fits
        kind = np.int64 if narrow else object
        own = (_values(planes, self.d) ** 2).sum(1) if narrow else np.array([dots(p[None], p[None], object)[0, 0] for p in planes], object)
        far = own[:, None] + np.array(self.squares, kind)[None] - 2 * dots(planes, self.planes, kind)
        at = np.argmin(far, axis=1)
        return at, far[np.arange(len(at)), at]


def _values(planes: np.ndarray, d: int, low: int = 0, high: int | None = None) -> np.ndarray:
    """Rows x d: the bits from low to below high of the components; the sign plane counts negative."""
    bits, every = unpack(planes, d), weights(planes.shape[1])
    out = np.zeros((len(planes), d), np.int64)
    for j in range(low, min(len(every), high or len(every))):
        out += bits[:, j].astype(np.int64) * (every[j] >> low)
    return out


def _plane_rows(d: int, scale: int):
    """vec_id and embedding to vec_id, width and planes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                q = integers(x, scale)
                need = np.array([width(row) for row in q]) if q.dtype == object else np.full(len(q), width(q))
                raw = [b""] * len(q)
                for bits in np.unique(need).tolist():
                    rows = np.flatnonzero(need == bits)
                    for i, p in zip(rows.tolist(), pack(q[rows], bits), strict=True):
                        raw[i] = p.tobytes()
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(need, pa.int32()), pa.array(raw, pa.binary())], ["vec_id", "width", "planes"])

    return run


def _groups(batch: pa.RecordBatch, d: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, planes) of the rows of one width and block."""
    need, words = batch.column(1).to_numpy(zero_copy_only=False), -(-d // 64)
    for bits in np.unique(need).tolist():
        rows = np.flatnonzero(need == bits)
        for at in range(0, len(rows), BLOCK):
            some = rows[at : at + BLOCK]
            yield some, np.frombuffer(b"".join(batch.column(2).take(pa.array(some)).to_pylist()), np.uint64).reshape(len(some), bits, words)


def _sum_rows(centroids):
    """cluster, limb, rows and sums of the components of a task's vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Centroids = centroids.value
        sums: dict[tuple[int, int], np.ndarray] = {}  # one for each centroid and limb
        rows: dict[int, int] = {}
        for batch in batches:
            for _, planes in _groups(batch, c.d):
                own, _ = c.nearest(planes)
                order = np.argsort(own, kind="stable")
                first = np.flatnonzero(np.concatenate([[True], np.diff(own[order]) > 0]))
                found = own[order][first].tolist()
                for k, n in zip(found, np.diff(np.append(first, len(own))).tolist(), strict=True):
                    rows[k] = rows.get(k, 0) + n
                for limb in range(-(-planes.shape[1] // LIMB)):
                    part = np.add.reduceat(_values(planes, c.d, limb * LIMB, (limb + 1) * LIMB)[order], first, axis=0)
                    for k, s in zip(found, part, strict=True):
                        sums[k, limb] = sums.get((k, limb), 0) + s
        keys = sorted(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in keys], pa.int32()), pa.array([x for _, x in keys], pa.int32()), pa.array([rows[k] if x == 0 else 0 for k, x in keys], pa.int64()), pa.array([sums[k].tolist() for k in keys], pa.list_(pa.int64()))],
            ["cluster", "limb", "rows", "sums"],
        )

    return run


def _assign_rows(centroids):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Centroids = centroids.value
        for batch in batches:
            cluster, far = np.zeros(batch.num_rows, np.int64), [None] * batch.num_rows
            for rows, planes in _groups(batch, c.d):
                cluster[rows], d = c.nearest(planes)
                for i, v in zip(rows.tolist(), d.tolist(), strict=True):
                    far[i] = v if v <= _MOST else None
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster, pa.int32()), pa.array(far, pa.int64())], ["vec_id", "cluster", "distance"])

    return run


def _moved(planes: DataFrame, values: list[list[int]], d: int) -> list[list[int]]:
    """The centroids after one round: componentwise floor(sum / count) of their vectors, or as before without any."""
    sent = planes.sparkSession.sparkContext.broadcast(Centroids(values, d))
    part = planes.mapInArrow(_sum_rows(sent), "cluster int, limb int, rows long, sums array<long>")
    each = part.select("cluster", "limb", "rows", F.posexplode("sums").alias("i", "s"))
    found = each.groupBy("cluster", "limb", "i").agg(F.sum("rows").alias("rows"), F.sum("s").alias("s")).collect()  # k d rows a limb
    sums = {r.cluster: [0] * d for r in found}
    rows = {r.cluster: r.rows for r in found if r.limb == 0}
    for r in found:
        sums[r.cluster][r.i] += r.s << (LIMB * r.limb)
    return [[s // rows[k] for s in sums[k]] if k in sums else list(v) for k, v in enumerate(values)]


def clusters(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 40, rounds: int = 5, d: int = 64, scale: int = 256, seed: int = 2) -> DataFrame:
    """vec_id, cluster, distance (squared, to the cluster's centroid), cluster_inertia, inertia and centroid_sha256 of every
    vector of d components, after so many rounds of k-means from k vectors that a hash of the id names."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where((F.size("v") == d) & ~bad)
    with scratch(spark) as save:
        planes = save(rows.mapInArrow(_plane_rows(d, scale), _PLANES), "planes")
        name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
        start = rows.orderBy(name.asc_nulls_last(), "v").limit(k).select("v").collect()  # k rows
        values = [[int(v) for v in row] for row in integers(np.array([r.v for r in start], np.float64).reshape(-1, d), scale).tolist()]
        if not values:
            return saved(planes.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256")), "clusters")
        for _ in range(rounds):
            values = _moved(planes, values, d)
        found = save(planes.mapInArrow(_assign_rows(spark.sparkContext.broadcast(Centroids(values, d))), "vec_id long, cluster int, distance long"), "assigned")
        total = lambda c: F.sum(F.col(c).cast("decimal(38, 0)"))
        known = found.groupBy("cluster").agg(F.when(F.count("distance") == F.count("*"), total("distance")).alias("own")).collect()  # k rows
        own = {r.cluster: None if r.own is None else int(r.own) for r in known}
        every = None if None in own.values() else sum(own.values())
        fits = lambda v: v if v is not None and v <= _MOST else None
        sha = lambda row: hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()
        names = spark.createDataFrame([(c, fits(own[c]), fits(every), sha(values[c])) for c in sorted(own)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
        return saved(found.join(F.broadcast(names), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"), "clusters")
