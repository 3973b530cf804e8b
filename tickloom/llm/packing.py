"""Best-fit packing of token sequences with exact-complement hashing.

Texts are tokenized once, inside tasks, into pieces of at most `limit` ids; only the pieces' places, lengths and
checksums are kept. How many pieces there are of each length is all that the plan needs: at most `limit` counts,
whatever the input. For every length from the largest down, the plan looks up the gap in the index of single lengths,
then of pair sums, then of triple sums, and consumes the combination as often as counts allow; each step uses up one
length, so there are at most `limit` of them. What is left is placed best-fit, largest first, again count by count.
Pieces of one length are interchangeable: each takes its rank among them (counted within hash buckets, at least
as many as shuffle partitions, and shifted by the buckets before, so no length is ranked in one task), and its rank says which sequence it goes to and where.

Null texts are empty and hold the end id alone. Rows that share an id are packed each for itself. Every sequence is
filled from offset 0 without gaps.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.cluster import saved, ship

LIMIT, END_ID, BUCKET_ROWS = 1024, 2, 100_000
VOCABULARY = "byte_bpe_50k"


@cache
def _encoders(vocabulary: str):
    """(fast encoder, strings that only the full tokenizer knows, full tokenizer). Both give the same ids."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return fast, [t.content for t in full.get_added_tokens_decoder().values()], full


def encode(text: str, vocabulary: str = VOCABULARY) -> np.ndarray:
    fast, special, full = _encoders(vocabulary)
    if any(s in text for s in special):
        return np.array(full.encode(text, add_special_tokens=False).ids, "<u4")
    return np.array(fast.encode_ordinary(text), "<u4")


def _texts(column: pa.Array) -> Iterator[str]:
    for x in column.cast(pa.binary()):
        yield (x.as_py() or b"").decode("utf-8", "replace")


def _pieces(text: str, limit: int, end_id: int, vocabulary: str) -> Iterator[tuple[int, np.ndarray]]:
    ids = np.append(encode(text, vocabulary), np.array([end_id], "<u4"))
    first = (len(ids) - 1) % limit + 1
    yield 0, ids[:first]
    for start in range(first, len(ids), limit):
        yield start, ids[start : start + limit]


def _piece_rows(limit: int, end_id: int, vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                rows: list[list[int]] = [[], [], [], [], []]
                for i, text in enumerate(_texts(batch.column(1))):
                    for n, (start, ids) in enumerate(_pieces(text, limit, end_id, vocabulary)):
                        for r, x in zip(rows, (i, n, start, len(ids), zlib.crc32(ids.tobytes())), strict=True):
                            r.append(x)
                ids = batch.column(0).take(pa.array(rows[0], pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(rows[1], pa.int32()), *(pa.array(r, pa.int64()) for r in rows[2:])], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


class Sums:
    """The sums of two and of three available lengths, by sum. Counts only fall, so what they cannot serve any more is
    taken out of the index for good, and a look-up costs about what it takes out."""

    def __init__(self, left: np.ndarray):
        """left: counts of each length, which the plan goes on lowering."""
        self.left, lengths = left, np.flatnonzero(left)
        lengths = lengths[lengths > 0]
        i, j = np.triu_indices(len(lengths))
        small, total = lengths[i], lengths[i] + lengths[j]
        order = np.lexsort((-small, total))
        bounds = np.searchsorted(total[order], np.arange(len(left) + 1))
        #: Of each sum the smaller length of its pairs, the smallest last.
        self.pairs = [small[order[a:b]].tolist() for a, b in pairwise(bounds)]
        #: Of each sum the lengths that leave the sum of a pair, the largest last.
        self.triples = [[a for a in lengths.tolist() if a < total and self.pairs[total - a]] for total in range(len(left))]

    def _fits(self, total: int, small: int) -> bool:
        return self.left[small] > (2 * small == total) and self.left[total - small] > 0

    def pair(self, total: int) -> list[int] | None:
        found = self.pairs[total]
        while found and not self._fits(total, found[-1]):
            found.pop()
        return [total - found[-1], found[-1]] if found else None

    def triple(self, total: int) -> list[int] | None:
        firsts = self.triples[total]
        while firsts and not (self.left[firsts[-1]] > 0 and self.pair(total - firsts[-1])):
            firsts.pop()
        for a in reversed(firsts):
            if self.left[a] <= 0:
                continue
            self.left[a] -= 1  # the pair must do without it, for this look-up only
            small = next((x for x in reversed(self.pairs[total - a]) if self._fits(total - a, x)), None)
            self.left[a] += 1
            if small is not None:
                return [a, total - a - small, small]
        return None


class Plan:
    """Which sequence and offset the piece with a given rank among those of its length has."""

    def __init__(self, counts: np.ndarray, limit: int = LIMIT):
        """counts: of each length from 0 to limit."""
        self.limit, self.left, self.used = limit, counts.astype(np.int64).copy(), np.zeros(limit + 1, np.int64)
        self.sums, self.n_sequences = Sums(self.left), 0
        self.slots: list[list[tuple[int, int, int]]] = [[] for _ in range(limit + 1)]  # first rank, first sequence, offset
        for size in range(limit, 0, -1):
            while self.left[size] and (rest := self._complement(size)) is not None:
                parts = [size, *rest]
                self._open(parts, min(self.left[x] // parts.count(x) for x in set(parts)))
        del self.sums  # the plan is sent to the tasks
        self._residuals()
        self.edges = [(np.array([s[0] for s in x], np.int64), np.array([s[1] for s in x], np.int64), np.array([s[2] for s in x], np.int64)) for x in self.slots]

    def _complement(self, size: int) -> list[int] | None:
        """One, two or three lengths that fill what a piece of this length leaves, all available with it."""
        gap = self.limit - size
        if not gap:
            return []
        self.left[size] -= 1
        found = [gap] if self.left[gap] else self.sums.pair(gap) or self.sums.triple(gap)
        self.left[size] += 1
        return found

    def _put(self, size: int, sequence: int, offset: int, many: int) -> None:
        self.slots[size].append((int(self.used[size]), sequence, offset))
        self.used[size] += many
        self.left[size] -= many

    def _open(self, parts: list[int], many: int) -> int:
        first, offset = self.n_sequences, 0
        for size in parts:
            self._put(size, first, offset, int(many))
            offset += size
        self.n_sequences += int(many)
        return first

    def _residuals(self) -> None:
        """Best fit, largest first; bins: by gap, runs (first sequence, how many) of sequences that leave it."""
        bins: list[list[tuple[int, int]]] = [[] for _ in range(self.limit + 1)]
        for size in range(self.limit, 0, -1):
            while self.left[size]:
                gap = next((g for g in range(size, self.limit + 1) if bins[g]), None)
                if gap is None:
                    each = min(self.limit // size, int(self.left[size]))
                    many = int(self.left[size]) // each
                    first = self._open([size] * each, many)
                    bins[self.limit - size * each].append((first, many))
                    continue
                first, many = bins[gap].pop()
                now = min(many, int(self.left[size]))
                self._put(size, first, self.limit - gap, now)
                bins[gap - size].append((first, now))
                if now < many:
                    bins[gap].append((first + now, many - now))

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for size in np.unique(length).tolist():
            own = np.flatnonzero(length == size)
            first, base, off = self.edges[size]
            i = np.searchsorted(first, rank[own], "right") - 1
            sequence[own], offset[own] = base[i] + rank[own] - first[i], off[i]
        return sequence, offset


def _place_rows(plan):
    """Columns doc_id, piece, start, length, ids_crc32, rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 5))
            yield pa.RecordBatch.from_arrays([*b.columns[:5], *map(pa.array, plan.value.place(length, rank))], [*b.schema.names[:5], "sequence_id", "offset"])

    return run


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, end_id: int = END_ID, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every row of docs."""
    spark = docs.sparkSession
    ship(spark)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    pieces = saved(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_piece_rows(limit, end_id, vocabulary), schema), "pieces")
    counts = np.zeros(limit + 1, np.int64)
    for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect():  # at most `limit` rows
        counts[r.length] = r.n
    plan = spark.sparkContext.broadcast(Plan(counts, limit))
    n_buckets = max(int(counts.max(initial=0) // BUCKET_ROWS + 1), int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n_buckets)))
    before = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = before.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    rows = rows.withColumn("at", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")))
    rows = rows.join(before, ["length", "bucket"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("at") + F.col("before") - 1).alias("rank"))
    return rows.mapInArrow(_place_rows(plan), f"{schema}, sequence_id long, offset long")


def _id_rows(limit: int, end_id: int, vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text in zip(batch.column(0), _texts(batch.column(1)), strict=True):
                got = [(n, ids.astype(np.int64).tolist()) for n, (_, ids) in enumerate(_pieces(text, limit, end_id, vocabulary))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id.as_py()] * len(got), pa.int64()), pa.array([n for n, _ in got], pa.int32()), pa.array([x for _, x in got], pa.list_(pa.int64()))], ["doc_id", "piece", "ids"]
                )

    return run


def sequences(docs: DataFrame, places: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, end_id: int = END_ID, vocabulary: str = VOCABULARY) -> DataFrame:
    """sequence_id and ids (array of long) of every sequence: the texts' ids laid out as packed() placed them. Needs
    distinct ids."""
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_id_rows(limit, end_id, vocabulary), "doc_id long, piece int, ids array<bigint>")
    rows = places.select("doc_id", "piece", "sequence_id", "offset").join(ids, ["doc_id", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most `limit` ids a sequence
    return rows.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
