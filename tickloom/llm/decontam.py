"""Benchmark decontamination by a prefix-filtered set join with exact containment.

A benchmark window (13 consecutive words of an item; the whole item if it has fewer) is the set of its five-word
shingles. A text contains the window only if it contains all of them, so one shingle is a sufficient prefix: the one
that is rarest in the texts (counted over all texts, ties by hash). Texts join the windows on that shingle; the
shingle's place in the window gives the only possible start (positional bound), which must leave room for the whole
window inside the text (length bound); every word of the window is then compared.

The benchmark is the small side. It is taken in parts of about PART_BYTES each (texts, ids and ITEM_BYTES an item), whose
size is asked first; every part is broadcast on its own and adds to the hits of the parts before, so a benchmark of any
size is joined and the driver holds one part at a time: about 40 bytes of arrays for a byte of text. Items are not cut.

Null and empty texts have no words and no hits. An item without words has no window. A null item_id counts as the
string null. Repeated items count once by id; rows of texts stay rows. Columns of the input besides the two used are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.cluster import ship
from tickloom.llm import scan

WINDOW, SHINGLE = 13, 5
PART_BYTES, ITEM_BYTES = 4 << 20, 64
_FILTER = 1 << 20


class Windows:
    """The distinct windows of some benchmark items and their shingles."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW, shingle: int = SHINGLE):
        texts = pa.array([t for _, t in items], pa.large_string())
        self.ids = [i for i, _ in items]
        hs, first, size, item, base = [], [], [], [], 0
        for block in scan.blocks(texts):
            w = block.words(scan.LETTERS, scan.LOWER)
            for d in range(block.n):
                m = int(w.count[d])
                if m:
                    k = min(m, window)
                    n = m - k + 1
                    first.append(base + w.at[d] + np.arange(n))
                    size.append(np.full(n, k))
                    item.append(np.full(n, block.first + d))
            hs.append(w.h)
            base += len(w.h)
        cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        self.h = np.concatenate(hs) if hs else np.zeros(0, np.uint64)
        self.first, self.size, self.item, self.shingle = cat(first), cat(size), cat(item), shingle

    def shingles(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By shingle length (five; the window's own length if that is less): window numbers, and the places among all
        words and the hashes of their shingles; windows that overlap share them."""
        out = {}
        length = np.minimum(self.size, self.shingle)
        for k in np.unique(length).tolist():
            own = np.flatnonzero(length == k)
            edge = np.zeros(len(self.h) + 1, np.int64)
            np.add.at(edge, self.first[own], 1)
            np.add.at(edge, self.first[own] + self.size[own] - k + 1, -1)
            at = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
            h = np.full(len(at), k, np.uint64)
            for j in range(k):
                h = (h ^ self.h[at + j]) * scan._Q
                h ^= h >> np.uint64(29)
            out[k] = (own, at, scan.mix(h))
        return out


class Lookup:
    """Places of known hashes in an array of hashes: a bit table first, then the sorted hashes."""

    def __init__(self, known: np.ndarray):
        self.known = np.unique(known)
        self.bits = np.zeros(_FILTER, bool)
        self.bits[(self.known & np.uint64(_FILTER - 1)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in h, numbers of their known hashes)"""
        at = np.flatnonzero(self.bits[(h & np.uint64(_FILTER - 1)).astype(np.int64)])
        i = np.minimum(np.searchsorted(self.known, h[at]), max(len(self.known) - 1, 0))
        ok = self.known[i] == h[at] if len(self.known) else np.zeros(0, bool)
        return at[ok], i[ok]


def _count_rows(known: dict[int, np.ndarray]):
    """How often each known shingle stands in the texts, by partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {k: Lookup(v) for k, v in known.items()}
        total = {k: np.zeros(len(t.known), np.int64) for k, t in tables.items()}
        for batch in batches:
            for block in scan.blocks(batch.column(0)):
                w = block.words(scan.LETTERS, scan.LOWER)
                for k, t in tables.items():
                    total[k] += np.bincount(t.find(w.windows(k)[1])[1], minlength=len(t.known))
        for k, t in tables.items():
            got = np.flatnonzero(total[k])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(got), k)), pa.array(t.known[got].view(np.int64)), pa.array(total[k][got])], ["k", "h", "n"])

    return run


class Index:
    """The windows by their rarest shingle."""

    def __init__(self, windows: Windows, counts: dict[int, tuple[np.ndarray, np.ndarray]]):
        """counts: by shingle length the hashes of shingles that the texts hold, ascending, and how often they do."""
        self.w, self.by = windows, {}
        for k, (own, at, h) in windows.shingles().items():
            known, many = counts.get(k, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
            n = np.zeros(len(h), np.int64)
            if len(known):
                i = np.minimum(np.searchsorted(known, h), len(known) - 1)
                n = np.where(known[i] == h, many[i], 0)
            order = np.lexsort((at, h, n))  # the rarest first
            rank = np.empty(len(at), np.int64)
            rank[order] = np.arange(len(at))
            slot, places = np.searchsorted(at, windows.first[own]), windows.size[own] - k + 1
            best = rank[slot]
            for j in range(1, int(places.max())):
                more = np.flatnonzero(places > j)
                best[more] = np.minimum(best[more], rank[slot[more] + j])
            best = order[best]
            by_hash = np.argsort(h[best], kind="stable")
            win, best = own[by_hash], best[by_hash]
            table = Lookup(h[best])
            lo = np.searchsorted(h[best], table.known)
            self.by[k] = (table, lo, np.diff(np.append(lo, len(best))), win, at[best] - windows.first[win])

    def occurrences(self, words: scan.Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of every occurrence of a window."""
        w, starts, wins = self.w, [], []
        for k, (table, lo, many, win, place) in self.by.items():
            first, h = words.windows(k)
            at, i = table.find(h)
            n = many[i]
            entry = np.repeat(lo[i], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            x, start = win[entry], np.repeat(first[at], n) - place[entry]
            doc = words.doc[np.repeat(first[at], n)]
            ok = (start >= words.at[doc]) & (start + w.size[x] <= words.at[doc + 1])
            x, start = x[ok], start[ok]
            for size in np.unique(w.size[x]).tolist():
                own = np.flatnonzero(w.size[x] == size)
                for part in np.array_split(own, max(1, len(own) // 50_000)):
                    same = (words.h[start[part, None] + np.arange(size)] == w.h[w.first[x[part], None] + np.arange(size)]).all(1)
                    starts.append(start[part][same])
                    wins.append(x[part][same])
        cat = lambda a: np.concatenate(a) if a else np.zeros(0, np.int64)
        return cat(starts), cat(wins)


def _hit_rows(index_of, keep: int):
    """Columns: keep columns that stay, text, n_words, hit_from, hit_to, item_ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = index_of.value
        for batch in batches:
            for block in scan.blocks(batch.column(keep)):
                words = block.words(scan.LETTERS, scan.LOWER)
                start, win = index.occurrences(words)
                old = [batch.column(keep + c).slice(block.first, block.n) for c in (2, 3, 4)]
                cover = np.zeros(len(words.s) + 1, np.int64)
                np.add.at(cover, start, 1)
                np.add.at(cover, start + index.w.size[win], -1)
                if any(len(x.values if hasattr(x, "values") else x) for x in old[:1]):
                    for d, (f, t) in enumerate(zip(old[0].to_pylist(), old[1].to_pylist(), strict=True)):
                        if f:
                            np.add.at(cover, words.at[d] + np.array(f, np.int64), 1)
                            np.add.at(cover, words.at[d] + np.array(t, np.int64), -1)
                hit = np.cumsum(cover[:-1]) > 0
                edge = np.zeros(len(hit) + 1, bool)
                edge[words.at] = True
                begin = np.flatnonzero(hit & (~np.concatenate([[False], hit[:-1]]) | edge[:-1]))
                end = np.flatnonzero(hit & (~np.concatenate([hit[1:], [False]]) | edge[1:])) + 1
                at = np.searchsorted(begin, words.at)
                doc = words.doc[begin] if len(begin) else np.zeros(0, np.int64)
                lists = [pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array((x - words.at[doc]).astype(np.int32))) for x in (begin, end)]
                ids: list[list[str]] = [x or [] for x in old[2].to_pylist()]
                if len(start):
                    pairs = np.unique(np.stack([words.doc[start], index.w.item[win]]), axis=1)
                    for d, i in pairs.T.tolist():
                        ids[d].append(index.w.ids[i])
                ids = [sorted(set(x)) for x in ids]
                front = [batch.column(c).slice(block.first, block.n) for c in range(keep + 1)]
                yield pa.RecordBatch.from_arrays([*front, pa.array(words.count.astype(np.int64)), *lists, pa.array(ids, pa.list_(pa.string()))], batch.schema.names)

    return run


def benchmark_hits(docs: DataFrame, items: DataFrame, keep: list[str], text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """The columns keep and text of every row of docs with n_words, the hit word ranges hit_from and hit_to (merged,
    each list one entry a range, end exclusive) and item_ids (sorted strings) of the items with a window there."""
    spark = docs.sparkSession
    ship(spark)
    items = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("i"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("t")).distinct()
    size = items.agg(F.sum(F.octet_length("t") + F.octet_length("i") + ITEM_BYTES)).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    text = F.col(text_col).alias("__text")
    out = docs.select(*keep, text, F.lit(0).cast("long").alias("n_words"), F.array().cast("array<int>").alias("hit_from"), F.array().cast("array<int>").alias("hit_to"), F.array().cast("array<string>").alias("item_ids"))
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == part).toArrow()
        windows = Windows(list(zip(own["i"].to_pylist(), own["t"].to_pylist(), strict=True)), window)
        known = {k: np.unique(h) for k, (_, _, h) in windows.shingles().items()}
        counts = {}
        if known:  # at most the part's own shingles come back
            found = docs.select(text).mapInArrow(_count_rows(known), "k long, h long, n long").groupBy("k", "h").agg(F.sum("n").alias("n")).toArrow()
            k, h, n = (found[c].to_numpy() for c in ("k", "h", "n"))
            for x in known:
                mine = np.flatnonzero(k == x)
                order = mine[np.argsort(h[mine].view(np.uint64))]
                counts[x] = (h[order].view(np.uint64), n[order])
        index = Index(windows, counts)
        out = out.mapInArrow(_hit_rows(spark.sparkContext.broadcast(index), len(keep)), out.schema)
    return out.withColumnRenamed("__text", text_col)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated (a twentieth of the words or more is hit)."""
    hits = benchmark_hits(docs, items, [id_col], **kw)
    n_hit = F.expr("cast(aggregate(zip_with(hit_from, hit_to, (f, t) -> t - f), 0L, (a, x) -> a + x) as bigint)")
    out = hits.select(F.col(id_col).alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))


def without_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of docs that are not contaminated, with the columns of docs."""
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns)}  # whatever the columns are called
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    hits = benchmark_hits(plain, items, [n for c, n in names.items() if c != text_col], names[text_col])
    hit = F.expr("aggregate(zip_with(hit_from, hit_to, (f, t) -> t - f), 0L, (a, x) -> a + x)")
    kept = hits.where(~((hit > 0) & (hit * 20 >= F.col("n_words"))))
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])
