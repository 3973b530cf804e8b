"""Phrase collocation mining with mergeable Misra-Gries summaries.

Texts are lower-cased in A-Z, cut into pieces at punctuation and line ends and those into words at spaces and tabs.
Phrases of one word are counted first, then of two, and so on; one of n words is looked at only where both its parts
of n - 1 words may be frequent. A level takes one scan of the texts:

* Tasks count the hashed phrases of some million words and send their counts as sorted runs to hash partitions.
* A partition merges its runs to one Misra-Gries summary: where more counters stand than its capacity, all are lowered by
  the largest count that does not fit, and what is not above zero goes. A summary of mass m and more than m / threshold
  counters lowers by less than the threshold in all, so that no phrase that occurs threshold times is lost. The mass of
  every partition is summed before merging. Hashes that meet only raise a counter.
* Survivors become one bit each in a map of at most MAX_BITS bits, whatever the input's size. A full map only lets more
  phrases through.

One last scan counts exactly: phrases that pass the maps are counted as strings in Spark, and those below the threshold go.

Null texts count as empty, a null lang as `und`. Texts of any length are read in blocks of whole texts. Repeated rows count
each. An empty table has no phrases. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.cluster import saved, scratch, ship
from tickloom.llm import scan

#: Counters of a hash partition, about.
CAPACITY = 1 << 18
MOST_PARTITIONS = 1 << 20
#: Phrases that a task counts before it sends its counts.
TASK_PHRASES = 1 << 22
BITS_A_SURVIVOR, LEAST_BITS, MAX_BITS = 16, 1 << 16, 1 << 29
SALTS = 32
_U = np.uint64
_Q, _R = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False


class Maps:
    """Which phrases may be frequent: a bit map for each number of words, in segments by hash partition."""

    def __init__(self, shift: int):
        self.shift, self.maps = shift, []

    def add(self, segments: list[bytes]) -> None:
        self.maps.append(np.frombuffer(b"".join(segments), np.uint8))

    def has(self, words: int, h: np.ndarray) -> np.ndarray:
        own = self.maps[words - 1]
        each = len(own) >> (64 - self.shift)  # bytes of a segment
        part, key = split(h, self.shift)
        at = _bit(key, each)
        return (own[part.astype(np.int64) * each + (at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8)) & 1 > 0


def _bit(key: np.ndarray, size: int) -> np.ndarray:
    return scan.mix(key.astype(np.uint64)) & _U(8 * size - 1)


def split(h: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash partition, 32-bit key in it) of hashes: the upper bits, and those after them."""
    return h >> _U(shift), (h >> _U(shift - 32)).astype(np.uint32)


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted 32-bit keys and their counts in few bytes."""
    planes = lambda x: x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()
    steps = np.diff(keys, prepend=np.uint32(0)).astype(np.uint32)
    return len(keys).to_bytes(8, "little") + pa.compress(planes(steps) + planes(counts.astype(np.uint64)), "zstd", asbytes=True)


def unpack(run: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(run[:8], "little")
    raw = np.frombuffer(pa.decompress(run[8:], 12 * n, "zstd", asbytes=True), np.uint8)
    whole = lambda x, kind: np.ascontiguousarray(x.reshape(-1, n).T).view(kind).ravel()
    return np.cumsum(whole(raw[: 4 * n], np.uint32), dtype=np.uint32), whole(raw[4 * n :], np.uint64).astype(np.int64)


class Summary:
    """A Misra-Gries summary that takes sorted runs of counts. lowered: at most so much do its counters fall short."""

    def __init__(self, capacity: int):
        self.capacity, self.lowered = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self._runs: list[tuple[np.ndarray, np.ndarray]] = []
        self._held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._runs.append((keys, counts))
        self._held += len(keys)
        if self._held > self.capacity:
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self._runs)])
        counts = np.concatenate([self.counts, *(c for _, c in self._runs)])
        self._runs, self._held = [], 0
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        self.keys, self.counts = keys[first], np.add.reduceat(counts[order], first)
        if len(self.keys) > self.capacity:
            spare = len(self.keys) - self.capacity - 1
            down = int(np.partition(self.counts, spare)[spare])  # the largest that does not fit
            kept = self.counts > down
            self.keys, self.counts, self.lowered = self.keys[kept], self.counts[kept] - down, self.lowered + down

    def survivors(self, threshold: int) -> np.ndarray:
        self.merge()
        return self.keys[self.counts + self.lowered >= threshold]


class _Phrases:
    """The phrases of a block: hashes by number of words, those that the maps let through, and where they stand."""

    def __init__(self, block: scan.Block, langs: np.ndarray, upto: int, maps: Maps):
        self.block, self.words = block, block.words(_WORD, scan.LOWER)
        s, e, doc = self.words.s, self.words.e, self.words.doc
        self.at: list[np.ndarray] = []  # first words of the phrases, by number of words
        self.h: list[np.ndarray] = []
        if not len(s):
            return
        breaks = np.concatenate([[0], np.cumsum(_BREAK[block.raw])])
        new = np.concatenate([[True], (breaks[s[1:]] > breaks[e[:-1]]) | (doc[1:] != doc[:-1])])
        piece = np.cumsum(new)
        self.own = scan.mix(self.words.h ^ langs[doc])
        block._sums = None  # blocks may be held for a while
        h, ok = self.own, np.ones(len(s), bool)
        for k in range(1, upto + 1):
            if k > 1:
                n = len(s) - k + 1
                if n <= 0:
                    return
                h = scan.mix(h[:n] * _Q + self.own[k - 1 :])
                ok = ok[:n] & ok[1:] & (piece[:n] == piece[k - 1 :])
            if k <= len(maps.maps):
                ok = ok.copy()
                ok[ok] = maps.has(k, h[ok])
            at = np.flatnonzero(ok)
            self.at.append(at)
            self.h.append(h[at])

    def second(self, k: int) -> np.ndarray:
        """Other hashes of the phrases of k words."""
        at = self.at[k - 1]
        out = np.full(len(at), k, np.uint64)
        for j in range(k):
            out = scan.mix((out ^ self.own[at + j]) * _R)
        return out


def _lang_hashes(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    """(hash of each row's lang, its name)"""
    names = ["und" if x is None else x for x in column.to_pylist()]
    known = {x: _U(scan.word_hash("lang " + x)) for x in set(names)}
    return np.array([known[x] for x in names], np.uint64), names


def _blocks(batches: Iterator[pa.RecordBatch], upto: int, maps: Maps) -> Iterator[tuple[_Phrases, list[str]]]:
    for batch in batches:
        langs, names = _lang_hashes(batch.column(0))
        for block in scan.blocks(batch.column(1)):
            yield _Phrases(block, langs[block.first : block.first + block.n], upto, maps), names[block.first : block.first + block.n]


def _run_rows(words: int, shift: int, maps):
    """Columns part, mass, run: a task's counts of phrases of so many words, a row for each hash partition."""

    def sent(held: list[np.ndarray]) -> pa.RecordBatch:
        h, counts = np.unique(np.concatenate(held), return_counts=True)
        part, key = split(h, shift)
        cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        runs, mass = [], []
        for s, e in zip(cut.tolist(), [*cut[1:].tolist(), len(h)], strict=True):
            keys, n = key[s:e], counts[s:e]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            keys, n = keys[first], np.add.reduceat(n, first)
            runs.append(pack(keys, n))
            mass.append(int(n.sum()))
        return pa.RecordBatch.from_arrays([pa.array(part[cut].astype(np.int64)), pa.array(mass, pa.int64()), pa.array(runs, pa.binary())], ["part", "mass", "run"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for found, _ in _blocks(batches, words, maps.value):
            if len(found.h) == words:
                held.append(found.h[-1])
                n += len(held[-1])
                if n >= TASK_PHRASES:
                    yield sent(held)
                    held, n = [], 0
        if n:
            yield sent(held)

    return run


def _merge_rows(threshold: int):
    """Columns part, mass, run; rows of a partition stand together, the first with its whole mass and no run. Gives
    part, lowered, n and keys of the survivors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, summary = None, None

        def done() -> pa.RecordBatch:
            keys = summary.survivors(threshold)
            return pa.RecordBatch.from_arrays([pa.array([own]), pa.array([summary.lowered]), pa.array([len(keys)]), pa.array([keys.tobytes()], pa.binary())], ["part", "lowered", "n", "keys"])

        for batch in batches:
            for part, mass, blob in zip(*(batch.column(i) for i in range(3)), strict=True):
                if part.as_py() != own:
                    if summary is not None:
                        yield done()
                    own, summary = part.as_py(), Summary(mass.as_py() // threshold + 1)
                if blob.is_valid:
                    summary.add(*unpack(blob.as_py()))
        if summary is not None:
            yield done()

    return run


def _segment_rows(size: int):
    """part and its segment, of size bytes, of the bit map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for keys in batch.column(1):
                bits = np.zeros(8 * size, bool)
                bits[_bit(np.frombuffer(keys.as_py(), np.uint32), size).astype(np.int64)] = True
                out.append(np.packbits(bits, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["part", "bits"])

    return run


def survivors(texts: DataFrame, words: int, threshold: int, maps: Maps, save) -> DataFrame:
    """part, lowered, n, keys: of each hash partition the keys of the phrases of so many words that may occur threshold
    times. texts: lang, text. save: as cluster.saved."""
    sent = texts.sparkSession.sparkContext.broadcast(maps)
    runs = save(texts.mapInArrow(_run_rows(words, maps.shift, sent), "part long, mass long, run binary"), "runs")
    masses = runs.groupBy("part").agg(F.sum("mass").alias("mass")).withColumn("run", F.lit(None).cast("binary"))
    rows = runs.union(masses).repartition("part").sortWithinPartitions("part", F.col("run").isNotNull())
    return save(rows.mapInArrow(_merge_rows(threshold), "part long, lowered long, n long, keys binary"), "survivors")


def _with_map(maps: Maps, found: DataFrame) -> None:
    """Adds the survivors' bit map to maps; the driver gets its MAX_BITS bits at most."""
    parts, n = 1 << (64 - maps.shift), found.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = 1 << (max(LEAST_BITS, min(MAX_BITS, n * BITS_A_SURVIVOR)) - 1).bit_length()
    size = max(1, min(MAX_BITS, bits) // 8 // parts)
    got = dict(tuple(r) for r in found.select("part", "keys").mapInArrow(_segment_rows(size), "part long, bits binary").collect())
    maps.add([bytes(got.get(p, b"\0" * size)) for p in range(parts)])


def _count_rows(upto: int, maps):
    """lang, phrase, f: a task's counts of phrases that pass the maps, and of all words under the empty phrase."""

    def counted(held: list[tuple[_Phrases, list[str]]]) -> pa.RecordBatch:
        langs, phrases, counts = [], [], []
        totals: dict[str, int] = {}
        for found, names in held:
            for name, n in zip(names, found.words.count.tolist(), strict=True):
                totals[name] = totals.get(name, 0) + n
        for k in range(1, upto + 1):
            some = [(i, x) for i, (x, _) in enumerate(held) if len(x.h) >= k and len(x.h[k - 1])]
            if not some:
                continue
            h, g = np.concatenate([x.h[k - 1] for _, x in some]), np.concatenate([x.second(k) for _, x in some])
            order = np.argsort(h)
            if (clash := (h[order][1:] == h[order][:-1]) & (g[order][1:] != g[order][:-1])).any():
                order = np.lexsort((g, h))
                clash = g[order][1:] != g[order][:-1]
            first = np.flatnonzero(np.concatenate([[True], (h[order][1:] != h[order][:-1]) | clash]))
            counts += np.diff(np.append(first, len(h))).tolist()
            # the first place of each phrase gives its words
            place = order[first]
            ends = np.cumsum([len(x.h[k - 1]) for _, x in some])
            which = np.searchsorted(ends, place, "right")
            for j, p in zip(which.tolist(), place.tolist(), strict=True):
                i, x = some[j]
                at = int(x.at[k - 1][p - (ends[j - 1] if j else 0)])
                raw = x.block.raw[x.words.s[at] : x.words.e[at + k - 1]].tobytes()
                phrases.append(b" ".join(raw.lower().split()).decode("utf-8", "replace"))
                langs.append(held[i][1][int(x.words.doc[at])])
        return pa.RecordBatch.from_arrays(
            [pa.array([*langs, *totals], pa.string()), pa.array([*phrases, *[""] * len(totals)], pa.string()), pa.array([*counts, *totals.values()], pa.int64())], ["lang", "phrase", "f"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for found, names in _blocks(batches, upto, maps.value):
            held.append((found, names))
            n += sum(map(len, found.h)) + len(names)
            if n >= TASK_PHRASES // 4:
                yield counted(held)
                held, n = [], 0
        if held:
            yield counted(held)

    return run


def frequent(texts: DataFrame, threshold: int, longest: int, save) -> DataFrame:
    """lang, phrase, f of every phrase of up to longest words with f >= threshold, exactly, and of every lang's words
    under the empty phrase. texts: lang, text. save: as cluster.saved."""
    ship(texts.sparkSession)
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = min(MOST_PARTITIONS, max(16, 1 << (size // 6 // threshold // CAPACITY).bit_length()))
    maps = Maps(64 - parts.bit_length() + 1)
    for words in range(1, longest + 1):
        _with_map(maps, survivors(texts, words, threshold, maps, save))
    sent = texts.sparkSession.sparkContext.broadcast(maps)
    counts = texts.mapInArrow(_count_rows(longest, sent), "lang string, phrase string, f long")
    return save(counts.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= threshold) | (F.col("phrase") == "")), "phrases")


def _scored(phrases: DataFrame, save) -> DataFrame:
    """lang, phrase, a, l, r, score of every phrase of two words or more: of its lowest-scoring cut."""
    words = F.split("phrase", " ")
    cuts = phrases.where(F.instr("phrase", " ") > 0).select("lang", "phrase", F.col("f").alias("a"), words.alias("w")).withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    part = lambda start, n: F.array_join(F.slice("w", start, n), " ")
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.size("w") - F.col("k")).alias("rest"))
    side = lambda name, f: phrases.where("phrase <> ''").select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(side("first", "l"), ["lang", "first"]).join(side("rest", "r"), ["lang", "rest"])
    score = F.expr("cast(cast(a as decimal(20, 0)) * 2000000 div (cast(l as decimal(20, 0)) + r) as bigint)")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return save(best.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")), "scored")


def _covered(phrases: DataFrame) -> DataFrame:
    """lang, phrase, most: the largest f of a longer phrase that holds the phrase's words contiguously."""
    longer = phrases.where(F.size(F.split("phrase", " ")) > 2).select("lang", "f", F.split("phrase", " ").alias("w"))
    n = F.explode(F.sequence(F.lit(2), F.size("w") - 1))
    inner = longer.withColumn("n", n).withColumn("i", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)))
    return inner.groupBy("lang", F.array_join(F.slice("w", F.col("i"), F.col("n")), " ").alias("phrase")).agg(F.max("f").alias("most"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", threshold: int = 30, longest: int = 4, percent: int = 80, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each lang's top phrases of 2 to longest words that occur threshold times
    or more, without those that mostly (percent / 100 of their occurrences) stand inside one longer phrase. a, l, r: how
    often phrase, first part and rest occur at the cut that scores floor(2000000 a / (l + r)) lowest; n: the lang's words."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    with scratch(docs.sparkSession) as save:
        phrases = frequent(texts, threshold, longest, save)
        found = _scored(phrases, save).join(_covered(phrases), ["lang", "phrase"], "left")
        found = found.where(F.coalesce(F.col("most").cast("decimal(20, 0)") * 100 < F.col("a").cast("decimal(20, 0)") * percent, F.lit(True)))
        order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
        # the best of each salt hold the best of all
        w = Window.partitionBy("lang", "salt").orderBy(*order)
        part = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
        ranked = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
        total = phrases.where("phrase = ''").select("lang", F.col("f").alias("n"))
        out = ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
        return saved(out, "collocations")
