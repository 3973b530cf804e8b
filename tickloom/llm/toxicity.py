"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its words (A-Z lower-cased) and the beginnings of longer words in several lengths, hashed to 64
bits; a term counts once a text. The model keeps the TERMS terms whose presence tells
most about the label (information gain on the training rows) and learns a weight and RANK factors for each by
logistic loss, so that pairs of terms count beyond their sum. It is fitted on at most max_rows labelled rows (those
with the smallest hash of their id; the bound is the only sampling), scored on every whole text inside tasks.

Texts without words have no terms and get the score of the bias. Null labels are not learned from; without labelled
rows of both kinds every score is the share of positive labels (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.cluster import saved, ship
from tickloom.llm import scan

TERMS, RANK, MAX_ROWS = 4096, 4, 8000
PREFIXES = (4, 5, 6, 7, 9)  # bytes
LEAST_GAIN = 12.0  # bits over all training rows: chance alone hardly gets there
_U = np.uint64


def terms(words: scan.Words) -> tuple[np.ndarray, np.ndarray]:
    """(text number, term) of every distinct term of every text of a block."""
    length = words.e - words.s
    hs, docs = [words.h], [words.doc]
    for size in PREFIXES:
        own = np.flatnonzero(length > size)
        h = words.block.hashes(words.s[own], words.s[own] + size, words.fold)
        hs.append(scan.mix(h ^ _U(size)))
        docs.append(words.doc[own])
    h, doc = np.concatenate(hs), np.concatenate(docs)
    key = scan.mix(h ^ scan.mix(doc.astype(np.uint64)))
    _, at = np.unique(key, return_index=True)
    return doc[at], h[at]


@dataclass
class Machine:
    known: np.ndarray  # sorted term hashes
    bias: float
    weight: np.ndarray
    factors: np.ndarray

    def margins(self, doc: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
        out = np.full(n, self.bias)
        if not len(self.known):
            return out
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        ok = self.known[at] == h
        doc, at = doc[ok], at[ok]
        out += np.bincount(doc, self.weight[at], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[at, f]
            out += 0.5 * (np.bincount(doc, v, n) ** 2 - np.bincount(doc, v * v, n))
        return out


def _gain(with_pos, with_neg, pos, neg):
    """Information gain of a term's presence."""

    def entropy(a, b):
        n = np.maximum(a + b, 1e-12)
        p, q = a / n, b / n
        return -(np.where(p > 0, p * np.log2(np.maximum(p, 1e-12)), 0) + np.where(q > 0, q * np.log2(np.maximum(q, 1e-12)), 0)) * n

    return entropy(pos, neg) - entropy(with_pos, with_neg) - entropy(pos - with_pos, neg - with_neg)


def gradients(bias: float, w: np.ndarray, v: np.ndarray, d: np.ndarray, c: np.ndarray, y: np.ndarray, l2: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Derivatives of the summed logistic loss of rows, and of l2 / 2 of all squares for each row, by the bias, the weights
    and the factors. d, c: row and term number of every term of a row; y: labels of the rows."""
    size, m, rank = len(y), len(w), v.shape[1]
    sums = np.stack([np.bincount(d, v[c, f], size) for f in range(rank)], 1)
    z = bias + np.bincount(d, w[c], size) + 0.5 * (sums**2 - np.stack([np.bincount(d, v[c, f] ** 2, size) for f in range(rank)], 1)).sum(1)
    g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
    dw = np.bincount(c, g[d], m) + l2 * w * size
    dv = np.stack([np.bincount(c, g[d] * (sums[d, f] - v[c, f]), m) for f in range(rank)], 1) + l2 * v * size
    return float(g.sum()), dw, dv


def fit(rows: list[np.ndarray], labels: np.ndarray, epochs: int = 60, rate: float = 0.1, l2: float = 1e-4, least_gain: float = LEAST_GAIN, seed: int = 7) -> Machine:
    """rows: distinct terms of each training text; labels: 0 or 1."""
    y = np.asarray(labels, float)
    pos, neg = y.sum(), len(y) - y.sum()
    none = np.zeros(0, np.uint64)
    if not pos or not neg:
        p = (pos + 0.5) / (len(y) + 1)
        return Machine(none, float(np.log(p / (1 - p))), np.zeros(0), np.zeros((0, RANK)))
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    h, at = np.unique(np.concatenate(rows), return_inverse=True)
    wp, wn = np.bincount(at, y[doc], len(h)), np.bincount(at, 1 - y[doc], len(h))
    gain = np.where(wp + wn >= 3, _gain(wp, wn, pos, neg), 0)
    keep = np.sort(np.argsort(-gain, kind="stable")[:TERMS])
    keep = keep[gain[keep] > least_gain]
    number = np.full(len(h), -1)
    number[keep] = np.arange(len(keep))
    col = number[at]
    doc, col = doc[col >= 0], col[col >= 0]
    rng = np.random.default_rng(seed)
    n, m = len(y), len(keep)
    w, v, bias = np.zeros(m), rng.normal(0, 0.01, (m, RANK)), float(np.log(pos / neg))
    gw, gv, gb = np.full(m, 1e-8), np.full((m, RANK), 1e-8), 1e-8
    for _ in range(epochs):
        order = rng.permutation(n)
        place = np.empty(n, int)
        place[order] = np.arange(n)
        for part in range(0, n, 256):
            own = np.flatnonzero((place[doc] >= part) & (place[doc] < part + 256))
            db, dw, dv = gradients(bias, w, v, place[doc[own]] - part, col[own], y[order[part : part + 256]], l2)
            gw += dw**2
            gv += dv**2
            gb += db**2
            w -= rate * 2 * dw / np.sqrt(gw)
            v -= rate * dv / np.sqrt(gv)
            bias -= rate * 2 * db / np.sqrt(gb)
    return Machine(h[keep], float(bias), w, v)


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns label, text: label and the text's terms."""
    for batch in batches:
        for block in scan.blocks(batch.column(1)):
            doc, h = terms(block.words(scan.LETTERS, scan.LOWER))
            order = np.argsort(doc, kind="stable")
            h, at = h[order], np.searchsorted(doc[order], np.arange(block.n + 1))
            sets = [h[at[i] : at[i + 1]].tobytes() for i in range(block.n)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.n), pa.array(sets, pa.binary())], ["label", "terms"])


def training_rows(docs: DataFrame, labels: DataFrame, label: str, learn: Column, max_rows: int, id_col: str, text_col: str) -> DataFrame:
    """label, text of at most max_rows labelled rows, those with the smallest hash of their id. learn: asked on labels. An
    id that stands several times in labels has its largest label, in docs the text with the smallest hash."""
    chosen = labels.where(learn & F.col(label).isin(0, 1)).groupBy(F.col(id_col).alias("__id")).agg(F.max(label).alias("label"))
    chosen = chosen.orderBy(F.xxhash64("__id"), "__id").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(chosen), "__id")  # at most max_rows ids
    return rows.groupBy("__id", "label").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("first")).select("label", "first.text")


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns label, terms: how many texts of each label have a term."""
    for batch in batches:
        label = batch.column(0).to_numpy(zero_copy_only=False)
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in batch.column(1)]
        h, at = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_inverse=True)
        y = np.repeat(label, [len(x) for x in sets])
        pos, n = np.bincount(at, y, len(h)).astype(np.int64), np.bincount(at, minlength=len(h))
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(pos), pa.array(n - pos)], ["h", "pos", "neg"])


def _known_rows(known: np.ndarray):
    """Columns label, terms: the terms among the known ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(x.as_py(), np.uint64) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.sort(x[np.isin(x, known)]).tobytes() for x in sets], pa.binary())], ["label", "terms"])

    return run


def _gain_of(pos: Column, neg: Column, all_pos: int, all_neg: int) -> Column:
    """_gain() as a column."""

    def entropy(a: Column, b: Column) -> Column:
        part = lambda x: F.when(x > 0, -x * F.log2(x / (a + b))).otherwise(0.0)
        return part(a) + part(b)

    whole = entropy(F.lit(float(all_pos)), F.lit(float(all_neg)))
    return whole - entropy(pos, neg) - entropy(F.lit(float(all_pos)) - pos, F.lit(float(all_neg)) - neg)


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Machine:
    """Terms are counted and chosen by Spark; the driver gets the chosen terms of each training row only."""
    ship(docs.sparkSession)
    rows = saved(training_rows(docs, labels, label, learn, max_rows, id_col, text_col).mapInArrow(_term_rows, "label int, terms binary"), "terms")
    n, pos = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    counts = rows.mapInArrow(_count_rows, "h long, pos long, neg long").groupBy("h").agg(F.sum("pos").cast("double").alias("pos"), F.sum("neg").cast("double").alias("neg"))
    gain = _gain_of(F.col("pos"), F.col("neg"), pos, n - pos)
    chosen = counts.where("pos + neg >= 3").select("h", gain.alias("gain")).where(F.col("gain") > LEAST_GAIN).orderBy(F.desc("gain"), "h").limit(TERMS).collect()
    known = np.sort(np.array([r.h for r in chosen], np.int64).view(np.uint64))
    got = rows.mapInArrow(_known_rows(known), "label int, terms binary").toArrow()
    pairs = sorted(zip(got.column("terms").to_pylist(), got.column("label").to_pylist(), strict=True))  # whatever order the rows came in
    return fit([np.frombuffer(t, np.uint64) for t, _ in pairs], np.array([y for _, y in pairs]))


def _score_rows(model, keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine: Machine = model.value
        for batch in batches:
            for block in scan.blocks(batch.column(keep)):
                doc, h = terms(block.words(scan.LETTERS, scan.LOWER))
                z = machine.margins(doc, h, block.n)
                front = [batch.column(c).slice(block.first, block.n) for c in range(keep + 1)]
                yield pa.RecordBatch.from_arrays([*front, pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], [*batch.schema.names, "__score"])

    return run


def scored(docs: DataFrame, machine: Machine, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns keep, the text and score (0 to 1, higher: likelier toxic) of every row."""
    ship(docs.sparkSession)
    rows = docs.select(*keep, F.col(text_col).alias("__text"))
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
    run = _score_rows(docs.sparkSession.sparkContext.broadcast(machine), len(keep))
    return rows.mapInArrow(run, f"{schema}, __score double").withColumnRenamed("__text", text_col)


def fold(id_col: str, folds: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", threshold: float = 0.7, folds: int = 3, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, learned from the labels of the other folds."""
    machine = train(docs, labels, fold(id_col, folds) != held_out)
    out = scored(docs.select(id_col, "text"), machine, [id_col])
    held = F.coalesce(fold(id_col, folds) == held_out, F.lit(False))
    return out.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", folds: int = 3, held_out: int = 1) -> DataFrame:
    """The rows of docs whose score is below threshold, with the columns of docs."""
    machine = train(docs, labels, fold(id_col, folds) != held_out, id_col=id_col, text_col=text_col)
    out = scored(docs, machine, [c for c in docs.columns if c != text_col], text_col)
    return out.where(F.col("__score") < threshold).select(*docs.columns)
