"""Quality by naive Bayes support vectors.

A text is a set of n-gram indicators. Its words (by white space) are reduced to shapes: letters of a case, digits and
each other sign, runs taken as one (Thnd*** is Aa*); a word equal to the one before is the shape of a repeat. n-grams
of one to three shapes, and words of up to four bytes, are indicators at four levels: present, and at one, five and
twenty percent of the text's words. The log-count ratios of the two labels scale the indicators; a linear hinge-loss
model is fitted on them by dual coordinate descent, and a logistic curve on margins of held-back folds turns margins
into scores.

It is fitted on at most max_rows labelled rows (smallest hash of the id) and the GRAMS indicators of three or more of
their texts that tell most about the label, counted and chosen by Spark: the driver gets at most max_rows sets of
GRAMS numbers, however long the texts are. Every whole text is scored inside tasks.
Texts without words have no indicators and get the score of the bias. Null labels are not learned from; without rows
of both labels every score is the share of label 1 (0.5 without any).
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
from tickloom.llm.toxicity import _count_rows, _gain_of, _known_rows, fold, training_rows

MAX_ROWS, GRAMS, LEVELS = 6000, 16_384, (0.0, 0.01, 0.05, 0.20)
_U = np.uint64
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = _SHAPE[128:] = ord("a")
_SHAPE[65:91] = ord("A")
_SHAPE[48:58] = ord("9")
_REPEAT = _U(0x5851F42D4C957F2D)


def grams(block: scan.Block) -> tuple[np.ndarray, np.ndarray]:
    """(text number, indicator) of every distinct indicator of every text of a block."""
    w = block.words(scan.NOT_SPACE)
    if not len(w.s):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    kind = _SHAPE[block.raw]
    new = np.ones(len(kind), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[w.s] = True
    place = np.concatenate([[0], np.cumsum(new)])
    small = scan.Block(kind[new], np.array([0, int(new.sum())]), 0)
    shape = small.hashes(place[w.s], place[w.e])
    again = np.zeros(len(w.s), bool)
    again[1:] = (w.h[1:] == w.h[:-1]) & (w.doc[1:] == w.doc[:-1])
    shape = np.where(again, _REPEAT, shape)
    hs, docs = [], []
    for k in (1, 2, 3):
        first = np.flatnonzero(w.at[w.doc + 1] - np.arange(len(w.s)) >= k)
        h = np.full(len(first), k, np.uint64)
        for j in range(k):
            h = scan.mix((h ^ shape[first + j]) * scan._Q)
        hs.append(h)
        docs.append(w.doc[first])
    short = np.flatnonzero(w.e - w.s <= 4)
    hs.append(scan.mix(w.h[short] ^ _U(77)))
    docs.append(w.doc[short])
    h, doc = np.concatenate(hs), np.concatenate(docs)
    key = scan.mix(h ^ scan.mix(doc.astype(np.uint64)))
    _, at, n = np.unique(key, return_index=True, return_counts=True)
    h, doc = h[at], doc[at]
    share = n / w.count[doc]
    out_h, out_d = [h], [doc]
    for i, level in enumerate(LEVELS[1:], 1):
        own = share >= level
        out_h.append(scan.mix(h[own] + _U(i)))
        out_d.append(doc[own])
    return np.concatenate(out_d), np.concatenate(out_h)


@dataclass
class Model:
    known: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    middle: float

    def scores(self, doc: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
        z = np.full(n, self.bias)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
            ok = self.known[at] == h
            z += np.bincount(doc[ok], self.weight[at[ok]], n)
        return 1 / (1 + np.exp(-np.clip(self.slope * z + self.middle, -30, 30)))


def svm(rows: list[np.ndarray], values: np.ndarray, y: np.ndarray, cost: float, epochs: int, seed: int) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """Hinge loss by dual coordinate descent: weights, bias, dual values and their upper bounds. rows: columns of each
    row; values: the value of a column where it is set; y: -1 or 1. Costs are balanced between the labels."""
    w, b, alpha = np.zeros(len(values)), 0.0, np.zeros(len(y))
    norm = np.array([(values[r] ** 2).sum() + 1 for r in rows])
    top = cost * np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            r = rows[i]
            g = y[i] * (w[r] @ values[r] + b) - 1
            now = min(max(alpha[i] - g / norm[i], 0.0), top[i])
            if now != alpha[i]:
                step = (now - alpha[i]) * y[i]
                w[r] += step * values[r]
                b += step
                alpha[i] = now
    return w, b, alpha, top


def _logistic(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    a, b = 1.0, 0.0
    t = np.where(y > 0, ((y > 0).sum() + 1) / ((y > 0).sum() + 2), 1 / ((y < 0).sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g, q = np.array([((p - t) * z).sum() + 1e-3 * (a - 1), (p - t).sum()]), np.maximum(p * (1 - p), 1e-9)
        hess = np.array([[(q * z * z).sum() + 1e-3, (q * z).sum()], [(q * z).sum(), q.sum() + 1e-6]])
        step = np.linalg.solve(hess, g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def log_count_ratios(doc: np.ndarray, col: np.ndarray, y: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Of each of n indicators: the log of (texts of label 1 with it, and one more) / (texts of label 1) over the same of
    label 0. doc, col: text and indicator number of every indicator of the texts that rows marks; y: -1 or 1."""
    p = np.bincount(col[y[doc] > 0], minlength=n) + 1.0
    q = np.bincount(col[y[doc] < 0], minlength=n) + 1.0
    return np.log((p / ((y > 0) & rows).sum().clip(1)) / (q / ((y < 0) & rows).sum().clip(1)))


def fit(sets: list[np.ndarray], labels: np.ndarray, cost: float = 0.1, epochs: int = 12, seed: int = 3) -> Model:
    y = np.where(np.asarray(labels) > 0, 1, -1)
    if not len(y) or abs(y.sum()) == len(y):
        p = ((y > 0).sum() + 0.5) / (len(y) + 1)
        return Model(np.zeros(0, np.uint64), np.zeros(0), 0.0, 1.0, float(np.log(p / (1 - p))))
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    h, col = np.unique(np.concatenate(sets), return_inverse=True)
    many = np.bincount(col) >= 3
    number = np.cumsum(many) - 1
    doc, col, h = doc[many[col]], number[col[many[col]]], h[many]
    order = np.argsort(doc, kind="stable")
    doc, col = doc[order], col[order]

    def ratio(rows: np.ndarray) -> np.ndarray:
        own = rows[doc]
        return log_count_ratios(doc[own], col[own], y, rows, len(h))

    at = np.searchsorted(doc, np.arange(len(y) + 1))
    cols = [col[at[i] : at[i + 1]] for i in range(len(y))]
    part, z = np.random.default_rng(seed).permutation(len(y)) % 3, np.zeros(len(y))
    for k in range(3):
        own = np.flatnonzero(part != k)
        r = ratio(part != k)
        w, b, *_ = svm([cols[i] for i in own], r, y[own], cost, epochs, seed)
        for i in np.flatnonzero(part == k):
            z[i] = (w[cols[i]] * r[cols[i]]).sum() + b
    slope, middle = _logistic(z, y)
    r = ratio(np.ones(len(y), bool))
    w, b, *_ = svm(cols, r, y, cost, epochs, seed)
    return Model(h, w * r, b, slope, middle)


def _gram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in scan.blocks(batch.column(1)):
            doc, h = grams(block)
            order = np.lexsort((h, doc))
            h, at = h[order], np.searchsorted(doc[order], np.arange(block.n + 1))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.n), pa.array([h[at[i] : at[i + 1]].tobytes() for i in range(block.n)], pa.binary())], ["label", "terms"])


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    ship(docs.sparkSession)
    rows = saved(training_rows(docs, labels, label, learn, max_rows, id_col, text_col).mapInArrow(_gram_rows, "label int, terms binary"), "grams")
    n, pos = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    counts = rows.mapInArrow(_count_rows, "h long, pos long, neg long").groupBy("h").agg(F.sum("pos").cast("double").alias("pos"), F.sum("neg").cast("double").alias("neg"))
    chosen = counts.where("pos + neg >= 3").select("h", _gain_of(F.col("pos"), F.col("neg"), pos, n - pos).alias("gain"))
    known = np.sort(np.array([r.h for r in chosen.orderBy(F.desc("gain"), "h").limit(GRAMS).collect()], np.int64).view(np.uint64))
    got = rows.mapInArrow(_known_rows(known), "label int, terms binary").toArrow()
    pairs = sorted(zip(got.column("terms").to_pylist(), got.column("label").to_pylist(), strict=True))  # whatever order the rows came in
    return fit([np.frombuffer(t, np.uint64) for t, _ in pairs], np.array([y for _, y in pairs]))


def _score_rows(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in scan.blocks(batch.column(1)):
                doc, h = grams(block)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.n), pa.array(model.value.scores(doc, h, block.n))], ["doc_id", "score"])

    return run


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, folds: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, learned from the labels of the other folds."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, fold(id_col, folds) != held_out, id_col=id_col, text_col=text_col))
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_score_rows(model), "doc_id long, score double")
    held = F.coalesce(fold("doc_id", folds) == held_out, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
