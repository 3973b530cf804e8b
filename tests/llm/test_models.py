"""Classifiers on held-out labels of the given tables, and their small cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import nbsvm, queries, toxicity

SF = "/root/testdata/sf0.01"


def scores(spark, name, label):
    got = queries.QUERIES[name](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return got, got.join(labels, "doc_id").select("held_out", "score", "predicted", F.col(label).alias("label")).toPandas()


@pytest.mark.parametrize(("name", "label", "folds", "held", "threshold", "least"), [("op3_toxicity", "toxic", 3, 1, 0.7, 0.9), ("op8_quality_classifier", "quality", 5, 0, 0.3, 0.95)])
def test_held_out_labels(spark, name, label, folds, held, threshold, least):
    got, rows = scores(spark, name, label)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert got.where(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held)).isEmpty()
    assert got.where("score < 0 or score > 1 or score is null").isEmpty()
    assert got.where((F.col("predicted") == 1) != (F.col("score") >= threshold)).isEmpty()
    out = rows[rows.held_out]
    assert (out.predicted == out.label).mean() >= least
    clean = out[out.label == (0 if label == "toxic" else 1)]
    assert (clean.predicted == clean.label).mean() >= 0.97


def test_pairs_of_terms_count_beyond_their_sum():
    """Label: both terms or neither of them. No sum of weights can tell."""
    rng = np.random.default_rng(1)
    a, b = np.uint64(11), np.uint64(12)
    rows, labels = [], []
    for _ in range(600):
        x, y = rng.integers(0, 2, 2)
        rows.append(np.array([*([a] if x else []), *([b] if y else []), np.uint64(100 + rng.integers(5))], np.uint64))
        labels.append(int(x == y))
    m = toxicity.fit(rows, np.array(labels), epochs=300, least_gain=-1.0)
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    z = m.margins(doc, np.concatenate(rows), len(rows))
    assert ((z > 0) == np.array(labels)).mean() > 0.95


def loss(bias, w, v, rows, y, l2):
    """Logistic loss of a factorization machine by its definition, pair by pair."""
    total = 0.0
    for terms, label in zip(rows, y, strict=True):
        z = bias + sum(w[i] for i in terms) + sum(float(v[i] @ v[j]) for n, i in enumerate(terms) for j in terms[n + 1 :])
        total += np.log1p(np.exp(z)) - label * z + l2 / 2 * ((w**2).sum() + (v**2).sum())
    return total


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(2)
    rows = [sorted(rng.choice(7, rng.integers(0, 6), replace=False).tolist()) for _ in range(12)]
    y, w, v, bias, l2 = rng.integers(0, 2, 12).astype(float), rng.normal(0, 1, 7), rng.normal(0, 1, (7, 3)), 0.3, 0.05
    d, c = np.repeat(np.arange(12), [len(r) for r in rows]), np.array([i for r in rows for i in r])
    db, dw, dv = toxicity.gradients(bias, w, v, d, c, y, l2)
    step = 1e-6

    def slope(change):
        return (loss(bias + change[0], w + change[1], v + change[2], rows, y, l2) - loss(bias - change[0], w - change[1], v - change[2], rows, y, l2)) / (2 * step)

    assert db == pytest.approx(slope((step, 0, 0)), abs=1e-5)
    for i in range(7):
        own = np.zeros(7)
        own[i] = step
        assert dw[i] == pytest.approx(slope((0, own, 0)), abs=1e-5)
        for f in range(3):
            own = np.zeros((7, 3))
            own[i, f] = step
            assert dv[i, f] == pytest.approx(slope((0, 0, own)), abs=1e-5)


def test_gain_in_spark_is_that_of_counts(spark):
    rows = [(float(a), float(b)) for a in range(9) for b in range(13)]
    got = spark.createDataFrame(rows, "pos double, neg double").select("pos", "neg", toxicity._gain_of(F.col("pos"), F.col("neg"), 8, 12).alias("g")).collect()
    for r in got:
        assert r.g == pytest.approx(float(toxicity._gain(np.array([r.pos]), np.array([r.neg]), 8, 12)[0]), abs=1e-9)


def test_dual_solution_is_the_optimum():
    """The dual value reaches the primal one, within the bounds of each row; weights are the rows' sum."""
    rng = np.random.default_rng(3)
    rows = [np.sort(rng.choice(30, rng.integers(1, 9), replace=False)) for _ in range(80)]
    values = rng.normal(0, 1, 30)
    y = np.where([values[r].sum() + rng.normal() > 0 for r in rows], 1, -1)
    w, b, alpha, top = nbsvm.svm(rows, values, y, 0.5, 3000, 1)
    x = np.zeros((80, 30))
    for i, r in enumerate(rows):
        x[i, r] = values[r]
    assert w == pytest.approx((alpha * y) @ x) and b == pytest.approx((alpha * y).sum())
    assert (alpha >= 0).all() and (alpha <= top).all()
    assert top[y > 0].sum() == pytest.approx(top[y < 0].sum())
    hinge = np.maximum(0, 1 - y * (x @ w + b))
    primal, dual = 0.5 * (w @ w + b * b) + (top * hinge).sum(), alpha.sum() - 0.5 * (w @ w + b * b)
    assert dual <= primal + 1e-9 and primal - dual < 1e-3 * primal


def test_log_count_ratios_are_those_of_counts():
    sets, y, rows = [{0, 1}, {1}, {1, 2}, {0, 2}, {2}], np.array([1, 1, -1, -1, 1]), np.array([True, True, True, True, False])
    own = [(i, c) for i, s in enumerate(sets) if rows[i] for c in sorted(s)]
    got = nbsvm.log_count_ratios(np.array([i for i, _ in own]), np.array([c for _, c in own]), y, rows, 3)
    for c in range(3):
        p, q = (1 + sum(c in s for s, t, r in zip(sets, y, rows, strict=True) if r and t == sign) for sign in (1, -1))
        assert got[c] == pytest.approx(np.log((p / 2) / (q / 2)))


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1.0, "x", 0) for i, t in rows], "doc_id long, text string, score double, label string, held_out int")


def labels(spark, rows):
    return spark.createDataFrame([(i, t, t, "extra") for i, t in rows], "doc_id long, toxic int, quality int, text string")


@pytest.mark.parametrize("operator", [toxicity.toxicity, nbsvm.quality])
def test_odd_rows(spark, operator):
    rows = [(1, "good words here"), (2, "bad words here"), (2, "bad words here"), (3, None), (4, ""), (None, "text"), (5, "z " * 100_000)]
    for marks in ([], [(1, 0), (2, 1), (2, 1), (9, 1), (3, None)], [(1, 1)]):
        got = operator(docs(spark, rows), labels(spark, marks)).collect()
        assert len(got) == len(rows)
        assert all(0 <= r.score <= 1 for r in got)
        assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert operator(docs(spark, []), labels(spark, [])).count() == 0


def test_toxic_rows_go_with_all_columns(spark):
    rows = [(i, ("insult " if i % 2 else "") + f"plain words number {i % 7}") for i in range(200)]
    d = docs(spark, rows)
    kept = toxicity.without_toxic(d, labels(spark, [(i, i % 2) for i in range(200)]))
    assert kept.schema == d.schema
    assert {r.doc_id for r in kept.collect()} == set(range(0, 200, 2))
