"""Whitening against numpy's own eigenvectors."""

import numpy as np
import pytest

from shredloom.llm import whitening
from shredloom.llm.common import table
from shredloom.llm.eigen import leading_pairs
from shredloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>"


def compare(rows, ids, vectors, k):
    x = np.floor(64 * np.asarray(vectors, float)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    y = x - total / n
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1], axes[:, ::-1][:, :k]
    want = y @ axes / np.sqrt(values[:k])
    got = np.full((n, k), np.nan)
    place = {vec: at for at, vec in enumerate(ids)}
    deviation = ((n * x.astype(object) - total) ** 2).sum(axis=1)
    for r in rows:
        got[place[r.vec_id], r.component - 1] = r.whitened
        assert r.n == n and r.deviation == deviation[place[r.vec_id]]
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        assert r.identity_error < 1e-9
    assert len(rows) == n * k
    signs = np.sign((want * got).sum(axis=0))
    assert np.abs(want * signs - got).max() < 1e-6


def test_query(spark):
    rows = table(spark, SF, "embeddings").collect()
    compare(QUERIES["op12_whitening"](spark, SF).collect(), [r.vec_id for r in rows],
            [r.embedding for r in rows], 32)


def test_odd_vectors(spark):
    draw = np.random.default_rng(3)
    good = [(k, row.tolist()) for k, row in enumerate(draw.standard_normal((40, 5)))]
    bad = [(100, None), (101, []), (102, [float("nan")] + [1.0] * 4), (103, [None] + [1.0] * 4),
           (104, [float("inf")] + [1.0] * 4), (105, [1.0, 2.0]), (106, [1e300] + [0.0] * 4)]
    df = spark.createDataFrame(good + bad, SCHEMA).selectExpr("*", "'mine' x", "1 n")
    compare(whitening.whiten(df).collect(), [k for k, _ in good], [v for _, v in good], 5)
    flat = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 6.0]), (2, [3.0, 6.0]),
                                  (None, [2.0, 4.0])], SCHEMA)  # rank one, an id twice, one null
    rows = whitening.whiten(flat).collect()
    assert len(rows) == 4 and {r.component for r in rows} == {1} and rows[0].identity_error < 1e-9
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)
    for none in (same, same.limit(1), same.limit(0), df.where("vec_id = 100")):
        assert whitening.whiten(none).collect() == []


def test_large_entries_are_exact(spark):
    rows = [(k, [float(2 ** 39 - k * k), float(k)]) for k in range(6)]
    got = {r.vec_id: r.deviation for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    x = np.array([[64 * int(c) + 1_000_000 for c in v] for _, v in rows], object)
    assert [got[k] for k in range(6)] == ((6 * x - x.sum(axis=0)) ** 2).sum(axis=1).tolist()
    assert whitening.square_sums(np.array([[2 ** 40]]), 10 ** 6, np.array([0])) == [None]


def clustered(draw):
    q, _ = np.linalg.qr(draw.standard_normal((24, 24)))
    return (q * np.concatenate([np.full(6, 5.0), np.full(6, 5 + 1e-9), np.logspace(0, -12, 12)])) @ q.T


@pytest.mark.parametrize("make", [
    clustered, lambda d: np.eye(9), lambda d: np.diag(np.arange(7.0)), lambda d: np.ones((1, 1)),
    lambda d: np.array([[2.0, 1.0], [1.0, 2.0]]), lambda d: np.zeros((4, 4)),
    lambda d: np.cov(d.standard_normal((5, 20)).T), lambda d: np.cov(d.standard_normal((400, 30)).T)])
def test_leading_pairs(make):
    a = make(np.random.default_rng(1))
    k = min(len(a), 12)
    values, axes = leading_pairs(a, k)
    size = max(np.abs(a).max(), 1e-300)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:k]).max() <= 1e-13 * size
    assert np.abs(axes @ axes.T - np.eye(k)).max() < 1e-13
    assert np.abs(a @ axes.T - axes.T * values).max() <= 1e-13 * size
