"""Whitening against numpy's full eigensystem."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import whitening
from martloom.llm.queries import op13_whitening


def spectrum(kind: str, d: int) -> np.ndarray:
    return {
        "falling": 1.0 / (1 + np.arange(d)) ** 2, "flat": 1 + 1e-3 * np.arange(d)[::-1], "equal": np.repeat([3.0, 1.0], [d // 2, d - d // 2]),
        "thin": np.r_[np.ones(5), np.zeros(d)][:d], "steep": 10.0 ** -np.linspace(0, 6, d),
    }[kind]


@pytest.mark.parametrize("d", [3, 16, 64, 300])
@pytest.mark.parametrize("kind", ["falling", "flat", "equal", "thin", "steep"])
def test_eigenpairs(kind, d):
    want = np.sort(spectrum(kind, d))[::-1]
    q, _ = np.linalg.qr(np.random.default_rng(1).normal(size=(d, d)))
    a = (q * want) @ q.T
    values, vectors = whitening.jacobi_davidson(lambda b: a @ b, d, 16)
    k = min(16, d, int((want > 1e-9 * want[0]).sum()))
    assert len(values) == k and np.allclose(values, want[:k], rtol=1e-9)
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12


def check(rows, table):
    """Rows of the query against a plain computation over ``{vec_id: vector}`` pairs."""
    x = {i: np.floor(64 * np.asarray(v, dtype=np.float64)).astype(np.int64) + 1_000_000 for i, v in table}
    fit = np.unique(np.array([v for v in x.values()]), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    by_id: dict = {}
    for r in rows:
        assert r.n == n and r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[r.vec_id], sums))
        assert r.explained == pytest.approx(e[r.component - 1] / np.trace(v), rel=1e-9) and r.identity_error < 1e-9
        by_id.setdefault(r.vec_id, {})[r.component] = r.whitened
    assert by_id.keys() == x.keys()
    k = min(16, int((e > 1e-9 * e[0]).sum()))
    z = np.array([[by_id[i][c + 1] for c in range(k)] for i in x])
    want = (np.array(list(x.values())) - sums / n) @ u[:, :k] / np.sqrt(e[:k])
    sign = np.sign((z * want).sum(axis=0))
    assert np.abs(z - want * sign).max() < 1e-6


def test_query(spark, sf_dir):
    table = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(op13_whitening(spark, sf_dir).collect(), [(i, v) for i, v in table if v and all(c is not None and np.isfinite(c) for c in v)])


def save(spark, tmp_path, rows):
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("X", F.lit("clash")).write.parquet(
        f"{tmp_path}/embeddings.parquet"
    )
    return op13_whitening(spark, str(tmp_path)).collect()


def test_odd_rows(spark, tmp_path):
    rng = np.random.default_rng(2)
    good = [(i, rng.normal(size=5).tolist(), None) for i in range(40)]
    good += [(100 + i, good[0][1], 1) for i in range(300)] + [(None, good[1][1], 2)]
    odd = [(900, None, 0), (901, [], 0), (902, [1.0, None, 0.0, 0.0, 0.0], 0), (903, [float("nan")] + [0.0] * 4, 0), (904, [float("inf")] * 5, 0), (905, [1.0, 2.0], 0)]
    check(save(spark, tmp_path, good + odd), [(i, np.float32(v)) for i, v, _ in good])


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)]])
def test_nothing_to_whiten(spark, tmp_path, rows):
    assert save(spark, tmp_path, rows) == []


def test_large_entries_stay_exact(spark):
    rows = spark.createDataFrame([(i, [float(i % 7) * 3e8, float(i % 5), -float(i)]) for i in range(50)], "vec_id long, embedding array<double>")
    x = whitening.whole_numbers(rows)
    model = whitening.fit(x)
    fit = [[int(np.floor(64 * c)) + 1_000_000 for c in (i % 7 * 3e8, i % 5, -i)] for i in range(50)]
    sums = [sum(c) for c in zip(*fit)]
    assert (model.n, model.sums) == (50, sums)
    got = {r.vec_id: int(r.deviation) for r in whitening.transform(x, model).collect()}
    assert got == {i: sum((50 * a - s) ** 2 for a, s in zip(v, sums)) for i, v in enumerate(fit)}
