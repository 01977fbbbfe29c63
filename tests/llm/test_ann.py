"""Nearest neighbours against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from martloom.llm import ann
from martloom.llm.queries import op5_ann


def brute_force(ids, vectors, k, modulus=20):
    out = {}
    for i, q in zip(ids, vectors, strict=True):
        if i % modulus == 0:
            scores = ann.products(q, vectors)
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_query_recall(spark, sf_dir):
    import pyarrow.parquet as pq

    table = pq.read_table(f"{sf_dir}/embeddings.parquet")
    ids, vectors = table["vec_id"].to_numpy(), np.stack(table["embedding"].to_pylist()).astype(np.float32).astype(float)
    want, got = brute_force(ids, vectors, 20), by_query(op5_ann(spark, sf_dir).collect())
    assert got.keys() == want.keys()
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hit >= 0.95 * 20 * len(want)
    for q, found in got.items():
        own = vectors[ids == q][0]
        assert q not in [i for i, _ in found] and len(found) == 20
        for i, score in found:
            assert score == pytest.approx(float((own * vectors[ids == i][0]).sum()), abs=1e-12)


def test_forest_within_a_leaf(monkeypatch):
    monkeypatch.setattr(ann, "LEAF_LIMIT", 500)
    draw = np.random.default_rng(2)
    rows = draw.standard_normal((6000, 12))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    lifted = np.column_stack([rows, np.zeros(len(rows))]).astype(np.float32)
    ids, hit = np.arange(len(rows)), 0
    for i, (top, _) in enumerate(ann.search_leaf(ids, rows, lifted, rows[:50], lifted[:50], 10)):
        hit += len(set(top) & set(np.argsort(-(rows @ rows[i]))[:10]))
    assert hit >= 0.9 * 500


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(0, 200)]  # one hot vector
    rows += [(300, [0.0, 2.0]), (301, [0.0, 1.0]), (302, [-0.0, 1.0]), (320, [-3.0, 0.0]), (303, None), (304, []), (305, [0.0, 0.0]),
             (306, [nan, 1.0]), (307, [inf, 1.0]), (308, [None, 1.0]), (309, [1.0, 1.0, 1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score", "2 AS `a.b`", "3 AS rank")
    got = by_query(ann.nearest(df, k=5).collect())
    assert got[0] == [(i, 1.0) for i in (1, 2, 3, 4, 5)]
    assert got[20] == [(i, 1.0) for i in (0, 1, 2, 3, 4)] == got[180]
    assert got[300] == [(301, 2.0), (302, 2.0), (0, 0.0), (1, 0.0), (2, 0.0)]
    assert got[320] == [(300, 0.0), (301, 0.0), (302, 0.0), (0, -3.0), (1, -3.0)]
    assert set(got) == {*range(0, 200, 20), 300, 320}
    few = by_query(ann.nearest(df.filter("vec_id IN (300, 301, 303)"), k=5).collect())
    assert few == {300: [(301, 2.0)]}
    assert ann.nearest(df.filter("vec_id IN (303, 304)")).columns == ["query_id", "rank", "vec_id", "score"]
    assert ann.nearest(df.limit(0)).count() == 0


def test_recall_where_96_leaves_are_a_small_part(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAF", 32)  # 96 leaves are a small part, as on larger tables
    draw = np.random.default_rng(5)
    vectors = draw.standard_normal((6000, 48)).astype(np.float32).astype(float)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    ids = np.arange(len(vectors))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors, strict=True)], "vec_id long, embedding array<double>")
    want, got = brute_force(ids, vectors, 20, 200), by_query(ann.nearest(df, modulus=200, trees=4).collect())
    assert got.keys() == want.keys()
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hit >= 0.9 * 20 * len(want)
