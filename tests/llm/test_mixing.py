"""Mixing against plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest

from martloom.llm import mixing


def brute_force(rows, weights=(1, 2, 3)):
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    total = defaultdict(int)
    for (_, _, source), n in zip(rows, sizes, strict=True):
        total[source] += n
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = {}, float(sum(sizes)), set(names)
    while True:
        unit = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if unit * weight[s] > 3 * total[s]]
        if not over:
            break
        for s in over:
            target[s] = 3.0 * total[s]
            left -= target[s]
            open_.remove(s)
    target |= {s: unit * weight[s] for s in open_}
    out, used = [0] * len(rows), defaultdict(int)
    for i in sorted(range(len(rows)), key=lambda i: (hashlib.md5(f"2:{'' if rows[i][0] is None else rows[i][0]}".encode()).hexdigest(), sizes[i])):
        source, n = rows[i][2], sizes[i]
        budget = int(target[source] + 0.5)
        epochs = budget // total[source] if total[source] else 0
        out[i] = epochs * n + max(0, min(n, budget - epochs * total[source] - used[source]))
        used[source] += n
    return [(n, total[s], target[s], t) for (_, _, s), n, t in zip(rows, sizes, out, strict=True)]


@pytest.mark.parametrize(("per_range", "fanout"), [(1000, 1000), (3, 2)])
def test_equals_plain_python(spark, documents, monkeypatch, per_range, fanout):
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", per_range)
    monkeypatch.setattr(mixing.words_before, "__defaults__", (fanout,))
    rows = [*documents, (9001, None, None), (9002, "  ", "zero"), (9003, "a b\x0bc\x1cd", None), (9004, "one", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS target", "2 AS `a.b`", "3 AS place")
    mixed = mixing.mix(docs)
    assert mixed.columns == ["doc_id", "text", "source", "a.b", "place", "size", "source_size", "target", "taken"]
    got = {r.doc_id: r for r in mixed.collect()}
    by_source, targets = defaultdict(int), {}
    for (doc_id, _, source), (size, source_size, target, taken) in zip(rows, brute_force(rows), strict=True):
        r = got[doc_id]
        assert (r.size, r.source_size, r.taken) == (size, source_size, taken) and r.target == pytest.approx(target)
        assert 0 <= taken <= 3 * size
        by_source[source] += taken
        targets[source] = target
    for source, taken in by_source.items():
        assert abs(taken - targets[source]) <= 0.5


def test_odd_tables(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    blank = mixing.mix(spark.createDataFrame([(1, None, None), (2, "", "a")], schema)).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 2
    same = mixing.mix(spark.createDataFrame([(None, "x y", "a")] * 4 + [(1, "z", "b")], schema)).collect()
    assert sum(r.taken for r in same if r.source == "a") + sum(r.taken for r in same if r.source == "b") == 9


@pytest.mark.parametrize("sizes", [(100, 200), (100, 200, 300), (100,) * 6, (100, 200, 300, 50, 100, 150), (7, 14, 0, 7)])
def test_equal_rooms(spark, sizes):
    rows = [(i, " ".join(["w"] * n), f"s{i}") for i, n in enumerate(sizes)]
    rows[-1] = (*rows[-1][:2], None)  # the source without a name comes last
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in mixing.mix(docs).collect()}
    for (doc_id, _, _), (size, source_size, target, taken) in zip(rows, brute_force(rows), strict=True):
        r = got[doc_id]
        assert (r.size, r.source_size, r.taken) == (size, source_size, taken) and r.target == pytest.approx(target)
    assert sum(r.target for r in got.values()) == pytest.approx(sum(sizes))
