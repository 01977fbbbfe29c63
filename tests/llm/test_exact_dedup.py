"""Exact groups against a dictionary."""

from __future__ import annotations

from collections import defaultdict

import pytest

from martloom.llm import exact_dedup


@pytest.mark.parametrize("digit", [64, 1])
def test_equals_a_dictionary(spark, monkeypatch, digit):
    monkeypatch.setattr(exact_dedup, "FIRST_DIGIT", digit)
    monkeypatch.setattr(exact_dedup, "GROWTH", 8 if digit == 64 else 3)
    stem = "p" * 100 + "é" * 300
    texts = ["", None, "a", "a", "ab", stem, stem + "x", stem + "y", stem + "x", "é", "é", stem[:-1], "A", " a", "long" * 40_000, "long" * 40_000 + "!"]
    rows = [(i, t) for i, t in enumerate(texts * 2)] + [(3, "a"), (77, "a"), (77, "a"), (None, "a"), (None, "only"), (None, "only"), (5, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS kept", "2 AS `a.b`", "3 AS place", "4 AS digit", "5 AS n")
    out = exact_dedup.exact_groups(docs)
    assert out.columns == ["doc_id", "text", "a.b", "place", "digit", "n", "keep_id", "group_size", "kept"]
    got = out.collect()
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    assert len(got) == len(rows)
    kept = defaultdict(int)
    for r in got:
        ids = groups[r.text or ""]
        assert r.keep_id == max((i for i in ids if i is not None), default=None) and r.group_size == len(ids)
        assert not r.kept or r.doc_id == r.keep_id
        kept[r.text or ""] += r.kept
    assert set(kept.values()) == {1} and kept.keys() == groups.keys()


def test_empty_table(spark):
    assert exact_dedup.exact_groups(spark.createDataFrame([], "doc_id long, text string"), keep_text=False).count() == 0
