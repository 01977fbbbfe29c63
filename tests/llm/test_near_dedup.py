"""Near duplicates against all pairs."""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pytest

from martloom.llm import near_dedup
from martloom.llm.components import components
from martloom.llm.queries import op4_near_dedup


def shingle_set(text, words):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not found:
        return frozenset()
    width = min(words, len(found))
    return frozenset(tuple(found[i : i + width]) for i in range(len(found) - width + 1))


def brute_force(rows, words, percent):
    """(n_shingles, component id) per row by comparing all pairs that share a shingle."""
    sets = [shingle_set(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                parent[root(i)] = root(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc_id)
    return [(len(s), min(groups[root(i)])) for i, s in enumerate(sets)]


def test_query_equals_all_pairs(spark, sf_dir, documents):
    rows = [(d, t) for d, t, _ in documents]
    got = {r.doc_id: r for r in op4_near_dedup(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for (doc_id, _), (n, component) in zip(rows, brute_force(rows, 3, 85), strict=True):
        r = got[doc_id]
        assert (r.n_shingles, r.component_id, r.kept) == (n, component, component == doc_id)


def variants(seed, n):
    """Texts around one original, many just above or below the limit, in chains."""
    draw = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(4000)]
    base = draw.choice(words, 60).tolist()
    out = [" ".join(base)]
    for _ in range(n):
        text = list(base) if draw.random() < 0.6 else out[draw.integers(len(out))].split(" ")
        for _ in range(draw.integers(1, 5)):
            text[draw.integers(len(text))] = str(draw.choice(words))
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_links_that_stars_leave_out(spark, words, percent, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_SETS", 16)  # several tiles
    rows = list(enumerate(variants(3, 150) + variants(4, 80)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(docs, words, percent, keep_text=False).collect()}
    assert got == {i: c for (i, _), (_, c) in zip(rows, brute_force(rows, words, percent), strict=True)}


def test_odd_rows(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(1, ""), (2, None), (3, " \n\t"), (4, "One"), (5, "one"), (6, "ÉCOLE a"), (7, "école a"), (8, long), (9, long + " y"),
            (10, "a\x0bb"), (11, "a b"), (11, "a b"), (12, "a\x1cb"), (None, "A  B"), (None, "lonely text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS node", "2 AS KEPT", "3 AS `x.y`")
    out = near_dedup.near_groups(docs)
    assert out.columns == ["doc_id", "text", "node", "x.y", "n_shingles", "component_id", "kept"]
    got = out.collect()
    assert len(got) == len(rows)
    label = {(r.doc_id, r.text): (r.component_id, r.kept) for r in got}
    for i in (1, 3, 4, 6, 7, 8, 10, 12):
        assert label[i, dict(rows)[i]] == (i, True)
    assert label[2, None] == (2, True) and label[5, "one"] == (4, False) and label[9, long + " y"] == (8, False)
    assert label[11, "a b"] == (10, False) and label[None, "A  B"] == (10, False) and label[None, "lonely text"] == (None, True)
    assert near_dedup.near_groups(docs.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    n = 300
    order = np.random.default_rng(1).permutation(n).tolist()
    edges = list(zip(order, order[1:], strict=False)) + [(1000, i) for i in range(1001, 1100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, n)} | {i: 1000 for i in range(1001, 1100)}


def test_signature_agreement_is_similarity():
    from martloom.llm.shingles import OnePermutation, mixed

    permutation = OnePermutation(32, 7)
    for n in (5, 40, 400, 4000):
        pool = mixed(np.arange(1, 2 * n * 50 + 1, dtype=np.uint64)).reshape(50, 2 * n)
        a = permutation.signatures([np.sort(p[:n]) for p in pool])
        b = permutation.signatures([np.sort(p[n // 5 : n + n // 5]) for p in pool])
        share = n - n // 5
        assert abs((a == b).mean() - share / (2 * n - share)) < 0.06
