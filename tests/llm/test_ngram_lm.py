"""Language-model scores against plain counting."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from martloom.llm import ngram_lm
from martloom.llm.elias_fano import BigramTrie, EliasFano
from martloom.llm.queries import op6_ngram_lm


def brute_force(rows):
    texts = []
    for doc_id, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        key = "" if doc_id is None else str(doc_id)
        texts.append((re.findall(r"[^\x20\x09-\x0D]+", lower) + ["\n"], zlib.crc32(key.encode()) % 10 == 0))
    one, two = Counter(), Counter()
    for words, held_out in texts:
        if not held_out:
            one.update(words)
            two.update(zip(["\n", *words], words, strict=False))
    total, distinct = sum(one.values()), len(one)
    for words, held_out in texts:
        alone = [(one[w] + 0.1) / (total + 0.1 * (distinct + 1)) for w in words]
        pairs = [
            (two[v, w] + ngram_lm.M * p) / (one[v] + ngram_lm.M) for v, w, p in zip(["\n", *words], words, alone, strict=False)
        ]
        yield held_out, len(words), sum(one[w] > 0 for w in words), total, sum(map(math.log10, alone)), sum(map(math.log10, pairs))


def check(rows, got):
    assert len(got) == len(rows)
    got = sorted(got, key=lambda r: (str(r.doc_id), r.base_score))
    want = sorted(((d, *b) for (d, _), b in zip(rows, brute_force(rows), strict=True)), key=lambda r: (str(r[0]), r[5]))
    for r, (_, held_out, n, known, total, base, score) in zip(got, want, strict=True):
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out, n, known, total)
        assert r.base_score == pytest.approx(base, abs=1e-9 * n)
        # Quantised twice, half a step each.
        assert r.score == pytest.approx(score, abs=1.01 * n / ngram_lm.STEPS)


def test_query(spark, sf_dir, documents):
    check([(d, t) for d, t, _ in documents], op6_ngram_lm(spark, sf_dir).collect())


def test_many_shards_and_slices(spark, documents, monkeypatch, tmp_path):
    for name, value in (("WORDS_PER_SHARD", 700), ("PAIRS_PER_SHARD", 3000), ("PAIRS_PER_SLICE", 50), ("BATCH_BYTES", 30_000)):
        monkeypatch.setattr(ngram_lm, name, value)
    rows = [(d, t) for d, t, _ in documents[:80]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check(rows, ngram_lm.score(docs, model=str(tmp_path)).collect())
    assert len(list(tmp_path.glob("*.ef"))) > 5


def test_odd_rows(spark):
    rows = [(1, ""), (2, None), (3, " \n"), (4, "The the THE"), (4, "The the THE"), (None, "the É é"), (7, "the " * 50_000), (8, "a\x1cb\x0bc")]
    docs = spark.createDataFrame(rows, "doc_id int, text string").selectExpr("*", "1 AS score", "2 AS `a.b`", "3 AS batch")
    check(rows, ngram_lm.score(docs).collect())
    held_out = [(i, "x y") for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    check(held_out, ngram_lm.score(spark.createDataFrame(held_out, "doc_id long, text string")).collect())
    assert ngram_lm.score(docs.limit(0)).count() == 0


def test_sequences_and_trie():
    draw = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 0), (1, 10**12), (700, 3), (700, 10**9), (300, 300)):
        values = np.sort(draw.integers(0, top + 1, n)).astype(np.uint64)
        sequence = EliasFano.build(values)
        assert sequence.decode().tolist() == values.tolist() == [sequence[i] for i in range(n)]
        for x in (0, top // 2, top, top + 1):
            assert sequence.successor(x, 0, n) == np.searchsorted(values, x)
    sparse = EliasFano.build(np.sort(draw.integers(0, 1 << 40, 10_000)).astype(np.uint64))
    assert (len(sparse.low) + len(sparse.high)) * 8 < 10_000 * (40 - np.log2(10_000) + 3)
    pairs = np.unique(draw.integers(0, 60, (900, 2)), axis=0).astype(np.uint64) * np.uint64(7)
    codes = draw.integers(0, 60_000, len(pairs))

    class Sink(bytearray):
        write = bytearray.extend

    file = Sink()
    BigramTrie.build(pairs[:, 0], pairs[:, 1], codes).write(file)
    trie = BigramTrie.open(bytes(file))
    known = {(int(v), int(w)): int(c) for (v, w), c in zip(pairs, codes, strict=True)}
    asked = [(v, w) for v in range(0, 430, 3) for w in range(0, 430, 7)]
    found = trie.find_all(np.array([v for v, _ in asked]), np.array([w for _, w in asked]))
    assert found.tolist() == [known.get(a, -1) for a in asked]
    for a in asked[::17]:
        assert trie.find(*a) == known.get(a, -1)


def test_packed_lookups():
    """Many lookups on the packed levels at once, in ranges of their own, against plain search."""
    draw = np.random.default_rng(2)
    top = 1 << 64
    sizes = ((1, 1), (1, top), (5, 2), (64, 64), (700, 3), (700, 10**9), (3000, 10**4), (2000, top), (128, 1 << 63), (9, 1 << 60))
    for n, end in sizes:
        values = np.sort(draw.integers(0, end, n, dtype=np.uint64))
        sequence = EliasFano.build(values)
        assert sequence.take(np.arange(n)).tolist() == values.tolist()
        asked = np.concatenate([values, draw.integers(0, end, 300, dtype=np.uint64), np.array([0, 1, end - 1, top - 1], np.uint64)])
        asked = np.concatenate([asked, values + np.uint64(1), values - np.uint64(1)])
        start = draw.integers(0, n + 1, len(asked))
        stop = np.minimum(n, start + draw.integers(0, n + 1, len(asked)))
        for a, b in ((np.zeros(len(asked), int), np.full(len(asked), n)), (start, stop)):
            at, found = sequence.successors(asked, a, b)
            want = [i + int(np.searchsorted(values[i:j], x)) for x, i, j in zip(asked, a, b, strict=True)]
            assert at.tolist() == want
            assert found.tolist() == [i < j and values[i] == x for x, i, j in zip(asked, want, b, strict=True)]
    nothing = EliasFano.build(np.zeros(0, np.uint64))
    at, found = nothing.successors(np.array([0, 5], np.uint64), 0, 0)
    assert at.tolist() == [0, 0] and not found.any()


def test_lookups_leave_the_levels_packed(monkeypatch):
    draw = np.random.default_rng(3)
    pairs = np.unique(draw.integers(0, 1 << 64, (4000, 2), dtype=np.uint64), axis=0)
    pairs[1::2, 0] = pairs[::2, 0]
    pairs = np.unique(pairs, axis=0)
    trie = BigramTrie.build(pairs[:, 0], pairs[:, 1], np.arange(len(pairs)) % 65_536)

    def refused(self):
        raise AssertionError("a level was decoded")

    monkeypatch.setattr(EliasFano, "decode", refused)
    order = draw.permutation(len(pairs))
    assert trie.find_all(pairs[order, 0], pairs[order, 1]).tolist() == (order % 65_536).tolist()
    assert (trie.find_all(pairs[:, 0], pairs[:, 1] + np.uint64(1)) == -1).all()
