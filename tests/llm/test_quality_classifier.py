"""The classifier on documents whose labels it has not seen, and its shrinking of sites."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import quality


def corpus(n, seed=1):
    draw = random.Random(seed)
    words = ["".join(draw.choices("aeioulmnrst", k=draw.randint(2, 9))) for _ in range(3000)]
    for i in range(n):
        text, low, toxic = draw.choices(words, k=draw.randint(5, 200)), draw.random() < 0.1, draw.random() < 0.1
        if toxic:
            text.insert(draw.randint(0, len(text)), draw.choice(["vile", "nasty,", "Vile!", "nastyness", "nastylike"]))
        if low:
            text = [w + "%%%" for w in text] if i % 2 else text[:3] * 20
        yield i, " ".join(text), f"s{draw.randint(0, 9) if draw.random() < 0.7 else 0}", "en", int(not low), int(toxic)


def test_held_out_accuracy(spark):
    rows = list(corpus(2500))
    docs = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(r[0], r[4], r[5]) for r in rows if r[0] % 5], "doc_id long, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in quality.classify(docs, labels).collect()}
    unseen = [r for r in rows if r[0] % 5 == 0]
    good = [kept[r[0]] for r in unseen if r[4] and not r[5]]
    bad = [kept[r[0]] for r in unseen if not r[4] or r[5]]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def penalised_fit(pairs):
    """Intercept and slope of greatest likelihood, less half of 1e-6 and 1e-2 times their squares, by damped Newton steps."""
    pairs = [(x, y, 1.0) for x, y in pairs] + [(0.0, 1.0, 0.5), (0.0, 0.0, 1.5)]
    a = b = 0.0
    for _ in range(500):
        ga, gb, haa, hab, hbb = -1e-6 * a, -1e-2 * b, 1e-6, 0.0, 1e-2
        for x, y, w in pairs:
            p = sigmoid(a + b * x)
            ga, gb = ga + w * (y - p), gb + w * (y - p) * x
            haa, hab, hbb = haa + w * p * (1 - p), hab + w * p * (1 - p) * x, hbb + w * p * (1 - p) * x * x
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        damp = min(1.0, 1.0 / max(abs(da), abs(db), 1e-300))
        a, b = a + damp * da, b + damp * db
    return a, b


def strength(groups):
    """From (n, bad, mean above, n above) per group: how many rows the mean above is worth."""
    spread = sum(n * (bad / n - m) ** 2 for n, bad, m, _ in groups)
    chance = sum((1 - n / above) * m * (1 - m) for n, _, m, above in groups)
    room = sum(n * (1 - n / above) for n, _, _, above in groups)
    noise = sum(n * m * (1 - m) for n, _, m, _ in groups) / sum(n for n, *_ in groups)
    between = (spread - chance) / room if room else 0.0
    return min(1e6, max(1.0, noise / max(between, 1e-12)))


def brute_force(rows, labels, drawn, targets):
    """Probabilities by document and target, from the definitions. ``rows``: id, text, host, path; ``labels``: id to 0/1 per target."""
    text = {r[0]: r[1] or "" for r in rows}
    out = defaultdict(list)
    for t in range(targets):
        first = {}
        for i in sorted(labels):
            if drawn[i] % 2 == 0:
                first.setdefault(text[i], i)
        seen, bad_seen = Counter(), Counter()
        for i in first.values():
            for f in quality.features(text[i]):
                seen[f] += 1
                bad_seen[f] += labels[i][t]
        everyone, all_bad = len(first), sum(labels[i][t] for i in first.values())
        weight = {}
        for f, n in seen.items():
            bad = bad_seen[f]
            ratio = math.log((bad + 0.5) / (all_bad + 1)) - math.log((n - bad + 0.5) / (everyone - all_bad + 1))
            share = all_bad / everyone
            test = sum(o * math.log(o / e) for o, e in ((bad, n * share), (n - bad, n * (1 - share))) if o)
            if math.sqrt(max(0.0, 2 * test)) >= 5 and ratio >= math.log(4):
                weight[f] = ratio
        evidence = {i: min(40.0, math.fsum(weight.get(f, 0.0) for f in quality.features(x))) for i, x in text.items()}
        a, b = penalised_fit([(evidence[i], labels[i][t]) for i in sorted(labels) if drawn[i] % 2])
        n, bad = Counter(), Counter()
        for i, _, host, path in rows:
            for site in ((), (host,), (host, path)):
                n[site] += 1
                bad[site] += labels[i][t] if i in labels else sigmoid(a + b * evidence[i])
        base = bad[()] / n[()]
        hosts = [s for s in n if len(s) == 1]
        k = strength([(n[s], bad[s], base, n[()]) for s in hosts])
        host_rate = {s: (bad[s] + k * base) / (n[s] + k) for s in hosts}
        paths = [s for s in n if len(s) == 2]
        k = strength([(n[s], bad[s], host_rate[s[:1]], n[s[:1]]) for s in paths])
        for i, _, host, path in rows:
            s = (host, path)
            rate = (bad[s] + k * host_rate[s[:1]]) / (n[s] + k)
            out[i].append(sigmoid(a + b * evidence[i] + math.log(rate / (1 - rate)) - math.log(base / (1 - base))))
    return out


def test_classify_equals_brute_force(spark):
    draw = random.Random(5)
    rows = [(i, text, host, draw.choice(["en", "de", None]), good, bad) for i, text, host, _, good, bad in corpus(1500, seed=2)]
    # Copies, of which only the first may count as evidence; a host that is nearly all bad, one seen once, and none.
    rows += [(2000 + i, rows[7][1], "copies", "en", rows[7][4], rows[7][5]) for i in range(40)]
    rows += [(3000 + i, " ".join(draw.choices("qwxyz", k=60)), "worst", "en", 0, 1) for i in range(30)]
    rows += [(4000, rows[8][1] + " once", "once", "en", 1, 0), (4001, rows[9][1] + " none", None, None, 1, 0)]
    docs = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, source string, lang string")
    marked = [(r[0], r[4], r[5]) for r in rows if r[0] % 4] + [(1, 0, 0)]
    labels = spark.createDataFrame(marked, "doc_id long, quality int, toxic int")
    known = {}
    for i, good, toxic in marked:
        low, bad = known.get(i, (0, 0))
        known[i] = max(low, int(good == 0)), max(bad, toxic)
    drawn = {r[0]: r[1] for r in docs.select("doc_id", F.xxhash64("doc_id", F.lit(10))).collect()}
    want = brute_force([r[:4] for r in rows], known, drawn, 2)
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert len(got) == len(rows)
    for i, (low, toxic) in want.items():
        assert got[i].low_quality == pytest.approx(low, abs=1e-9), i
        assert got[i].toxic == pytest.approx(toxic, abs=1e-9), i
        assert got[i].kept == (max(low, toxic) <= 0.5)
    assert 0.05 < np.mean([not r.kept for r in got.values()]) < 0.5


def test_sites_shrink_toward_their_parents(spark):
    draw = random.Random(3)
    rows = [("big", "a", float(draw.random() < 0.5)) for _ in range(2000)] + [("big", "b", float(draw.random() < 0.1)) for _ in range(2000)]
    rows += [(f"h{i}", "a", float(draw.random() < (0.02 if i % 2 else 0.3))) for i in range(40) for _ in range(50)]
    rows += [("tiny", "a", 1.0), (None, None, 0.0)]
    rates = {(r.host, r.path): r for r in quality.site_rates(spark.createDataFrame(rows, "host string, path string, bad double")).collect()}
    base = np.mean([r[2] for r in rows])
    assert rates["big", "a"].rate == pytest.approx(0.5, abs=0.05) and rates["big", "b"].rate == pytest.approx(0.1, abs=0.05)
    tiny = rates["tiny", "a"]
    assert tiny.base == pytest.approx(base) and base < tiny.host_rate < 0.5
    assert rates[None, None].rate < base


def test_odd_rows(spark):
    rows = [(1, None, "a", "en"), (2, "", None, None), (3, "x " * 200_000, "a", None), (3, "y", "a", "en"), (None, "z", "b", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    docs = docs.selectExpr("*", "1 AS toxic", "2 AS `a.b`", "3 AS row", "4 AS kept", "5 AS id")
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (77, 1, 1), (None, 1, 1), (1, None, 0)], "doc_id long, quality int, toxic int")
    out = quality.classify(docs, labels)
    assert out.columns == ["doc_id", "text", "source", "lang", "a.b", "row", "id", "low_quality", "toxic", "kept"]
    got = out.collect()
    assert sorted(((r.doc_id or 0, r.text) for r in got), key=str) == sorted(((r[0] or 0, r[1]) for r in rows), key=str)
    assert all(0 <= r.toxic <= 1 and 0 <= r.low_quality <= 1 and r.kept is not None for r in got)
    assert quality.classify(docs, labels.limit(0)).filter(~F.col("kept")).count() == 0
    assert quality.classify(docs.limit(0), labels).count() == 0
