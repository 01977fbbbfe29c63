"""A quality classifier that weighs a document's own evidence with what is known of its host and path.

Evidence: words, beginnings of words, runs of punctuation and a few shapes of the whole text. A feature counts
if the labelled documents with it are bad significantly more often than the others; a document's evidence is the sum of
the log ratios of its features, calibrated on labelled documents that did not choose the features.

Sites: each document is bad with certainty (label) or with its own probability (no label). Means per host
are shrunk toward the whole corpus, means per path toward their host, by strengths that are
estimated from how much hosts, and paths inside hosts, really differ (empirical Bayes). A path's shrunk mean is the prior
of its documents: a site seen a few times hardly moves it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import bare, col, map_batches, materialize, slices
from martloom.llm.shingles import Shingler

# At most so many labelled documents, drawn by a hash of their ids, choose and calibrate the features. Everything
# else covers all rows.
SAMPLE = 20_000
# At most so many features, the most significant first; how many standard errors and times more often make one count.
FEATURES = 50_000
SIGNIFICANT = 5.0
TELLING = 4.0
PREFIX = 5
EVIDENCE_LIMIT = 40.0
# Shrinking strengths lie between these numbers of documents.
STRENGTH = (1.0, 1e6)
TARGETS = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


def features(text: str) -> set[int]:
    """The distinct features of a text, hashed."""
    words = text.split()
    found, upper, odd = set(), 0, 0
    for word in set(words):
        body = word.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
        tail = word[len(word.rstrip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")) :]
        lower = body.lower()
        found.add("w" + lower)
        if len(lower) > PREFIX:
            found.add("p" + lower[:PREFIX])
        if len(tail) > 1 or not body:
            found.add("t" + tail)
            odd += 1
        upper += len(body) > 1 and body.isupper()
    if words:
        n = min(len(words), 1000).bit_length()
        distinct = max(1, len(set(words)))
        found.add(f"r{n}:{10 * distinct // len(words)}")
        found.add(f"o{10 * odd // distinct}")
        found.add(f"u{10 * upper // distinct}")
    else:
        found.add("empty")
    return {xxhash.xxh3_64_intdigest(f) >> 1 for f in found}


def _feature_counts(labelled: DataFrame, targets: list[str]) -> DataFrame:
    """From ``id, text`` and a 0/1 column per target: per feature the documents with it, in all and bad; feature -1 is any.

    Copies would make chance look significant, so of documents with the same smallest shingle, as exact and
    most near copies have it, the one with the smallest id counts.
    """
    schema = T.StructType([
        labelled.schema["id"], T.StructField("lead", T.LongType()), T.StructField("features", T.ArrayType(T.LongType())),
        *[T.StructField(t, T.LongType()) for t in targets],
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        shingler = Shingler(5)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").to_pylist()
                leads = [int(s[0]) >> 1 if len(s) else -1 for s in shingler(texts)]
                found = [[-1, *features(t.decode("utf-8", "replace"))] for t in texts]
                yield [part.column("id"), pa.array(leads, pa.int64()), pa.array(found, pa.list_(pa.int64())), *[part.column(t) for t in targets]]

    frame = labelled.select("id", F.coalesce("text", F.lit("")).cast("binary").alias("text"), *[F.col(t).cast("long").alias(t) for t in targets])
    seen = materialize(map_batches(frame, run, schema), "quality-labelled")
    single = seen.groupBy("lead").agg(F.min_by(F.struct("features", *targets), "id").alias("doc")).select("doc.*")
    counted = single.select(F.explode("features").alias("feature"), *targets).groupBy("feature")
    return counted.agg(F.count("*").alias("n"), *[F.sum(t).alias(t) for t in targets])


def _weights(counts: DataFrame, target: str) -> dict[int, float]:
    """Features that make a document bad significantly more often, with their log ratios. Bounded by ``FEATURES``."""
    whole = counts.filter("feature = -1").select("n", target).first()
    if whole is None:
        return {}
    all_n, all_bad = whole
    n, bad, share = F.col("n"), F.col(target), all_bad / all_n
    good = n - bad
    ratio = F.log((bad + 0.5) / (all_bad + 1)) - F.log((good + 0.5) / (all_n - all_bad + 1))

    def surprise(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    # Likelihood ratio test, in standard errors.
    z = F.sqrt(F.greatest(F.lit(0.0), 2 * (surprise(bad, n * share) + surprise(good, n * (1 - share)))))
    rated = counts.filter("feature <> -1").select("feature", ratio.alias("weight"), z.alias("z"))
    telling = rated.filter((F.col("z") >= SIGNIFICANT) & (F.col("weight") >= np.log(TELLING)))
    rows = telling.orderBy(F.desc("z"), "feature").limit(FEATURES).collect()
    return {r.feature: r.weight for r in rows}


def _with_evidence(docs: DataFrame, weights: Mapping[str, dict[int, float]], keep_text: bool) -> DataFrame:
    """``docs``, whose last column is ``text``, with a column ``e0``, ``e1``, ... of evidence per target."""
    names = [f"e{i}" for i in range(len(weights))]
    tables = list(weights.values())
    shown = docs.columns if keep_text else docs.columns[:-1]
    schema = T.StructType([*docs.select(*shown).schema, *[T.StructField(n, T.DoubleType()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [features(t or "") for t in part.column("text").to_pylist()]
                sums = [[min(EVIDENCE_LIMIT, sum(sorted(t[f] for f in s if f in t))) for s in sets] for t in tables]
                yield [*part.columns[: len(shown)], *[pa.array(s, pa.float64()) for s in sums]]

    return map_batches(docs, run, schema)


def calibrated(evidence: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of the log odds of ``bad`` given the evidence.

    Two rows without evidence, a quarter of them bad, stand for what is believed before any label.
    """
    x = np.concatenate([evidence, [0.0, 0.0]])
    y = np.concatenate([bad, [1.0, 0.0]])
    w = np.concatenate([np.ones(len(bad)), [0.5, 1.5]])
    design = np.stack([np.ones_like(x), x], axis=1)
    theta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        ridge = np.diag([1e-6, 1e-2])
        step = np.linalg.solve(
            design.T @ (design * (w * p * (1 - p))[:, None]) + ridge, design.T @ (w * (y - p)) - ridge @ theta
        )
        theta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(theta[0]), float(theta[1])


def _strength(groups: DataFrame, mean: Column) -> float:
    """How many documents the mean above is worth, by the moments of ``n, bad`` per group around ``mean``.

    Groups that differ no more than chance would have them give the upper limit.
    """
    n, rate = F.col("n"), F.col("bad") / F.col("n")
    spread = F.sum(n * (rate - mean) * (rate - mean))
    chance = F.sum((1 - n / F.col("above_n")) * mean * (1 - mean))
    room = F.sum(n * (1 - n / F.col("above_n")))
    between = F.try_divide(spread - chance, room)
    noise = F.try_divide(F.sum(n * mean * (1 - mean)), F.sum(n))
    low, high = STRENGTH
    found = F.greatest(F.lit(low), F.least(F.lit(high), F.try_divide(noise, F.greatest(between, F.lit(1e-12)))))
    return groups.agg(F.coalesce(found, F.lit(high))).first()[0]


def site_rates(events: DataFrame) -> DataFrame:
    """From ``host, path, bad`` (a probability per document): ``host, path, rate`` and the corpus mean ``base``.

    ``rate`` is the path's mean, shrunk toward the host's, which is shrunk toward the corpus mean.
    """
    paths = materialize(
        events.groupBy("host", "path").agg(F.count("*").cast("double").alias("n"), F.sum("bad").alias("bad")), "quality-paths"
    )
    total = paths.agg(F.sum("bad"), F.sum("n")).first()
    base = total[0] / total[1] if total[1] else 0.0
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("above_n", F.lit(float(total[1] or 0)))
    hosts = materialize(hosts, "quality-hosts")
    k = _strength(hosts, F.lit(base))
    hosts = hosts.select(
        F.col("host").alias("h"), F.col("n").alias("above_n"), ((F.col("bad") + k * base) / (F.col("n") + k)).alias("host_rate")
    )
    placed = materialize(paths.join(materialize(hosts, "quality-rates"), F.col("host").eqNullSafe(F.col("h"))).drop("h"), "quality-placed")
    k = _strength(placed, F.col("host_rate"))
    rate = (F.col("bad") + k * F.col("host_rate")) / (F.col("n") + k)
    return placed.select("host", "path", F.lit(base).alias("base"), "host_rate", rate.alias("rate"))


def classify(
    docs: DataFrame, labels: DataFrame, targets: Mapping[str, str] = TARGETS, id_col: str = "doc_id", text_col: str = "text",
    host_col: str = "source", path_col: str = "lang", limit: float = 0.5, sample: int = SAMPLE, keep_text: bool = True,
) -> DataFrame:
    """Every row of ``docs`` with the probability of each target and ``kept``: none of them is above ``limit``.

    ``targets`` names what to detect and gives the condition on ``labels`` that says it.

    * A null text is empty; an empty text has a feature of its own. Null hosts and paths are hosts and paths too.
    * Labels for unknown or null ids, and labels whose condition is null, are left out. If an id has several labels,
      the bad one counts; rows that share an id share its label.
    * Without any label a document's evidence says nothing and all documents are kept.
    * The model is bounded by parameters of this module: of features that pass ``SIGNIFICANT`` and ``TELLING`` the first
      ``FEATURES`` count, evidence is at most ``EVIDENCE_LIMIT``, and a shape feature takes 1,000 words and more as one size class.
    * An input column named like a result column gives way to it. An empty table gives an empty result.
    """
    names = list(targets)
    marks = [f"y{i}" for i in range(len(names))]
    known = labels.select(col(id_col).alias("label_id"), *[F.expr(c).cast("int").alias(m) for m, c in zip(marks, targets.values(), strict=True)])
    known = known.dropna().groupBy("label_id").agg(*[F.max(m).alias(m) for m in marks])
    drawn = F.xxhash64("label_id", F.lit(10))
    chosen = known.withColumn("drawn", drawn).orderBy("drawn", "label_id").limit(sample)
    chosen = materialize(chosen, "quality-sample")
    shown = [c for c in bare(docs, *names, "kept") if keep_text or c != text_col]
    passed = [c for c in shown if c != text_col]
    base = docs.select(
        F.struct(F.lit(0).alias("_"), *[col(c).alias(f"c{i}") for i, c in enumerate(passed)]).alias("row"),
        col(id_col).alias("id"), col(host_col).cast("string").alias("host"), col(path_col).cast("string").alias("path"),
        col(text_col).cast("string").alias("text"),
    )
    # The sample has at most ``sample`` rows of a few numbers each.
    labelled = base.select("id", "text").join(F.broadcast(chosen), F.col("id") == F.col("label_id"))
    half = F.pmod("drawn", F.lit(2)) == 0
    counts = materialize(_feature_counts(labelled.filter(half), marks), "quality-features")
    scored = materialize(_with_evidence(base, {m: _weights(counts, m) for m in marks}, text_col in shown), "quality-scored")
    kinds = [f"e{i}" for i in range(len(names))]
    held = scored.select("id", *kinds).join(F.broadcast(chosen.filter(~half)), F.col("id") == F.col("label_id"))
    # Two numbers per target and row of the sample; an id that repeats in ``docs`` counts once.
    rows = held.groupBy("id").agg(*[F.max(c).alias(c) for c in [*kinds, *marks]]).collect()
    # Labels meet ids and evidence only; the texts are neither shuffled nor stored again.
    events = scored.select("id", "host", "path", *kinds).join(known, F.col("id") == F.col("label_id"), "left")
    events = materialize(events.select("host", "path", *kinds, *marks), "quality-events")
    result, odds = scored, {}
    for i, (e, m) in enumerate(zip(kinds, marks, strict=True)):
        x, y = (np.array([r[c] for r in rows], float) for c in (e, m))
        a, b = calibrated(x, y)
        alone = F.lit(a) + F.lit(b) * F.col(e)
        bad = F.coalesce(F.col(m).cast("double"), 1 / (1 + F.exp(-alone)))
        rates = materialize(site_rates(events.select("host", "path", bad.alias("bad"))), "quality-rates")
        rates = rates.select(F.col("host").alias(f"h{i}"), F.col("path").alias(f"p{i}"), F.col("rate").alias(f"r{i}"), F.col("base").alias(f"b{i}"))
        result = result.join(rates, F.col("host").eqNullSafe(F.col(f"h{i}")) & F.col("path").eqNullSafe(F.col(f"p{i}")))
        log_odds = {c: F.log(F.greatest(F.col(c), F.lit(1e-9)) / F.greatest(1 - F.col(c), F.lit(1e-9))) for c in (f"r{i}", f"b{i}")}
        # The evidence speaks relative to the corpus mean; the site's mean takes that mean's place.
        odds[names[i]] = alone + log_odds[f"r{i}"] - log_odds[f"b{i}"]
    result = result.select(
        *[F.col("text" if c == text_col else f"row.c{passed.index(c)}").alias(c) for c in shown],
        *[(1 / (1 + F.exp(-o))).alias(n) for n, o in odds.items()],
    )
    return result.withColumn("kept", F.greatest(*map(col, names), F.lit(0.0)) <= limit)
