"""K-Means on map units, choice of k, segment assignment and cluster quality."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions import vectors
from martloom.session import materialize

# Range of k, sensitivity of the elbow, k where there is none, seed, end of training.
K_RANGE = tuple(range(2, 11))
SENSITIVITY = 1.0
DEFAULT_K = 3
SEED = 42
MAX_ITERATIONS, TOLERANCE = 300, 1e-4
# The sweep's start: scans that draw candidates, and clusterings of these that are tried for each k.
DRAWS, STARTS = 5, 10

# Exact silhouette: rows per tile at most, fewer where that makes tasks for all cores, and so many weights per tile. A pair of
# tiles is one group and holds these rows twice.
TILE_ROWS, SMALL_TILE_ROWS, TILES = 65_536, 2_048, 24
TILE_WEIGHTS = 1 << 24
MAX_PARTITIONS = 10_000
# Scores hold one entry per cluster in every task; more clusters than this are refused.
MAX_LABELS = 10_000


def _array(cols: Sequence[str]) -> Column:
    return F.expr("array(" + ", ".join(f"CAST(`{c}` AS DOUBLE)" for c in cols) + ")")


def _vector(cols: Sequence[str]) -> Column:
    return array_to_vector(_array(cols))


def _mean_variance(df: DataFrame, cols: Sequence[str]) -> float:
    total = " + ".join(f"var_pop(CAST(`{c}` AS DOUBLE))" for c in cols)
    return (df.agg(F.expr(total).alias("v")).first()["v"] or 0.0) / len(cols)


def kmeans_fit(
    df: DataFrame, cols: Sequence[str], k: int, seed: int = SEED, variance: float | None = None
) -> tuple[KMeansModel, DataFrame]:
    """Fit K-Means; the model's ``summary.trainingCost`` is the inertia. Labels are in ``label``.

    Training ends when the summed squared moves of the centres fall below ``TOLERANCE`` times the
    mean variance of the features, which is measured unless given.
    """
    spread = _mean_variance(df, cols) if variance is None else variance
    # Spark compares each centre's own move.
    tolerance = math.sqrt(TOLERANCE * spread / k)
    prepared = df.withColumn("_features", _vector(cols))
    estimator = KMeans(k=k, seed=seed, maxIter=MAX_ITERATIONS, tol=tolerance, featuresCol="_features")
    model = estimator.setPredictionCol("label").fit(prepared)
    return model, model.transform(prepared).drop("_features")


def _drawn(rows: DataFrame, cols: Sequence[str], found: np.ndarray, n: int, seed: int, step: int) -> np.ndarray:
    """``n`` rows drawn without repeats, each by its squared distance to the nearest of ``found``.

    Every row gets an exponential key whose rate is its weight, and the smallest keys win, so a task returns ``n`` rows at most.
    """
    # Rounding errors must not make a row that has been found likely again.
    nil = 1e-12 * (1.0 + float((found * found).sum(axis=1).max()))

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        draw = np.random.default_rng([seed, step, TaskContext.get().partitionId()])
        best, keys = np.zeros((0, len(cols))), np.zeros(0)
        for batch in batches:
            for x in vectors.blocks(batch.to_numpy(dtype=float)):
                away = vectors.squared_distances(x, found).min(axis=1)
                key = draw.standard_exponential(len(x)) / np.where(away > nil, away, 1.0)
                best, keys = np.vstack([best, x[away > nil]]), np.concatenate([keys, key[away > nil]])
                first = np.argsort(keys, kind="stable")[:n]
                best, keys = best[first], keys[first]
        yield pd.DataFrame(best, columns=list(cols)).assign(_key=keys)

    schema = ", ".join(f"`{c}` double" for c in cols) + ", _key double"
    won = rows.mapInPandas(keyed, schema).orderBy("_key").limit(n).collect()
    return np.array([r[:-1] for r in won], dtype=float).reshape(-1, len(cols))


def _centre_sums(rows: DataFrame, cols: Sequence[str], centres: Mapping[int, np.ndarray]) -> dict[int, tuple]:
    """One scan for several sets of centres: per set the number of rows, their sums and their squared distances by nearest centre."""
    width = len(cols)
    names = ["n", "cost", *[f"s{d}" for d in range(width)]]

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every = np.vstack(list(centres.values()))
        sizes = [len(c) for c in centres.values()]
        begins = np.cumsum([0, *sizes[:-1]])
        total = np.zeros((len(every), width + 2))
        for batch in batches:
            for x in vectors.blocks(batch.to_numpy(dtype=float)):
                away = vectors.squared_distances(x, every)
                nearest = [b + away[:, b : b + n].argmin(axis=1) for b, n in zip(begins, sizes, strict=True)]
                mine = np.zeros(away.shape)
                mine[np.arange(len(x))[:, None], np.stack(nearest, axis=1)] = 1.0
                total[:, 0] += mine.sum(axis=0)
                total[:, 1] += (mine * away).sum(axis=0)
                total[:, 2:] += mine.T @ x
        places = {"k": np.repeat(list(centres), sizes), "c": np.arange(len(every)) - np.repeat(begins, sizes)}
        yield pd.DataFrame(total, columns=names).assign(**places)

    schema = ", ".join(f"{n} double" for n in names) + ", k int, c int"
    per_centre = rows.mapInPandas(summed, schema).groupBy("k", "c").agg(*[F.sum(n).alias(n) for n in names]).collect()
    out = {k: (np.zeros(len(c)), np.zeros(len(c)), np.zeros((len(c), width))) for k, c in centres.items()}
    for r in per_centre:
        n, cost, sums = out[r["k"]]
        n[r["c"]], cost[r["c"]], sums[r["c"]] = r["n"], r["cost"], [r[f"s{d}"] for d in range(width)]
    return out


def _best_start(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """The best of ``STARTS`` weighted clusterings of a few candidates, each from centres drawn far apart."""
    best, least = points[:1], math.inf
    for attempt in range(STARTS):
        draw = np.random.default_rng([seed, k, attempt])
        chosen = points[[draw.choice(len(points), p=weights / weights.sum())]]
        while len(chosen) < min(k, len(points)):
            mass = weights * vectors.squared_distances(points, chosen).min(axis=1)
            if not mass.sum() > 0:
                break
            chosen = np.vstack([chosen, points[draw.choice(len(points), p=mass / mass.sum())]])
        for _ in range(MAX_ITERATIONS):
            own = vectors.squared_distances(points, chosen).argmin(axis=1)
            mass = np.bincount(own, weights, len(chosen))
            sums = np.stack([np.bincount(own, weights * p, len(chosen)) for p in points.T], axis=1)
            moved = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1e-300)[:, None], chosen)
            done, chosen = np.array_equal(moved, chosen), moved
            if done:
                break
        cost = float(weights @ vectors.squared_distances(points, chosen).min(axis=1))
        if cost < least:
            best, least = chosen, cost
    return best


def kmeans_sweep(df: DataFrame, cols: Sequence[str], ks: Sequence[int] = K_RANGE, seed: int = SEED) -> DataFrame:
    """Inertia for each k of K-Means with k centres, all trained together.

    ``DRAWS`` scans draw candidates far from those before them, one more weighs them by the rows near them; each k starts at the
    best weighted clustering of these candidates. Every further scan moves the centres of all k whose summed squared moves
    still exceed ``TOLERANCE`` times the mean variance, and a last one measures all inertias. So the number of scans is
    that of the slowest k, and a task returns a row per centre.

    A centre without rows stays in its place. Where there are fewer distinct rows than k, each is a centre. Null and
    non-finite values are refused. Without rows all inertias are 0.
    """
    ks = sorted(set(ks))
    if not ks or ks[0] < 1 or sum(ks) > MAX_LABELS:
        raise ValueError(f"k from 1 on, {MAX_LABELS} centres in all at most")
    names = [f"x{d}" for d in range(len(cols))]
    kept = materialize(df.select(*[F.col(f"`{c}`").cast("double").alias(x) for c, x in zip(cols, names, strict=True)]), "sweep-rows")
    finite = " AND ".join(f"coalesce(abs({x}) < double('inf'), false)" for x in names)
    seen = kept.agg(
        F.count_if(~F.expr(finite)).alias("odd"),
        F.expr(" + ".join(f"var_pop({x})" for x in names) + " AS spread"),
        F.min_by(F.array(*names), F.xxhash64(F.lit(seed), *names)).alias("first"),
    ).first()
    if seen["odd"]:
        raise ValueError(f"{seen['odd']} rows with null or non-finite values")
    if seen["first"] is None:
        return df.sparkSession.createDataFrame([(k, 0.0) for k in ks], "k int, sse double")
    found = np.array([seen["first"]])
    for step in range(DRAWS):
        found = np.vstack([found, _drawn(kept, names, found, 2 * ks[-1], seed, step)])
    found = np.unique(found, axis=0)
    weights = _centre_sums(kept, names, {0: found})[0][0]
    centres = {k: _best_start(found, weights, k, seed) for k in ks}
    limit = TOLERANCE * seen["spread"] / len(cols)
    moving = list(ks)
    for _ in range(MAX_ITERATIONS):
        for k, (n, _, sums) in _centre_sums(kept, names, {k: centres[k] for k in moving}).items():
            moved = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres[k])
            if ((moved - centres[k]) ** 2).sum() <= limit:
                moving.remove(k)
            centres[k] = moved
        if not moving:
            break
    costs = _centre_sums(kept, names, centres)
    return df.sparkSession.createDataFrame([(k, float(costs[k][1].sum())) for k in ks], "k int, sse double")


def elbow_k(sweep: DataFrame, sensitivity: float = SENSITIVITY, default: int = DEFAULT_K) -> DataFrame:
    """The elbow of a convex decreasing curve by the Kneedle rule, or ``default`` if it has none.

    The curve is flipped and scaled to the unit square. From each local maximum of its distance
    to the diagonal a threshold is carried on; after a local minimum the threshold is zero. The
    first point whose successor falls below the threshold makes the last maximum the elbow.
    The windows run over one row per k.
    """
    every = Window.partitionBy()
    k, sse = F.col("k"), F.col("sse")
    k0, k1 = F.min(k).over(every), F.max(k).over(every)
    low, high = F.min(sse).over(every), F.max(sse).over(every)
    x = (k - k0) / F.nullif(k1 - k0, F.lit(0))
    y = (high - sse) / F.nullif(high - low, F.lit(0.0))
    step = 1.0 / (F.count(k).over(every) - 1)
    by_k = Window.orderBy("k")
    so_far = by_k.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    curve = sweep.select("k", (y - x).alias("d"), step.alias("step"))
    before, after = F.lag("d").over(by_k), F.lead("d").over(by_k)
    d = F.col("d")
    marked = curve.select(
        "k", "d", "step", after.alias("after"),
        ((d >= F.coalesce(before, d)) & (d >= F.coalesce(after, d))).alias("is_max"),
        ((d <= F.coalesce(before, d)) & (d <= F.coalesce(after, d))).alias("is_min"),
    )
    event = F.when(F.col("is_min"), 0.0).when(F.col("is_max"), d - F.col("step") * sensitivity)
    seen_max = F.max(F.col("is_max").cast("int")).over(so_far) == 1
    carried = marked.select(
        "k",
        "after",
        F.last(event, ignorenulls=True).over(so_far).alias("threshold"),
        F.last(F.when(F.col("is_max"), F.col("k")), ignorenulls=True).over(so_far).alias("candidate"),
        seen_max.alias("seen_max"),
    )
    fallen = carried.filter(F.col("seen_max") & (F.col("after") < F.col("threshold")))
    return fallen.agg(F.coalesce(F.min_by("candidate", "k"), F.lit(default)).cast("int").alias("k"))


def assign_segments(features: DataFrame, assigned: DataFrame, neuron_labels: DataFrame, id_col: str) -> DataFrame:
    """Features with the segment of each row's best unit. ``neuron_labels`` is ``(i, j, label)``."""
    labels = neuron_labels.select("i", "j", F.col("label").cast("int").alias("segment_id"))
    segments = assigned.join(labels, ["i", "j"]).select(id_col, "segment_id")
    return features.join(segments, id_col, "left")


def _distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def _points(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    return df.select(F.col(label).alias("label"), _array(cols).alias("v"))


def _gathered(per_label: DataFrame, gather: Column) -> Column:
    """One value made of a row per cluster, as a subquery; an error if there are too many."""
    few = per_label.limit(MAX_LABELS + 1)
    refused = F.raise_error(F.lit(f"more than {MAX_LABELS} clusters"))
    return few.agg(F.when(F.count(F.lit(1)) <= MAX_LABELS, gather).otherwise(refused).alias("m")).scalar()


def davies_bouldin(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Mean over clusters of the worst (spread + spread) / distance of centroids; -1 below two clusters.

    Rows are never shuffled by cluster: the centroids, one per cluster, reach them as a subquery
    and both passes combine map-side. The last step works on the clusters alone.
    """
    points = _points(df, cols, label)
    means = points.groupBy("label").agg(F.expr(f"array({', '.join(f'avg(v[{d}])' for d in range(len(cols)))}) AS c"))
    by_label = _gathered(means, F.map_from_entries(F.collect_list(F.struct("label", "c"))))
    spread = (
        points.withColumn("c", F.element_at(by_label, F.col("label")))
        .select("label", _distance(F.col("v"), F.col("c")).alias("d"))
        .groupBy("label")
        .agg(F.avg("d").alias("s"))
        .withColumn("c", F.element_at(by_label, F.col("label")))
    )
    clusters = _gathered(spread, F.collect_list(F.struct("label", "s", "c")))
    spread = spread.withColumn("all", clusters)
    worst = F.array_max(
        F.transform(
            F.filter("all", lambda o: o["label"] != F.col("label")),
            # Clusters with one and the same centroid do not count against each other.
            lambda o: F.coalesce(F.try_divide(F.col("s") + o["s"], _distance(F.col("c"), o["c"])), F.lit(0.0)),
        )
    )
    score = spread.select(worst.alias("worst")).agg(F.avg("worst").alias("mean"))
    return score.select(F.coalesce("mean", F.lit(-1.0)).alias("davies_bouldin"))


def _silhouette_of_sums(sums: DataFrame, sizes: DataFrame) -> DataFrame:
    """Mean silhouette from per-row distance sums ``(row, own, copies, other, total)`` and cluster sizes.

    ``sizes`` is one row per cluster and reaches the sums as a map.
    """
    by_label = _gathered(sizes, F.map_from_entries(F.collect_list(F.struct("label", "size"))))
    own = F.col("own") == F.col("other")
    size = F.element_at(by_label, F.col("other"))
    per_row = sums.groupBy("row", "own", "copies").agg(
        F.max(F.when(own, F.col("total") / F.nullif(size - 1, F.lit(0)))).alias("a"),
        F.min(F.when(~own, F.col("total") / size)).alias("b"),
    )
    # A row alone in its cluster has no a, and a single cluster has no b: the score is 0 and -1.
    one = F.when(F.col("b").isNull(), None).otherwise(
        F.coalesce((F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0)), F.lit(0.0))
    )
    scored = per_row.agg((F.sum(one * F.col("copies")) / F.sum("copies")).alias("mean"))
    return scored.select(F.coalesce("mean", F.lit(-1.0)).alias("silhouette"))


def _tiles(n: int, labels: int) -> int:
    """How many tiles ``n`` rows make."""
    most = min(TILE_ROWS, max(SMALL_TILE_ROWS, TILE_WEIGHTS // max(labels, 1)))
    return max(1, math.ceil(n / most), min(TILES, math.ceil(n / SMALL_TILE_ROWS)))


def silhouette_exact(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Mean Euclidean silhouette; -1 below two clusters.

    Every row is scored against every other. Equal rows of a cluster are first
    merged into one with a count; the distinct rows are spread over tiles by hash, and each pair
    of tiles is one bounded group, a task of its own, that measures each distance once and returns sums per row and
    cluster, not pairs. The work is quadratic in the distinct rows; for many millions of them use ``silhouette_squared``.
    """
    points = _points(df, cols, label)
    merged = points.groupBy("label", "v").agg(F.count(F.lit(1)).alias("copies"))
    distinct = materialize(merged.withColumn("row", F.monotonically_increasing_id()), "silhouette-rows")
    sizes = distinct.groupBy("label").agg(F.sum("copies").alias("size"))
    labels = sorted(r["label"] for r in sizes.select("label").limit(MAX_LABELS + 1).collect())
    if len(labels) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} clusters")
    tiles = _tiles(distinct.count(), len(labels))
    groups = tiles * (tiles + 1) // 2
    partitions = min(groups, MAX_PARTITIONS)

    names = [f"v{d}" for d in range(len(cols))]
    tiled = distinct.select(
        "row", "label", "copies", *[F.col("v")[d].alias(v) for d, v in enumerate(names)],
        F.pmod(F.xxhash64("row"), F.lit(tiles)).cast("long").alias("tile"),
    )
    # Pairs of tiles are numbered through; the first tile of a pair is the smaller one.
    first, second = F.least("tile", "other_tile"), F.greatest("tile", "other_tile")
    pairs = tiled.withColumn("other_tile", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long")))).select(
        "row", "label", "copies", *names, (F.col("tile") == first).alias("is_first"), (F.col("tile") == second).alias("is_second"),
        (second * (second + 1) / 2 + first).cast("long").alias("pair"),
    )
    dealt = pairs.repartitionById(partitions, (F.col("pair") % partitions).cast("int")).sortWithinPartitions("pair")
    label_type = df.schema[label].dataType.simpleString()

    def totals(rows: pd.DataFrame, sums: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "row": np.repeat(rows["row"].to_numpy(), len(labels)),
                "own": np.repeat(rows["label"].to_numpy(), len(labels)),
                "copies": np.repeat(rows["copies"].to_numpy(), len(labels)),
                "other": np.tile(np.array(labels), len(rows)),
                "total": sums.ravel(),
            }
        )

    def sums_of_pair(parts: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(parts)
        places = np.array(labels)
        x, y = rows[rows["is_first"]], rows[rows["is_second"]]
        if x.empty or y.empty:
            return
        weights = [(side["label"].to_numpy()[:, None] == places) * side["copies"].to_numpy(float)[:, None] for side in (x, y)]
        of_x, of_y = vectors.label_distance_sums(
            x[names].to_numpy(dtype=float), weights[0], y[names].to_numpy(dtype=float), weights[1]
        )
        yield totals(x, of_x)
        # A tile paired with itself is both sides.
        if not x["is_second"].iloc[0]:
            yield totals(y, of_y)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, []
        for batch in batches:
            for pair, part in batch.groupby("pair"):
                if held and pair != now:
                    yield from sums_of_pair(held)
                    held = []
                now = pair
                held.append(part)
        if held:
            yield from sums_of_pair(held)

    schema = f"row long, own {label_type}, copies long, other {label_type}, total double"
    partial = dealt.mapInPandas(sums, schema)
    summed = partial.groupBy("row", "own", "copies", "other").agg(F.sum("total").alias("total"))
    return _silhouette_of_sums(summed, sizes)


def silhouette_squared(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Silhouette on squared distances from cluster moments: linear, but another number than the exact one."""
    prepared = df.select(F.col(label).cast("double").alias("prediction"), _vector(cols).alias("features"))
    score = ClusteringEvaluator(metricName="silhouette", distanceMeasure="squaredEuclidean").evaluate(prepared)
    return df.sparkSession.createDataFrame([(float(score),)], "silhouette_squared double")
