from __future__ import annotations

import math
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.functions import vectors
from martloom.operators import cluster, publish, som

COLS = ["x", "y", "z"]


def _blobs(spark, n=60, far=8.0):
    rng = np.random.default_rng(1)
    centres = np.where(np.arange(n)[:, None] % 2 == 0, 0.0, far)
    points = centres + rng.normal(size=(n, 3)) * 0.3
    rows = [(f"c{i}", *map(float, p), i % 2) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "id string, x double, y double, z double, label int"), points


def test_nearest_equals_brute_force_with_ties():
    rng = np.random.default_rng(0)
    w = rng.normal(size=(12, 3))
    w[7] = w[2]
    x = np.vstack([rng.normal(size=(500, 3)), w, (w[0] + w[1])[None, :] / 2])
    best, second = vectors.nearest(x, w, second=True)
    exact = vectors.squared_distances(x, w)
    order = np.argsort(exact, axis=1, kind="stable")
    assert (best == order[:, 0]).all() and (second == order[:, 1]).all()


def test_map_is_the_same_for_any_partitioning(spark):
    df, _ = _blobs(spark)
    for start in ("rows", "plane"):
        one = som.som_fit(df.coalesce(1), COLS, "id", 4, 3, epochs=4, start=start).collect()
        assert som.som_fit(df.repartition(7), COLS, "id", 4, 3, epochs=4, start=start).collect() == one
    drawn = [som.som_fit(df, COLS, "id", 4, 3, epochs=1, sigma=0.5, seed=seed, start="rows").collect() for seed in (7, 8)]
    assert drawn[0] != drawn[1]


def test_training_lowers_the_error(spark):
    df, _ = _blobs(spark)
    errors = []
    for epochs in (1, 20):
        units = som.som_fit(df, COLS, "id", 6, 5, epochs=epochs, start="rows")
        errors.append(som.quantization_error(som.som_assign(df, COLS, "id", units)).first()[0])
    assert errors[1] < errors[0]


def _sheet(spark, n=3000):
    """Points on a curved sheet in three dimensions, with a little noise."""
    rng = np.random.default_rng(4)
    u, v = rng.uniform(-2, 2, n), rng.uniform(-1, 1, n)
    points = np.stack([u + 0.2 * v, v, 0.3 * u * u], axis=1) + rng.normal(size=(n, 3)) * 0.01
    return spark.createDataFrame([(f"c{i}", *map(float, p)) for i, p in enumerate(points)], "id string, x double, y double, z double"), points


def test_covariance_is_exact_and_independent_of_partitions(spark):
    df, points = _sheet(spark, 500)
    n, mean, spread = som.covariance(df.repartition(5), COLS)
    assert n == 500 and np.allclose(mean, points.mean(axis=0), atol=1e-6) and np.allclose(spread, np.cov(points.T, bias=True), atol=1e-5)
    again = som.covariance(df.coalesce(1), COLS)
    assert (again[1] == mean).all() and (again[2] == spread).all()


def test_plane_lies_along_the_widest_directions(spark):
    df, points = _sheet(spark)
    values, axes = np.linalg.eigh(np.cov(points.T, bias=True))
    for m, n, long in ((9, 4, 0), (4, 9, 1)):
        plane = som.plane_weights(df, COLS, m, n).reshape(m, n, 3)
        sides = [plane[-1, 0] - plane[0, 0], plane[0, -1] - plane[0, 0]]
        for side, axis in ((sides[long], -1), (sides[1 - long], -2)):
            assert np.allclose(np.abs(side @ axes[:, axis]), 2 * np.sqrt(values[axis]), rtol=1e-4)


def test_map_unfolds_on_a_sheet(spark):
    """Both errors beat those of one epoch from drawn rows, and neighbours in the data are neighbours on the map."""
    df, _ = _sheet(spark)
    folded = som.map_errors(som.som_assign(df, COLS, "id", som.som_fit(df, COLS, "id", 20, 10, epochs=1, start="rows", sigma=1.2))).first()
    early = som.map_errors(som.som_assign(df, COLS, "id", som.som_fit(df, COLS, "id", 20, 10, epochs=1))).first()
    trained = som.map_errors(som.som_assign(df, COLS, "id", som.som_fit(df, COLS, "id", 20, 10))).first()
    assert trained.quantization_error < 0.5 * early.quantization_error
    assert trained.topographic_error < 0.25 and trained.topographic_error < 0.5 * folded.topographic_error


def test_plane_of_one_direction_or_one_row(spark):
    line = spark.createDataFrame([(str(i), float(i), 2.0 * i) for i in range(20)], "id string, x double, y double")
    units = som.som_fit(line, ["x", "y"], "id", 5, 2)
    assert som.map_errors(som.som_assign(line, ["x", "y"], "id", units)).first().quantization_error < 3
    single = som.som_fit(line.limit(1), ["x"], "id", 3, 2)
    assert {tuple(r.w) for r in single.collect()} == {(0.0,)}
    with pytest.raises(ValueError, match="empty"):
        som.som_fit(line.limit(0), ["x"], "id", 3, 2)


def test_map_larger_than_the_data(spark):
    df, points = _blobs(spark, n=4)
    units = som.som_fit(df, COLS, "id", 5, 4, epochs=0, start="rows")
    assert units.count() == 20 and {tuple(r.w) for r in units.collect()} == {tuple(p) for p in points}


def test_initial_rows_do_not_depend_on_the_prefilter(spark):
    ids = spark.range(5000).select(F.col("id").cast("string").alias("id"), F.col("id").cast("double").alias("x"))
    got = som.initial_weights(ids, ["x"], "id", 50, 42)[:, 0]
    by_hash = ids.orderBy(F.md5(F.concat(F.lit("42:"), "id"))).limit(50).collect()
    assert list(got) == [r.x for r in by_hash]


def test_too_large_a_map_is_refused(spark):
    df, _ = _blobs(spark, n=4)
    with pytest.raises(ValueError, match="exceeds"):
        som.som_fit(df, COLS, "id", 5000, 5000)


def test_map_views(spark):
    grid = spark.createDataFrame([(i, j, [float(i), float(j)]) for i in range(2) for j in range(2)], "i int, j int, w array<double>")
    assert {r.u for r in som.u_matrix(grid).collect()} == {1.0}
    planes = {(r.feature, r.i, r.j): r.value for r in som.component_planes(grid, ["a", "b"]).collect()}
    assert len(planes) == 8 and planes[("a", 1, 0)] == 1.0 and planes[("b", 1, 0)] == 0.0
    assigned = spark.createDataFrame([("a", 0, 0, 1.0, 1, 1), ("b", 0, 0, 3.0, 0, 2)], "id string, i int, j int, dist double, i2 int, j2 int")
    assert som.map_errors(assigned).first() == (2.0, 0.5)


def test_elbow(spark):
    def elbow(values):
        return cluster.elbow_k(spark.createDataFrame([(k + 2, float(v)) for k, v in enumerate(values)], "k int, sse double")).first()[0]

    assert elbow([100, 20, 15, 12, 10, 9, 8, 7.5, 7]) == 3
    assert elbow([100, 80, 20, 15, 12, 10, 9, 8, 7]) == 4
    assert elbow([90, 80, 70, 60, 50, 40, 30, 20, 10]) in range(2, 11)
    assert elbow([5] * 9) == 3


def _silhouette(points, labels):
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    scores = []
    for i, own in enumerate(labels):
        same = labels == own
        if same.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i][same].sum() / (same.sum() - 1)
        b = min(d[i][labels == other].mean() for other in set(labels) if other != own)
        scores.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(scores))


def test_silhouette_over_several_tiles_with_copies_and_a_singleton(spark, monkeypatch):
    monkeypatch.setattr(cluster, "TILE_ROWS", 16)
    rng = np.random.default_rng(3)
    points = np.vstack([rng.normal(size=(70, 3)), np.repeat([[1.0, 2.0, 3.0]], 40, axis=0), [[9.0, 9.0, 9.0]]])
    labels = np.array([i % 3 for i in range(70)] + [1] * 40 + [5])
    df = spark.createDataFrame([(*map(float, p), int(c)) for p, c in zip(points, labels)], "x double, y double, z double, label int")
    want = _silhouette(points, labels)
    assert math.isclose(cluster.silhouette_exact(df, COLS, "label").first()[0], want, rel_tol=1e-9)


def test_distance_sums_of_far_near_and_odd_rows():
    """Offsets, copies, near copies and a long row: as exact as coordinate by coordinate, both ways."""
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(300, 3)) + 1e4, rng.normal(size=(520, 3)) + 1e4
    x[:40], x[40:80], x[80] = y[:40], y[40:80] + 1e-7, 1e7
    x_weights, y_weights = rng.integers(0, 3, (300, 2)).astype(float), rng.integers(0, 3, (520, 4)).astype(float)
    away = np.sqrt(vectors.squared_distances(x, y))
    of_x, of_y = vectors.label_distance_sums(x, x_weights, y, y_weights)
    assert np.allclose(of_x, away @ y_weights, rtol=1e-9, atol=0) and np.allclose(of_y, away.T @ x_weights, rtol=1e-9, atol=0)
    near = np.array([[1.0, 1.0], [1.0, 1.0 + 1e-9], [1.0, 1.0]])
    one = np.ones((3, 1))
    assert np.allclose(vectors.label_distance_sums(near, one, near, one)[0].ravel(), [1e-9, 2e-9, 1e-9], rtol=1e-6)
    assert np.isnan(vectors.label_distance_sums(np.array([[np.nan, 0.0]]), one[:1], near, one)[0]).all()


def test_silhouette_has_tasks_for_all_cores(spark):
    """A few thousand rows are several groups, each a task, and each distance is measured once."""
    n = 3 * cluster.SMALL_TILE_ROWS
    df = spark.range(n).selectExpr("CAST(id % 5 AS INT) AS label", "CAST(id AS DOUBLE) AS x", "CAST(id % 5 * 10000 AS DOUBLE) AS y")
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    context.setJobGroup("tiles", "tiles")
    score = cluster.silhouette_exact(df, ["x", "y"], "label").first()[0]
    context.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in tracker.getJobIdsForGroup("tiles") for s in tracker.getJobInfo(j).stageIds]
    tasks = [tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)]
    assert 3 * 4 // 2 in tasks
    points = np.array([(i, i % 5 * 10000) for i in range(n)], dtype=float)
    labels = np.arange(n) % 5
    one_hot = (labels[:, None] == np.arange(5)).astype(float)
    sums = np.vstack([np.sqrt(vectors.squared_distances(b, points)) @ one_hot for b in vectors.blocks(points)])
    own, size = labels[:, None] == np.arange(5), one_hot.sum(axis=0)
    a, b = (sums / (size - 1))[own], np.where(own, np.inf, sums / size).min(axis=1)
    assert score == pytest.approx(((b - a) / np.maximum(a, b)).mean(), rel=1e-9)


def test_tiles_hold_a_bounded_number_of_rows_and_weights():
    assert [cluster._tiles(n, 3) for n in (0, 1, 5_000, 300_000, 10_000_000)] == [1, 1, 3, 24, 153]
    assert cluster._tiles(1_000_000, cluster.MAX_LABELS) == math.ceil(1_000_000 / cluster.SMALL_TILE_ROWS)


def test_single_cluster_scores(spark):
    df, _ = _blobs(spark, n=6)
    single = df.withColumn("label", F.lit(0))
    assert cluster.silhouette_exact(single, COLS, "label").first()[0] == -1.0
    assert cluster.davies_bouldin(single, COLS, "label").first()[0] == -1.0


def test_too_many_clusters_are_refused(spark, monkeypatch):
    monkeypatch.setattr(cluster, "MAX_LABELS", 1)
    df, _ = _blobs(spark, n=6)
    with pytest.raises(Exception, match="more than 1 clusters"):
        cluster.davies_bouldin(df, COLS, "label").collect()
    with pytest.raises(ValueError, match="more than 1 clusters"):
        cluster.silhouette_exact(df, COLS, "label")


def test_davies_bouldin(spark):
    df, points = _blobs(spark)
    labels = np.arange(len(points)) % 2
    c = [points[labels == g].mean(axis=0) for g in (0, 1)]
    s = [np.sqrt(((points[labels == g] - c[g]) ** 2).sum(1)).mean() for g in (0, 1)]
    want = (s[0] + s[1]) / np.sqrt(((c[0] - c[1]) ** 2).sum())
    assert math.isclose(cluster.davies_bouldin(df, COLS, "label").first()[0], want, rel_tol=1e-9)


def _metrics(spark, *values):
    return spark.createDataFrame([values], "silhouette double, davies_bouldin double, quantization_error double, topographic_error double")


def test_gate(spark):
    good = publish.validate_model(_metrics(spark, 0.6, 0.75, 0.26, 0.26)).first()
    assert good.accepted and good.reasons == "None"
    bad = publish.validate_model(_metrics(spark, 0.5, 0.8, 0.3, 0.27)).first()
    assert not bad.accepted
    assert bad.reasons == (
        "Silhouette Score (0.5000) below threshold (0.6)., Davies-Bouldin Index (0.8000) above threshold (0.75)., "
        "Quantization Error (0.3000) above threshold (0.26)., Topographic Error (0.2700) above threshold (0.26)."
    )
    single = publish.validate_model(_metrics(spark, -1.0, -1.0, 0.1, 0.1)).first()
    assert single.reasons == "Silhouette Score (-1.0000) below threshold (0.6)."


def test_publication_follows_the_verdict(spark):
    segments = spark.createDataFrame([("a", 1.0, 0)], "customer_unique_id string, x double, segment_id int")
    centroids = spark.createDataFrame([(0, [1.004, -2.0]), (7, [0.126, 3.0])], "segment_id int, centroid array<double>")
    yes = publish.validate_model(_metrics(spark, 0.9, 0.1, 0.1, 0.1))
    no = publish.validate_model(_metrics(spark, 0.1, 0.1, 0.1, 0.1))
    assert publish.publish_segmented(segments, yes).count() == 1
    empty = publish.publish_segmented(segments, no)
    assert empty.count() == 0 and empty.columns == segments.columns
    moment = datetime(2018, 1, 1)
    assert [tuple(r) for r in publish.dim_segment(centroids, yes, now=moment).orderBy("segment_id").collect()] == [
        (0, "The Vast Unengaged / Lapsed Base", "Description for Segment 0 based on centroid: [1.0, -2.0]", moment),
        (7, "Segment 7 (Unknown Name)", "Description for Segment 7 based on centroid: [0.13, 3.0]", moment),
    ]
    assert publish.dim_segment(centroids, no, now=moment).count() == 0
    named = publish.segment_profile(segments, ["x"], publish.SEGMENT_NAMES).first()
    assert named.segment_name == publish.SEGMENT_NAMES[0] and named.x == 1.0


def test_kmeans_finds_two_blobs(spark):
    df, _ = _blobs(spark)
    model, labelled = cluster.kmeans_fit(df.drop("label"), COLS, 2)
    groups = labelled.withColumn("even", F.substring("id", 2, 9).cast("int") % 2).select("even", "label").distinct()
    assert groups.count() == 2 and model.summary.trainingCost < 60
    sweep = {r.k: r.sse for r in cluster.kmeans_sweep(df, COLS, ks=(2, 3, 4)).collect()}
    assert sweep[2] >= sweep[3] >= sweep[4]


def test_sweep_trains_all_k_together(spark, monkeypatch):
    """As good as separate fits on planted groups, with as many jobs for nine k as for one."""
    draw = np.random.default_rng(4)
    places = draw.uniform(-50, 50, (7, 2))
    points = np.vstack([p + draw.normal(size=(60, 2)) for p in places])
    df = spark.createDataFrame([tuple(map(float, p)) for p in points], "`a.b` double, y double").repartition(3)
    flat = df.toDF("a", "y")
    sweep = {r.k: r.sse for r in cluster.kmeans_sweep(df, ["a.b", "y"]).collect()}
    assert sorted(sweep) == list(range(2, 11))
    for k, sse in sweep.items():
        apart = cluster.kmeans_fit(flat, ["a", "y"], k)[0].summary.trainingCost
        assert 0 < sse <= apart * 1.01, k
    within = sum(((g - g.mean(axis=0)) ** 2).sum() for g in np.split(points, 7))
    assert sweep[7] == pytest.approx(within)

    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()

    def jobs(ks):
        group = f"sweep-{len(ks)}"
        context.setJobGroup(group, group)
        cluster.kmeans_sweep(flat, ["a", "y"], ks).collect()
        context.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(group))

    monkeypatch.setattr(cluster, "MAX_ITERATIONS", 3)
    monkeypatch.setattr(cluster, "TOLERANCE", -1.0)
    assert jobs((10,)) == jobs(tuple(range(2, 11)))


def test_sweep_of_odd_rows(spark):
    few = spark.createDataFrame([(1.0,), (1.0,), (1.0,), (5.0,)], "x double")
    assert [tuple(r) for r in cluster.kmeans_sweep(few, ["x"], (3, 1, 2, 2)).collect()] == [(1, 12.0), (2, 0.0), (3, 0.0)]
    assert [r.sse for r in cluster.kmeans_sweep(few.filter("x < 2"), ["x"], (1, 2)).collect()] == [0.0, 0.0]
    assert [r.sse for r in cluster.kmeans_sweep(few.limit(0), ["x"], (2, 3)).collect()] == [0.0, 0.0]
    for odd in (None, float("nan"), float("inf")):
        with pytest.raises(ValueError, match="1 rows"):
            cluster.kmeans_sweep(few.unionByName(spark.createDataFrame([(odd,)], "x double")), ["x"])
    with pytest.raises(ValueError):
        cluster.kmeans_sweep(few, ["x"], (0, 2))


def test_whole_job(spark, sf_dir, tmp_path):
    from martloom.plans.catalog import Lake
    from martloom.plans.segmentation import SegmentationConfig, run_segmentation

    lake = Lake(spark, sf_dir)
    config = SegmentationConfig("exact", m=6, n=4, epochs=3, gate=False)
    done = run_segmentation(lake.marts, str(tmp_path), config, datetime(2018, 1, 1))
    people = lake.marts["dim_customer"].select("customer_unique_id").distinct().count()
    assert done.dim_customer_segmented.count() == people == done.segments.count()
    assert done.dim_segment.count() == done.k
    assert done.segments.filter("segment_id IS NULL").count() == 0
    recency = [r.Recency for r in publish.segment_profile(done.segments, ["Recency"]).orderBy("segment_id").collect()]
    assert len(recency) >= 2
    gated = run_segmentation(lake.marts, None, SegmentationConfig("moments", squared_limit=0.7, m=6, n=4, epochs=1, by_zip=True))
    verdict = gated.verdict.first()
    assert gated.dim_customer_segmented.count() == (gated.segments.count() if verdict.accepted else 0)


def test_coincident_centroids_do_not_count(spark):
    rows = [(0.0, 1), (2.0, 1), (0.0, 2), (2.0, 2), (11.0, 3), (11.0, 3)]
    df = spark.createDataFrame(rows, "x double, label int")
    assert math.isclose(cluster.davies_bouldin(df, ["x"], "label").first()[0], (0.1 + 0.1 + 0.1) / 3)
    one = spark.createDataFrame(rows[:4], "x double, label int")
    assert cluster.davies_bouldin(one, ["x"], "label").first()[0] == 0.0


def test_map_sums_do_not_overflow(spark, monkeypatch):
    from martloom.operators import som

    df = spark.range(0, 600_000, 1, 1).selectExpr("CAST(1e6 AS DOUBLE) AS x")
    sums, counts = som._epoch_sums(df, np.array([[0.0], [1e6]]))
    assert counts.tolist() == [0, 600_000] and sums[1, 0] == 6e11
    with pytest.raises(Exception, match="scale the columns"):
        som._epoch_sums(df.selectExpr("x * 1e4 AS x"), np.array([[0.0]]))
