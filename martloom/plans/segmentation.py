"""Customer segmentation: features, map, clusters, gate, published tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators import cluster, features, publish, som
from martloom.operators.features import CUSTOMER, FEATURES
from martloom.session import materialize
from martloom.sources import tables


@dataclass(frozen=True)
class SegmentationConfig:
    """Settings of one training run.

    ``silhouette`` names the figure the gate holds against its limit, for the two are different numbers: ``exact`` is the
    mean Euclidean silhouette, quadratic in the distinct customers, with the limit of ``publish.LIMITS``; ``moments`` is the
    one on squared distances, linear, with ``squared_limit``.
    """

    silhouette: str
    squared_limit: float | None = None

    m: int = som.ROWS
    n: int = som.COLUMNS
    sigma: float | None = None
    sigma_end: float = som.SIGMA_END
    epochs: int = som.EPOCHS
    seed: int = som.SEED
    gate: bool = True
    by_zip: bool = False


@dataclass(frozen=True)
class Segmentation:
    """Frames of one run; ``verdict`` is the row of the gate."""

    k: int
    neurons: DataFrame
    assigned: DataFrame
    segments: DataFrame
    verdict: DataFrame
    dim_customer_segmented: DataFrame
    dim_segment: DataFrame


def order_clusters(model: KMeansModel, by: int) -> dict[int, int]:
    """New number of each cluster: the one with the largest value of a feature becomes 0.

    K-Means numbers its clusters at random, while segment names go by number.
    """
    centers = model.clusterCenters()
    ranked = sorted(range(len(centers)), key=lambda c: -centers[c][by])
    return {old: new for new, old in enumerate(ranked)}


def metrics_row(labelled: DataFrame, assigned: DataFrame, config: SegmentationConfig) -> DataFrame:
    """The four figures the gate looks at, as one row."""
    errors = som.map_errors(assigned).select(F.struct("*").alias("e"))
    measure = cluster.silhouette_exact if config.silhouette == "exact" else cluster.silhouette_squared
    silhouette = measure(labelled, FEATURES, "segment_id")
    bouldin = cluster.davies_bouldin(labelled, FEATURES, "segment_id")
    return labelled.sparkSession.range(1).select(
        silhouette.scalar().alias("silhouette"), bouldin.scalar().alias("davies_bouldin"), errors.scalar().alias("e")
    ).select("silhouette", "davies_bouldin", "e.*")


def run_segmentation(
    marts: Mapping[str, DataFrame],
    target: str | None,
    config: SegmentationConfig,
    now: datetime | None = None,
) -> Segmentation:
    """Train on the marts and, if the gate agrees, publish the segment tables below ``target``.

    Customers stay distributed throughout; only the map's units and the cluster centres, both of
    fixed size, pass through the driver.
    """
    if config.silhouette not in ("exact", "moments"):
        raise ValueError(config.silhouette)
    limits = publish.LIMITS if config.gate else {**dict.fromkeys(publish.LIMITS, float("inf")), "silhouette": -2.0}
    if config.gate and config.silhouette == "moments":
        if config.squared_limit is None:
            raise ValueError("the silhouette on squared distances needs a limit of its own")
        limits = {**limits, "silhouette": config.squared_limit}
    feats = materialize(features.customer_features(marts, config.by_zip), "features")
    scaled = materialize(features.standard_scale(feats, FEATURES, CUSTOMER)[0], "scaled")
    neurons = materialize(
        som.som_fit(
            scaled, FEATURES, CUSTOMER, config.m, config.n, config.sigma, config.sigma_end, config.epochs, config.seed
        ),
        "neurons",
    )
    assigned = materialize(som.som_assign(scaled, FEATURES, CUSTOMER, neurons), "assigned")

    units = som.neuron_columns(neurons, FEATURES)
    k = cluster.elbow_k(cluster.kmeans_sweep(units, FEATURES, seed=config.seed)).first()["k"]
    model, labelled_units = cluster.kmeans_fit(units, FEATURES, k, config.seed)
    renumbered = order_clusters(model, FEATURES.index("Recency"))
    numbers = F.create_map(*[F.lit(x) for pair in renumbered.items() for x in pair])
    labels = labelled_units.select("i", "j", F.element_at(numbers, F.col("label")).alias("label"))

    distinct = assigned.dropDuplicates([CUSTOMER]) if config.by_zip else assigned
    segments = materialize(cluster.assign_segments(feats, distinct, labels, CUSTOMER), "segments")
    by_customer = segments.select(CUSTOMER, "segment_id").distinct() if config.by_zip else segments
    labelled = materialize(
        scaled.join(by_customer.select(CUSTOMER, "segment_id"), CUSTOMER), "labelled"
    )
    verdict = materialize(publish.validate_model(metrics_row(labelled, assigned, config), limits), "verdict")

    centers = model.clusterCenters()
    centroids = feats.sparkSession.createDataFrame(
        [(new, [float(x) for x in centers[old]]) for old, new in renumbered.items()],
        "segment_id int, centroid array<double>",
    )
    published = publish.publish_segmented(segments, verdict)
    described = publish.dim_segment(centroids, verdict, now=now)
    if target is not None:
        published = tables.write_table(published, f"{target}/dim_customer_segmented")
        described = tables.write_table(described, f"{target}/dim_segment")
    return Segmentation(k, neurons, assigned, segments, verdict, published, described)
