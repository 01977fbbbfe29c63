"""Model gate and the tables it lets through."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits of the gate, its messages, and the segment names by id.
LIMITS = {
    "silhouette": 0.6,
    "davies_bouldin": 0.75,
    "quantization_error": 0.26,
    "topographic_error": 0.26,
}
MESSAGES = {
    "silhouette": "Silhouette Score (%.4f) below threshold ({limit}).",
    "davies_bouldin": "Davies-Bouldin Index (%.4f) above threshold ({limit}).",
    "quantization_error": "Quantization Error (%.4f) above threshold ({limit}).",
    "topographic_error": "Topographic Error (%.4f) above threshold ({limit}).",
}
NO_REASON = "None"
SEGMENT_NAMES = {
    0: "The Vast Unengaged / Lapsed Base",
    1: "The Engaged & Growing Buyers",
    2: "The Recent, Highly Satisfied Explorers",
}
UNNAMED = "Segment %d (Unknown Name)"
DESCRIPTION = "Description for Segment %d based on centroid: [%s]"


def validate_model(metrics: DataFrame, limits: Mapping[str, float] = LIMITS) -> DataFrame:
    """The verdict on one row of metrics: accepted or not, and every reason against it."""

    def reason(metric: str) -> Column:
        value = F.col(metric)
        beyond = value < limits[metric] if metric == "silhouette" else value > limits[metric]
        return F.when(beyond, F.format_string(MESSAGES[metric].format(limit=limits[metric]), value))

    reasons = F.concat_ws(", ", *[reason(metric) for metric in LIMITS])
    judged = metrics.select(*LIMITS, reasons.alias("found"))
    return judged.select(
        (F.col("found") == "").alias("accepted"),
        F.when(F.col("found") == "", NO_REASON).otherwise(F.col("found")).alias("reasons"),
        *LIMITS,
    )


def _accepted(verdict: DataFrame) -> Column:
    return verdict.select("accepted").scalar()


def publish_segmented(segments: DataFrame, verdict: DataFrame) -> DataFrame:
    """All segments if the model was accepted, else none, in the same schema either way."""
    return segments.filter(_accepted(verdict))


def name_of(segment: Column, names: Mapping[int, str]) -> Column:
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(known, segment), F.format_string(UNNAMED, segment))


def dim_segment(
    centroids: DataFrame,
    verdict: DataFrame,
    names: Mapping[int, str] = SEGMENT_NAMES,
    now: datetime | None = None,
) -> DataFrame:
    """Name and description per segment of an accepted model. ``centroids`` is ``(segment_id, centroid)``."""
    segment = F.col("segment_id").cast("int")
    rounded = F.transform("centroid", lambda x: F.round(x, 2).cast("string"))
    moment = F.current_timestamp() if now is None else F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    return centroids.filter(_accepted(verdict)).select(
        segment.alias("segment_id"),
        name_of(segment, names).alias("segment_name"),
        F.format_string(DESCRIPTION, segment, F.array_join(rounded, ", ")).alias("segment_description"),
        moment.alias("created_at"),
    )


def segment_profile(
    segmented: DataFrame, cols: Sequence[str], names: Mapping[int, str] | None = None
) -> DataFrame:
    """Mean of each feature per segment, with the segment's name if names are given."""
    profile = segmented.groupBy("segment_id").agg(*[F.avg(c).alias(c) for c in cols])
    if names is None:
        return profile
    return profile.withColumn("segment_name", name_of(F.col("segment_id"), names))


def segment_distribution(segmented: DataFrame) -> DataFrame:
    """Rows per segment, in order of the segment."""
    return segmented.groupBy("segment_id").agg(F.count(F.lit(1)).alias("n_customers")).orderBy("segment_id")
