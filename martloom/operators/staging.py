"""Staging models: one lazily composed frame per raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions import dates, text

# Format of the approval text and the word that stands for null in it.
APPROVAL_FORMAT = "yyyy-MM-dd HH:mm:ss"
NULL_WORD = "NULL"


def _located(raw: DataFrame, kind: str, ids: list[str]) -> DataFrame:
    """Ids, cleaned place, and the key of the place, for customers and sellers alike."""
    zip_code = text.zip5(F.col(f"{kind}_zip_code_prefix"))
    city = text.normalize_city(F.col(f"{kind}_city"))
    placed = raw.select(
        *ids,
        zip_code.alias("zip_code_prefix"),
        city.alias("city"),
        F.col(f"{kind}_state").alias("state"),
        "load_timestamp",
    )
    return placed.withColumn(
        "location_key", text.location_key(F.col("zip_code_prefix"), F.col("city"), F.col("state"))
    )


def stg_customers(raw: DataFrame) -> DataFrame:
    return _located(raw, "customer", ["customer_id", "customer_unique_id"])


def stg_sellers(raw: DataFrame) -> DataFrame:
    return _located(raw, "seller", ["seller_id"])


def stg_geolocation(raw: DataFrame) -> DataFrame:
    """One centroid per (zip, city, state); points without a zip are left out."""
    points = raw.filter(F.col("geolocation_zip_code_prefix").isNotNull()).select(
        text.zip5(F.col("geolocation_zip_code_prefix")).alias("zip_code_prefix"),
        text.title_case(text.trim_space(F.col("geolocation_city"))).alias("city"),
        F.upper(text.trim_space(F.col("geolocation_state"))).alias("state"),
        F.col("geolocation_lat").try_cast("double").alias("latitude"),
        F.col("geolocation_lng").try_cast("double").alias("longitude"),
        "load_timestamp",
    )
    centroids = points.groupBy("zip_code_prefix", "city", "state").agg(
        F.round(F.avg("latitude"), 6).alias("latitude"),
        F.round(F.avg("longitude"), 6).alias("longitude"),
        F.max("load_timestamp").alias("load_timestamp"),
        F.count(F.lit(1)).alias("source_points"),
    )
    return centroids.select(
        "zip_code_prefix",
        "latitude",
        "longitude",
        "city",
        "state",
        "load_timestamp",
        F.lit(False).alias("is_imputed"),
        (F.col("source_points") > 1).alias("was_merged"),
        "source_points",
        F.concat("zip_code_prefix", F.lit("|"), "city", F.lit("|"), "state").alias("geo_key"),
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    """Orders with the approval text parsed back; a malformed approval time is an error."""
    approved = F.col("order_approved_at")
    if isinstance(raw.schema["order_approved_at"].dataType, T.StringType):
        kind = dates.timestamp_kind(raw)
        approved = F.when(
            approved != NULL_WORD, dates.parse_like(F.nullif(approved, F.lit(NULL_WORD)), APPROVAL_FORMAT, kind)
        )
    return raw.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        approved.alias("order_approved_at"),
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        "load_timestamp",
    )


def stg_products(raw: DataFrame, translations: DataFrame) -> DataFrame:
    """Products plus the English category, which falls back to the source name.

    The translation table is left to the optimizer: it is sent to all executors only while its
    measured size stays below the session's broadcast limit.
    """
    english = translations.select("product_category_name", "product_category_name_english")
    return raw.join(english, "product_category_name", "left").select(
        *[F.col(c) for c in raw.columns],
        F.coalesce("product_category_name_english", "product_category_name").alias("product_category_english"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select("*")


def stg_order_payments(raw: DataFrame) -> DataFrame:
    return raw.select("*")


def stg_order_reviews(raw: DataFrame) -> DataFrame:
    return raw.select("*")
