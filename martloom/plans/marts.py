"""From raw tables to staging, history and marts, lazily."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession

from martloom.operators import dims, facts, scd2, staging

# Key and change columns of the history tables.
HISTORY_KEYS = {"customers": "customer_id", "products": "product_id", "sellers": "seller_id"}
UPDATED_AT = "load_timestamp"
PLACE_KEY = "geo_key"
PLACE_CHECKS = ("latitude", "longitude", "city", "state")
PLACE_COLUMNS = (
    "zip_code_prefix", "latitude", "longitude", "city", "state", "load_timestamp", "is_imputed", "geo_key",
)


def build_staging(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "customers": staging.stg_customers(raw["customers"]),
        "sellers": staging.stg_sellers(raw["sellers"]),
        "geolocation": staging.stg_geolocation(raw["geolocation"]),
        "products": staging.stg_products(raw["products"], raw["translation"]),
        "orders": staging.stg_orders(raw["orders"]),
        "order_items": staging.stg_order_items(raw["order_items"]),
        "order_payments": staging.stg_order_payments(raw["order_payments"]),
        "order_reviews": staging.stg_order_reviews(raw["order_reviews"]),
    }


def build_changes(
    stg: Mapping[str, DataFrame], as_of: Column, open_rows: Mapping[str, DataFrame | None]
) -> dict[str, DataFrame]:
    """What the staged rows change in each history, given its open versions (None or absent: first load)."""
    changes = {
        name: scd2.changes_timestamp(open_rows.get(name), stg[name], key, UPDATED_AT)
        for name, key in HISTORY_KEYS.items()
    }
    places = stg["geolocation"].select(*PLACE_COLUMNS)
    changes["geolocation"] = scd2.changes_check(
        open_rows.get("geolocation"), places, PLACE_KEY, PLACE_CHECKS, as_of
    )
    return changes


def build_dims(
    spark: SparkSession,
    snapshots: Mapping[str, DataFrame],
    start: date | Column = dims.FIRST_DAY,
    end: date | Column | None = None,
    easter_method: str = "reference",
) -> dict[str, DataFrame]:
    return {
        "dim_customer": dims.dim_customer(snapshots["customers"]),
        "dim_product": dims.dim_product(snapshots["products"]),
        "dim_seller": dims.dim_seller(snapshots["sellers"]),
        "dim_geolocation": dims.dim_geolocation(snapshots["geolocation"]),
        "dim_date": dims.dim_date(spark, start, end, easter_method),
    }


def build_facts(stg: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "fact_orders": facts.fact_orders(stg["orders"]),
        "fact_sales": facts.fact_sales(stg["orders"], stg["order_items"]),
        "fact_payments": facts.fact_payments(stg["order_payments"], stg["orders"]),
        "fact_fulfillment": facts.fact_fulfillment(stg["orders"], stg["order_items"]),
        "fact_reviews": facts.fact_reviews(stg["order_reviews"], stg["orders"]),
    }
