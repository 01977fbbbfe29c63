"""Fact tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.dates import date_id, whole_hours
from martloom.functions.numbers import rate

# States in which revenue counts, and the review scores that are good and bad.
DELIVERED = "delivered"
RECOGNIZED = ("delivered", "invoiced")
POSITIVE_FROM, NEGATIVE_TO = 4, 2


def _flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def fact_orders(stg_orders: DataFrame) -> DataFrame:
    renamed = {
        "order_purchase_timestamp": "order_purchase_date",
        "order_approved_at": "order_approved_date",
        "order_delivered_carrier_date": "order_delivered_carrier_date",
        "order_delivered_customer_date": "order_delivered_customer_date",
        "order_estimated_delivery_date": "order_estimated_delivery_date",
    }
    return stg_orders.select(
        "order_id",
        "customer_id",
        "order_status",
        *[F.col(old).alias(new) for old, new in renamed.items()],
        *[date_id(F.col(old)).alias(f"{new}_id") for old, new in renamed.items()],
        "load_timestamp",
    )


def fact_sales(stg_orders: DataFrame, stg_items: DataFrame) -> DataFrame:
    """One row per item sold, with the order's state and dates."""
    orders = stg_orders.select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "load_timestamp"
    )
    items = stg_items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")
    total = F.col("price") + F.col("freight_value")
    bought = F.col("order_purchase_timestamp")
    return items.join(orders, "order_id").select(
        "order_id",
        "order_item_id",
        F.to_date(bought).alias("order_purchase_date"),
        date_id(bought).alias("order_purchase_date_id"),
        "customer_id",
        "seller_id",
        "product_id",
        "order_status",
        "price",
        "freight_value",
        total.alias("total_item_value"),
        F.lit(1).alias("order_count"),
        _flag(F.col("order_status") == DELIVERED).alias("delivered_flag"),
        F.when(F.col("order_status").isin(*RECOGNIZED), total).otherwise(0.0).alias("recognized_revenue"),
        "load_timestamp",
    )


def fact_payments(stg_payments: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """Payments of approved orders, dated by the approval."""
    approved = stg_orders.filter(F.col("order_approved_at").isNotNull()).select(
        "order_id", "customer_id", date_id(F.col("order_approved_at")).alias("payment_date_id")
    )
    return stg_payments.join(approved, "order_id").select(
        "order_id",
        "customer_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
        _flag(F.col("payment_installments") > 1).alias("is_installment"),
        rate(F.col("payment_value"), F.col("payment_installments")).alias("installment_value"),
        _flag(F.col("payment_type") == "credit_card").alias("payment_type_flag_credit"),
        "load_timestamp",
        "payment_date_id",
    )


def fact_fulfillment(stg_orders: DataFrame, stg_items: DataFrame) -> DataFrame:
    """Delivery times and delays in calendar days per item; unknown where a date is missing."""
    orders = stg_orders.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_approved_at",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        "load_timestamp",
    )
    items = stg_items.select("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date")
    delivered, estimated, approved = (
        F.to_date(c)
        for c in ("order_delivered_customer_date", "order_estimated_delivery_date", "order_approved_at")
    )
    delay = F.datediff(delivered, estimated)
    return items.join(orders, "order_id").select(
        "order_id",
        "order_item_id",
        "customer_id",
        "product_id",
        "seller_id",
        "order_status",
        "order_approved_at",
        "shipping_limit_date",
        date_id(F.col("shipping_limit_date")).alias("shipping_limit_date_id"),
        F.datediff(delivered, approved).alias("actual_delivery_days"),
        F.datediff(estimated, approved).alias("estimated_delivery_days"),
        delay.alias("delivery_delay"),
        _flag(delay > 0).alias("delivery_late_flag"),
        "load_timestamp",
    )


def dedup_latest_review(
    df: DataFrame,
    key: str = "review_id",
    order_cols: Sequence[str] = ("review_creation_date", "review_answer_timestamp"),
    tie_cols: Sequence[str] | None = None,
) -> DataFrame:
    """The latest row of each key. The remaining columns break ties, so a rerun picks the same row.

    The rank filter is pushed below the shuffle, so each task sends at most one row per key.
    """
    if tie_cols is None:
        rest = [c for c in df.columns if c != key and c not in order_cols]
        tie_cols = sorted(rest, key=lambda c: c != "order_id")
    latest = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order_cols], *[F.asc(c) for c in tie_cols])
    return df.withColumn("_rank", F.row_number().over(latest)).filter("_rank = 1").drop("_rank")


def fact_reviews(stg_reviews: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """One row per review with its length, dates, response time and the order's customer."""
    comment = F.coalesce("review_comment_message", F.lit(""))
    created, answered = F.col("review_creation_date"), F.col("review_answer_timestamp")
    reviews = dedup_latest_review(stg_reviews).select(
        "review_id",
        "order_id",
        "review_score",
        comment.alias("review_comment_message"),
        F.length(comment).alias("review_length"),
        _flag(comment != "").alias("has_comment"),
        created.alias("review_creation_date"),
        date_id(created).alias("review_creation_date_id"),
        answered.alias("review_answer_date"),
        date_id(answered).alias("review_answer_date_id"),
        whole_hours(created, answered).alias("response_time_hours"),
        _flag(F.col("review_score") >= POSITIVE_FROM).alias("is_positive_review"),
        _flag(F.col("review_score") <= NEGATIVE_TO).alias("is_negative_review"),
        "load_timestamp",
    )
    columns = reviews.columns
    return reviews.join(stg_orders.select("order_id", "customer_id"), "order_id", "left").select(
        *columns, "customer_id"
    )
