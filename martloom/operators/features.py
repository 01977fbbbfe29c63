"""Customer features for the segmentation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import whole_days
from martloom.functions.numbers import MONEY, exact_mean, exact_sum

CUSTOMER = "customer_unique_id"

# Names and order of the features.
FEATURES = (
    "Recency",
    "Frequency",
    "Monetary",
    "number_of_orders",
    "avg_order_value",
    "total_order_items",
    "total_payment_value",
    "avg_payment_installments",
    "avg_review_score",
    "num_reviews",
    "avg_product_category_value",
    "num_unique_products",
)


def _mean(total: str, n: str) -> Column:
    """Mean from summed partial sums and counts."""
    return F.sum(total) / F.nullif(F.sum(n), F.lit(0))


def order_customer_link(fact_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Distinct (order, person); the person is null for an order without a customer row."""
    people = dim_customer.select("customer_id", CUSTOMER)
    return fact_orders.join(people, "customer_id", "left").select("order_id", CUSTOMER).distinct()


def order_details(fact_orders: DataFrame, dim_customer: DataFrame, fact_sales: DataFrame) -> DataFrame:
    """Orders with their person and their items; orders without items stay."""
    people = dim_customer.select("customer_id", CUSTOMER)
    items = fact_sales.select("order_id", "product_id", "price", "order_item_id")
    return fact_orders.join(people, "customer_id", "left").join(items, "order_id", "left")


def reference_day(orders: DataFrame) -> Column:
    """One day after the last purchase, as a one-row subquery."""
    return orders.agg((F.max("order_purchase_date") + F.expr("INTERVAL 1 DAY")).alias("day")).scalar()


def rfm(details: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Recency in whole days, number of distinct orders, and money spent.

    The details hold every order, so the last purchase may be looked up in ``orders`` alone,
    which spares computing the details a second time.
    """
    per_person = (
        details.filter(F.col(CUSTOMER).isNotNull())
        .groupBy(CUSTOMER)
        .agg(
            F.max("order_purchase_date").alias("last_purchase"),
            F.count_distinct("order_id").alias("Frequency"),
            F.coalesce(exact_sum(F.col("price")), F.lit(0.0)).alias("Monetary"),
        )
    )
    recency = whole_days(F.col("last_purchase"), reference_day(details if orders is None else orders))
    return per_person.select(CUSTOMER, recency.alias("Recency"), "Frequency", "Monetary")


def order_features(details: DataFrame) -> DataFrame:
    return (
        details.filter(F.col(CUSTOMER).isNotNull())
        .groupBy(CUSTOMER)
        .agg(
            F.count_distinct("order_id").alias("number_of_orders"),
            exact_mean(F.col("price")).alias("avg_order_value"),
            F.count("order_item_id").alias("total_order_items"),
        )
    )


def _by_person(fact: DataFrame, link: DataFrame, *columns: str) -> DataFrame:
    """Rows of a fact with the known person behind their order."""
    known = link.filter(F.col(CUSTOMER).isNotNull())
    return fact.select("order_id", *columns).join(known, "order_id")


def payment_features(fact_payments: DataFrame, link: DataFrame) -> DataFrame:
    return _by_person(fact_payments, link, "payment_value", "payment_installments").groupBy(CUSTOMER).agg(
        F.coalesce(exact_sum(F.col("payment_value")), F.lit(0.0)).alias("total_payment_value"),
        F.avg("payment_installments").alias("avg_payment_installments"),
    )


def review_features(fact_reviews: DataFrame, link: DataFrame) -> DataFrame:
    return _by_person(fact_reviews, link, "review_id", "review_score").groupBy(CUSTOMER).agg(
        F.avg("review_score").alias("avg_review_score"),
        F.count("review_id").alias("num_reviews"),
    )


def product_features(fact_sales: DataFrame, dim_product: DataFrame, link: DataFrame) -> DataFrame:
    """Mean price, distinct products and the most frequent category (the first by name on a tie).

    Items are summed per (person, product) before the category is looked up, so a product that
    makes up much of all sales is one row per person in that join, and then per (person,
    category). Every step combines map-side; a person's items never sit in one task. Product ids
    are unique in ``dim_product``, as its data test asserts.
    """
    per_product = (
        _by_person(fact_sales, link, "product_id", "price")
        .groupBy(CUSTOMER, "product_id")
        .agg(
            F.sum(F.col("price").cast(MONEY)).alias("spent"),
            F.count("price").alias("n_prices"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )
    category = dim_product.select("product_id", "product_category_name")
    per_category = (
        per_product.join(category, "product_id", "left")
        .groupBy(CUSTOMER, "product_category_name")
        .agg(
            F.sum("spent").alias("spent"),
            F.sum("n_prices").alias("n_prices"),
            F.sum("n_rows").alias("n_rows"),
            F.count("product_id").alias("n_products"),
        )
    )
    # The smallest (-rows, name) is the most frequent category; rows without a category do not vote.
    vote = F.when(
        F.col("product_category_name").isNotNull(),
        F.struct((-F.col("n_rows")).alias("votes"), F.col("product_category_name").alias("name")),
    )
    return per_category.groupBy(CUSTOMER).agg(
        (F.sum("spent").cast("double") / F.nullif(F.sum("n_prices"), F.lit(0))).alias("avg_product_category_value"),
        F.sum("n_products").alias("num_unique_products"),
        F.min(vote)["name"].alias("most_frequent_category"),
    )


def customer_features(marts: Mapping[str, DataFrame], by_zip: bool = False) -> DataFrame:
    """Twelve features per person, 0 where there is nothing to measure.

    Gives what joining ``rfm`` ... ``product_features`` on the person gives, with fewer shuffles.
    Customers without a person have zeros, as nothing is theirs; an order counts once however often it is
    there. For the rest it relies on what the data tests assert: customer and product ids in their dimensions, and every fact carries its order's customer id. So each
    fact is first summed per customer id (map-side, which also flattens hot customers), these
    sums share the partitioning of ``dim_customer``, and one more shuffle brings them to the
    person. Only the distinct products need the items themselves.

    ``by_zip`` gives one row per distinct (person, zip) instead; the zip is not in the result.
    """
    customers, orders = marts["dim_customer"], marts["fact_orders"]
    people = customers.select("customer_id", CUSTOMER)

    ordered = orders.groupBy("customer_id").agg(
        F.max("order_purchase_date").alias("last_purchase"), F.count_distinct("order_id").alias("n_orders")
    )
    paid = marts["fact_payments"].groupBy("customer_id").agg(
        F.sum(F.col("payment_value").cast(MONEY)).alias("paid"),
        F.sum("payment_installments").alias("installments"),
        F.count("payment_installments").alias("n_installments"),
    )
    reviewed = marts["fact_reviews"].groupBy("customer_id").agg(
        F.sum("review_score").alias("scores"),
        F.count("review_score").alias("n_scores"),
        F.count("review_id").alias("n_reviews"),
    )
    active = people
    for part in (ordered, paid, reviewed):
        active = active.join(part, "customer_id", "left")
    activity = active.groupBy(CUSTOMER).agg(
        F.max("last_purchase").alias("last_purchase"),
        F.sum("n_orders").alias("number_of_orders"),
        F.sum("paid").cast("double").alias("total_payment_value"),
        _mean("installments", "n_installments").alias("avg_payment_installments"),
        _mean("scores", "n_scores").alias("avg_review_score"),
        F.sum("n_reviews").alias("num_reviews"),
    )
    bought = (
        marts["fact_sales"]
        .select("customer_id", "product_id", "price", "order_item_id")
        .join(people, "customer_id")
        .groupBy(CUSTOMER)
        .agg(
            exact_sum(F.col("price")).alias("Monetary"),
            exact_mean(F.col("price")).alias("avg_order_value"),
            F.count("order_item_id").alias("total_order_items"),
            F.count_distinct("product_id").alias("num_unique_products"),
        )
    )
    # Persons without an order have no recency, whatever the reference day is.
    recency = whole_days(F.col("last_purchase"), reference_day(orders))
    measured = activity.join(bought, CUSTOMER, "left").select(
        CUSTOMER,
        recency.alias("Recency"),
        F.col("number_of_orders").alias("Frequency"),
        "Monetary",
        "number_of_orders",
        "avg_order_value",
        "total_order_items",
        "total_payment_value",
        "avg_payment_installments",
        "avg_review_score",
        "num_reviews",
        F.col("avg_order_value").alias("avg_product_category_value"),
        "num_unique_products",
    )
    filled = measured.selectExpr(
        CUSTOMER, *[f"CASE WHEN {CUSTOMER} IS NULL THEN 0D ELSE coalesce(CAST({f} AS DOUBLE), 0D) END AS {f}" for f in FEATURES]
    )
    if by_zip:
        places = customers.select(CUSTOMER, "zip_code_prefix").distinct()
        # The zip codes of the person that is missing are rows too.
        filled = filled.withColumnRenamed(CUSTOMER, "_person")
        return places.join(filled, F.col(CUSTOMER).eqNullSafe(F.col("_person"))).drop("zip_code_prefix", "_person")
    return filled


_MOMENTS = (("mean", "avg"), ("std", "stddev_pop"))


def standard_scale(
    df: DataFrame, cols: Sequence[str], id_col: str, as_float32: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(x - mean) / population deviation per column; a constant column is only centred.

    The statistics are one row, used as a subquery, so the data is not shuffled.
    """
    stats = df.agg(*[F.expr(f"{f}(`{c}`) AS `{name}_{c}`") for c in cols for name, f in _MOMENTS])
    kind = "float" if as_float32 else "double"
    scaled = [
        f"CAST((`{c}` - _s.`mean_{c}`) / CASE WHEN _s.`std_{c}` = 0 THEN 1 ELSE _s.`std_{c}` END AS {kind}) AS `{c}`"
        for c in cols
    ]
    with_stats = df.withColumn("_s", stats.select(F.struct("*").alias("s")).scalar())
    return with_stats.selectExpr(f"`{id_col}`", *scaled), stats
