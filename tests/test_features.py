from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from martloom.operators import features as f
from martloom.plans.catalog import Lake


@pytest.fixture(scope="module")
def lake(spark, sf_dir):
    return Lake(spark, sf_dir)


def test_fast_form_equals_the_joined_parts(lake):
    m = lake.marts
    joined = m["dim_customer"].select(f.CUSTOMER).distinct()
    parts = (
        f.rfm(lake.details), f.order_features(lake.details), f.payment_features(m["fact_payments"], lake.link),
        f.review_features(m["fact_reviews"], lake.link),
        f.product_features(m["fact_sales"], m["dim_product"], lake.link).drop("most_frequent_category"),
    )
    for part in parts:
        joined = joined.join(part, f.CUSTOMER, "left")
    slow = {r[f.CUSTOMER]: r for r in joined.fillna(0).collect()}
    fast = {r[f.CUSTOMER]: r for r in f.customer_features(m).collect()}
    assert fast.keys() == slow.keys()
    for person, row in fast.items():
        assert all(math.isclose(row[c], slow[person][c], rel_tol=1e-12) for c in f.FEATURES), person


def test_features_by_zip_repeat_a_person_with_two_places(lake):
    places = lake.marts["dim_customer"].select(f.CUSTOMER, "zip_code_prefix").distinct().count()
    rows = f.customer_features(lake.marts, by_zip=True)
    assert rows.columns == [f.CUSTOMER, *f.FEATURES] and rows.count() == places


def test_most_frequent_category_takes_the_first_name_on_a_tie(spark):
    sales = spark.createDataFrame(
        [("o1", "p1", 1.0), ("o1", "p2", 2.0), ("o2", "p3", 3.0), ("o2", "p9", None)], "order_id string, product_id string, price double"
    )
    products = spark.createDataFrame([("p1", "b"), ("p2", "a"), ("p3", None)], "product_id string, product_category_name string")
    link = spark.createDataFrame([("o1", "u"), ("o2", "v"), ("o3", None)], "order_id string, customer_unique_id string")
    got = {r[0]: tuple(r)[1:] for r in f.product_features(sales, products, link).collect()}
    assert got == {"u": (1.5, 2, "a"), "v": (3.0, 2, None)}


def test_recency_counts_whole_days(spark):
    rows = [("u", "1", "2018-01-01 23:00:00", 1.0), ("v", "2", "2018-01-03 01:00:00", None), (None, "3", "2018-01-05 00:00:00", 9.0)]
    details = spark.createDataFrame(rows, "customer_unique_id string, order_id string, t string, price double")
    details = details.withColumn("order_purchase_date", F.col("t").cast("timestamp_ntz"))
    got = {r[0]: tuple(r)[1:] for r in f.rfm(details).collect()}
    assert got == {"u": (4, 1, 1.0), "v": (2, 1, 0.0)}


def test_scaler_on_a_constant_column(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, 5.0)], "id string, x double, y double")
    scaled, stats = f.standard_scale(df, ["x", "y"], "id")
    assert [tuple(r) for r in scaled.orderBy("id").collect()] == [("a", -1.0, 0.0), ("b", 1.0, 0.0)]
    assert scaled.schema["x"].dataType.simpleString() == "float"
    assert stats.first()["std_x"] == 1.0
