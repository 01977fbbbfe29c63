"""One key holds a third of the rows: results stay whole and equal to SQL."""

from __future__ import annotations

import pytest
from compare import difference, duck
from pyspark.sql import functions as F

from martloom.plans.catalog import Lake

NAMES = (
    "fact_sales", "fact_payments", "fact_fulfillment", "fact_reviews", "dedup_latest_review", "product_features",
    "customer_features", "run_tests", "test_relationships", "stg_geolocation", "stg_products", "rfm",
)


@pytest.fixture(scope="module")
def skewed(spark, sf_dir, tmp_path_factory):
    """The given tables with every third order and item moved to one customer, order, product and seller."""
    out = tmp_path_factory.mktemp("skewed")
    hot = {
        "orders": ("o_orderkey", ["o_custkey"]),
        "lineitem": ("l_partkey", ["l_orderkey", "l_partkey", "l_suppkey"]),
        "customer": ("c_custkey", ["c_nationkey"]),
    }
    for name in ("customer", "supplier", "part", "orders", "lineitem", "documents"):
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if name in hot:
            by, cols = hot[name]
            third = F.col(by) % 3 == 0
            for c in cols:
                df = df.withColumn(c, F.when(third, F.lit(7).cast(df.schema[c].dataType)).otherwise(F.col(c)))
        df.repartition(6).write.parquet(f"{out}/{name}.parquet")
    return str(out)


@pytest.fixture
def eager_skew_handling(spark):
    """Sort-merge joins only, and partitions of a few kilobytes count as skewed."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys(spark, skewed, eager_skew_handling, name):
    assert difference(spark, duck(skewed), name, skewed) is None


def test_hot_order_is_split_in_the_join(spark, skewed, eager_skew_handling):
    sales = Lake(spark, skewed).facts["fact_sales"]
    sales.collect()
    assert "skew=true" in sales._jdf.queryExecution().executedPlan().toString()
