"""Raw commerce tables derived from the given TPC-H-like tables.

One SQL text per raw table, rendered for Spark or for DuckDB. Only functions that are spelled
differently go through :class:`Dialect`; the rest is the same text for both engines.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from martloom.plans.suite import STATES


@dataclass(frozen=True)
class Dialect:
    """How one engine spells zone-less timestamps and their text form."""

    timestamp: str
    format_call: str

    def text_of(self, expr: str) -> str:
        return self.format_call.format(expr)


SPARK = Dialect("TIMESTAMP_NTZ", "date_format({}, 'yyyy-MM-dd HH:mm:ss')")
DUCKDB = Dialect("TIMESTAMP", "strftime({}, '%Y-%m-%d %H:%M:%S')")


def city(k: str) -> str:
    return (
        f"CASE {k} % 5 WHEN 0 THEN 'São   Paulo' WHEN 1 THEN ' Niterói ' WHEN 2 THEN 'Embu-Guaçu' "
        f"WHEN 3 THEN 'BRASÍLIA' ELSE 'Cidade ' || CAST({k} AS STRING) END"
    )


def state(k: str) -> str:
    return f"substr('{''.join(STATES)}', CAST({k} AS INT) * 2 + 1, 2)"


def raw_sql(d: Dialect) -> dict[str, str]:
    """SQL of each raw table. Tables stand in braces."""
    loaded = f"{d.timestamp} '2018-10-20 00:00:00'"
    later = f"{d.timestamp} '2018-10-21 00:00:00'"
    day = f"CAST(o_orderdate AS {d.timestamp})"
    bought = f"({day} + INTERVAL '1' MINUTE * (o_orderkey % 1440))"
    status = (
        "CASE WHEN o_orderkey % 8 IN (0,1,2) THEN 'delivered' WHEN o_orderkey % 8 = 3 THEN 'shipped' "
        "WHEN o_orderkey % 8 = 4 THEN 'invoiced' WHEN o_orderkey % 8 = 5 THEN 'canceled' "
        "WHEN o_orderkey % 8 = 6 THEN 'processing' ELSE 'unavailable' END"
    )
    created = f"{day} + INTERVAL '1' DAY * 15"
    approved = d.text_of(f"{bought} + INTERVAL '1' MINUTE * (o_orderkey % 97)")
    return {
        "raw_customers": f"""
            SELECT CAST(c_custkey AS STRING) AS customer_id,
                   CAST(CAST(floor(c_custkey / 3) AS BIGINT) AS STRING) AS customer_unique_id,
                   1000 + c_nationkey * 37 AS customer_zip_code_prefix,
                   {city("c_nationkey")} AS customer_city,
                   CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE {state("c_nationkey")} END AS customer_state,
                   {loaded} AS load_timestamp
            FROM {{customer}}""",
        "raw_sellers": f"""
            SELECT CAST(s_suppkey AS STRING) AS seller_id, 1000 + s_nationkey * 37 AS seller_zip_code_prefix,
                   {city("s_nationkey")} AS seller_city, {state("s_nationkey")} AS seller_state,
                   {loaded} AS load_timestamp
            FROM {{supplier}}""",
        "raw_geolocation": f"""
            SELECT CASE WHEN c_custkey % 211 = 0 THEN NULL ELSE 1000 + c_nationkey * 37 END
                       AS geolocation_zip_code_prefix,
                   CASE WHEN c_custkey % 101 = 0 THEN 'n/a'
                        ELSE CAST(CAST(-23 - (c_custkey % 64) / 64.0 AS DOUBLE) AS STRING) END AS geolocation_lat,
                   CAST(CAST(-46 - (c_custkey % 32) / 32.0 AS DOUBLE) AS STRING) AS geolocation_lng,
                   {city("c_nationkey")} AS geolocation_city,
                   lower({state("c_nationkey")}) || ' ' AS geolocation_state,
                   {loaded} AS load_timestamp
            FROM {{customer}}""",
        "raw_products": f"""
            SELECT CAST(p_partkey AS STRING) AS product_id,
                   CASE WHEN p_partkey % 41 = 0 THEN 'NULL' WHEN p_partkey % 43 = 0 THEN 'sem_traducao'
                        ELSE 'cat_' || lower(p_type) END AS product_category_name,
                   CAST(1 + p_partkey % 6 AS INT) AS product_photos_qty,
                   CAST(p_size * 25 - 20 AS DOUBLE) AS product_weight_g,
                   CAST(p_size + 3 AS DOUBLE) AS product_length_cm, CAST(p_size AS DOUBLE) AS product_height_cm,
                   CAST(p_size + 5 AS DOUBLE) AS product_width_cm, {loaded} AS load_timestamp
            FROM {{part}}""",
        "raw_translation": """
            SELECT DISTINCT 'cat_' || lower(p_type) AS product_category_name,
                   lower(p_type) || '_goods' AS product_category_name_english
            FROM {part}""",
        "raw_orders": f"""
            SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS customer_id,
                   {status} AS order_status, {bought} AS order_purchase_timestamp,
                   CASE WHEN o_orderkey % 50 = 0 THEN 'NULL' ELSE {approved} END AS order_approved_at,
                   CASE WHEN {status} IN ('delivered', 'shipped')
                        THEN {bought} + INTERVAL '1' HOUR * (o_orderkey % 72) END AS order_delivered_carrier_date,
                   CASE WHEN {status} = 'delivered'
                        THEN {bought} + INTERVAL '1' HOUR * (24 + o_orderkey % 700) END
                        AS order_delivered_customer_date,
                   {day} + INTERVAL '1' DAY * (10 + o_orderkey % 20) AS order_estimated_delivery_date,
                   {loaded} AS load_timestamp
            FROM {{orders}}""",
        "raw_order_items": f"""
            SELECT CAST(l_orderkey AS STRING) AS order_id, l_linenumber AS order_item_id,
                   CAST(l_partkey AS STRING) AS product_id, CAST(l_suppkey AS STRING) AS seller_id,
                   CAST(l_shipdate AS {d.timestamp}) AS shipping_limit_date, l_extendedprice AS price,
                   l_quantity AS freight_value, {loaded} AS load_timestamp
            FROM {{lineitem}}""",
        "raw_order_payments": f"""
            SELECT CAST(o_orderkey AS STRING) AS order_id, 1 AS payment_sequential,
                   CASE o_orderkey % 5 WHEN 0 THEN 'boleto' WHEN 1 THEN 'voucher' WHEN 2 THEN 'debit_card'
                        ELSE 'credit_card' END AS payment_type,
                   CAST(o_orderkey % 13 AS INT) AS payment_installments, o_totalprice AS payment_value,
                   {loaded} AS load_timestamp
            FROM {{orders}}
            UNION ALL
            SELECT CAST(o_orderkey AS STRING), 2, 'voucher', 1, CAST(o_orderkey % 40 AS DOUBLE), {loaded}
            FROM {{orders}} WHERE o_orderkey % 10 = 0""",
        "raw_order_reviews": f"""
            SELECT CAST(CAST(floor(o_orderkey / 2) AS BIGINT) AS STRING) AS review_id,
                   CAST(o_orderkey AS STRING) AS order_id, CAST(1 + o_orderkey % 5 AS INT) AS review_score,
                   CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'NULL'
                        ELSE 'Ótimo produto ' || CAST(o_orderkey AS STRING) END AS review_comment_message,
                   {created} AS review_creation_date,
                   CASE WHEN o_orderkey % 11 = 0 THEN NULL
                        ELSE {created} + INTERVAL '1' MINUTE * (o_orderkey % 9973) END AS review_answer_timestamp,
                   {loaded} AS load_timestamp
            FROM {{orders}} WHERE o_orderkey % 3 <> 0""",
        # A second load: every tenth row changes a day later, the first keys are gone, one is new.
        "raw_customers_2": f"""
            SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
                   CASE WHEN CAST(customer_id AS BIGINT) % 10 = 0 THEN 'Nova Cidade' ELSE customer_city END
                       AS customer_city, customer_state,
                   CASE WHEN CAST(customer_id AS BIGINT) % 10 = 0 THEN {later} ELSE load_timestamp END
                       AS load_timestamp
            FROM {{raw_customers}} WHERE CAST(customer_id AS BIGINT) >= 5
            UNION ALL
            SELECT CAST(max(CAST(customer_id AS BIGINT)) + 1 AS STRING), 'new', 1000, 'Recife', 'PE', {later}
            FROM {{raw_customers}}""",
        "raw_sellers_2": f"""
            SELECT seller_id, seller_zip_code_prefix,
                   CASE WHEN CAST(seller_id AS BIGINT) % 10 = 0 THEN 'Nova Cidade' ELSE seller_city END
                       AS seller_city, seller_state,
                   CASE WHEN CAST(seller_id AS BIGINT) % 10 = 0 THEN {later} ELSE load_timestamp END
                       AS load_timestamp
            FROM {{raw_sellers}} WHERE CAST(seller_id AS BIGINT) >= 5
            UNION ALL
            SELECT CAST(max(CAST(seller_id AS BIGINT)) + 1 AS STRING), 1000, 'Recife', 'PE', {later}
            FROM {{raw_sellers}}""",
        "raw_products_2": f"""
            SELECT product_id,
                   CASE WHEN CAST(product_id AS BIGINT) % 10 = 0 THEN 'nova_categoria'
                        ELSE product_category_name END AS product_category_name,
                   product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm,
                   CASE WHEN CAST(product_id AS BIGINT) % 10 = 0 THEN {later} ELSE load_timestamp END
                       AS load_timestamp
            FROM {{raw_products}} WHERE CAST(product_id AS BIGINT) >= 5
            UNION ALL
            SELECT CAST(max(CAST(product_id AS BIGINT)) + 1 AS STRING), 'sem_traducao', 1,
                   CAST(100 AS DOUBLE), CAST(20 AS DOUBLE), CAST(20 AS DOUBLE), CAST(20 AS DOUBLE), {later}
            FROM {{raw_products}}""",
        # The first place vanishes, the last one moves, one is new; reloaded a day later.
        "stg_geolocation_2": f"""
            SELECT zip_code_prefix,
                   CASE WHEN geo_key = (SELECT max(geo_key) FROM {{stg_geolocation}}) THEN latitude + 1
                        ELSE latitude END AS latitude,
                   longitude, city, state, {later} AS load_timestamp, is_imputed, was_merged, source_points, geo_key
            FROM {{stg_geolocation}}
            WHERE geo_key <> (SELECT min(geo_key) FROM {{stg_geolocation}})
            UNION ALL
            SELECT '99999', CAST(-8 AS DOUBLE), CAST(-35 AS DOUBLE), 'Recife', 'PE', {later}, FALSE, FALSE,
                   CAST(1 AS BIGINT), '99999|Recife|PE'""",
    }


RAW_TABLES = (
    "customers", "sellers", "geolocation", "products", "translation", "orders", "order_items", "order_payments",
    "order_reviews",
)


def derive(spark: SparkSession, name: str, table: Callable[[str], DataFrame]) -> DataFrame:
    """One derived table; ``table`` gives the tables its SQL names."""
    sql = raw_sql(SPARK)[name]
    return spark.sql(sql, **{t: table(t) for t in set(re.findall(r"[{](\w+)[}]", sql))})


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All first-load raw tables of one scale."""

    def given(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    return {name: derive(spark, f"raw_{name}", given) for name in RAW_TABLES}
