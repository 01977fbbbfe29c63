"""DuckDB SQL for the registered queries, written independently of the Spark operators.

Every shared piece is a named query in ``PIECES``; :func:`with_pieces` puts the ones a statement
needs in front of it.
"""

from __future__ import annotations

import re

from martloom.functions.text import ACCENTED, PLAIN
from martloom.operators.features import FEATURES
from martloom.operators.quality import DataTest
from martloom.plans.fixtures import DUCKDB, raw_sql
from martloom.plans.suite import mart_tests

DELIMITERS = r"""\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-"""


def r6(expr: str) -> str:
    return f"round({expr}, 6) + 0.0"


def money_sum(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(18,6))) AS DOUBLE)"


def money_mean(c: str) -> str:
    return f"{money_sum(c)} / nullif(count({c}), 0)"


def date_id(c: str) -> str:
    return f"CAST(strftime({c}, '%Y%m%d') AS BIGINT)"


def flag(condition: str) -> str:
    return f"CAST(CASE WHEN {condition} THEN 1 ELSE 0 END AS INTEGER)"


def normal_city(c: str) -> str:
    return rf"lower(trim(regexp_replace(translate({c}, '{ACCENTED}', '{PLAIN}'), '\s+', ' ', 'g')))"


def title_case(c: str) -> str:
    words = f"regexp_extract_all({c}, '[^{DELIMITERS}]+|[{DELIMITERS}]+')"
    return f"array_to_string(list_transform({words}, lambda x: upper(x[1]) || lower(x[2:])), '')"


def _place(kind: str, ids: str) -> str:
    zip5, city = f"lpad(CAST({kind}_zip_code_prefix AS VARCHAR), 5, '0')", normal_city(f"{kind}_city")
    return f"""
        SELECT {ids}, {zip5} AS zip_code_prefix, {city} AS city, {kind}_state AS state, load_timestamp,
               coalesce({zip5} || '||' || {city} || '||' || {kind}_state, '00000||unknown||XX') AS location_key"""


def _first(stg: str, key: str, moment: str) -> str:
    return f"""
        SELECT *, md5({key} || '|' || CAST({moment} AS VARCHAR)) AS dbt_scd_id, {moment} AS dbt_updated_at,
               {moment} AS dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to FROM {stg}"""


def _second(first: str, stg_2: str, key: str) -> str:
    """Timestamp rule: close what a later row replaces, add the later and the unseen rows."""
    return f"""
        SELECT a.* REPLACE (CASE WHEN b.load_timestamp > a.load_timestamp THEN b.load_timestamp END AS dbt_valid_to)
        FROM {first} a LEFT JOIN {stg_2} b USING ({key})
        UNION ALL
        SELECT b.*, md5(b.{key} || '|' || CAST(b.load_timestamp AS VARCHAR)), b.load_timestamp, b.load_timestamp,
               CAST(NULL AS TIMESTAMP)
        FROM {stg_2} b LEFT JOIN {first} a USING ({key})
        WHERE a.{key} IS NULL OR b.load_timestamp > a.load_timestamp"""


RUN_1, RUN_2 = "TIMESTAMP '2018-10-20 12:00:00'", "TIMESTAMP '2018-10-22 00:00:00'"
PLACE_COLS = "zip_code_prefix, latitude, longitude, city, state, load_timestamp, is_imputed, geo_key"

# Fixed formula.
PARITY_EASTER = """make_date(year, 1, 1) + CAST(
    ((255 - 11 * (year % 19)) % 30 + 21
     + (6 + (year + year // 4 + (255 - 11 * (year % 19)) // 30) % 7) % 7 - 1) AS INTEGER)"""

# Fixed formula: Gregorian computus, step by step.
GREGORIAN = """
    SELECT year, make_date(year, n // 31, n % 31 + 1) AS easter_sunday FROM (
      SELECT year, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS n FROM (
        SELECT *, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM (
          SELECT *, (19 * a + b - d - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h, c // 4 AS i, c % 4 AS k FROM (
            SELECT year, year % 19 AS a, year // 100 AS b, year % 100 AS c, (year // 100) // 4 AS d,
                   (year // 100) % 4 AS e FROM years))))"""

# Names of the holidays.
HOLIDAY = """CASE strftime(date_day, '%m-%d')
    WHEN '01-01' THEN 'Ano Novo' WHEN '04-21' THEN 'Tiradentes' WHEN '05-01' THEN 'Dia do Trabalhador'
    WHEN '09-07' THEN 'Independência do Brasil' WHEN '10-12' THEN 'Nossa Senhora Aparecida'
    WHEN '11-02' THEN 'Finados' WHEN '11-15' THEN 'Proclamação da República' WHEN '12-25' THEN 'Natal'
    ELSE CASE date_diff('day', easter_sunday, date_day)
      WHEN -48 THEN 'Carnaval (Segunda-feira)' WHEN -47 THEN 'Carnaval (Terça-feira)'
      WHEN -2 THEN 'Sexta-feira Santa' WHEN 0 THEN 'Páscoa' WHEN 60 THEN 'Corpus Christi' END END"""


def _calendar(easter: str) -> str:
    return f"""
        SELECT {date_id("date_day")} AS date_id, date_day AS full_date, CAST(year(date_day) AS INTEGER) AS year,
               CAST(month(date_day) AS INTEGER) AS month, CAST(day(date_day) AS INTEGER) AS day,
               CAST(dayofweek(date_day) + 1 AS INTEGER) AS day_of_week, strftime(date_day, '%A') AS day_name,
               strftime(date_day, '%B') AS month_name, CAST(strftime(date_day, '%U') AS INTEGER) AS week_of_year,
               CAST(quarter(date_day) AS INTEGER) AS quarter_of_year, strftime(date_day, '%Y-%m') AS year_month,
               dayofweek(date_day) IN (0, 6) AS is_weekend, holiday_name IS NOT NULL AS is_holiday, holiday_name,
               CASE WHEN month(date_day) IN (12, 1, 2) THEN 'Summer' WHEN month(date_day) <= 5 THEN 'Autumn'
                    WHEN month(date_day) <= 8 THEN 'Winter' ELSE 'Spring' END AS season,
               day(date_day) = 1 AS is_first_day_of_month, date_day = last_day(date_day) AS is_last_day_of_month
        FROM (SELECT date_day, {HOLIDAY} AS holiday_name
              FROM date_spine LEFT JOIN {easter} ON year(date_day) = year)"""


GRID_ROWS, GRID_COLS = 4, 3
UNITS = GRID_ROWS * GRID_COLS
VALUES = "[" + ", ".join(FEATURES) + "]"

PIECES: dict[str, str] = {
    **raw_sql(DUCKDB),
    "stg_customers": _place("customer", "customer_id, customer_unique_id") + " FROM raw_customers",
    "stg_customers_2": _place("customer", "customer_id, customer_unique_id") + " FROM raw_customers_2",
    "stg_sellers": _place("seller", "seller_id") + " FROM raw_sellers",
    "stg_sellers_2": _place("seller", "seller_id") + " FROM raw_sellers_2",
    "stg_geolocation": f"""
        SELECT zip_code_prefix, round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude, city,
               state, max(load_timestamp) AS load_timestamp, FALSE AS is_imputed, count(*) > 1 AS was_merged,
               count(*) AS source_points, zip_code_prefix || '|' || city || '|' || state AS geo_key
        FROM (SELECT lpad(CAST(geolocation_zip_code_prefix AS VARCHAR), 5, '0') AS zip_code_prefix,
                     {title_case("trim(geolocation_city)")} AS city, upper(trim(geolocation_state)) AS state,
                     try_cast(geolocation_lat AS DOUBLE) AS latitude,
                     try_cast(geolocation_lng AS DOUBLE) AS longitude, load_timestamp
              FROM raw_geolocation WHERE geolocation_zip_code_prefix IS NOT NULL)
        GROUP BY zip_code_prefix, city, state""",
    "stg_orders": """
        SELECT * REPLACE (CASE WHEN order_approved_at = 'NULL' THEN NULL
                               ELSE strptime(order_approved_at, '%Y-%m-%d %H:%M:%S') END AS order_approved_at)
        FROM raw_orders""",
    "stg_products": """
        SELECT p.*, coalesce(t.product_category_name_english, p.product_category_name) AS product_category_english
        FROM raw_products p LEFT JOIN raw_translation t USING (product_category_name)""",
    "stg_products_2": """
        SELECT p.*, coalesce(t.product_category_name_english, p.product_category_name) AS product_category_english
        FROM raw_products_2 p LEFT JOIN raw_translation t USING (product_category_name)""",
    "snap_customers_1": _first("stg_customers", "customer_id", "load_timestamp"),
    "snap_customers": _second("snap_customers_1", "stg_customers_2", "customer_id"),
    "snap_sellers_1": _first("stg_sellers", "seller_id", "load_timestamp"),
    "snap_sellers": _second("snap_sellers_1", "stg_sellers_2", "seller_id"),
    "snap_products_1": _first("stg_products", "product_id", "load_timestamp"),
    "snap_products": _second("snap_products_1", "stg_products_2", "product_id"),
    "snap_geolocation_1": _first(f"(SELECT {PLACE_COLS} FROM stg_geolocation)", "geo_key", RUN_1),
    "snap_geolocation": f"""
        SELECT a.* REPLACE (CASE WHEN b.geo_key IS NULL OR a.latitude IS DISTINCT FROM b.latitude
                                 OR a.longitude IS DISTINCT FROM b.longitude THEN {RUN_2} END AS dbt_valid_to)
        FROM snap_geolocation_1 a LEFT JOIN stg_geolocation_2 b USING (geo_key)
        UNION ALL
        SELECT b.* FROM ({_first(f"(SELECT {PLACE_COLS} FROM stg_geolocation_2)", "geo_key", RUN_2)}) b
        LEFT JOIN snap_geolocation_1 a USING (geo_key)
        WHERE a.geo_key IS NULL OR a.latitude IS DISTINCT FROM b.latitude
              OR a.longitude IS DISTINCT FROM b.longitude""",
    "bounds": """
        SELECT make_date(year(min(o_orderdate)), 1, 1) AS first, make_date(year(max(o_orderdate)) + 1, 12, 31) AS last
        FROM orders""",
    "date_spine": """
        SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS date_day FROM bounds""",
    "years": "SELECT DISTINCT CAST(year(date_day) AS INTEGER) AS year FROM date_spine",
    "easter": f"SELECT year, CAST({PARITY_EASTER} AS DATE) AS easter_sunday FROM years",
    "easter_gregorian": GREGORIAN,
    "dim_date": _calendar("easter"),
    "dim_date_gregorian": _calendar("easter_gregorian"),
    # Dimensions of the first load, which the facts refer to.
    "dim_customer": "SELECT customer_id, customer_unique_id, zip_code_prefix, city, state, load_timestamp FROM stg_customers",
    "dim_seller": "SELECT seller_id, zip_code_prefix, city, state, load_timestamp FROM stg_sellers",
    "dim_product": """
        SELECT product_id, product_category_english AS product_category_name, product_photos_qty, product_weight_g,
               product_length_cm, product_height_cm, product_width_cm, load_timestamp FROM stg_products""",
    "dim_geolocation": f"SELECT {PLACE_COLS} FROM stg_geolocation",
    "translation": "SELECT * FROM raw_translation",
    "fact_orders": f"""
        SELECT order_id, customer_id, order_status, order_purchase_timestamp AS order_purchase_date,
               order_approved_at AS order_approved_date, order_delivered_carrier_date, order_delivered_customer_date,
               order_estimated_delivery_date, {date_id("order_purchase_timestamp")} AS order_purchase_date_id,
               {date_id("order_approved_at")} AS order_approved_date_id,
               {date_id("order_delivered_carrier_date")} AS order_delivered_carrier_date_id,
               {date_id("order_delivered_customer_date")} AS order_delivered_customer_date_id,
               {date_id("order_estimated_delivery_date")} AS order_estimated_delivery_date_id, load_timestamp
        FROM stg_orders""",
    "fact_sales": f"""
        SELECT o.order_id, order_item_id, CAST(order_purchase_timestamp AS DATE) AS order_purchase_date,
               {date_id("order_purchase_timestamp")} AS order_purchase_date_id, customer_id, seller_id, product_id,
               order_status, price, freight_value, price + freight_value AS total_item_value, 1 AS order_count,
               {flag("order_status = 'delivered'")} AS delivered_flag,
               CASE WHEN order_status IN ('delivered', 'invoiced') THEN price + freight_value
                    ELSE CAST(0 AS DOUBLE) END AS recognized_revenue, o.load_timestamp
        FROM stg_orders o JOIN raw_order_items i USING (order_id)""",
    "fact_payments": f"""
        SELECT p.order_id, customer_id, payment_sequential, payment_type, payment_installments, payment_value,
               {flag("payment_installments > 1")} AS is_installment,
               CASE WHEN payment_installments <> 0 THEN
                    ((2 * CAST(round(payment_value * 100) AS BIGINT) + payment_installments)
                     // (2 * payment_installments)) / 100.0 END AS installment_value,
               {flag("payment_type = 'credit_card'")} AS payment_type_flag_credit, p.load_timestamp,
               {date_id("order_approved_at")} AS payment_date_id
        FROM raw_order_payments p JOIN stg_orders o USING (order_id) WHERE order_approved_at IS NOT NULL""",
    "fact_fulfillment": f"""
        SELECT o.order_id, order_item_id, customer_id, product_id, seller_id, order_status, order_approved_at,
               shipping_limit_date, {date_id("shipping_limit_date")} AS shipping_limit_date_id,
               CAST(datediff('day', CAST(order_approved_at AS DATE), CAST(order_delivered_customer_date AS DATE))
                    AS INTEGER) AS actual_delivery_days,
               CAST(datediff('day', CAST(order_approved_at AS DATE), CAST(order_estimated_delivery_date AS DATE))
                    AS INTEGER) AS estimated_delivery_days,
               CAST(datediff('day', CAST(order_estimated_delivery_date AS DATE),
                    CAST(order_delivered_customer_date AS DATE)) AS INTEGER) AS delivery_delay,
               {flag('''CAST(order_delivered_customer_date AS DATE) > CAST(order_estimated_delivery_date AS DATE)''')}
                   AS delivery_late_flag, o.load_timestamp
        FROM stg_orders o JOIN raw_order_items i USING (order_id)""",
    "latest_reviews": """
        SELECT * FROM raw_order_reviews QUALIFY row_number() OVER (PARTITION BY review_id
            ORDER BY review_creation_date DESC NULLS LAST, review_answer_timestamp DESC NULLS LAST, order_id) = 1""",
    "fact_reviews": f"""
        SELECT r.review_id, r.order_id, review_score, coalesce(review_comment_message, '') AS review_comment_message,
               CAST(length(coalesce(review_comment_message, '')) AS INTEGER) AS review_length,
               {flag("coalesce(review_comment_message, '') <> ''")} AS has_comment, review_creation_date,
               {date_id("review_creation_date")} AS review_creation_date_id,
               review_answer_timestamp AS review_answer_date,
               {date_id("review_answer_timestamp")} AS review_answer_date_id,
               datesub('hour', review_creation_date, review_answer_timestamp) AS response_time_hours,
               {flag("review_score >= 4")} AS is_positive_review, {flag("review_score <= 2")} AS is_negative_review,
               r.load_timestamp, o.customer_id
        FROM latest_reviews r LEFT JOIN stg_orders o USING (order_id)""",
    "link": """
        SELECT DISTINCT o.order_id, c.customer_unique_id
        FROM fact_orders o LEFT JOIN dim_customer c USING (customer_id)""",
    "details": """
        SELECT o.*, c.customer_unique_id, s.product_id, s.price, s.order_item_id
        FROM fact_orders o LEFT JOIN dim_customer c USING (customer_id) LEFT JOIN fact_sales s USING (order_id)""",
    "rfm": f"""
        SELECT customer_unique_id,
               datesub('day', max(order_purchase_date),
                       (SELECT max(order_purchase_date) + INTERVAL 1 DAY FROM details)) AS "Recency",
               count(DISTINCT order_id) AS "Frequency", coalesce({money_sum("price")}, 0.0) AS "Monetary"
        FROM details WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id""",
    "order_feats": f"""
        SELECT customer_unique_id, count(DISTINCT order_id) AS number_of_orders,
               {money_mean("price")} AS avg_order_value, count(order_item_id) AS total_order_items
        FROM details WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id""",
    "payment_feats": f"""
        SELECT customer_unique_id, coalesce({money_sum("payment_value")}, 0.0) AS total_payment_value,
               avg(payment_installments) AS avg_payment_installments
        FROM fact_payments JOIN link USING (order_id) WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id""",
    "review_feats": """
        SELECT customer_unique_id, avg(review_score) AS avg_review_score, count(review_id) AS num_reviews
        FROM fact_reviews JOIN link USING (order_id) WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id""",
    "sold": """
        SELECT customer_unique_id, product_id, price, product_category_name
        FROM fact_sales LEFT JOIN dim_product USING (product_id) JOIN link USING (order_id)
        WHERE customer_unique_id IS NOT NULL""",
    "product_feats": f"""
        SELECT a.*, m.product_category_name AS most_frequent_category FROM (
          SELECT customer_unique_id, {money_mean("price")} AS avg_product_category_value,
                 count(DISTINCT product_id) AS num_unique_products FROM sold GROUP BY customer_unique_id) a
        LEFT JOIN (SELECT customer_unique_id, product_category_name FROM sold
                   WHERE product_category_name IS NOT NULL GROUP BY customer_unique_id, product_category_name
                   QUALIFY row_number() OVER (PARTITION BY customer_unique_id
                                              ORDER BY count(*) DESC, product_category_name) = 1) m
        USING (customer_unique_id)""",
    "features": "SELECT customer_unique_id, "
    + ", ".join(f'CAST(coalesce("{f}", 0) AS DOUBLE) AS "{f}"' for f in FEATURES)
    + """
        FROM (SELECT DISTINCT customer_unique_id FROM dim_customer) LEFT JOIN rfm USING (customer_unique_id)
        LEFT JOIN order_feats USING (customer_unique_id) LEFT JOIN payment_feats USING (customer_unique_id)
        LEFT JOIN review_feats USING (customer_unique_id) LEFT JOIN product_feats USING (customer_unique_id)""",
    "stats": "SELECT "
    + ", ".join(f'avg("{f}") AS "mean_{f}", stddev_pop("{f}") AS "std_{f}"' for f in FEATURES)
    + " FROM features",
    "scaled": "SELECT customer_unique_id, "
    + ", ".join(
        f'("{f}" - "mean_{f}") / CASE WHEN "std_{f}" = 0 THEN 1 ELSE "std_{f}" END AS "{f}"' for f in FEATURES
    )
    + " FROM features, stats",
    # A small fixed map: each unit is the mean of the customers that share a remainder.
    "neurons": f"""
        SELECT CAST(u // {GRID_COLS} AS INTEGER) AS i, CAST(u % {GRID_COLS} AS INTEGER) AS j, u,
               [{", ".join(f'avg("{f}")' for f in FEATURES)}] AS w
        FROM (SELECT CAST(customer_unique_id AS BIGINT) % {UNITS} AS u, * FROM scaled) GROUP BY u""",
    "points": f"SELECT customer_unique_id, {VALUES} AS v FROM scaled",
    "ranked": """
        SELECT customer_unique_id, i, j, list_distance(v, w) AS dist,
               row_number() OVER (PARTITION BY customer_unique_id ORDER BY list_distance(v, w), u) AS place
        FROM points, neurons""",
    "assigned": """
        SELECT a.customer_unique_id, a.i, a.j, a.dist, b.i AS i2, b.j AS j2
        FROM ranked a JOIN ranked b USING (customer_unique_id) WHERE a.place = 1 AND b.place = 2""",
    "segments": """
        SELECT f.*, CAST(a.i % 3 AS INTEGER) AS segment_id FROM features f LEFT JOIN assigned a USING (customer_unique_id)""",
    "labelled": """
        SELECT p.customer_unique_id, v, segment_id FROM points p JOIN segments USING (customer_unique_id)""",
    "centroids": "SELECT segment_id, ["
    + ", ".join(f"avg(v[{d + 1}])" for d in range(len(FEATURES)))
    + "] AS c FROM labelled GROUP BY segment_id",
    "quantization": "SELECT avg(dist) AS quantization_error FROM assigned",
    "topographic": """
        SELECT avg(CASE WHEN greatest(abs(i - i2), abs(j - j2)) > 1 THEN 1.0 ELSE 0.0 END) AS topographic_error
        FROM assigned""",
    "spreads": """
        SELECT segment_id, c, avg(list_distance(v, c)) AS s FROM labelled JOIN centroids USING (segment_id)
        GROUP BY segment_id, c""",
    "davies": """
        SELECT avg(worst) AS davies_bouldin FROM (
          SELECT max((a.s + b.s) / list_distance(a.c, b.c)) AS worst
          FROM spreads a JOIN spreads b ON a.segment_id <> b.segment_id GROUP BY a.segment_id)""",
    "silhouette": """
        SELECT avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette
        FROM (SELECT customer_unique_id, max(CASE WHEN same THEN total / nullif(n - 1, 0) END) AS a,
                     min(CASE WHEN NOT same THEN total / n END) AS b
              FROM (SELECT x.customer_unique_id, x.segment_id = y.segment_id AS same, y.segment_id AS other,
                           sum(list_distance(x.v, y.v)) AS total, count(*) AS n
                    FROM labelled x, labelled y GROUP BY ALL) GROUP BY customer_unique_id)""",
    # Mean squared distance to a cluster from its size, sum and sum of squares.
    "moments": "SELECT segment_id, count(*) AS n, ["
    + ", ".join(f"sum(v[{d + 1}])" for d in range(len(FEATURES)))
    + "] AS s, sum(list_dot_product(v, v)) AS q FROM labelled GROUP BY segment_id",
    "silhouette_sq": """
        SELECT avg(CASE WHEN n = 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END)
                   AS silhouette_squared
        FROM (SELECT customer_unique_id, max(CASE WHEN same THEN n END) AS n,
                     max(CASE WHEN same THEN d * n / (n - 1) END) AS a, min(CASE WHEN NOT same THEN d END) AS b
              FROM (SELECT customer_unique_id, l.segment_id = m.segment_id AS same, m.n,
                           list_dot_product(v, v) + q / m.n - 2 * list_dot_product(v, s) / m.n AS d
                    FROM labelled l, moments m) GROUP BY customer_unique_id)""",
    "metrics": "SELECT * FROM silhouette, davies, quantization, topographic",
}


def with_pieces(statement: str, own: tuple[str, ...] = ()) -> str:
    """The statement with every piece it needs, directly or not, in front of it, then its ``own`` pieces."""
    ordered: list[str] = []

    def visit(sql: str, above: tuple[str, ...]) -> None:
        for word in sorted(set(re.findall(r"\b[a-z_0-9]+\b", sql))):
            if word in PIECES and word not in ordered and word not in above:
                visit(PIECES[word], (*above, word))
                ordered.append(word)

    visit(" ".join((*own, statement)), ())
    parts = [f"{name} AS ({re.sub(r'[{](\w+)[}]', lambda m: m[1], PIECES[name])})" for name in ordered]
    parts += own
    return f"WITH {', '.join(parts)} {statement}" if parts else statement


def _literal(value) -> str:
    if isinstance(value, bool):
        return str(value).upper()
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def test_failures(test: DataTest) -> str:
    """SQL that counts the failures of one declared test."""
    a, cols = test.args, test.columns
    scope = f"(SELECT * FROM {test.model}" + (f" WHERE {test.where})" if test.where else ")")
    first = cols[0] if cols else None
    if test.kind in ("unique", "unique_combination"):
        by = ", ".join(cols)
        some = f" WHERE {first} IS NOT NULL" if test.kind == "unique" else ""
        return f"SELECT count(*) FROM (SELECT {by} FROM {scope}{some} GROUP BY {by} HAVING count(*) > 1)"
    if test.kind in ("accepted_values", "in_set"):
        listed = ", ".join(_literal(v) for v in a["values"] if v is not None)
        what = f"DISTINCT {first}" if test.kind == "accepted_values" else "*"
        return f"SELECT count({what}) FROM {scope} WHERE {first} IS NOT NULL AND {first} NOT IN ({listed})"
    if test.kind == "relationships":
        return f"""SELECT count(*) FROM {scope} t WHERE {first} IS NOT NULL AND NOT EXISTS
                   (SELECT 1 FROM {a["to"]} p WHERE p.{a["field"]} = t.{first})"""
    condition = {
        "not_null": lambda: f"{first} IS NULL",
        "matches_regex": lambda: f"NOT regexp_matches({first}, '{a['regex']}')",
        "accepted_range": lambda: f"{first} < {a['low']} OR {first} > {a['high']}",
        "pair_greater": lambda: f"NOT ({cols[0]} > {cols[1]})",
        "expression": lambda: f"NOT ({a['sql_expr']})",
    }[test.kind]()
    return f"SELECT count(*) FROM {scope} WHERE {condition}"


def suite_report() -> str:
    lines = [
        f"""SELECT {i} AS test_no, '{t.model}' AS model, '{t.kind}' AS test, '{t.label}' AS "column",
                   ({test_failures(t)}) AS failures, '{t.severity}' AS severity"""
        for i, t in enumerate(mart_tests())
    ]
    return f"""
        SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
        FROM ({" UNION ALL ".join(lines)})"""


def _kernel(length: int, radius: float, a: str, b: str) -> str:
    return f"exp(-(({a} - {b}) * ({a} - {b})) / {2.0 * radius * radius!r})"


def som_training(epochs: int, sigma: float, seed: int) -> str:
    """The batch rule on the small grid, one group of pieces per epoch."""
    place = lambda u: (f"({u} // {GRID_COLS})", f"({u} % {GRID_COLS})")
    parts = [
        f"""w0 AS (SELECT row_number() OVER (ORDER BY md5('{seed}:' || customer_unique_id)) - 1 AS u, v AS w
                   FROM points ORDER BY md5('{seed}:' || customer_unique_id) LIMIT {UNITS})"""
    ]
    for e in range(epochs):
        radius = sigma / (1.0 + e / (epochs / 2.0))
        (ai, aj), (bi, bj) = place("a.u"), place("b.u")
        h = f"{_kernel(GRID_ROWS, radius, ai, bi)} * {_kernel(GRID_COLS, radius, aj, bj)}"
        sums = ", ".join(f"sum(v[{d + 1}])" for d in range(len(FEATURES)))
        moved = ", ".join(f"sum({h} * b.s[{d + 1}]) / sum({h} * b.n)" for d in range(len(FEATURES)))
        parts += [
            f"""b{e} AS (SELECT u, count(*) AS n, [{sums}] AS s FROM (
                    SELECT customer_unique_id, v, u FROM points, w{e}
                    QUALIFY row_number() OVER (PARTITION BY customer_unique_id
                                               ORDER BY list_distance(v, w), u) = 1) GROUP BY u)""",
            f"w{e + 1} AS (SELECT a.u, [{moved}] AS w FROM w{e} a, b{e} b GROUP BY a.u)",
        ]
    last = f"w{epochs}"
    values = ", ".join(f'round(w[{d + 1}], 4) + 0.0 AS "{f}"' for d, f in enumerate(FEATURES))
    i, j = place("u")
    body = f"SELECT CAST({i} AS INTEGER) AS i, CAST({j} AS INTEGER) AS j, {values} FROM {last}"
    return with_pieces(body, tuple(parts))
