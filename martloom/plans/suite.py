"""The declared tests of the marts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from martloom.operators.quality import DataTest

# Accepted sets and limits.
STATES = (
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG", "PA", "PB", "PR", "PE", "PI",
    "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
)
ORDER_STATUS = (
    "created", "approved", "processing", "shipped", "delivered", "canceled", "invoiced", "unavailable",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
SEASONS = ("Summer", "Autumn", "Winter", "Spring")
HOLIDAYS = (
    None, "Ano Novo", "Tiradentes", "Dia do Trabalhador", "Independência do Brasil", "Nossa Senhora Aparecida",
    "Finados", "Proclamação da República", "Natal", "Carnaval (Segunda-feira)", "Carnaval (Terça-feira)",
    "Sexta-feira Santa", "Páscoa", "Corpus Christi",
)
ZIP = "^[0-9]{5}$"
CALENDAR_RANGES = {"month": (1, 12), "day": (1, 31), "day_of_week": (1, 7), "quarter_of_year": (1, 4)}


class _Model:
    """Collects the tests of one model."""

    def __init__(self, model: str):
        self.model = model
        self.tests: list[DataTest] = []

    def _add(self, kind: str, columns: Sequence[str], where: str | None, severity: str, **args: Any) -> "_Model":
        self.tests.append(DataTest(self.model, kind, tuple(columns), args, where, severity))
        return self

    def present(self, *columns: str) -> "_Model":
        for c in columns:
            self._add("not_null", [c], None, "error")
        return self

    def unique(self, *columns: str) -> "_Model":
        return self._add("unique" if len(columns) == 1 else "unique_combination", columns, None, "error")

    def accepted(self, column: str, values: Iterable[Any], where: str | None = None, severity: str = "error"):
        return self._add("accepted_values", [column], where, severity, values=tuple(values))

    def one_of(self, values: Iterable[Any], *columns: str) -> "_Model":
        for c in columns:
            self._add("in_set", [c], None, "error", values=tuple(values))
        return self

    def within(self, column: str, low: Any, high: Any, where: str | None = None, severity: str = "error"):
        return self._add("accepted_range", [column], where, severity, low=low, high=high)

    def refers(self, to: str, field: str, *columns: str, severity: str = "error") -> "_Model":
        for c in columns:
            self._add("relationships", [c], None, severity, to=to, field=field)
        return self

    def matches(self, column: str, regex: str) -> "_Model":
        return self._add("matches_regex", [column], None, "error", regex=regex)

    def after(self, later: str, earlier: str) -> "_Model":
        both = f"{later} IS NOT NULL AND {earlier} IS NOT NULL"
        return self._add("pair_greater", [later, earlier], both, "warn", or_equal=False)

    def holds(self, sql_expr: str, severity: str) -> "_Model":
        return self._add("expression", [], None, severity, sql_expr=sql_expr)


def _place(model: str, key: str) -> _Model:
    """Customers and sellers are tested alike."""
    return (
        _Model(model)
        .unique(key)
        .present(key, "city", "load_timestamp")
        .matches("zip_code_prefix", ZIP)
        .refers("dim_geolocation", "zip_code_prefix", "zip_code_prefix", severity="warn")
        .accepted("state", STATES)
    )


def _calendar() -> _Model:
    calendar = (
        _Model("dim_date")
        .unique("date_id")
        .present(
            "date_id", "full_date", "year", "month", "day", "day_of_week", "day_name", "month_name",
            "week_of_year", "quarter_of_year", "season",
        )
        .accepted("day_name", DAY_NAMES, severity="warn")
        .accepted("month_name", MONTH_NAMES)
        .accepted("holiday_name", HOLIDAYS, where="is_holiday = TRUE")
        .accepted("season", SEASONS)
        .within("week_of_year", 1, 53, severity="warn")
        .one_of((True, False), "is_weekend", "is_holiday", "is_first_day_of_month", "is_last_day_of_month")
    )
    for column, (low, high) in CALENDAR_RANGES.items():
        calendar.within(column, low, high)
    return calendar


def mart_tests() -> list[DataTest]:
    """All tests, model by model."""
    customer = _place("dim_customer", "customer_id").present("customer_unique_id")
    seller = _place("dim_seller", "seller_id")
    place = (
        _Model("dim_geolocation")
        .unique("geo_key")
        .present("geo_key", "zip_code_prefix")
        .accepted("is_imputed", (True, False))
    )
    product = (
        _Model("dim_product")
        .unique("product_id")
        .present("product_id", "product_category_name", "load_timestamp")
        .refers("translation", "product_category_name_english", "product_category_name", severity="warn")
        .within("product_weight_g", 10, 50000, severity="warn")
        .within("product_length_cm", 5, 200)
        .within("product_height_cm", 1, 150)
    )
    orders = (
        _Model("fact_orders")
        .unique("order_id", "customer_id")
        .after("order_approved_date", "order_purchase_date")
        .after("order_delivered_carrier_date", "order_approved_date")
        .after("order_delivered_customer_date", "order_delivered_carrier_date")
        .unique("order_id")
        .present("order_id", "customer_id", "order_purchase_date", "load_timestamp")
        .accepted("order_status", ORDER_STATUS)
        .refers(
            "dim_date", "date_id",
            "order_purchase_date_id", "order_approved_date_id", "order_delivered_carrier_date_id",
            "order_delivered_customer_date_id", "order_estimated_delivery_date_id",
        )
    )
    sales = (
        _Model("fact_sales")
        .unique("order_id", "order_item_id")
        .present(
            "order_id", "order_item_id", "customer_id", "seller_id", "product_id", "order_purchase_date_id",
            "order_status", "price", "freight_value", "total_item_value", "order_count", "delivered_flag",
            "load_timestamp",
        )
        .within("order_item_id", 1, 50, severity="warn")
        .within("price", 0.01, 10000)
        .within("freight_value", 0, 500)
        .refers("dim_customer", "customer_id", "customer_id")
        .refers("dim_seller", "seller_id", "seller_id")
        .refers("dim_product", "product_id", "product_id")
        .refers("dim_date", "date_id", "order_purchase_date_id")
        .accepted("order_status", ORDER_STATUS)
        .accepted("order_count", (1,))
        .one_of((0, 1), "delivered_flag")
    )
    payments = (
        _Model("fact_payments")
        .unique("order_id", "payment_sequential")
        .present("order_id", "customer_id", "payment_sequential", "payment_value", "load_timestamp")
        .refers("dim_customer", "customer_id", "customer_id")
        .refers("dim_date", "date_id", "payment_date_id")
        .within("payment_sequential", 1, 29)
        .within("payment_installments", 1, 24, where="payment_installments > 0")
        .within("payment_value", 0.01, 10000, severity="warn")
        .accepted("payment_type", PAYMENT_TYPES)
        .one_of((0, 1), "is_installment", "payment_type_flag_credit")
    )
    fulfillment = (
        _Model("fact_fulfillment")
        .unique("order_id", "order_item_id")
        .holds("actual_delivery_days <= estimated_delivery_days + 14", severity="warn")
        .after("shipping_limit_date", "order_approved_at")
        .present(
            "order_id", "order_item_id", "customer_id", "product_id", "seller_id", "shipping_limit_date_id",
            "load_timestamp",
        )
        .within("order_item_id", 1, 50, severity="warn")
        .refers("fact_orders", "order_id", "order_id")
        .refers("dim_customer", "customer_id", "customer_id")
        .refers("dim_product", "product_id", "product_id")
        .refers("dim_seller", "seller_id", "seller_id")
        .refers("dim_date", "date_id", "shipping_limit_date_id", severity="warn")
        .within("actual_delivery_days", 1, 60, where="delivery_delay IS NOT NULL", severity="warn")
        .within("delivery_delay", -7, 30, where="delivery_delay IS NOT NULL", severity="warn")
        .one_of((0, 1), "delivery_late_flag")
    )
    reviews = (
        _Model("fact_reviews")
        .unique("review_id")
        .present(
            "review_id", "order_id", "customer_id", "review_score", "review_creation_date", "load_timestamp"
        )
        .refers("dim_customer", "customer_id", "customer_id")
        .refers("dim_date", "date_id", "review_creation_date_id", "review_answer_date_id")
        .within("review_score", 1, 5)
        .one_of((0, 1), "has_comment", "is_positive_review", "is_negative_review")
    )
    models = (customer, _calendar(), place, product, seller, orders, sales, payments, fulfillment, reviews)
    return [test for model in models for test in model.tests]
