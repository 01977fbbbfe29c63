"""Dimension tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions import dates as D
from martloom.operators.scd2 import current_rows

# First day of the default calendar, fixed holidays, and movable ones by distance to Easter.
FIRST_DAY = date(2016, 1, 1)
YEARS_AHEAD = 5
FIXED_HOLIDAYS = {
    "01-01": "Ano Novo",
    "04-21": "Tiradentes",
    "05-01": "Dia do Trabalhador",
    "09-07": "Independência do Brasil",
    "10-12": "Nossa Senhora Aparecida",
    "11-02": "Finados",
    "11-15": "Proclamação da República",
    "12-25": "Natal",
}
MOVABLE_HOLIDAYS = {
    -48: "Carnaval (Segunda-feira)",
    -47: "Carnaval (Terça-feira)",
    -2: "Sexta-feira Santa",
    0: "Páscoa",
    60: "Corpus Christi",
}


def dim_customer(snapshot: DataFrame) -> DataFrame:
    return current_rows(snapshot).select(
        "customer_id", "customer_unique_id", "zip_code_prefix", "city", "state", "load_timestamp"
    )


def dim_product(snapshot: DataFrame) -> DataFrame:
    """Products under their English category."""
    return current_rows(snapshot).select(
        "product_id",
        F.col("product_category_english").alias("product_category_name"),
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        "load_timestamp",
    )


def dim_seller(snapshot: DataFrame) -> DataFrame:
    return current_rows(snapshot).select("seller_id", "zip_code_prefix", "city", "state", "load_timestamp")


def dim_geolocation(snapshot: DataFrame, current_only: bool = False) -> DataFrame:
    """Places with a point. By default all versions, so a place that changed appears once per version."""
    versions = current_rows(snapshot) if current_only else snapshot
    return versions.select(
        "zip_code_prefix",
        "latitude",
        "longitude",
        "city",
        "state",
        "load_timestamp",
        "geo_key",
        "is_imputed",
        F.struct(F.col("longitude").alias("lon"), F.col("latitude").alias("lat")).alias("geo_point"),
    )


def _day(value: date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def date_spine(
    spark: SparkSession, start: date | Column = FIRST_DAY, end: date | Column | None = None
) -> DataFrame:
    """One row per day. The bounds may be dates or one-row subqueries; the default end is five years ahead."""
    last = F.add_months(F.current_date(), 12 * YEARS_AHEAD) if end is None else _day(end)
    bounds = spark.range(1).select(_day(start).alias("first"), last.alias("last"))
    return bounds.select(F.explode(F.sequence("first", "last")).alias("date_day"))


def easter_dates(years: DataFrame, method: str = "reference") -> DataFrame:
    """Easter of each distinct ``year``. ``reference`` keeps the parity dates, ``gregorian`` the real feast."""
    rule = {"reference": D.parity_easter, "gregorian": D.gregorian_easter}[method]
    return years.select("year").distinct().select("year", rule(F.col("year")).alias("easter_sunday"))


def brazil_holidays(days: DataFrame, easter: DataFrame) -> DataFrame:
    """Holiday name of each day or null; a fixed holiday wins over a movable one."""
    day = F.col("date_day")
    name = F.lit(None).cast("string")
    for distance, movable in reversed(list(MOVABLE_HOLIDAYS.items())):
        name = F.when(day == F.date_add("easter_sunday", distance), movable).otherwise(name)
    fixed = F.create_map(*[F.lit(x) for pair in FIXED_HOLIDAYS.items() for x in pair])
    name = F.coalesce(F.try_element_at(fixed, F.date_format(day, "MM-dd")), name)
    joined = days.withColumn("year", F.year("date_day")).join(easter, "year", "left")
    return joined.select("date_day", name.alias("holiday_name"))


def dim_date(
    spark: SparkSession,
    start: date | Column = FIRST_DAY,
    end: date | Column | None = None,
    easter_method: str = "reference",
) -> DataFrame:
    """The calendar: ids, parts, names, holidays and southern seasons, in order of the day."""
    days = date_spine(spark, start, end)
    easter = easter_dates(days.select(F.year("date_day").alias("year")), easter_method)
    day, month = F.col("date_day"), F.month("date_day")
    weekday = F.dayofweek(day)
    season = (
        F.when(month.isin(12, 1, 2), "Summer")
        .when(month.between(3, 5), "Autumn")
        .when(month.between(6, 8), "Winter")
        .otherwise("Spring")
    )
    return (
        brazil_holidays(days, easter)
        .select(
            D.date_id(day).alias("date_id"),
            day.alias("full_date"),
            F.year(day).alias("year"),
            month.alias("month"),
            F.dayofmonth(day).alias("day"),
            weekday.alias("day_of_week"),
            F.date_format(day, "EEEE").alias("day_name"),
            F.date_format(day, "MMMM").alias("month_name"),
            D.sunday_week(day).alias("week_of_year"),
            F.quarter(day).alias("quarter_of_year"),
            F.date_format(day, "yyyy-MM").alias("year_month"),
            weekday.isin(1, 7).alias("is_weekend"),
            F.col("holiday_name").isNotNull().alias("is_holiday"),
            "holiday_name",
            season.alias("season"),
            (F.dayofmonth(day) == 1).alias("is_first_day_of_month"),
            (day == F.last_day(day)).alias("is_last_day_of_month"),
        )
        .orderBy("full_date")
    )
