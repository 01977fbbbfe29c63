from __future__ import annotations

import pytest
from datetime import date, datetime

from pyspark.sql import functions as F

from martloom.functions.dates import date_id, gregorian_easter, parity_easter, sunday_week, whole_days, whole_hours
from martloom.functions.numbers import exact_sum, rate
from martloom.operators import dims, facts, scd2

T1, T2, T3 = datetime(2018, 1, 1), datetime(2018, 1, 2), datetime(2018, 1, 3)


def _people(spark, rows):
    return spark.createDataFrame(rows, "id string, city string, load_timestamp timestamp_ntz")


def test_timestamp_history(spark):
    first = scd2.snapshot_timestamp(None, _people(spark, [("a", "x", T1), ("b", "y", T1)]), "id", "load_timestamp")
    second = scd2.snapshot_timestamp(
        first, _people(spark, [("a", "z", T2), ("c", "w", T2)]), "id", "load_timestamp"
    )
    third = scd2.snapshot_timestamp(second, _people(spark, [("a", "z", T2), ("b", "y", T3)]), "id", "load_timestamp")
    got = sorted((r.id, r.city, r.dbt_valid_from, r.dbt_valid_to) for r in third.collect())
    assert got == [
        ("a", "x", T1, T2), ("a", "z", T2, None), ("b", "y", T1, T3), ("b", "y", T3, None), ("c", "w", T2, None)
    ]
    assert third.select("dbt_scd_id").distinct().count() == 5
    assert sorted(r.id for r in scd2.current_rows(third).collect()) == ["a", "b", "c"]


def test_rows_without_a_key_never_meet(spark):
    first = scd2.snapshot_timestamp(None, _people(spark, [(None, "x", T1), (None, "y", T1)]), "id", "load_timestamp")
    second = scd2.snapshot_timestamp(first, _people(spark, [(None, "z", T2), ("a", "w", T2)]), "id", "load_timestamp")
    got = sorted((r.id or "", r.city, r.dbt_valid_to is None) for r in second.collect())
    assert got == [("", "x", True), ("", "y", True), ("", "z", True), ("a", "w", True)]


def test_a_repeated_key_is_refused(spark):
    """The first load and a merge refuse it inside their own plan: nothing runs before the result is asked for."""
    bad = _people(spark, [("a", "x", T1), ("b", "x", T1), ("a", "y", T1), (None, "z", T1), (None, "z", T1)])
    good = scd2.snapshot_timestamp(None, bad.filter("id = 'b' OR id IS NULL"), "id", "load_timestamp")
    assert good.count() == 3
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("refusal", "building the plans")
    plans = [
        scd2.snapshot_timestamp(None, bad, "id", "load_timestamp"), scd2.snapshot_timestamp(good, bad, "id", "load_timestamp"),
        scd2.snapshot_check(good, bad, "id", ["city"], _at(T2)), scd2.changes_timestamp(good, bad, "id", "load_timestamp"),
    ]
    assert not tracker.getJobIdsForGroup("refusal")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for df in plans:
        with pytest.raises(Exception, match="repeats id: a"):
            df.select("city").collect()


def test_the_merge_shuffles_each_side_once(spark):
    """The check of repeated keys uses the shuffle that the join needs."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        prev = spark.createDataFrame([("a", "x", T1, "i", T1, T1, None)], "id string, city string, load_timestamp timestamp_ntz, "
                                     "dbt_scd_id string, dbt_updated_at timestamp_ntz, dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz")
        merged = scd2.snapshot_timestamp(prev, _people(spark, [("a", "z", T2)]), "id", "load_timestamp")
        assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_history_grows_by_one_version_per_load(spark):
    history = None
    for i, moment in enumerate((T1, T2, T3)):
        history = scd2.snapshot_timestamp(history, _people(spark, [("a", "x", moment), ("b", "x", moment)]), "id", "load_timestamp")
        assert history.count() == 2 * (i + 1)


def _places(spark, rows):
    return spark.createDataFrame(rows, "geo_key string, latitude double")


def _at(moment):
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def test_check_history(spark):
    batch = _places(spark, [("a", 1.0), ("b", None), ("c", 3.0)])
    first = scd2.snapshot_check(None, batch, "geo_key", ["latitude"], _at(T1))
    same = scd2.snapshot_check(first, batch, "geo_key", ["latitude"], _at(T2))
    assert sorted(map(str, same.collect())) == sorted(map(str, first.collect()))
    moved = _places(spark, [("a", 1.0), ("b", 2.0), ("d", 4.0)])
    got = scd2.snapshot_check(first, moved, "geo_key", ["latitude"], _at(T2))
    assert sorted((r.geo_key, r.latitude or 0.0, r.dbt_valid_from, r.dbt_valid_to) for r in got.collect()) == [
        ("a", 1.0, T1, None), ("b", 0.0, T1, T2), ("b", 2.0, T2, None), ("c", 3.0, T1, T2), ("d", 4.0, T2, None)
    ]
    kept = scd2.snapshot_check(first, moved, "geo_key", ["latitude"], _at(T2), invalidate_hard_deletes=False)
    assert kept.filter("geo_key = 'c' AND dbt_valid_to IS NULL").count() == 1
    back = scd2.snapshot_check(got, batch, "geo_key", ["latitude"], _at(T3))
    assert [(r.dbt_valid_from, r.dbt_valid_to) for r in back.filter("geo_key = 'c'").orderBy("dbt_valid_from").collect()] == [
        (T1, T2), (T3, None)
    ]


def test_calendar(spark):
    got = {r.full_date: r for r in dims.dim_date(spark, date(2016, 1, 1), date(2024, 12, 31)).collect()}
    assert len(got) == 3288
    new_year = got[date(2016, 1, 1)]
    assert (new_year.week_of_year, new_year.day_name, new_year.holiday_name, new_year.season) == (0, "Friday", "Ano Novo", "Summer")
    assert got[date(2016, 1, 3)].week_of_year == 1 and got[date(2016, 1, 3)].is_weekend
    assert got[date(2016, 2, 29)].is_last_day_of_month and not got[date(2016, 2, 28)].is_last_day_of_month
    assert got[date(2024, 4, 21)].holiday_name == "Tiradentes"
    assert {d.year for d, r in got.items() if (r.holiday_name or "").startswith("Carnaval")} == {2016, 2021, 2024}


def test_calendar_with_real_easter(spark):
    days = dims.dim_date(spark, date(2018, 1, 1), date(2018, 12, 31), easter_method="gregorian")
    movable = {r.full_date: r.holiday_name for r in days.filter("is_holiday").collect()}
    assert movable[date(2018, 4, 1)] == "Páscoa" and movable[date(2018, 2, 12)] == "Carnaval (Segunda-feira)"
    assert movable[date(2018, 3, 30)] == "Sexta-feira Santa" and movable[date(2018, 5, 31)] == "Corpus Christi"


def test_default_calendar_reaches_five_years_ahead(spark):
    last = dims.date_spine(spark).agg(F.max("date_day")).first()[0]
    assert last.year == date.today().year + 5


def test_easter(spark):
    years = spark.createDataFrame([(2018,), (2000,), (2024,)], "year int")
    got = years.select("year", gregorian_easter(F.col("year")).alias("g"), parity_easter(F.col("year")).alias("p"))
    assert {r.year: r.g for r in got.collect()} == {2018: date(2018, 4, 1), 2000: date(2000, 4, 23), 2024: date(2024, 3, 31)}
    assert {r.year: r.p for r in got.collect()}[2018] == date(2018, 1, 23)


def test_week_and_id(spark):
    days = spark.sql("SELECT explode(sequence(date'2016-01-01', date'2031-12-31')) AS d")
    for r in days.select("d", sunday_week(F.col("d")).alias("w"), date_id(F.col("d")).alias("i")).collect():
        assert r.w == int(r.d.strftime("%U")) and r.i == int(r.d.strftime("%Y%m%d"))


def test_spans_ignore_the_session_zone(spark):
    rows = [("2018-11-03 23:30:00", "2018-11-05 00:29:59"), ("2018-11-05 00:30:00", "2018-11-03 23:31:00"), (None, "2018-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "a string, b string").selectExpr("CAST(a AS TIMESTAMP_NTZ) a", "CAST(b AS TIMESTAMP_NTZ) b")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        got = df.select(whole_days(F.col("a"), F.col("b")).alias("d"), whole_hours(F.col("a"), F.col("b")).alias("h")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [tuple(r) for r in got] == [(1, 24), (-1, -24), (None, None)]


def test_rate_rounds_half_cents_up(spark):
    rows = [(0.05, 2), (1.0, 3), (10.0, 0), (2.675, 1), (-0.05, 2), (None, 2), (100.01, 2)]
    df = spark.createDataFrame(rows, "v double, n int").select(rate(F.col("v"), F.col("n")).alias("r"))
    assert [r.r for r in df.collect()] == [0.03, 0.33, None, 2.68, -0.03, None, 50.01]


def test_exact_sum(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(None,)], "v double")
    assert df.agg(exact_sum(F.col("v"))).first()[0] == 1.0


def test_review_tie_goes_to_the_first_order(spark):
    columns = "review_id string, order_id string, review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz"
    rows = [("r", "2", T1, T2), ("r", "1", T1, T2), ("r", "0", T1, None), ("q", "9", None, None)]
    got = facts.dedup_latest_review(spark.createDataFrame(rows, columns)).collect()
    assert sorted((r.review_id, r.order_id) for r in got) == [("q", "9"), ("r", "1")]


def test_hot_review_is_filtered_before_the_shuffle(spark, sf_dir):
    from martloom.plans.catalog import Lake

    plan = facts.dedup_latest_review(Lake(spark, sf_dir).stg["order_reviews"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_geolocation_versions(spark):
    columns = "zip_code_prefix string, latitude double, longitude double, city string, state string, load_timestamp timestamp_ntz, is_imputed boolean, geo_key string"
    first = scd2.snapshot_check(None, spark.createDataFrame([("1", 1.0, 2.0, "c", "s", T1, False, "k")], columns), "geo_key", ["latitude"], _at(T1))
    second = scd2.snapshot_check(first, spark.createDataFrame([("1", 5.0, 2.0, "c", "s", T2, False, "k")], columns), "geo_key", ["latitude"], _at(T2))
    assert dims.dim_geolocation(second).count() == 2
    current = dims.dim_geolocation(second, current_only=True).collect()
    assert [(r.geo_point.lon, r.geo_point.lat) for r in current] == [(2.0, 5.0)]
