from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions import dates, text
from martloom.operators import cleaning, staging


def test_clean_text_traps(spark):
    cells = ["a\r\nb", "a\rb\nc", 'say "hi"', "x\x07y\x7fz\tw", None, "a,b"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "id int, c string")
    got = [r.c for r in cleaning.clean_text(df, replace_delimiter=";").orderBy("id").collect()]
    assert got == ["a b", "a b c", 'say ""hi""', "x y z w", "NULL", "a;b"]


def test_clean_text_can_keep_nulls_and_leave_columns_alone(spark):
    df = spark.createDataFrame([(None, "a\nb", 1)], "c string, d string, n int")
    assert cleaning.clean_text(df, ["c"], null_placeholder=None).first() == (None, "a\nb", 1)


def test_dates_by_name_and_garbage(spark):
    df = spark.createDataFrame(
        [("2018-01-02 03:04:05", "never", "2018-01-02")], "Ship_DATE string, a_timestamp string, approved_at string"
    )
    row = cleaning.standardize_dates(df).first()
    assert row == (datetime(2018, 1, 2, 3, 4, 5), None, "2018-01-02")


def test_parsed_dates_take_the_kind_of_the_table(spark):
    df = spark.createDataFrame([("2018-01-02", datetime(2018, 1, 1))], "x_date string, load_timestamp timestamp_ntz")
    assert cleaning.standardize_dates(df).schema["x_date"].dataType.simpleString() == "timestamp_ntz"


def test_prepare_keeps_real_nulls_in_dates(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), (None, None)], "c string, d_date string")
    got = sorted(cleaning.prepare_table(df).collect())
    assert got == [("NULL", None), ("a", None)]


def test_load_stamp(spark):
    row = cleaning.add_load_timestamps(spark.range(1), -3, datetime(2018, 1, 1, 1, 30)).first()
    assert row[1:] == (datetime(2017, 12, 31, 22, 30), date(2017, 12, 31))
    assert cleaning.add_load_timestamps(spark.range(1)).first()["load_timestamp"] is not None


def test_title_case_starts_words_after_punctuation(spark):
    cases = {"embu-guaçu": "Embu-Guaçu", "d'OESTE x.y": "D'oeste X.Y", "são  paulo(sp)/rj": "São  Paulo(Sp)/Rj"}
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    assert {r.c: r.t for r in df.select("c", text.title_case(F.col("c")).alias("t")).collect()} == cases


def test_city_and_key(spark):
    df = spark.createDataFrame([(" São \t Paulo ", 1234, "SP"), ("Ñuñoa", 5, None)], "c string, z int, s string")
    city, key = text.normalize_city(F.col("c")), text.location_key(text.zip5(F.col("z")), F.col("c"), F.col("s"))
    assert [tuple(r) for r in df.select(city, key).collect()] == [
        ("sao paulo", "01234|| São \t Paulo ||SP"),
        ("ñuñoa", "00000||unknown||XX"),
    ]


def test_malformed_approval_is_an_error(spark):
    import pytest

    columns = (
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
        "order_approved_at string, order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, "
        "order_estimated_delivery_date timestamp, load_timestamp timestamp"
    )
    row = ("1", "2", "s", None, "soon", None, None, None, None)
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        staging.stg_orders(spark.createDataFrame([row], columns)).collect()


def test_geolocation_merges_points(spark):
    columns = "geolocation_zip_code_prefix int, geolocation_lat string, geolocation_lng string, geolocation_city string, geolocation_state string, load_timestamp timestamp_ntz"
    t1, t2 = datetime(2018, 1, 1), datetime(2018, 1, 2)
    rows = [
        (1, "1.0", "2.0", " a-b ", "sp ", t1), (1, "2.0", "n/a", "A-B", "SP", t2), (None, "1", "1", "x", "y", t1),
        (2, "bad", "3", "c", "rj", t1),
    ]
    got = {r.geo_key: r for r in staging.stg_geolocation(spark.createDataFrame(rows, columns)).collect()}
    assert set(got) == {"00001|A-B|SP", "00002|C|RJ"}
    both, single = got["00001|A-B|SP"], got["00002|C|RJ"]
    assert (both.latitude, both.longitude, both.load_timestamp, both.was_merged, both.source_points) == (1.5, 2.0, t2, True, 2)
    assert (single.latitude, single.was_merged, single.is_imputed) == (None, False, False)


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_dates_are_utc_in_any_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [("2018-01-01 00:00:00", 1514764800000000000), ("2018-01-01T03:00:00+03:00", None), ("2018-01-01 00:00:00Z", None), ("2018-02-18", None), ("x", None)]
        df = cleaning.standardize_dates(spark.createDataFrame(rows, "a_date string, b_date long"))
        df = cleaning.add_load_timestamps(df, now=datetime(2018, 1, 1))
        got = df.selectExpr("unix_seconds(a_date)", "unix_seconds(b_date)", "unix_seconds(load_timestamp)", "CAST(load_date AS STRING)").collect()
        assert [r[0] for r in got] == [1514764800] * 3 + [1518912000, None]
        assert got[0][1] == 1514764800 and got[0][2] == 1514764800 and got[0][3] == "2018-01-01"
        bare = spark.sql("SELECT '2018-01-01 03:00:00+03:00' AS a_date, TIMESTAMP_NTZ'2018-01-01 00:00:00' AS b_date, 1 AS `x.y`, 'q' AS `t.z`")
        done = cleaning.clean_text(cleaning.standardize_dates(bare))
        assert done.filter("a_date = b_date").count() == 1 and done.columns[2:] == ["x.y", "t.z"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_text_is_parsed_once_for_its_instant(spark):
    texts = spark.range(3).select(F.col("id").cast("string").alias("d"))
    read = texts.select(dates.parse_like(F.col("d"), "yyyy-MM-dd HH:mm:ss", T.TimestampType()))
    plan = read._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("gettimestamp") == 1


def test_instants_of_far_and_odd_times(spark):
    times = ["1969-12-31 23:59:59.999999", "0001-01-01 00:00:00.000001", "9999-12-31 23:59:59.999999", "2018-10-28 02:30:00", "2018-03-25 02:30:00.5"]
    want = [(datetime.fromisoformat(x) - datetime(1970, 1, 1)) // timedelta(microseconds=1) for x in times]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "Europe/Berlin", "America/Sao_Paulo"):
            spark.conf.set("spark.sql.session.timeZone", other)
            rows = spark.createDataFrame([*enumerate([*times, None])], "i int, t string")
            got = rows.select("i", F.unix_micros(dates.instant_of_utc(F.col("t").cast("timestamp_ntz"))).alias("m")).orderBy("i").collect()
            assert [r.m for r in got] == [*want, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_the_usual_form_of_a_date_needs_no_pattern(spark, monkeypatch):
    texts = ["2018-10-23 06:00:00", "2018-10-23T06:00:00", "2018-10-23 06:00:0Z", "2018-10-23 06:00Z  ", "2018-10-23 06:00+2", "2018-10-23 06:00+02:00",
             "2018-1-23 06:00:00Z", "2018-10-23 6:00+02:00", "2018-10-23 06:00:00 Europe/Berlin", " 2018-10-3 06:00:00", "2018-10-23", "x" * 13 + ":00:00", "", None]
    df = spark.createDataFrame([*enumerate(texts)], "i int, d_date string")

    def read():
        return cleaning.standardize_dates(df).orderBy("i").collect()

    fast = read()
    monkeypatch.setattr(cleaning, "_plain", lambda c: F.lit(False))
    assert fast == read() and sum(r.d_date is not None for r in fast) > 5
