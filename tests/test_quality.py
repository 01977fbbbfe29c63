from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from martloom.operators import quality as q
from martloom.plans.catalog import Lake
from martloom.plans.suite import mart_tests
from martloom.sources import tables


@pytest.fixture(scope="module")
def things(spark):
    rows = [(1, "a", 5.0, 1.0), (1, "b'\\d", None, 2.0), (2, None, 11.0, 3.0), (None, "z", 0.0, None), (None, "z", 0.0, 0.0)]
    return spark.createDataFrame(rows, "id int, c string, x double, y double")


def test_null_rules(things):
    assert q.not_null(things, "id").count() == 2
    assert [r.id for r in q.unique(things, "id").collect()] == [1]
    assert [tuple(r) for r in q.unique_combination(things, ["id", "c"]).collect()] == [(None, "z", 2)]
    assert sorted(map(tuple, q.accepted_values(things, "c", ["a", "b'\\d", None]).collect())) == [("z", 2)]
    assert q.in_set(things, "c", ["a"]).count() == 3
    assert q.in_set(things, "c", [None]).count() == 4
    assert q.matches_regex(things, "c", r"^[a-z]$").count() == 1
    assert q.accepted_range(things, "x", 0, 10).count() == 1
    assert q.accepted_range(things, "x", 0.0, 11.0, inclusive=False).count() == 3
    assert q.accepted_range(things, "x").count() == 0
    assert q.pair_greater(things, "x", "y").count() == 1
    assert q.pair_greater(things, "x", "y", or_equal=True).count() == 0
    assert q.expression(things, "x > 4").count() == 2
    assert q.not_null(things, "id", where="c = 'z' AND y IS NOT NULL").count() == 1


def test_relationships(spark, things):
    parents = spark.createDataFrame([(1,), (1,), (None,)], "pid int")
    assert [r.id for r in q.relationships(things, "id", parents, "pid").collect()] == [2]


def test_suite_is_complete():
    suite = mart_tests()
    kinds = Counter(t.kind for t in suite)
    assert len(suite) == 138 and sum(t.severity == "warn" for t in suite) == 17
    assert sum(t.where is not None for t in suite) == 8
    assert kinds["not_null"] == 58 and kinds["relationships"] == 22 and kinds["accepted_range"] == 18


def test_report_counts_what_the_single_tests_return(spark, sf_dir, tmp_path):
    directory = str(tmp_path / "marts")
    tables.write_frames(Lake(spark, sf_dir).marts, directory)
    stored = tables.read_frames(spark, directory)
    suite = [t for t in mart_tests() if t.model in ("dim_customer", "dim_product", "fact_payments", "fact_reviews")]
    report = {r.test_no: r for r in q.run_tests(stored, suite).collect()}
    assert len(report) == len(suite)
    for i, t in enumerate(suite):
        assert report[i].failures == t.failing_rows(stored).count(), t
    failed = [(r.model, r.test, r.column) for r in report.values() if r.status == "fail"]
    print(failed)
    assert all((r.failures == 0) == (r.status == "pass") for r in report.values())


def test_status_follows_severity(spark):
    df = spark.createDataFrame([(None,), (1,)], "a int")
    suite = [q.DataTest("m", "not_null", ("a",)), q.DataTest("m", "not_null", ("a",), severity="warn"),
             q.DataTest("m", "unique", ("a",))]
    got = sorted((r.test_no, r.failures, r.status) for r in q.run_tests({"m": df}, suite).collect())
    assert got == [(0, 1, "fail"), (1, 1, "warn"), (2, 0, "pass")]


def _scans(df):
    return df._jdf.queryExecution().sparkPlan().toString().count("FileScan")


def test_every_table_is_scanned_once(spark, sf_dir, tmp_path):
    directory = str(tmp_path / "marts")
    tables.write_frames(Lake(spark, sf_dir).marts, directory)
    stored = tables.read_frames(spark, directory)
    suite = dict(enumerate(mart_tests()))
    count = q._Count.of(stored, {i: t for i, t in suite.items() if t.row_condition() is None})
    counts, observed = q.key_counts(stored, suite, count)
    used = {t.model for t in suite.values()} | {t.args["to"] for t in suite.values() if t.kind == "relationships"}
    assert _scans(counts) == len(used) and len(observed) <= len(used)
    # A parent's key that is tested itself is not counted again.
    shared = [n for i, n in count.parent_of.items() if n in count.of_test.values()]
    assert shared and sum(map(len, count.keys.values())) < len(count.of_test) + len(count.parent_of)


def test_keys_of_any_type_and_nulls(spark):
    child = spark.createDataFrame(
        [(1, "1", None), (1, "1", None), (2, "x", 5), (None, None, 5), (9, "9", None)], "a int, b string, c long"
    ).withColumn("d", F.lit("2020-01-01").cast("date"))
    parent = spark.createDataFrame([(1, "1"), (2, "2"), (None, None)], "k long, t string")
    frames = {"child": child, "parent": parent}
    suite = [
        q.DataTest("child", "relationships", ("a",), {"to": "parent", "field": "k"}),
        q.DataTest("child", "relationships", ("a",), {"to": "parent", "field": "t"}),
        q.DataTest("child", "relationships", ("b",), {"to": "parent", "field": "k"}),
        q.DataTest("child", "relationships", ("b",), {"to": "parent", "field": "t"}, where="c IS NULL"),
        q.DataTest("child", "unique_combination", ("a", "b", "c")), q.DataTest("child", "unique_combination", ("c",)),
        q.DataTest("child", "unique_combination", ("d", "c")), q.DataTest("child", "unique", ("d",)), q.DataTest("parent", "unique", ("k",)),
        q.DataTest("child", "accepted_values", ("b",), {"values": ["1"]}), q.DataTest("parent", "not_null", ("k",)),
    ]
    got = {r.test_no: r.failures for r in q.run_tests(frames, suite).collect()}
    assert got == {0: 1, 1: 1, 2: 2, 3: 1, 4: 1, 5: 2, 6: 2, 7: 1, 8: 0, 9: 2, 10: 1}


def test_keys_that_do_not_repeat_are_stored_for_references_only(spark, monkeypatch):
    items = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 1), (3, None), (3, None)], "o int, i int")
    orders = spark.createDataFrame([(1,), (2,), (4,)], "o int")
    suite = [
        q.DataTest("items", "unique_combination", ("o", "i")), q.DataTest("items", "relationships", ("o",), {"to": "orders", "field": "o"}),
        q.DataTest("orders", "unique", ("o",)), q.DataTest("items", "unique", ("o",)),
    ]
    stored = []
    monkeypatch.setattr(q, "materialize", lambda df, name, store=q.materialize: stored.append(store(df, name)) or stored[-1])
    got = {r.test_no: r.failures for r in q.run_tests({"items": items, "orders": orders}, suite).collect()}
    assert got == {0: 2, 1: 2, 2: 0, 3: 3}
    # Of four pairs those two that repeat, and each order number of both tables.
    assert sorted(r.n for r in stored[0].collect()) == [1, 1, 1, 2, 2, 2, 2, 2]


def test_only_single_row_tests_or_none(spark):
    df = spark.createDataFrame([(None,), (1,)], "a int")
    assert q.run_tests({"m": df}, [q.DataTest("m", "not_null", ("a",))]).first().failures == 1
    assert q.run_tests({"m": df.limit(0)}, [q.DataTest("m", "not_null", ("a",)), q.DataTest("m", "unique", ("a",))]).collect()[0].failures == 0
    assert q.run_tests({"m": df}, []).count() == 0
