from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.sources import csv, tables


def test_directory_skips_bad_files(spark, tmp_path):
    (tmp_path / "good.csv").write_text('id,zip,note,price,flag\n1,01037,"two\nlines ""q""",1.5,True\n2,NA,None,3,false\n')
    (tmp_path / "latin.csv").write_bytes("id,c\n1,São\n".encode("latin-1"))
    (tmp_path / "long.csv").write_text("id,c\n1,2\n1,2,3\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "bom.csv").write_bytes(b"\xef\xbb\xbfname,english\nbebes,baby\n")
    (tmp_path / "notes.txt").write_text("x")
    got = csv.read_csv_dir(spark, str(tmp_path), multi_line={"good"})
    assert set(got) == {"good", "bom"}
    assert got["bom"].columns == ["name", "english"]
    assert [f.dataType.simpleString() for f in got["good"].schema] == ["bigint", "bigint", "string", "double", "boolean"]
    assert [tuple(r) for r in got["good"].collect()] == [
        (1, 1037, 'two\nlines "q"', 1.5, True), (2, None, None, 3.0, False)
    ]


def test_long_digit_strings_stay_text(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n123456789012345678901,1e3\n2,.5\n")
    got = csv.read_csv_dir(spark, str(tmp_path))["t"]
    assert [tuple(r) for r in got.collect()] == [("123456789012345678901", 1000.0), ("2", 0.5)]


def test_directory_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        csv.read_csv_dir(spark, str(tmp_path / "none"))
    assert csv.read_csv_dir(spark, str(tmp_path)) == {}
    (tmp_path / "a.csv").write_text("")
    with pytest.raises(RuntimeError):
        csv.read_csv_dir(spark, str(tmp_path))


def test_given_schema(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n01,2\n")
    schema = T.StructType.fromDDL("a string, b double")
    assert csv.read_csv_dir(spark, str(tmp_path), {"t": schema})["t"].first() == ("01", 2.0)


def test_bad_record_budget(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    (tmp_path / "t.csv").write_text("a,b\n1,2.5\nx,1\n3,y\n4,4\n")
    schema = T.StructType.fromDDL("a int, b double")
    good, bad = csv.load_csv_with_bad_record_budget(spark, path, schema, max_bad=2)
    assert sorted(map(tuple, good.collect())) == [(1, 2.5), (4, 4.0)]
    assert sorted(r.record for r in bad.collect()) == ["3,y", "x,1"]
    with pytest.raises(ValueError, match="2 bad rows"):
        csv.load_csv_with_bad_record_budget(spark, path, schema, max_bad=1)


def test_seed_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "s.csv").write_bytes(b"\xef\xbb\xbfproduct_category_name,product_category_name_english\nbebes,baby\n")
    assert csv.read_seed(spark, str(tmp_path / "s.csv")).collect() == [("bebes", "baby")]


def test_frames(spark, tmp_path):
    directory = str(tmp_path / "frames")
    tables.write_frames({"a": spark.range(3), "b": spark.range(2)}, directory)
    (tmp_path / "frames" / "readme.txt").write_text("x")
    got = tables.read_frames(spark, directory)
    assert {n: df.count() for n, df in got.items()} == {"a": 3, "b": 2}
    with pytest.raises(TypeError):
        tables.write_frames([spark.range(1)], directory)
    with pytest.raises(TypeError):
        tables.write_frames({"a": 1}, directory)
    with pytest.raises(FileNotFoundError):
        tables.read_frames(spark, str(tmp_path / "none"))
    tables.write_frames({}, str(tmp_path / "empty"), spark)
    assert tables.read_frames(spark, str(tmp_path / "empty")) == {}


def test_write_table_overwrites(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(3), path)
    assert tables.write_table(spark.range(5), path).count() == 5


def test_validation_and_report(spark, tmp_path):
    ok = spark.createDataFrame([("a",)], "customer_id string")
    holes = spark.createDataFrame([("a",), (None,)], "customer_id string")
    with pytest.raises(ValueError, match="empty"):
        tables.validate_frame(ok.limit(0))
    with pytest.raises(ValueError, match="customer_id"):
        tables.validate_frame(holes)
    with pytest.raises(tables.LoadError) as caught:
        tables.load_report({"a-b.c.csv": ok, "holes": holes}, str(tmp_path), offset_hours=0)
    report = {r["table"]: (r.status, r.rows) for r in caught.value.report.collect()}
    assert report == {"a_b_c": ("loaded", 1), "holes": ("skipped", None)}
    assert "load_date" in spark.read.parquet(str(tmp_path / "a_b_c")).columns


def test_each_table_is_computed_once_and_bad_ones_leave_the_old(spark, tmp_path):
    """Rows are counted where they are computed; the write is the only job that computes them."""
    seen = {name: spark.sparkContext.accumulator(0) for name in ("good", "holes")}

    def frame(name, missing):
        count = seen[name]

        def touch(batches):
            for b in batches:
                count.add(len(b))
                yield b

        return spark.range(100).selectExpr(f"CASE WHEN id >= {missing} THEN CAST(id AS STRING) END AS customer_id").mapInPandas(
            touch, "customer_id string"
        )

    target = str(tmp_path / "out")
    tables.load_report({"holes": spark.createDataFrame([("old",)], "customer_id string")}, target)
    frames = {"good": frame("good", 0), "holes": frame("holes", 3), "none": spark.range(1).limit(0), "empty": spark.range(0)}
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))
    report = {r["table"]: r for r in tables.load_report({**frames, "broken": broken}, target, strict=False).collect()}
    assert {n: (r.status, r.rows) for n, r in report.items()} == {
        "good": ("loaded", 100), "holes": ("skipped", None), "none": ("skipped", None), "empty": ("skipped", None), "broken": ("failed", None)
    }
    assert report["holes"].error == "null values in customer_id" and report["none"].error == report["empty"].error == "empty table"
    assert {n: a.value for n, a in seen.items()} == {"good": 100, "holes": 100}
    assert spark.read.parquet(f"{target}/holes").collect() == [("old",)]
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["good", "holes"]


def test_shared_folder_comes_from_the_session(spark):
    from martloom.session import materialize, shared_dir

    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_dir(spark) == named
    kept = materialize(spark.range(4).withColumn("x", F.lit("y")))
    assert kept.count() == 4 and shared_dir(spark) in kept.inputFiles()[0]


def test_recorded_scratch_is_dropped_alone(spark):
    from martloom.session import drop_scratch, materialize, recorded_scratch

    kept = materialize(spark.range(3))
    with recorded_scratch() as paths:
        gone = materialize(spark.range(4))
        stored = materialize(gone.filter("id > 0"))
    outside = materialize(spark.range(5))
    assert len(paths) == 2 and all(any(f.startswith(("file:" + p, "file://" + p, p)) for p in paths) for f in gone.inputFiles())
    drop_scratch(spark, [p for p in paths if not any(p in f for f in stored.inputFiles())])
    assert (kept.count(), stored.count(), outside.count()) == (3, 3, 5)
    with pytest.raises(Exception, match="FILE_NOT_EXIST|not exist"):
        spark.read.schema("id long").parquet(paths[0]).count()


def test_bad_rows_stay_bad_whatever_is_selected(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,price,name\n1,2.5,a\n2,oops,b\n3,4,c\n4,5,d,e\n")
    schema = "id long, price double, name string"
    good, bad = csv.load_csv_with_bad_record_budget(spark, str(tmp_path / "t.csv"), T.StructType.fromDDL(schema), max_bad=2)
    assert good.count() == 2 and sorted(r.id for r in good.select("id").collect()) == [1, 3]
    assert good.groupBy().sum("id").first()[0] == 4 and bad.count() == 2


def test_a_file_that_breaks_its_schema_is_skipped(spark, tmp_path):
    (tmp_path / "good.csv").write_text("id,price\n1,2.5\n2,\n")
    (tmp_path / "bad.csv").write_text("id,price\n1,oops\n")
    (tmp_path / "other.csv").write_text("id,cost\n1,2\n")
    (tmp_path / "quoted.csv").write_text('id,price\n1,"2\n3"\n')
    schema = T.StructType.fromDDL("id long, price double")
    got = csv.read_csv_dir(spark, str(tmp_path), {n: schema for n in ("good", "bad", "other")})
    assert list(got) == ["good"] and got["good"].count() == 2
    assert csv.read_csv_table(spark, str(tmp_path / "quoted.csv"), multi_line=True).count() == 1


def test_a_load_with_a_budget_reads_the_lines_once(spark, tmp_path):
    """One pass over the lines: what it parses to is equal to what Spark's reader makes of the file, in any part file."""
    folder = tmp_path / "t.csv"
    folder.mkdir()
    (folder / "a.csv").write_text('\ufeffid,price,name\n1,2.5,"a, ""b"""\n\n2,oops,b\n', encoding="utf-8")
    (folder / "b.csv").write_text("id,price,name\n3,,é\n4,5\n5,1,c,d\n", encoding="utf-8")
    schema = T.StructType.fromDDL("id long, price double, name string")
    good, bad = csv.load_csv_with_bad_record_budget(spark, str(folder), schema, max_bad=3)
    assert sorted(map(tuple, good.collect())) == [(1, 2.5, 'a, "b"'), (3, None, "é")]
    assert sorted(r.record for r in bad.collect()) == ["2,oops,b", "4,5", "5,1,c,d"]
    rows, _ = csv._parsed_lines(spark, str(folder), T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())]))
    assert rows._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1
    with pytest.raises(ValueError, match="3 bad rows exceed the budget of 2"):
        csv.load_csv_with_bad_record_budget(spark, str(folder), schema, max_bad=2)
    whole, none = csv.load_csv_with_bad_record_budget(spark, str(folder / "b.csv"), T.StructType.fromDDL("x string, y string, z string"))
    assert whole.count() == 1 and none.count() == 2
    (tmp_path / "only-header.csv").write_text("id,price,name\n")
    good, bad = csv.load_csv_with_bad_record_budget(spark, str(tmp_path / "only-header.csv"), schema)
    assert good.count() == bad.count() == 0 and good.columns == ["id", "price", "name"]
    (tmp_path / "latin.csv").write_bytes("id,price,name\n1,2,é\n".encode("latin-1"))
    with pytest.raises(ValueError, match="1 lines are not UTF-8"):
        csv.load_csv_with_bad_record_budget(spark, str(tmp_path / "latin.csv"), schema)


def test_one_pass_tells_all_about_a_table(spark, tmp_path):
    """Bytes, widths and types are looked at in one scan of all part files, and the rows are those of Spark's reader."""
    folder = tmp_path / "t.csv"
    folder.mkdir()
    for i in range(6):
        body = f'{i},2.5,"a, ""{i}""",true\n\n  \n{i + 10},,é,\n{i + 20},1e3\n'
        (folder / f"{i}.csv").write_text("\ufeffid,price,a.name,flag\n" + body, encoding="utf-8")
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    context.setJobGroup("one-pass", "one-pass")
    try:
        got = csv.read_csv_table(spark, str(folder))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    stages = {s for j in tracker.getJobIdsForGroup("one-pass") for s in tracker.getJobInfo(j).stageIds}
    # The header comes from a single task; what reads all part files has a task for each.
    assert sum(1 for s in stages if (info := tracker.getStageInfo(s)) and info.numCompletedTasks >= 6) == 1
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "double", "string", "boolean"]
    reader = spark.read.option("escape", '"').csv(str(folder), header=True, schema=got.schema, enforceSchema=True)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, reader.collect()), key=str) and got.count() == 18
    assert got.select("price").distinct().count() == 3


def test_what_makes_a_table_unreadable(spark, tmp_path):
    def fails(name, data, match, **options):
        (tmp_path / name).write_bytes(data)
        with pytest.raises(ValueError, match=match):
            csv.read_csv_table(spark, str(tmp_path / name), **options)

    fails("head.csv", "é,b\n1,2\n".encode("latin-1"), "header is not UTF-8")
    fails("body.csv", "a,b\né,2\n".encode("latin-1"), "1 lines are not UTF-8")
    fails("open.csv", b'a,b\n1,"2\n3"\n', "span lines")
    fails("open-head.csv", b'a,"b\nc"\n1,2\n', "spans lines")
    fails("wide.csv", b"a,b\n1,2,3\n", "1 lines have more cells")
    fails("misfit.csv", b"a,b\n1,x\n", "misfits|do not fit", schema=T.StructType.fromDDL("a long, b long"))
    fails("bytes.csv", 'a,b\n"é\n",2\n'.encode("latin-1"), "not UTF-8", multi_line=True)
    fails("none.csv", b"", "no header|not")
    # A header within the data, as in files that were joined, is a header.
    (tmp_path / "joined.csv").write_text("a,b\n1,2\na,b\n3,NULL\n")
    assert csv.read_csv_table(spark, str(tmp_path / "joined.csv")).collect() == [(1, 2), (3, None)]
    (tmp_path / "head-only.csv").write_text("a,b\n")
    empty = csv.read_csv_table(spark, str(tmp_path / "head-only.csv"))
    assert empty.count() == 0 and empty.columns == ["a", "b"]
    unchecked = csv.read_csv_table(spark, str(tmp_path / "wide.csv"), T.StructType.fromDDL("a long, b long"), verify=False)
    assert unchecked.collect() == [(1, 2)]


def test_budgeted_queries_load_more_bad_rows_than_the_usual_budget(spark, tmp_path):
    from martloom.plans.catalog import QUERIES

    keys = spark.range(1, 1102).selectExpr("CASE WHEN id <= 1001 THEN id * 997 ELSE id * 997 + 1 END AS o_orderkey")
    orders = keys.selectExpr("o_orderkey", "1L AS o_custkey", "2.5D AS o_totalprice", "'1-URGENT' AS o_orderpriority")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    assert tuple(QUERIES["load_csv_row_counts"](spark, str(tmp_path)).first()) == (100, 1001)
    assert QUERIES["load_csv_good_keys"](spark, str(tmp_path)).filter("o_orderkey % 997 = 1").count() == 100
    assert QUERIES["load_csv_with_bad_record_budget"](spark, str(tmp_path)).count() == 100


def test_types_take_one_aggregate_per_column(spark, tmp_path):
    """More would make a line's code too long for the JVM to compile it."""
    assert len(csv._facts_about(["a", "b", "c"], {})) == 1 + 3
    columns = {
        "whole": ["1", " -2 ", "+3"], "huge": ["1", "99999999999999999999", ""], "mixed": ["7", "1e3", ".5"],
        "huge_mixed": ["99999999999999999999", "1.5", "2"], "yes": ["true", "FALSE", ""], "yes_or_one": ["true", "1", ""],
        "odd": ["1", "1.2.3", "4"], "none": ["", "NA", "null"],
    }
    lines = [",".join(columns), *[",".join(cells) for cells in zip(*columns.values(), strict=True)]]
    (tmp_path / "kinds.csv").write_text("\n".join(lines) + "\n")
    assert dict(csv.read_csv_table(spark, f"{tmp_path}/kinds.csv").dtypes) == {
        "whole": "bigint", "huge": "string", "mixed": "double", "huge_mixed": "double", "yes": "boolean", "yes_or_one": "string",
        "odd": "string", "none": "double",
    }
