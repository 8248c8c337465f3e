from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from punctual.operators import tables
from punctual.operators.text import word_count
from punctual.plans import sql
from punctual.schema import FLIGHT_COLUMNS, FLIGHT_SCHEMA
from punctual.operators.lookup import with_names
from punctual.sources import files, lookup, manifest

HEADER = '"Year","Month","FlightDate","Reporting_Airline","Origin","Dest","CRSDepTime","ArrDelay","Extra",'
ROWS = [
    '"2024","1","2024-01-05","AA","JFK","LAX","2400","-3.00","z",',
    '"2024","2.00","2024-02-06","DL","LAX","","0915"," 7.50 ","z",',
    '"x","1","bad","UA","SFO","JFK","","oops","z",',
]


@pytest.fixture
def raw(tmp_path):
    (tmp_path / "raw").mkdir()
    for i, row in enumerate(ROWS, 1):
        (tmp_path / "raw" / f"on_time_2024_{i}.csv").write_text(f"{HEADER}\n{row}\n")
    return str(tmp_path / "raw")


def test_conform(spark, raw, caplog):
    df = files.conform(files.read_raw_csv(spark, raw + "/*.csv"))
    assert df.columns == [*FLIGHT_COLUMNS, "Dep_Hour", "Route"]
    assert [f.dataType for f in df.schema][:-2] == [f.dataType for f in FLIGHT_SCHEMA]
    assert "column Tail_Number is absent" in caplog.text
    by = {r["Reporting_Airline"]: r for r in df.collect()}
    assert (by["AA"]["ArrDelay"], by["AA"]["Dep_Hour"], by["AA"]["Route"]) == (-3.0, 0, "JFK-LAX")
    assert (by["DL"]["Month"], by["DL"]["ArrDelay"], by["DL"]["Dep_Hour"], by["DL"]["Route"]) == (2, 7.5, 9, "LAX")
    bad = by["UA"]
    assert (bad["Year"], bad["FlightDate"], bad["ArrDelay"], bad["Dep_Hour"], bad["Tail_Number"]) == (None,) * 5


def test_strict_mode_refuses_bad_text(spark, raw):
    with pytest.raises(PySparkException):
        files.conform(files.read_raw_csv(spark, raw), mode="strict").collect()
    with pytest.raises(ValueError):
        files.conform(files.read_raw_csv(spark, raw), mode="other")


def test_years_can_be_replaced_one_by_one(spark, make_flights, tmp_path):
    path = str(tmp_path / "cleaned")
    assert files.write_flights(make_flights({"Year": 2022}, {"Year": 2023}, {"Year": 2023}), path) == 3
    files.write_flights(make_flights({"Year": 2023}), path, mode="replace_years")
    counts = {r["Year"]: r["count"] for r in files.read_flights(spark, path).groupBy("Year").count().collect()}
    assert counts == {2022: 1, 2023: 1}
    files.write_flights(make_flights({"Year": 2024}), path)
    assert files.read_flights(spark, path).select("Year").distinct().collect()[0]["Year"] == 2024
    assert files.read_flights(spark, path).columns[-1] == "Year"


def test_spread_write_keeps_every_row_and_bounds_files(spark, make_flights, tmp_path):
    rows = [{"Year": 2022 + i % 2, "Flight_Number_Reporting_Airline": str(i)} for i in range(60)]
    path = tmp_path / "cleaned"
    files.write_flights(make_flights(*rows), str(path), files_per_year=3, sort=("Month", "Origin"))
    assert files.read_flights(spark, str(path)).count() == 60
    for year in path.glob("Year=*"):
        assert 1 <= len(list(year.glob("*.parquet"))) <= 3


def test_year_filter_prunes_directories(spark, make_flights, tmp_path):
    path = str(tmp_path / "cleaned")
    files.write_flights(make_flights({"Year": 2022}, {"Year": 2023}), path)
    df = tables.calendar_delays(files.read_flights(spark, path).where(F.col("Year") == 2023))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Year" in plan
    assert df.first()["Year"] == 2023


def test_manifest(spark, raw):
    rows = {r["Month"]: r for r in manifest.raw_manifest(spark, raw, 2024, 2024, min_bytes=10, count_rows=True).collect()}
    assert len(rows) == 12
    assert (rows[1]["files"], rows[1]["rows"], rows[1]["ok"]) == (1, 1, True)
    assert (rows[4]["files"], rows[4]["bytes"], rows[4]["rows"], rows[4]["ok"]) == (0, 0, 0, False)
    big = manifest.raw_manifest(spark, raw, 2024, 2024)
    assert big.where("ok").isEmpty() and big.first()["rows"] is None


def test_missing_months(spark):
    df = spark.createDataFrame([(2022, m) for m in range(1, 13) if m != 5] + [(2024, 1)], "Year int, Month int")
    gaps = manifest.missing_months(df).where("Year = 2022").collect()
    assert [(r["Year"], r["Month"]) for r in gaps] == [(2022, 5)]
    assert manifest.missing_months(df).count() == 1 + 12 + 11
    assert manifest.missing_months(df, 2021, 2021).count() == 12
    covered = manifest.month_coverage(df)
    assert covered.count() == 36 and covered.where("ok").count() == 12


def test_csv_round_trip_and_inferred_types(spark, tmp_path):
    rows = files.rows_to_table(spark, [("purchase", 5), ("click", 12), ("view", 30)], ["action", "count"])
    files.write_csv(rows, str(tmp_path / "out"))
    text = files.read_raw_csv(spark, str(tmp_path / "out"))
    assert dict(text.dtypes) == {"action": "string", "count": "string"}
    typed = files.read_csv_inferred(spark, str(tmp_path / "out"))
    assert dict(typed.dtypes)["count"] == "int"
    assert sorted(map(tuple, typed.collect())) == sorted([("purchase", 5), ("click", 12), ("view", 30)])


def test_word_count_of_lines(spark, tmp_path):
    (tmp_path / "sample.txt").write_text("spark is great spark is fast\n  hdfs is reliable\n")
    counts = word_count(files.read_lines(spark, str(tmp_path / "sample.txt"))).collect()
    assert [(r["word"], r["count"]) for r in counts] == [
        ("is", 3), ("spark", 2), ("", 1), ("fast", 1), ("great", 1), ("hdfs", 1), ("reliable", 1),
    ]


def test_lookups(spark, tmp_path, make_flights):
    spark.createDataFrame([("AA", "American"), ("DL", "Delta")], "code string, name string").write.parquet(
        str(tmp_path / "carriers")
    )
    (tmp_path / "carriers.csv").write_text("Code,Description\nAA,American\n")
    assert lookup.read_lookup(spark, str(tmp_path / "carriers")).count() == 2
    dim = lookup.read_lookup(
        spark, str(tmp_path / "carriers.csv"), columns={"code": "Code", "name": "Description"}
    )
    fact = make_flights({}, {"Reporting_Airline": "ZZ"})
    names = {r["Reporting_Airline"]: r["Airline_Name"] for r in tables.airline_performance(fact, dim).collect()}
    assert names == {"AA": "American", "ZZ": "ZZ"}
    twice = tables.airline_performance(fact, dim.union(dim)).agg(F.sum("Total_Flights")).first()[0]
    assert twice == 2
    with pytest.raises(ValueError):
        lookup.read_lookup(spark)


def test_views(spark, make_flights):
    sql.register({"fact_view": make_flights({}, {"Reporting_Airline": "DL"}, {})})
    assert sql.total_rows(spark, "fact_view").first()["total_rows"] == 3
    assert sql.preview(spark, "fact_view", 2).count() == 2
    rows = sql.category_count(spark, "fact_view", "Reporting_Airline").collect()
    assert [tuple(r) for r in rows] == [("AA", 2), ("DL", 1)]
    assert "Reporting_Airline: string" in sql.schema_text(spark.table("fact_view"))


def test_mixed_headers_go_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Year,Origin,Dest\n2024,AAA,BBB\n")
    (tmp_path / "b.csv").write_text("Dest,Year,Origin\nDDD,2025,CCC\n")
    (tmp_path / "c.csv").write_text("Year,Dest\n2026,EEE\n")
    (tmp_path / "empty.csv").write_text("")
    rows = files.read_raw_csv(spark, str(tmp_path / "*.csv")).select("Year", "Origin", "Dest").collect()
    assert sorted(map(tuple, rows), key=str) == [("2024", "AAA", "BBB"), ("2025", "CCC", "DDD"), ("2026", None, "EEE")]
    with pytest.raises(files.HeaderError):
        files.read_raw_csv(spark, str(tmp_path), headers="same")
    with pytest.raises(FileNotFoundError):
        files.read_raw_csv(spark, str(tmp_path / "nothing"))


def test_manifest_reports_files_it_did_not_expect(spark, tmp_path):
    for name in ("x_2024_1.csv", "x_2031_2.csv", "notes.txt"):
        (tmp_path / name).write_text("a,b\n1,2\n")
    rows = manifest.raw_manifest(spark, str(tmp_path), 2024, 2024, min_bytes=1, count_rows=True).collect()
    assert len(rows) == 14 and sum(r["files"] for r in rows) == 3
    odd = {(r["Year"], r["Month"]): (r["files"], r["rows"], r["ok"]) for r in rows if r["Year"] != 2024}
    assert odd == {(2031, 2): (1, 1, False), (None, None): (1, 1, False)}


def test_large_tables_are_not_exported_through_one_task(spark, tmp_path):
    with pytest.raises(ValueError, match="more than 10 rows"):
        files.export_csv(spark.range(11), str(tmp_path), "t", most_rows=10)
    assert files.export_csv(spark.range(10), str(tmp_path), "t", most_rows=10)[1] == 10


def test_only_the_name_of_an_unknown_code_falls_back(spark):
    df = spark.createDataFrame([("AAA",), ("BBB",)], "code string")
    dim = spark.createDataFrame([("AAA", "Alpha", "A-town", "AL")] * 2, "code string, name string, city string, state string")
    rows = with_names(df, dim, "code", names={"Name": "name", "City": "city", "State": "state"}).collect()
    assert sorted(map(tuple, rows)) == [("AAA", "Alpha", "A-town", "AL"), ("BBB", "BBB", None, None)]


# ---- headers, guessed types and losses ------------------------------------------------------------


def test_headers_are_found_by_tasks(spark, tmp_path, monkeypatch):
    """Many small files of three headers, one with a byte order mark, odd names, empty files: no file is opened by the driver."""
    for k in range(300):
        folder = tmp_path / f"in {k % 7}"
        folder.mkdir(exist_ok=True)
        head, row = [("a,b", "{0},x"), ("b,a", "x,{0}"), ("﻿a,b,c", "{0},x,z")][k % 3]
        (folder / f"part[{k}] +{k}.csv").write_text(f"{head}\n{row.format(k)}\n" if k % 50 else "")
    monkeypatch.setattr(files, "hadoop_fs", None)
    df = files.read_raw_csv(spark, [str(tmp_path / f"in {k}") for k in range(7)])
    assert sorted(df.columns) == ["a", "b", "c"]
    rows = df.select("a", "b", "c").collect()
    assert sorted(int(r.a) for r in rows) == [k for k in range(300) if k % 50]
    assert {(r.b, r.c) for r in rows} == {("x", None), ("x", "z")}


def test_header_of_a_file_in_several_parts(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        (tmp_path / "big.csv").write_text("a,b\n" + "".join(f"{k},{k}\n" for k in range(500)))
        (tmp_path / "small.csv").write_text("b,a\n1000,1000\n")
        found = {r.file.rsplit("/", 1)[1]: r.header for r in files._first_lines(spark, [str(tmp_path)]).collect()}
        assert found == {"big.csv": "a,b", "small.csv": "b,a"}
        assert files.read_raw_csv(spark, str(tmp_path)).where("a = b").count() == 501
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_headers_of_packed_files(spark, tmp_path, monkeypatch):
    """Of a packed file one line leaves the JVM, whatever its size: no other file comes before it in its task."""
    for k, columns in enumerate((["a", "b"], ["b", "a"], ["a", "b"])):
        rows = spark.range(60_000).select(F.xxhash64("id").alias("a"), (F.col("id") + k).alias("b"))
        files.write_csv(rows.select(*columns).coalesce(2), f"{tmp_path}/{k}", compression="gzip")
    assert all(f.name.endswith(".csv.gz") for f in tmp_path.glob("*/part-*"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")  # files of half as much
    seen, first_lines = [], files._first_lines

    def counted(*args):
        lines = first_lines(*args)
        seen.append(lines._jdf.queryExecution().executedPlan().execute().getNumPartitions())
        return lines

    monkeypatch.setattr(files, "_first_lines", counted)
    try:
        back = files.read_raw_csv(spark, [f"{tmp_path}/{k}" for k in range(3)])
        assert back.count() == 180_000 and back.where("CAST(b AS BIGINT) BETWEEN 0 AND 60001").count() == 180_000
        # nine bytes a row and more: a file beyond what may share a task, with three of them in no task together
        assert min(f.stat().st_size for f in tmp_path.glob("*/part-*")) > (1 << 20) // 32 and seen == [6]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_names_of_a_header():
    assert files.header_names('"a b",,A,a b,"x,y",') == ["a b0", "_c1", "A", "a b3", "x,y", "_c5"]


def test_types_are_guessed_by_name(spark, tmp_path):
    (tmp_path / "1.csv").write_text("i,big,d,day,at,flag,text,none\n1,1,1,2024-01-05,2024-01-05 10:00,true,2024,\n-7,2, 2.5 ,2024-1-6,2024-01-05T10:00:01Z,False,x,\n")
    (tmp_path / "2.csv").write_text("text,none,i,d,flag,at,day,big\n3,,,.5,TRUE,,,3000000000\n\"\",,0012,1e3,,,,\n")
    df = files.read_csv_inferred(spark, str(tmp_path))
    assert dict(df.dtypes) == {"i": "int", "big": "bigint", "d": "double", "day": "date", "at": "timestamp", "flag": "boolean", "text": "string", "none": "string"}
    assert df.agg(F.sum("i"), F.sum("d"), F.count("day"), F.max("big"), F.count("text")).first()[:] == (6, 1004.0, 2, 3_000_000_000, 3)
    (tmp_path / "3.csv").write_text("i,day\nNaN,2024-13-01\n")
    assert dict(files.read_csv_inferred(spark, str(tmp_path)).dtypes)["i"] == dict(files.read_csv_inferred(spark, str(tmp_path)).dtypes)["day"] == "string"


def test_every_loss_is_counted(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text("Year,Month,ArrDelay,Origin\n2024,1,5,AAA\n2x24,2,oops,BBB\n2024,3\n2024,4, ,CCC\n2024,5,1.00,DDD,more\n")
    (raw / "b.csv").write_text("Origin,Year\nEEE,2023\nFFF,\n")
    (raw / "c.csv").write_text("Year,Month\n")
    got = files.load_raw(spark, str(raw), str(tmp_path / "cleaned"), str(tmp_path / "rejects")).collect()
    assert {(r.file.rsplit("/", 1)[1], r.rows_in, r.rows_out, r.rejected, tuple(sorted((r.lost or {}).items()))) for r in got} == {
        ("a.csv", 5, 3, 2, (("ArrDelay", 1), ("Year", 1))),
        ("b.csv", 2, 2, 0, ()),
    }
    kept = files.read_flights(spark, str(tmp_path / "cleaned"))
    assert sorted((r.Origin, r.Year, r.ArrDelay) for r in kept.collect()) == [("AAA", 2024, 5.0), ("BBB", None, None), ("CCC", 2024, None), ("EEE", 2023, None), ("FFF", None, None)]
    assert set(kept.columns) == {*FLIGHT_COLUMNS, "Dep_Hour", "Route"}
    assert sorted(r.line for r in spark.read.parquet(str(tmp_path / "rejects")).collect()) == ["2024,3", "2024,5,1.00,DDD,more"]


@pytest.mark.parametrize("sink", ["write_flights", "write_csv", "cut"])
def test_writes_neither_sort_by_folder_nor_leave_methods_to_the_interpreter(spark, tmp_path, sink):
    """What the tasks of a write see of the settings; the session has its own again afterwards."""
    from pyspark import TaskContext
    from punctual import runtime

    def seen(batches):
        for batch in batches:
            for c, key in (("open", "spark.sql.maxConcurrentOutputFileWriters"), ("method", "spark.sql.codegen.hugeMethodLimit")):
                batch[c] = TaskContext.get().getLocalProperty(key)
            yield batch[["Year", "open", "method"]]

    rows = spark.createDataFrame([(2000 + k % 3,) for k in range(30)], "Year int").coalesce(1)
    df, path = rows.mapInPandas(seen, "Year int, open string, method string"), str(tmp_path / "out")
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "7")  # the session's own setting stays
    try:
        if sink == "write_csv":
            files.write_csv(df, path)
            back = spark.read.option("header", True).csv(path)
        elif sink == "write_flights":
            assert files.write_flights(df, path) == 30
            back = spark.read.parquet(path)
        else:
            back = runtime.cut(df, "Year", path)
        assert {tuple(r) for r in back.select("open", "method").collect()} == {("7", "8000")}
        spark.conf.unset("spark.sql.maxConcurrentOutputFileWriters")
        back = runtime.cut(df, "Year", f"{path}2")
        assert {tuple(r) for r in back.select("open", "method").collect()} == {("64", "8000")}
        assert sorted(r[0] for r in back.select("Year").collect()) == sorted(2000 + k % 3 for k in range(30))
    finally:
        spark.conf.unset("spark.sql.maxConcurrentOutputFileWriters")
    assert all(spark.conf.get(key, None) is None for key in runtime.WRITING)


def test_raw_text_to_be_typed_is_written_once(spark, sf_dir, monkeypatch):
    from punctual.plans import catalog

    write, written = catalog.cut, []
    monkeypatch.setattr(catalog, "cut", lambda df, *a, **k: written.append(df.columns) or write(df, *a, **k))
    assert "CarrierDelay" in catalog.QUERIES["conform_flights"](spark, sf_dir).columns
    assert len(written) == 1
