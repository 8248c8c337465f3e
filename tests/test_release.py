from __future__ import annotations

import pytest
from flights import CANCELLED, LATE

from punctual.operators import checks, incremental, tables
from punctual.runtime import hadoop_fs
from punctual.sources import files, release as releases
from punctual.sources.publish import PublishError


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x int")


def state(spark, target, version=None):
    return {n: sorted(r.x for r in df.collect()) for n, df in releases.read_release(spark, target, version).items()}


def test_versions_stay_readable_and_tables_are_carried_over(spark, tmp_path):
    target = str(tmp_path)
    assert releases.read_release(spark, target) == {} and releases.versions(spark, target) == []
    assert releases.release(spark, {"a": rows(spark, 1), "b": rows(spark, 2, 2)}, target, contract=False) == 1
    assert releases.release(spark, {"a": rows(spark, 3), "b": None, "c": rows(spark)}, target, contract=False) == 2
    assert state(spark, target) == state(spark, target, 2) == {"a": [3], "b": [2, 2], "c": []}
    assert state(spark, target, 1) == {"a": [1], "b": [2, 2]}
    assert releases.release(spark, {"c": rows(spark, 9)}, target, carry=False, contract=False) == 3
    assert state(spark, target) == {"c": [9]}
    with pytest.raises(PublishError):
        releases.read_release(spark, target, 7)


@pytest.mark.parametrize("stop_at", ["a", "b", "c", "pointer", "half a pointer"])
def test_a_run_that_stops_anywhere_leaves_the_release_before(spark, tmp_path, monkeypatch, stop_at):
    target = str(tmp_path)
    old = {n: rows(spark, k) for k, n in enumerate("abc")}
    releases.release(spark, old, target, contract=False)
    before = state(spark, target)
    write, point = releases._write, releases._point

    def stops(df, name, path, contract):
        if name == stop_at:
            raise KeyboardInterrupt
        return write(df, name, path, contract)

    def breaks(spark, target, version, entries):
        if stop_at == "half a pointer":
            fs, path = hadoop_fs(spark, f"{target}/releases/{version:012d}.json")
            out = fs.create(path, False)
            out.write(bytearray(b'{"version": 2, "tables": {"a": '))
            out.close()
        raise KeyboardInterrupt

    monkeypatch.setattr(releases, "_write", stops)
    if "pointer" in stop_at:
        monkeypatch.setattr(releases, "_point", breaks)
    with pytest.raises(KeyboardInterrupt):
        releases.release(spark, {n: rows(spark, 100) for n in "abc"}, target, contract=False)
    assert state(spark, target) == before
    monkeypatch.setattr(releases, "_write", write)
    monkeypatch.setattr(releases, "_point", point)
    latest = releases.release(spark, {"b": rows(spark, 7)}, target, contract=False)
    assert state(spark, target) == {**before, "b": [7]} and latest == (3 if stop_at == "half a pointer" else 2)
    # the folder of the first release still serves two tables
    assert len(releases.vacuum(spark, target, keep=1)) == (1 if stop_at == "half a pointer" else 0)


def test_number_taken_by_another_run(spark, tmp_path, monkeypatch):
    target, point = str(tmp_path), releases._point

    def late(spark, target, version, entries):
        if version == 1:
            point(spark, target, 1, {"other": {"path": "data/none", "rows": 0}})
        return point(spark, target, version, entries)

    monkeypatch.setattr(releases, "_point", late)
    assert releases.release(spark, {"a": rows(spark, 1)}, target, contract=False) == 2
    assert releases.versions(spark, target) == [1, 2] and set(releases._entries(spark, target, 2)) == {"a", "other"}


def test_vacuum(spark, tmp_path):
    target = str(tmp_path)
    for k in range(4):
        releases.release(spark, {"a": rows(spark, k), "b": rows(spark, k) if k == 1 else None}, target, contract=False)
    assert len(releases.vacuum(spark, target, keep=2)) == 1  # that of the second holds b
    assert releases.versions(spark, target) == [3, 4]
    assert state(spark, target) == {"a": [3], "b": [1]} and state(spark, target, 3) == {"a": [2], "b": [1]}
    assert releases.vacuum(spark, target, keep=2) == []


# ---- incremental tables -------------------------------------------------------------------------


def months(make_flights):
    return make_flights(
        {"Month": 1}, {"Month": 1, **LATE}, {"Month": 2, "Origin": "CCC", "OriginCityName": "Gamma, GA"}, {"Month": 2, **CANCELLED, "CancellationCode": "B"},
        {"Year": 2023, "Month": 12, "Reporting_Airline": "BB", **LATE}, {"Year": 2023, "Month": 12, "Dest": "DDD"}, {"Month": 3, "Dep_Hour": None},
    )


def all_rows(made):
    return {n: sorted(map(str, df.collect())) for n, df in made.items()}


@pytest.mark.parametrize("how", ["left", "full"])
def test_steps_equal_one_run(spark, make_flights, tmp_path, how):
    fact, store = months(make_flights), str(tmp_path / "store")
    incremental.refresh(fact.where("ArrDel15 = 1"), store, [(2024, 1), (2023, 12)])  # half of it first
    incremental.refresh(fact, store, [(2024, 2), (2024, 3)])
    for _ in range(2):
        sums = incremental.refresh(fact, store, [(2024, 1), (2023, 12), (2024, 1)])
    want = all_rows(tables.all_tables(fact, how=how))
    assert all_rows(incremental.tables_from_store(sums, how=how)) == want
    assert checks.reconcile_totals(incremental.tables_from_store(sums)).where("NOT Agrees").count() == 0


def test_a_month_without_flights_disappears(spark, make_flights, tmp_path):
    fact, store = months(make_flights), str(tmp_path / "store")
    every = [(2024, 1), (2024, 2), (2024, 3), (2023, 12)]
    incremental.refresh(fact, store, every)
    left = fact.where("NOT (Year = 2024 AND Month = 2)")
    sums = incremental.refresh(left, store, [(2024, 2), (1999, 1)])
    assert all_rows(incremental.tables_from_store(sums)) == all_rows(tables.all_tables(left))
    assert all_rows(incremental.tables_from_store(incremental.refresh(fact, store, []))) == all_rows(tables.all_tables(left))


def test_a_load_reads_its_months_alone(spark, make_flights, tmp_path):
    path = str(tmp_path / "fact")
    files.write_flights(months(make_flights), path)
    chosen = incremental.months_of(files.read_flights(spark, path), [(2024, 1), (2024, 3)])
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Year" in plan or "PartitionFilters: [(Year" in plan, plan
    assert {f.rsplit("Year=", 1)[1][:4] for f in files.read_flights(spark, path).where("Year = 2024").inputFiles()} >= {"2024"}
    assert chosen.count() == 3
