"""The commands, one after another, on a small raw folder."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from punctual import runtime
from punctual.__main__ import main
from punctual.plans.demo import COLUMNS, flights
from punctual.schema import CONTRACTS
from punctual.sources import files


def test_jobs_in_order(spark, sf_dir, tmp_path, capsys):
    columns = [c for c in COLUMNS if c not in ("Dep_Hour", "Route")]
    raw = flights(spark, sf_dir, *columns).select(*[F.col(c).cast("string").alias(c) for c in columns])
    files.write_csv(raw, f"{tmp_path}/raw")
    main(["etl", f"{tmp_path}/raw", f"{tmp_path}/cleaned", "--files-per-year", "2"], spark)
    assert f"{raw.count()} rows" in capsys.readouterr().out
    main(["aggregate", f"{tmp_path}/cleaned", f"{tmp_path}/csv"], spark)
    assert "false" not in capsys.readouterr().out
    main(["train", f"{tmp_path}/cleaned", f"{tmp_path}/csv", "--models", "lr", "--split", "hash", "--limit", "40"], spark)
    out = capsys.readouterr().out
    assert "auc_roc" in out and "40 rows" in out
    main(["load", f"{tmp_path}/csv", f"{tmp_path}/serving"], spark)
    for name in CONTRACTS:
        assert spark.read.parquet(f"{tmp_path}/serving/{name}").schema == CONTRACTS[name].schema
    main(["explore", f"{tmp_path}/csv/agg_hourly_delays.csv", "--column", "Dep_Hour"], spark)
    assert "total_rows" in capsys.readouterr().out


def test_words(spark, tmp_path):
    (tmp_path / "in.txt").write_text("a b a\n")
    main(["words", f"{tmp_path}/in.txt", f"{tmp_path}/out"], spark)
    assert [tuple(r) for r in files.read_raw_csv(spark, f"{tmp_path}/out").collect()] == [("a", "2"), ("b", "1")]


def test_unknown_job_is_refused():
    with pytest.raises(SystemExit):
        main(["schedule"])


@pytest.mark.parametrize("master,refused", [("local", False), ("local[4]", False), ("local-cluster[2,1,1024]", True), ("spark://host:7077", True)])
def test_a_folder_of_one_machine_is_refused_on_a_cluster(spark, tmp_path, master, refused):
    conf = {"spark.sql.warehouse.dir": f"file:{tmp_path}/"}
    context = SimpleNamespace(master=master, _jvm=spark.sparkContext._jvm, _jsc=spark.sparkContext._jsc)
    session = SimpleNamespace(conf=conf, sparkContext=context)
    if refused:
        with pytest.raises(ValueError):
            runtime.shared_dir(session)
    else:
        assert runtime.shared_dir(session) == f"file:{tmp_path}/_intermediate"
    conf["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert runtime.shared_dir(session) == "hdfs:///shared"
