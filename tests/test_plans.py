"""The shape of the physical plans, which is what carries the queries to large data."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from punctual.operators import tables
from punctual.plans.catalog import fact
from punctual.plans.demo import flights
from punctual.sources import files


@pytest.fixture(scope="module")
def cleaned(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cleaned"))
    files.write_flights(flights(spark, sf_dir), path)
    return files.read_flights(spark, path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


SINGLE = [t for t in tables.READS if t != "all_tables"]


@pytest.mark.parametrize("name", SINGLE)
def test_one_scan_of_few_columns_with_hash_aggregates(cleaned, name):
    text = plan(getattr(tables, name)(cleaned))
    assert text.count("FileScan parquet") == 1
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    read = set(re.search(r"ReadSchema: struct<([^>]*)>", text).group(1).replace("...", "").split(","))
    assert len(read) <= len(tables.READS[name])
    # The aggregate next to the scan must not sort the fact.
    lowest = text[: text.index("FileScan")].rstrip().splitlines()
    below = [line for line in lowest if "Aggregate" in line][-1]
    assert "HashAggregate" in below and "partial_sum" in below


def test_row_filters_reach_the_scan(cleaned):
    assert "EqualTo(Cancelled,1" in plan(tables.cancellation_reasons(cleaned))
    causes = plan(tables.delay_causes_monthly(cleaned))
    assert all(f"EqualTo({c}" in causes for c in ("Cancelled,0", "Diverted,0", "ArrDel15,1"))


def test_all_grains_from_one_scan(cleaned):
    text = plan(tables.grain_sums(cleaned))
    assert text.count("FileScan parquet") == 1 and text.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in text


def test_demo_fact_joins_only_what_is_read(spark, sf_dir):
    assert "Join" not in plan(tables.hourly_delays(fact(spark, sf_dir, "hourly_delays")))
    airline = plan(tables.airline_performance(fact(spark, sf_dir, "airline_performance")))
    assert airline.count("Join") == 1 and "part.parquet" in airline
    assert flights(spark, sf_dir, "Dep_Hour").count() == flights(spark, sf_dir).count()


def test_hot_join_key_is_split(spark, tmp_path):
    """A third of all lines under one order: adaptive execution splits that partition for the lookup join."""
    from pyspark.sql import functions as F

    lines = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("l_orderkey"),
        (F.col("id") % 100).alias("l_partkey"),
        (F.col("id") % 10).alias("l_suppkey"),
        F.lit(1).alias("l_linenumber"),
        F.lit(100.0).alias("l_extendedprice"),
        F.lit("N").alias("l_returnflag"),
        F.current_timestamp().alias("l_shipdate"),
    )
    lines.repartition(8).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = spark.range(60000).select(F.col("id").alias("o_orderkey"), (F.col("id") % 50).alias("o_custkey"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(50).select(F.col("id").alias("c_custkey"), (F.col("id") % 5).cast("int").alias("c_nationkey")).write.parquet(
        f"{tmp_path}/customer.parquet"
    )
    spark.range(5).selectExpr("CAST(id AS INT) n_nationkey", "concat('N', id) n_name", "0 AS n_regionkey").write.parquet(
        f"{tmp_path}/nation.parquet"
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = flights(spark, str(tmp_path), "Dest").groupBy("Dest").count()
        assert sum(r["count"] for r in df.collect()) == 60000
        assert "skew=true" in plan(df)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_large_lookup_is_not_broadcast(cleaned, spark):
    """No join is forced: over the size threshold the dimension is shuffled."""
    carriers = spark.createDataFrame([("AA", "American")], "code string, name string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(tables.airline_performance(cleaned, carriers))
        assert "Broadcast" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_generated_methods_of_the_typing_query_are_small_enough_to_compile(spark, sf_dir):
    """HotSpot leaves methods of more than 8,000 bytes to the interpreter."""
    from punctual.plans.catalog import QUERIES

    text = QUERIES["conform_flights"](spark, sf_dir)._jdf.queryExecution().debug().codegenToSeq().toString()
    sizes = [int(x) for x in re.findall(r"ByteCodeStats\((\d+),", text)]
    assert sizes and max(sizes) < 8000


def test_sampled_predictions_are_scored_after_the_draw(spark, sf_dir, monkeypatch):
    """The row filter of the sample lies below the model in the plan."""
    from punctual.ml import features, models
    from punctual.operators import ranking
    from punctual.plans.catalog import _training

    train, test = features.split_hash(_training(spark, sf_dir))
    scored = models.score(models.train(train, "lr", max_iter=1), test)
    written, write = [], ranking.cut
    monkeypatch.setattr(ranking, "cut", lambda df: written.append(plan(df)) or write(df))
    models.predictions(scored, 10)
    (text,) = written  # the rows up to the slot of the last one drawn; the result reads these
    draw = re.search(r"Filter \(+[^\n]*md5\(", text)
    assert draw and text.index("rawPrediction") < draw.start()


@pytest.mark.parametrize(
    "name",
    [
        "conform_flights", "csv_etl", "csv_mixed_headers", "delay_model_scores", "export_and_load", "feature_importance",
        "parquet_by_year", "pr_area", "publish_all", "raw_manifest_files", "raw_manifest_months", "reconcile_totals",
        "roc_auc_by_rank", "split_sizes", "stream_accounting", "stream_live_metrics", "stream_late_rows", "release_versions",
        "csv_losses", "csv_inferred", "incremental_totals",
    ],
)
def test_queries_leave_no_folder_behind(spark, sf_dir, name):
    """What a result still reads is noted for deletion; all else is gone when the query returns."""
    from pathlib import Path

    from punctual import runtime
    from punctual.plans.catalog import QUERIES

    shared = Path(runtime.shared_dir(spark))
    before, noted = {p.name for p in shared.iterdir()}, len(runtime._kept)
    QUERIES[name](spark, sf_dir).count()
    for fs, path in runtime._kept[noted:]:
        fs.delete(path, True)
    del runtime._kept[noted:]
    assert {p.name for p in shared.iterdir()} == before


def _shuffle_files(spark) -> int:
    held = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return sum(held.apply(k).getName().startswith("shuffle_") for k in range(held.size()))


def test_shuffle_files_go_with_the_write(spark):
    from punctual.runtime import cut

    before = _shuffle_files(spark)
    out = cut(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count())
    assert _shuffle_files(spark) <= before
    assert out.count() == 100


def test_raw_files_of_the_batch_are_packed(spark, sf_dir, monkeypatch):
    from punctual.plans import batch, catalog

    seen = []

    def listed(spark, raw, *_):
        seen.extend(spark.read.text(raw).inputFiles())
        return batch.BatchResult(1)

    monkeypatch.setattr(batch, "run_batch", listed)
    assert catalog.batch_run(spark, sf_dir).count() == 1
    assert seen and all(f.endswith(".csv.gz") for f in seen)


def test_only_narrow_terms_are_shuffled(spark, sf_dir):
    """The price, eight bytes a row, is read for a delay of one: that is what moves."""
    shown = flights(spark, sf_dir, "ArrDelay", "Cancelled", "Reporting_Airline", "Dest")._jdf.queryExecution().optimizedPlan().toString()
    early = [line for line in shown.splitlines() if "AS ad#" in line]
    assert len(early) == 1 and shown.index(early[0]) > shown.index("Join")
