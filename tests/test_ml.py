from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from punctual.ml import features, metrics, models
from punctual.plans.demo import flights


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, prediction int, score double")


def brute_auc(rows):
    late = [s for y, _, s in rows if y == 1]
    ontime = [s for y, _, s in rows if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in late for b in ontime)
    return wins / (len(late) * len(ontime))


@pytest.mark.parametrize("digits", [1, 2, 12])
def test_auc_against_all_pairs(spark, digits):
    random.seed(digits)
    rows = [(int(random.random() < 0.3), 0, round(random.random() ** 3, digits)) for _ in range(1500)]
    rows += [(1, 0, 0.5)] * 300 + [(0, 0, 0.5)] * 500
    row = metrics.roc_auc_by_rank(scored(spark, rows).repartition(5)).first()
    assert row["auc"] == pytest.approx(brute_auc(rows), abs=1e-12)
    assert row["positives"] + row["negatives"] == len(rows)


def test_auc_without_both_classes(spark):
    assert metrics.roc_auc_by_rank(scored(spark, [(1, 1, 0.5)])).first()["auc"] is None
    assert metrics.roc_auc_by_rank(scored(spark, [])).first()["auc"] is None


def test_counts(spark):
    rows = [(1, 1, 0.9)] * 3 + [(1, 0, 0.2)] * 1 + [(0, 1, 0.8)] * 2 + [(0, 0, 0.1)] * 4
    df = scored(spark, rows)
    cells = {(r["label"], r["prediction"]): r["flights"] for r in metrics.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 4, (0, 1): 2, (1, 0): 1, (1, 1): 3}
    row = metrics.precision_recall(df).first()
    assert (row["accuracy_pct"], row["precision_pct"], row["recall_pct"]) == (70.0, 60.0, 75.0)
    assert row["f1_late"] == pytest.approx(2 * 0.6 * 0.75 / 1.35)
    base = metrics.majority_baseline(df).first()
    assert (base["majority_class"], base["flights"], base["accuracy_pct"]) == (0, 10, 60.0)


def test_metrics_of_nothing(spark):
    df = scored(spark, [])
    assert {r["flights"] for r in metrics.confusion_matrix(df).collect()} == {0}
    assert metrics.precision_recall(df).first()["f1_weighted"] == 0.0
    assert metrics.majority_baseline(df).first()["accuracy_pct"] == 0.0


def test_roc_points(spark):
    rows = [(1, 1, 1.0), (0, 0, 0.0), (1, 0, 0.55), (0, 1, 0.95)]
    points = {r["bin"]: r for r in metrics.roc_points(scored(spark, rows), bins=10).collect()}
    assert sorted(points) == [0, 5, 9]
    assert (points[9]["true_positive_rate_pct"], points[9]["false_positive_rate_pct"]) == (50.0, 50.0)
    assert (points[0]["true_positives"], points[0]["false_positives"]) == (2, 2)


@pytest.mark.parametrize("name", features.FORBIDDEN)
def test_leaking_features_are_refused(name):
    with pytest.raises(features.LeakageError):
        features.check_features(["Month", name])


def test_unknown_features_are_refused():
    with pytest.raises(ValueError):
        features.check_features(["Weather"])
    assert features.check_features(["Month", "Origin"]) == ["Month", "Origin"]


def test_splits(spark):
    df = spark.range(8000).select(
        F.col("id"), (2021 + F.col("id") % 4).cast("int").alias("Year"), F.lit(0).alias("label")
    )
    train, test = features.split_hash(df.repartition(3))
    again, _ = features.split_hash(df.repartition(7))
    assert train.count() + test.count() == 8000 and train.count() == again.count()
    assert train.join(test, "id").isEmpty()
    old, new, check = features.split_by_year(df, 2022, check_year=2024)
    assert old.agg(F.max("Year")).first()[0] == 2022 and 450 < old.count() < 750
    assert {r["Year"] for r in new.select("Year").distinct().collect()} == {2023} and check.count() == 2000
    with pytest.raises(ValueError):
        features.split_by_year(df, 2022, 2022)
    _, last = features.default_split(df)
    assert last.agg(F.min("Year")).first()[0] == 2024
    one_year = df.where("Year = 2021")
    first, second = features.default_split(one_year)
    assert first.count() + second.count() == 2000
    first, second = features.split_random(df)
    assert first.count() + second.count() == 8000


@pytest.fixture(scope="module")
def fitted(spark, sf_dir):
    needed = ["Year", "FlightDate", *features.CATEGORICAL, *features.NUMERIC, "Cancelled", "Diverted", "ArrDel15"]
    rows = features.training_rows(flights(spark, sf_dir, *needed))
    train, test = features.split_hash(rows)
    return {"lr": models.train(train, "lr"), "gbt": models.train(train, "gbt", max_iter=2)}, test


def test_scores_after_an_observed_write(spark, fitted, tmp_path):
    from pyspark.sql import Observation

    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).write.parquet(str(tmp_path / "x"))
    assert seen.get["n"] == 3
    found, test = fitted
    assert models.predictions(models.score(found["lr"], test), 20).count() == 20


def test_prediction_table(spark, fitted):
    found, test = fitted
    rows = models.predictions(models.score(found["gbt"], test), limit=None)
    assert rows.count() == test.count()
    assert rows.where("Delay_Probability < 0 OR Delay_Probability > 1").isEmpty()
    assert rows.where("CAST(round(CAST(Delay_Probability AS DOUBLE), 4) AS FLOAT) <> Delay_Probability").isEmpty()
    low = rows.where("Risk_Category = 'Low' AND Delay_Probability >= CAST(0.15 AS FLOAT)")
    assert low.isEmpty()


def test_unseen_category_is_scored_and_null_feature_skipped(spark, fitted):
    found, test = fitted
    row = test.limit(1).withColumn("Origin", F.lit("NOWHERE"))
    for model in found.values():
        assert models.score(model, row).count() == 1
        assert models.score(model, row.withColumn("Distance", F.lit(None).cast("double"))).select("prediction").count() <= 1
        assert models.score(model, row.withColumn("Distance", F.lit(None).cast("double"))).collect() == []


def test_comparison_and_importance(spark, fitted):
    found, test = fitted
    table = {r["model"]: r for r in models.compare(found, test).collect()}
    assert set(table) == {"lr", "gbt"}
    for row in table.values():
        assert 0 <= row["auc_roc"] <= 1 and 0 <= row["accuracy"] <= 1
    direct = models.evaluate(models.score(found["lr"], test))
    assert direct["accuracy"] == table["lr"]["accuracy"]
    weights = models.importance(found["lr"], spark)
    names = {r["feature"] for r in weights.collect()}
    assert set(features.NUMERIC) <= names and any(n.startswith("Origin_ohe_") for n in names)
    trees = {r["feature"] for r in models.importance(found["gbt"], spark).collect()}
    assert trees == {*features.NUMERIC, *[f"{c}_idx" for c in features.CATEGORICAL]}


def test_metrics_agree_with_mllib(spark, fitted):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    found, test = fitted
    pred = models.score(found["gbt"], test)
    mine = models.evaluate(pred)
    for name, key in (("accuracy", "accuracy"), ("f1", "f1")):
        theirs = MulticlassClassificationEvaluator(labelCol="label", metricName=name).evaluate(pred)
        assert mine[key] == pytest.approx(theirs, abs=1e-12)


def test_wrong_arguments(spark, fitted):
    _, test = fitted
    with pytest.raises(ValueError):
        models.train(test, "forest")
    with pytest.raises(ValueError):
        models.train(test, "gbt", max_depth=6)


def test_gradient_follows_its_definition(spark):
    """Beside plain sums over the rows away from the optimum; at the optimum there is none."""
    rng = np.random.default_rng(3)
    carriers, places = list("ABC"), list("PQRS")
    rows = [
        (str(rng.choice(carriers)), str(rng.choice(places)), str(rng.choice(places)), *map(float, rng.integers(1, 12, 4)), 7.0, int(rng.random() < 0.4))
        for _ in range(300)
    ]
    kinds = ", ".join([f"{c} string" for c in features.CATEGORICAL] + [f"{c} double" for c in features.NUMERIC] + ["label int"])
    df = spark.createDataFrame(rows, kinds)
    model = models.train(df, "lr", max_iter=1)
    late = {tuple(r[:-1]): r[-1] for r in models.score(model, df).select(*features.CATEGORICAL, *features.NUMERIC, F.element_at(vector_to_array("probability"), 2)).collect()}
    apart = np.array([late[r[:-1]] - r[-1] for r in rows])
    found = {(r["kind"], r["feature"]): (r["rows"], r["gradient"]) for r in models.gradient(model, df).collect()}
    assert found["intercept", "intercept"] == (300, pytest.approx(apart.mean()))
    for k, c in enumerate(features.CATEGORICAL):
        for value in {r[k] for r in rows}:
            own = np.array([r[k] == value for r in rows])
            assert found[c, value] == (own.sum(), pytest.approx(apart[own].sum() / 300))
    for k, c in enumerate(features.NUMERIC, start=len(features.CATEGORICAL)):
        x = np.array([r[k] for r in rows])
        expected = (apart * (x - x.mean())).mean() / x.std() if x.std() else 0.0
        assert found["number", c] == (300, pytest.approx(expected))
    assert len(found) == 1 + len(features.NUMERIC) + 3 + 4 + 4
    fitted = models.gradient(models.train(df, "lr", max_iter=200), df)
    assert fitted.where("abs(gradient) > 1e-4").isEmpty()
    assert models.gradient(model, df.limit(0)).isEmpty()


def test_the_default_split_trains_on_all_rows_of_earlier_years(spark):
    df = spark.range(4000).select(F.col("id"), (2021 + F.col("id") % 4).cast("int").alias("Year"), F.lit(0).alias("label"))
    train, test = features.default_split(df)
    assert (train.count(), train.select("id").distinct().count(), test.count()) == (3000, 3000, 1000)
    assert train.agg(F.max("Year")).first()[0] == 2023
    drawn, last = features.default_split(df, train_fraction=0.15)
    assert 350 < drawn.count() < 550 and last.count() == 1000


def _trained_on(monkeypatch) -> list[int]:
    """The numbers of rows that models are trained on from now on."""
    sizes, train = [], models.train
    monkeypatch.setattr(models, "train", lambda df, *a, **k: sizes.append(df.count()) or train(df, *a, **k, max_iter=1))
    return sizes


def test_a_batch_trains_on_all_rows_of_earlier_years(spark, tmp_path, monkeypatch):
    from punctual.plans.batch import run_batch
    from punctual.sources import files

    days = F.date_add(F.lit("2022-01-01").cast("date"), (F.col("id") % 1000).cast("int"))
    rows = spark.range(2000).select("id", days.alias("day"), (F.col("id") % 3 == 0).alias("late"))
    late = F.col("late").cast("double")
    raw = rows.select(
        F.year("day").alias("Year"), F.month("day").alias("Month"), F.dayofmonth("day").alias("DayofMonth"), F.lit(1).alias("DayOfWeek"),
        F.col("day").alias("FlightDate"), F.lit("AA").alias("Reporting_Airline"), F.col("id").alias("Flight_Number_Reporting_Airline"),
        F.lit("AAA").alias("Origin"), F.lit("Alpha").alias("OriginCityName"), F.lit("AL").alias("OriginState"),
        F.lit("BBB").alias("Dest"), F.lit("Beta").alias("DestCityName"), F.lit("BE").alias("DestState"),
        F.lit("900").alias("CRSDepTime"), *[(late * 20).alias(c) for c in ("DepDelay", "DepDelayMinutes", "ArrDelay", "ArrDelayMinutes")],
        late.alias("DepDel15"), late.alias("ArrDel15"), F.lit(0.0).alias("Cancelled"), F.lit(0.0).alias("Diverted"),
        F.lit(60.0).alias("CRSElapsedTime"), F.lit(40.0).alias("AirTime"), (100 + F.col("id") % 7).alias("Distance"),
    )
    files.write_csv(raw, f"{tmp_path}/raw")
    sizes = _trained_on(monkeypatch)
    done = run_batch(spark, f"{tmp_path}/raw", f"{tmp_path}/cleaned", f"{tmp_path}/serving")
    earlier = rows.where(F.year("day") < 2024).count()
    assert sizes == [earlier] and done.published["ml_delay_predictions"] == 2000 - earlier


def test_compared_models_are_trained_on_all_rows_of_earlier_years(spark, sf_dir, monkeypatch):
    from punctual.plans import catalog

    sizes = _trained_on(monkeypatch)
    assert catalog.model_comparison(spark, sf_dir).count() == 2
    rows = catalog._training(spark, sf_dir)
    last = rows.agg(F.max("Year")).first()[0]
    assert sizes == [rows.where(F.col("Year") < last).count()] * 2
