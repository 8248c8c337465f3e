"""Training, scoring and assessing delay classifiers with MLlib."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from punctual.functions.flight import risk_category
from punctual.ml.features import CATEGORICAL, NUMERIC, feature_stages
from punctual.ml.metrics import majority_baseline, precision_recall
from punctual.operators.ranking import repeatable_limit
from punctual.runtime import cut, scratch
from punctual.schema import CONTRACTS

MIN_BINS = 400


def training_table(df: DataFrame, path: str) -> DataFrame:
    """The features and the label as a written table.

    Fitting reads its input several times (category counts, size checks, statistics, the iterations'
    cache). On this table each read is a narrow scan, whatever joins and filters the rows come from.
    """
    return cut(df.select(*CATEGORICAL, *NUMERIC, "label"), path=path)


def train(
    df: DataFrame,
    kind: str = "lr",
    *,
    max_iter: int = 20,
    max_depth: int = 5,
    seed: int = 42,
    written: bool = False,
) -> PipelineModel:
    """Fit ``"lr"`` (logistic regression on one-hot codes) or ``"gbt"`` (boosted trees on category indices).

    ``written`` says that ``df`` already is a ``training_table``; otherwise one exists during the fit.
    """
    if kind not in ("lr", "gbt"):
        raise ValueError("kind must be 'lr' or 'gbt'")
    if max_depth > 5:
        raise ValueError("boosted trees are limited to depth 5")
    if not written:
        with scratch(df.sparkSession, "training") as path:
            return _fit(training_table(df, path), kind, max_iter, max_depth, seed)
    return _fit(df, kind, max_iter, max_depth, seed)


def _fit(df: DataFrame, kind: str, max_iter: int, max_depth: int, seed: int) -> PipelineModel:
    if kind == "lr":
        classifier = LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter)
        *prepared, fitted = Pipeline(stages=[*feature_stages(), classifier]).fit(df).stages
        return PipelineModel(stages=[*prepared, _without_summary(fitted, df.sparkSession)])
    prepared = Pipeline(stages=feature_stages(one_hot=False)).fit(df)
    # A tree needs one bin per category, the one for unseen values included.
    categories = max(len(labels) for labels in prepared.stages[0].labelsArray) + 1
    classifier = GBTClassifier(
        featuresCol="features",
        labelCol="label",
        maxIter=max_iter,
        maxDepth=max_depth,
        maxBins=max(MIN_BINS, categories),
        seed=seed,
    )
    fitted = classifier.fit(prepared.transform(df).select("features", "label"))
    return PipelineModel(stages=[*prepared.stages, fitted])


def _without_summary(fitted: LogisticRegressionModel, spark: SparkSession) -> LogisticRegressionModel:
    """The model as loaded from storage.

    Fresh from training it holds its training summary and, through that, the session; Spark cannot
    ship it to the tasks once the session has observed a write.
    """
    with scratch(spark, "model") as path:
        fitted.save(path)
        return LogisticRegressionModel.load(path)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def evaluate(pred: DataFrame) -> dict[str, float]:
    """ROC and PR area, accuracy, weighted F1, precision, recall and the majority baseline.

    The scored rows are reduced to three columns and written, so the model runs once, not per metric, and a lost
    executor does not bring it back.
    """
    slim = pred.select("label", "prediction", vector_to_array("probability")[1].alias("probability"))
    with scratch(pred.sparkSession, "scored") as path:
        slim = cut(slim, path=path)
        area = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="probability")
        counts = precision_recall(slim).first()
        return {
            "auc_roc": area.evaluate(slim, {area.metricName: "areaUnderROC"}),
            "auc_pr": area.evaluate(slim, {area.metricName: "areaUnderPR"}),
            "accuracy": counts["accuracy_pct"] / 100.0,
            "f1": counts["f1_weighted"],
            "precision": counts["precision_pct"] / 100.0,
            "recall": counts["recall_pct"] / 100.0,
            "majority_accuracy": majority_baseline(slim).first()["accuracy_pct"] / 100.0,
        }


def compare(models: Mapping[str, PipelineModel], test: DataFrame) -> DataFrame:
    """One row of metrics per model."""
    rows = [{"model": name, **evaluate(score(model, test))} for name, model in models.items()]
    columns = list(rows[0]) if rows else ["model"]
    kinds = ", ".join(f"{c} {'string' if c == 'model' else 'double'}" for c in columns)
    return test.sparkSession.createDataFrame([tuple(r[c] for c in columns) for r in rows], kinds)


def importance(
    model: PipelineModel,
    spark: SparkSession,
    categorical: Sequence[str] = CATEGORICAL,
    numeric: Sequence[str] = NUMERIC,
) -> DataFrame:
    """Coefficients (or tree importances) with feature names, largest magnitude first."""
    inputs = ", ".join([f"{c} string" for c in categorical] + [f"{c} double" for c in numeric])
    features = PipelineModel(stages=model.stages[:-1]).transform(spark.createDataFrame([], inputs))
    groups = features.schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for attributes in groups.values() for a in attributes}
    fitted = model.stages[-1]
    weights = fitted.coefficients if hasattr(fitted, "coefficients") else fitted.featureImportances
    rows = [(names[i], float(w)) for i, w in enumerate(weights.toArray())]
    table = spark.createDataFrame(rows, "feature string, weight double")
    return table.orderBy(F.desc(F.abs("weight")), "feature")


def gradient(
    model: PipelineModel,
    df: DataFrame,
    categorical: Sequence[str] = CATEGORICAL,
    numeric: Sequence[str] = NUMERIC,
) -> DataFrame:
    """The mean gradient of the logistic loss at a model's weights: kind, feature, rows, gradient.

    ``kind`` is a categorical column (one row per category in ``df``), ``number`` or ``intercept``. A number counts as
    centred and in units of its standard deviation. At the optimum of a fit without a penalty all entries vanish on the
    training rows, so this checks a fit without trusting it. One grouped pass; rows that the model skips take no part.
    """
    residual = (vector_to_array("probability")[1] - F.col("label")).alias("residual")
    inputs = [(F.lit(c), F.col(c).cast("string"), F.lit(1.0)) for c in categorical]
    inputs += [(F.lit("number"), F.lit(c), F.col(c).cast("double")) for c in numeric]
    inputs.append((F.lit("intercept"), F.lit("intercept"), F.lit(1.0)))
    each = F.array(*(F.struct(k.alias("kind"), f.alias("feature"), v.alias("value")) for k, f, v in inputs))
    rows = score(model, df).select(residual, F.inline(each))
    with scratch(df.sparkSession, "gradient") as path:
        sums = rows.groupBy("kind", "feature").agg(
            F.count("*").alias("rows"),
            F.sum("residual").alias("total"),
            F.covar_pop("residual", "value").alias("covariance"),
            F.stddev_pop("value").alias("deviation"),
        )
        sums = cut(sums, path=path)
        n = sums.where("kind = 'intercept'").first()
        of_number = F.when(F.col("deviation") > 0, F.col("covariance") / F.col("deviation")).otherwise(0.0)
        mean = F.when(F.col("kind") == "number", of_number).otherwise(F.col("total") / (n["rows"] if n else 1))
        return cut(sums.select("kind", "feature", "rows", mean.alias("gradient")))


def predictions(pred: DataFrame, limit: int | None = None, seed: int = 42) -> DataFrame:
    """The published prediction table: rounded probability, risk bucket; all rows, or a repeatable sample of ``limit``.

    A sample is drawn by what is known without the model, so only drawn rows are scored.
    """
    rows = pred.select(
        "FlightDate",
        "Reporting_Airline",
        "Origin",
        "Dest",
        F.col("Dep_Hour").cast("int").alias("Dep_Hour"),
        F.col("label").cast("int").alias("Actual_Delayed"),
        F.col("prediction").cast("int").alias("Predicted_Delayed"),
        class_probability(pred).alias("Delay_Probability"),
    ).withColumn("Risk_Category", risk_category("Delay_Probability"))
    rows = rows.select(*CONTRACTS["ml_delay_predictions"].columns)
    if limit is None:
        return rows
    return repeatable_limit(rows, limit, ["FlightDate", *CATEGORICAL, "Dep_Hour", "Actual_Delayed"], seed)


def class_probability(pred: DataFrame):
    """Probability of class 1, to four digits; ``score`` stands in where there is no vector."""
    p = vector_to_array("probability")[1] if "probability" in pred.columns else F.col("score")
    return F.round(p, 4).cast("float")
