"""The whole batch in its fixed order, as one call."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from punctual.ml import features, models
from punctual.operators import checks, tables
from punctual.runtime import cut, scratch
from punctual.sources import files
from punctual.sources.publish import publish, publish_all


@dataclass
class BatchResult:
    fact_rows: int = 0
    published: dict[str, int | None] = field(default_factory=dict)
    metrics: dict[str, dict[str, float]] = field(default_factory=dict)
    violations: list[tuple] = field(default_factory=list)
    reconciled: bool = True


class BatchError(RuntimeError):
    """Tables that must not be published."""


def run_batch(
    spark: SparkSession,
    raw: str,
    cleaned: str,
    target: str,
    *,
    dim: DataFrame | None = None,
    kinds: tuple[str, ...] = ("lr",),
    prediction_limit: int | None = None,
) -> BatchResult:
    """Raw CSV -> cleaned Parquet -> seven tables -> checks -> publish -> train, score, publish predictions.

    What is checked is what is published: the contract form, written once. A broken rule or totals that do not agree
    raise a BatchError before any published table changes.
    The first model in ``kinds`` supplies the published predictions; an empty tuple skips the models.
    """
    result = BatchResult()
    result.fact_rows = files.write_flights(files.conform(files.read_raw_csv(spark, raw)), cleaned)
    fact = files.read_flights(spark, cleaned)

    with scratch(spark, "checked") as work:
        outputs = {
            name: cut(checks.apply_contract(df, name), path=f"{work}/{name}")
            for name, df in tables.all_tables(fact, dim).items()
        }
        for name, df in outputs.items():
            result.violations += [tuple(r) for r in checks.contract_violations(df, name).collect()]
        apart = [tuple(r) for r in checks.reconcile_totals(outputs).where("NOT Agrees").collect()]
        if apart or result.violations:
            raise BatchError(f"nothing published; violations: {result.violations}, totals apart: {apart}")
        result.published.update(publish_all(outputs, target))

    if kinds:
        train, test = features.default_split(features.training_rows(fact))
        with scratch(spark, "training") as path:
            rows = models.training_table(train, path)
            fitted = {kind: models.train(rows, kind, written=True) for kind in kinds}
        for kind, model in fitted.items():
            result.metrics[kind] = models.evaluate(models.score(model, test))
        scored = models.predictions(models.score(fitted[kinds[0]], test), prediction_limit)
        result.published["ml_delay_predictions"] = publish(scored, "ml_delay_predictions", target)
    return result
