"""Contract checks and reconciliation of totals across tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from punctual.schema import CONTRACTS, KIND_MAX, KIND_TYPES


def apply_contract(df: DataFrame, table: str) -> DataFrame:
    """Select the contract's columns by name, round, fill null measures with 0 and narrow the types.

    Key columns are never filled. A number that does not fit its type raises.
    """
    contract = CONTRACTS[table]
    columns = []
    for name, kind in contract.columns.items():
        value = F.col(name)
        if kind == "f32":
            value = F.round(value.cast("double"), contract.digits)
        if name in contract.measures:
            value = F.coalesce(value, F.lit(0))
        columns.append(value.cast(KIND_TYPES[kind]).alias(name))
    return df.select(*columns)


def contract_violations(df: DataFrame, table: str) -> DataFrame:
    """Broken rules and how many rows break each: (Table, Rule, Column, Violations), none if clean.

    Rules: keys not null, unsigned ranges, percentages within 0-100, key unique.
    """
    contract = CONTRACTS[table]
    rules: dict[tuple[str, str], str] = {}
    for name, kind in contract.columns.items():
        if name in contract.keys:
            rules["null_key", name] = f"`{name}` IS NULL"
        if kind in KIND_MAX:
            high = KIND_MAX[kind]
            above = f" OR `{name}` > {high}L" if high else ""
            rules["out_of_range", name] = f"`{name}` < 0{above}"
        if name.endswith("_Pct"):
            rules["not_a_percentage", name] = f"`{name}` < 0 OR `{name}` > 100 OR isnan(`{name}`)"
    counted = df.agg(*[F.expr(f"count_if({p})").alias(f"r{i}") for i, p in enumerate(rules.values())])
    cases = ", ".join(f"'{rule}', '{column}', r{i}" for i, (rule, column) in enumerate(rules))
    found = counted.selectExpr(f"stack({len(rules)}, {cases}) AS (Rule, Column, Violations)")
    if contract.unique:
        copies = df.groupBy(*contract.keys).agg(F.count("*").alias("n")).where("n > 1")
        twice = copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("Violations")).select(
            F.lit("duplicate_key").alias("Rule"), F.lit(",".join(contract.keys)).alias("Column"), "Violations"
        )
        found = found.unionByName(twice)
    return found.where("Violations > 0").select(F.lit(table).alias("Table"), "Rule", "Column", "Violations")


# Which tables carry which total, and under which column.
TOTALS: dict[str, dict[str, str]] = {
    "flights": {
        "agg_airline_performance": "Total_Flights",
        "agg_airport_performance": "Total_Departures",
        "agg_calendar_delays": "Total_Flights",
        "agg_hourly_delays": "Total_Flights",
        "agg_route_traffic": "Flight_Count",
    },
    "delayed": {
        "agg_airline_performance": "Delayed_Flights",
        "agg_calendar_delays": "Delayed_Flights",
        "agg_hourly_delays": "Delayed_Flights",
    },
    "cancelled": {
        "agg_airline_performance": "Cancelled_Flights",
        "agg_airport_performance": "Cancelled_Departures",
        "agg_calendar_delays": "Cancelled_Flights",
        "agg_cancellation_reasons": "Cancelled_Flights",
    },
}


def reconcile_totals(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every total as each given table states it: (Metric, Source, Total, Agrees)."""
    wanted: dict[str, dict[str, str]] = {}
    for metric, sources in TOTALS.items():
        for source, column in sources.items():
            if source in tables:
                wanted.setdefault(source, {})[metric] = column
    parts = []
    for source, metrics in wanted.items():
        sums = tables[source].agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(m) for m, c in metrics.items()])
        cases = ", ".join(f"'{m}', {m}" for m in metrics)
        parts.append(
            sums.selectExpr(f"stack({len(metrics)}, {cases}) AS (Metric, Total)").withColumn("Source", F.lit(source))
        )
    stated = reduce(DataFrame.unionByName, parts)
    same = Window.partitionBy("Metric")
    return stated.select(
        "Metric", "Source", "Total", (F.min("Total").over(same) == F.max("Total").over(same)).alias("Agrees")
    )
