"""Classifier metrics as grouped Spark jobs over (label, prediction, score)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from punctual.functions.numeric import pct
from punctual.operators.rollup import count_if
from punctual.runtime import cut, scratch


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """All four cells, empty ones included."""
    cell = {(y, p): f"sum({count_if(f'{label} = {y} AND {prediction} = {p}')})" for y in (0, 1) for p in (0, 1)}
    counts = pred.agg(*[F.expr(f"coalesce({e}, 0L)").alias(f"c{y}{p}") for (y, p), e in cell.items()])
    return counts.selectExpr("stack(4, 0, 0, c00, 0, 1, c01, 1, 0, c10, 1, 1, c11) AS (label, prediction, flights)")


def precision_recall(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision and recall in percent, F1 of class 1 and F1 weighted over both classes."""
    n = pred.agg(
        *[
            F.expr(f"coalesce(sum({count_if(f'{label} = {y} AND {prediction} = {p}')}), 0L)").alias(name)
            for name, y, p in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
        ]
    )

    def f1(hit, missed, wrong):
        whole = 2.0 * F.col(hit) + F.col(missed) + F.col(wrong)
        return F.when(whole > 0, 2.0 * F.col(hit) / whole).otherwise(0.0)

    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    negatives, positives = F.col("tn") + F.col("fp"), F.col("tp") + F.col("fn")
    late, ontime = f1("tp", "fn", "fp"), f1("tn", "fp", "fn")
    return n.select(
        "tn",
        "fp",
        "fn",
        "tp",
        pct(F.col("tp") + F.col("tn"), total).alias("accuracy_pct"),
        pct("tp", F.col("tp") + F.col("fp")).alias("precision_pct"),
        pct("tp", positives).alias("recall_pct"),
        late.alias("f1_late"),
        F.when(total > 0, (late * positives + ontime * negatives) / total).otherwise(0.0).alias("f1_weighted"),
    )


def majority_baseline(pred: DataFrame, label: str = "label") -> DataFrame:
    """The class that is most frequent and the accuracy of always answering it."""
    n = pred.agg(
        F.count(label).alias("flights"), F.expr(f"coalesce(sum({count_if(f'{label} = 1')}), 0L)").alias("positives")
    )
    late = F.col("positives") * 2 > F.col("flights")
    winners = F.when(late, F.col("positives")).otherwise(F.col("flights") - F.col("positives"))
    return n.select(
        F.when(late, 1).otherwise(0).alias("majority_class"), "flights", pct(winners, "flights").alias("accuracy_pct")
    )


def roc_points(pred: DataFrame, bins: int = 100, label: str = "label", score: str = "score") -> DataFrame:
    """Threshold sweep: rates, precision and counts for the rule "late if bin(score) >= bin".

    Scores are grouped into ``bins`` equal bins first, so the running sums cover at most that many rows.
    """
    bucket = F.least(F.floor(F.col(score) * bins).cast("int"), F.lit(bins - 1))
    grouped = pred.groupBy(bucket.alias("bin")).agg(
        F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")
    )
    down = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    swept = grouped.select(
        "bin",
        F.sum("p").over(down).alias("true_positives"),
        F.sum("n").over(down).alias("false_positives"),
        F.sum("p").over(every).alias("positives"),
        F.sum("n").over(every).alias("negatives"),
    )
    return swept.select(
        "bin",
        (F.col("bin") / float(bins)).alias("threshold"),
        "true_positives",
        "false_positives",
        pct("true_positives", "positives").alias("true_positive_rate_pct"),
        pct("false_positives", "negatives").alias("false_positive_rate_pct"),
        pct("true_positives", F.col("true_positives") + F.col("false_positives")).alias("precision_pct"),
    )


#: Distinct scores per range of the running sums.
RANGE_ROWS = 100_000


def _running(pred: DataFrame, label: str, score: str, path: str) -> DataFrame:
    """Per distinct score (s, p, n, p_above, n_above): late and on-time flights at it, and at higher scores.

    No row is ranked by itself. Rows are grouped by score; the scores are dealt out by ranges, as many as their number
    asks for, and the running sum has two levels: over the totals of the ranges, and inside each.
    """
    grouped = pred.groupBy(F.col(score).alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")
    )
    grouped = cut(grouped, path=f"{path}/grouped")
    ranges = -(-grouped.count() // RANGE_ROWS) or 1
    placed = grouped.repartitionByRange(ranges, F.desc("s")).withColumn("r", F.spark_partition_id())
    placed = cut(placed, path=f"{path}/placed")  # the numbers of the ranges hold from here on
    before = Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("r").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("r").agg(F.sum("p").alias("tp"), F.sum("n").alias("tn"))
    totals = totals.select("r", *[F.coalesce(F.sum(f"t{c}").over(before), F.lit(0)).alias(f"{c}_start") for c in "pn"])
    summed = placed.select("r", "s", "p", "n", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"{c}_in") for c in "pn"])
    above = [(F.col(f"{c}_start") + F.col(f"{c}_in")).alias(f"{c}_above") for c in "pn"]
    return summed.join(totals, "r").select("s", "p", "n", *above)


def roc_auc_by_rank(pred: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve: the share of (late, on-time) pairs that the score orders
    correctly, ties counting half. One row: auc, positives, negatives."""
    with scratch(pred.sparkSession, "roc") as path:
        rows = _running(pred, label, score, path)
        # Twice the number of pairs won, in whole numbers: an on-time flight beats by every late one above it.
        wins = F.col("n").cast("decimal(38,0)") * (2 * F.col("p_above") + F.col("p"))
        sums = rows.agg(F.sum(wins).alias("wins"), F.sum("p").alias("p"), F.sum("n").alias("n"))
        pairs = F.col("p").cast("double") * F.col("n").cast("double")
        return cut(
            sums.select(
                F.when(pairs > 0, F.col("wins").cast("double") / (2.0 * pairs)).alias("auc"),
                F.coalesce("p", F.lit(0)).alias("positives"),
                F.coalesce("n", F.lit(0)).alias("negatives"),
            )
        )


def pr_area(pred: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the precision-recall curve over all distinct scores, by trapezoids, from recall 0 with the first
    precision. One row: auc_pr (null without late flights), positives."""
    with scratch(pred.sparkSession, "pr") as path:
        rows = _running(pred, label, score, path)
        hit, shown = F.col("p_above") + F.col("p"), F.col("p_above") + F.col("n_above") + F.col("p") + F.col("n")
        after = hit.cast("double") / shown
        above = F.col("p_above") + F.col("n_above")
        before = F.when(above > 0, F.col("p_above").cast("double") / above).otherwise(after)
        sums = rows.agg(F.sum(F.col("p") * (before + after) / 2.0).alias("area"), F.sum("p").alias("p"))
        positives = F.coalesce("p", F.lit(0))
        return cut(sums.select(F.when(positives > 0, F.col("area") / F.col("p")).alias("auc_pr"), positives.alias("positives")))
