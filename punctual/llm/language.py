"""Language ID: interpolated Kneser-Ney character models per language, lowest cross-entropy, calibrated rejection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from punctual.llm.kneser_ney import PART_ENTRIES, estimate, gram_counts, log_likelihoods
from punctual.runtime import cut, scratch

ORDER = 4
RESULTS = ["lang_pred", "score", "cross_entropy", "rejected"]


def identify(
    df: DataFrame,
    learn: Column,
    text: str = "text",
    lang: str = "lang",
    order: int = ORDER,
    sharpness: float = 20.0,
    reject_quantile: float = 0.999,
    reject_margin: float = 1.75,
    part_entries: int = PART_ENTRIES,
) -> DataFrame:
    """``df`` with lang_pred, score, cross_entropy and rejected; learned from text and lang of the rows ``learn`` alone.

    ``cross_entropy`` is the mean negative log-probability of a character under the best language, ``score`` the
    softmax of ``-sharpness * cross_entropy`` over the languages; ties go to the name that sorts first. A text is
    rejected if it has no letter, or if its cross-entropy is above ``reject_margin`` times the ``reject_quantile`` of
    the learned texts that the model gives the same language.

    A null text, or one without a letter, gets ``und``, score 0, null cross-entropy and is rejected. Learned rows with
    a null text or lang teach nothing; if none is left, every text is ``und``. Other columns are kept; columns that
    have the names of the results are replaced. Repeated rows get equal results, an empty table an empty one.
    """
    plain = df.drop(*RESULTS)
    known = plain.where(learn & F.col(text).isNotNull() & F.col(lang).isNotNull())
    known = known.select(F.col(text).cast("string").alias("_text"), F.col(lang).cast("string").alias("_lang"))
    with scratch(df.sparkSession, "language") as work:
        counts = cut(gram_counts(known, "_lang", "_text", order), path=f"{work}/counts")
        kinds = [r["kind"] for r in counts.select("kind").distinct().orderBy("kind").collect()]
        if not kinds:
            none = [F.lit("und"), F.lit(0.0), F.lit(None).cast("double"), F.lit(True)]
            return plain.withColumns(dict(zip(RESULTS, none, strict=True)))
        model = estimate(counts, order, 0, work)

        def best(rows: DataFrame) -> DataFrame:
            rows = log_likelihoods(rows, "_text", model, kinds, order, part_entries)
            entropy = F.transform("lls", lambda x: -x / F.col("n_codes"))
            lowest = F.array_min("_entropy")
            names = F.array(*map(F.lit, kinds))
            weight = F.aggregate("_entropy", F.lit(0.0), lambda a, x: a + F.exp((lowest - x) * sharpness))
            has = F.col("n_letters") > 0
            return rows.withColumn("_entropy", entropy).withColumns(
                {
                    "lang_pred": F.when(has, F.element_at(names, F.array_position("_entropy", lowest).cast("int"))).otherwise("und"),
                    "score": F.when(has, 1 / weight).otherwise(0.0),
                    "cross_entropy": F.when(has, lowest),
                }
            )

        typical = best(known.select("_text")).where("n_letters > 0").groupBy("lang_pred")
        limits = typical.agg((F.percentile_approx("cross_entropy", reject_quantile) * reject_margin).alias("most")).collect()
        kept = [c for c in plain.columns if c != text]
        row = F.struct(*(F.col(f"`{c}`") for c in kept)) if kept else F.lit(0)
        scored = best(plain.select(F.col(text).cast("string").alias("_text"), row.alias("_row")))
    rejected = F.col("lang_pred") == "und"
    for limit in limits:
        rejected = rejected | ((F.col("lang_pred") == limit["lang_pred"]) & (F.col("cross_entropy") > limit["most"]))
    columns = [F.col("_text").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in plain.columns]
    return scored.select(*columns, *RESULTS[:3], rejected.alias("rejected"))
