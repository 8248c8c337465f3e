"""Toxicity: class-conditional Kneser-Ney models, length-normalised likelihood ratios, shared backoff counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from punctual.llm.kneser_ney import PART_ENTRIES, SLICE, estimate, folded, gram_counts, places, rolling, unique_keys
from punctual.llm.text import list_array, text_slices
from punctual.runtime import cut, scratch

ORDER = 6
#: How many characters of a context the shared model weighs as much as.
STRENGTH = 50.0
#: Words whose likelihood ratio is below this many nats say nothing about the class.
MARGIN = 1.0
#: Words added to the length of a text, so that one word of a short text does not decide alone.
SHORT = 20
#: The two numbers of the logistic calibration are fitted on about this many learned rows at most, drawn by a hash.
CALIBRATION_ROWS = 50_000
FOUND = ["log_ratio", "evidence"]


def model_table(known: DataFrame, order: int, work: str) -> DataFrame:
    """(gram, context, delta, base): ln of toxic over ordinary probability of a gram's last character is delta + base.

    A class estimate takes its own discounted count of the gram, and gives the shared model - Kneser-Ney over the
    counts of both classes - the mass of the discounts and STRENGTH more. ``base`` is the ratio for any character that
    the context was never followed by; the shared probability cancels in it. A row with delta null is a context.
    """
    counts = cut(gram_counts(known, "_kind", "_text", order, within_words=True), path=f"{work}/counts")
    pooled = counts.groupBy("gram").agg(F.sum("n").alias("n")).select(F.lit("all").alias("kind"), "gram", "n")
    estimate(pooled, order, 0, work)
    shared = counts.sparkSession.read.parquet(f"{work}/p{order}").select("gram", "p")
    toxic, discount = F.col("kind") == "toxic", 0.75
    n_of = lambda own: F.sum(F.when(own, F.col("n")).otherwise(0))
    grams = counts.groupBy("gram").agg(n_of(toxic).alias("n1"), n_of(~toxic).alias("n0"))
    grams = cut(grams.withColumn("context", F.substring("gram", 1, order - 1)), path=f"{work}/grams")
    seen = lambda c: F.count_if(F.col(c) > 0)
    contexts = grams.groupBy("context").agg(*(f(c).alias(a) for c, f, a in (("n1", F.sum, "c1"), ("n0", F.sum, "c0"), ("n1", seen, "t1"), ("n0", seen, "t0"))))
    rest = {c: discount * F.col(f"t{c}") + STRENGTH for c in "10"}
    size = {c: F.col(f"c{c}") + STRENGTH for c in "10"}
    base = F.ln(rest["1"] / size["1"]) - F.ln(rest["0"] / size["0"])
    contexts = cut(contexts.withColumn("base", base), path=f"{work}/contexts")
    p = {c: (F.greatest(F.col(f"n{c}") - discount, F.lit(0.0)) + rest[c] * F.col("p")) / size[c] for c in "10"}
    rows = grams.join(contexts, "context").join(shared, "gram")
    rows = rows.select("gram", (F.ln(p["1"]) - F.ln(p["0"]) - F.col("base")).alias("value"), F.lit(False).alias("is_context"))
    return cut(rows.unionByName(contexts.select(F.col("context").alias("gram"), F.col("base").alias("value"), F.lit(True).alias("is_context"))), path=f"{work}/ratios")


class RatioArrays:
    """Sorted hashes of grams and of contexts with their numbers."""

    def __init__(self, rows: pa.Table, order: int):
        self.sides = []
        is_context = rows["is_context"].to_numpy()
        for start, own in ((0, ~is_context), (1, is_context)):
            n, text = order - start, "".join(rows["gram"].filter(pa.array(own)).to_pylist())
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            ends = np.arange(1, len(codes) // n + 1) * n - 1 + start
            keys = rolling(codes, ends, np.full(len(ends), order - 1), order, start)
            order_of = np.argsort(keys)
            self.sides.append((keys[order_of], rows["value"].to_numpy()[own][order_of]))

    def of(self, codes: np.ndarray, at: np.ndarray, reach: np.ndarray, order: int) -> np.ndarray:
        total = np.zeros(len(at))
        for start, (keys, values) in enumerate(self.sides):
            if len(keys):
                wanted = rolling(codes, at, reach, order, start)
                place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                total += np.where(keys[place] == wanted, values[place], 0.0)
        return total


def evidence(df: DataFrame, model: DataFrame, order: int, part_entries: int) -> DataFrame:
    """``df`` with ``log_ratio`` and ``evidence``.

    ``log_ratio`` is the toxic minus the ordinary log-likelihood of the text, over its number of characters (0 without
    any); ``evidence`` sums the ratios of words beyond the margin, over the number of words. Ratios of words are summed
    over the parts of a model of more than ``part_entries`` rows before the margin applies.
    """
    passes = max(1, -(-model.count() // part_entries))
    df = df.withColumn("_words", F.lit(None).cast("array<double>"))
    for part in range(passes):
        chosen = model.where(F.pmod(F.xxhash64("gram"), F.lit(passes)) == part) if passes > 1 else model
        arrays = df.sparkSession.sparkContext.broadcast(RatioArrays(chosen.toArrow(), order))
        last = part == passes - 1

        def score(batches: Iterator[pa.RecordBatch], arrays=arrays, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start, end in text_slices(batch, "_text", SLICE):
                    piece = batch.slice(start, end - start)
                    codes, rows = folded(piece.column("_text").to_pylist(), order)
                    at, reach = places(codes, order, True)
                    inverse, first = unique_keys(rolling(codes, at, reach, order))
                    values = arrays.value.of(codes, at[first], reach[first], order)[inverse]
                    opened = np.cumsum(codes == 32)
                    words = opened[at - 1] - 1
                    # a text has a space more than words, so some numbers name no word
                    sums = np.bincount(words, weights=values, minlength=int(opened[-1]) if len(opened) else 0)
                    real = np.zeros(len(sums), dtype=bool)
                    real[words] = True
                    row_of = np.zeros(len(sums), dtype=np.int64)
                    row_of[words] = rows[at]
                    sums, row_of = sums[real], row_of[real]
                    n = np.bincount(row_of, minlength=len(piece))
                    before = piece.column("_words").drop_null().flatten().to_numpy()
                    sums = sums + before if len(before) else sums
                    if last:
                        total = np.bincount(row_of, weights=np.maximum(sums - MARGIN, 0), minlength=len(piece))
                        ratio = np.bincount(row_of, weights=sums, minlength=len(piece)) / np.maximum(np.bincount(rows[at], minlength=len(piece)), 1)
                        found = [pa.array(ratio), pa.array(total / (n + SHORT))]
                        yield pa.RecordBatch.from_arrays([piece.column("_row"), piece.column("_text"), *found], names=["_row", "_text", *FOUND])
                    else:
                        yield pa.RecordBatch.from_arrays([piece.column("_row"), piece.column("_text"), list_array(n, sums)], names=["_row", "_text", "_words"])

        kind = {f.name: f for f in df.schema}
        out = StructType([kind["_row"], kind["_text"]])
        out = out.add(FOUND[0], "double").add(FOUND[1], "double") if last else out.add("_words", "array<double>")
        df = df.select("_row", "_text", "_words").mapInArrow(score, out)
        if not last:
            df = cut(df)
    return df


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> tuple[float, float]:
    """Intercept and slope by Newton's method on standardised values."""
    centre, spread = x.mean(), x.std() or 1.0
    design, w = np.stack([np.ones(len(x)), (x - centre) / spread], axis=1), np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (y - p) - ridge * w
        w += np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2), slope)
        if np.abs(slope).max() < 1e-9:
            break
    return float(w[0] - w[1] * centre / spread), float(w[1] / spread)


def toxicity(
    df: DataFrame, labelled: DataFrame, text: str = "text", label: str = "toxic", order: int = ORDER,
    part_entries: int = PART_ENTRIES, calibration_rows: int = CALIBRATION_ROWS,
) -> DataFrame:
    """``df`` with ``log_ratio``, ``evidence`` (see above) and ``score`` (0 to 1), learned from ``labelled`` alone.

    ``labelled`` has the columns ``text`` and ``label``: 1 (toxic), 0 (ordinary) or null; rows with another value, or a
    null text, teach nothing. Counts take in all labelled rows, the calibration ``calibration_rows`` of them. Without
    rows of both classes the score is their share of toxic rows (0 without any). The score is calibrated on the
    evidence; ``log_ratio`` is reported beside it. A null or empty text has 0 of both and gets the score of no
    evidence. Other columns are kept; columns with the names of the results are replaced. Repeated rows get equal
    results, an empty table an empty one.
    """
    plain = df.drop(*FOUND, "score")
    kind = F.when(F.col(label) == 1, "toxic").when(F.col(label) == 0, "ordinary")
    with scratch(df.sparkSession, "toxicity") as work:
        known = labelled.select(F.col(text).cast("string").alias("_text"), kind.alias("_kind"))
        known = cut(known.where("_text IS NOT NULL AND _kind IS NOT NULL"), path=f"{work}/known")
        tally = {r["_kind"]: r["count"] for r in known.groupBy("_kind").count().collect()}
        rows, toxic = sum(tally.values()), tally.get("toxic", 0)
        if not 0 < toxic < rows:
            return plain.withColumns({**dict.fromkeys(FOUND, F.lit(0.0)), "score": F.lit(toxic / rows if rows else 0.0)})
        model = model_table(known, order, work)
        share = min(1.0, calibration_rows / rows)
        drawn = known.where(F.pmod(F.xxhash64("_text"), F.lit(1_000_000)) < int(share * 1_000_000)) if share < 1 else known
        sample = evidence(drawn.select("_text", F.col("_kind").alias("_row")), model, order, part_entries).select("_row", "evidence").toArrow()
        x, y = sample["evidence"].to_numpy(), np.array(sample["_row"].to_pylist()) == "toxic"
        intercept, slope = logistic(x, y) if 0 < y.sum() < len(y) else (float(np.log(toxic / (rows - toxic))), 1.0)
        kept = [c for c in plain.columns if c != text]
        row = F.struct(*(F.col(f"`{c}`") for c in kept)) if kept else F.lit(0)
        scored = evidence(plain.select(F.col(text).cast("string").alias("_text"), row.alias("_row")), model, order, part_entries)
    columns = [F.col("_text").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in plain.columns]
    return scored.select(*columns, *FOUND, (1 / (1 + F.exp(-(F.col("evidence") * slope + intercept)))).alias("score"))
