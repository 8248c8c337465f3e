"""Interpolated Kneser-Ney character models per class: counted and estimated by Spark, kept in sorted hash arrays.

A text is folded to lower-case letters with one space for each run of anything else, with a space before and after
it. Counts of the highest order come from all training texts (summed inside each task first); lower orders use
continuation counts, those up to ``shared`` pooled over the classes. The estimated log-probabilities are written as
corrections: the log-probability of a character is the sum of one stored number per order, so a model of any size
can be applied in parts of at most ``part_entries`` entries, one pass over the texts each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from punctual.llm.text import list_array, mix, text_slices
from punctual.runtime import cut

#: Sorted entries that one pass over the texts holds in memory (hash, and two numbers per class, 4 bytes each).
PART_ENTRIES = 4_000_000
SLICE = 2 << 20


@cache
def _tables() -> tuple[np.ndarray]:
    fold = np.full(0x110000, 32, dtype=np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            fold[code] = ord(low) if len(low) == 1 else code
    fold[0] = 0
    return (fold,)


def folded(texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts, each after ``order - 1`` zeros and a space; and the text that each code belongs to."""
    pad = "\0" * (order - 1) + " "
    clean = [(t.replace("\0", " ") if t else "") + " " for t in texts]
    raw = np.frombuffer((pad + pad.join(clean)).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = _tables()[0][raw]
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    lengths = np.array([len(t) + order for t in clean], dtype=np.int64)
    rows = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    return codes[keep], rows[keep]


_FACTORS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def gram_hashes(codes: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the ``length`` codes that end at the given places."""
    total = np.full(len(at), length, dtype=np.uint64)
    for k in range(length):
        total += mix(codes[at - k].astype(np.uint64) + np.uint64(1)) * _FACTORS[k]
    return mix(total)


def unique_keys(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inverse, kinds = pd.factorize(hashes)
    first = np.empty(len(kinds), dtype=np.int64)
    first[inverse[::-1]] = np.arange(len(hashes) - 1, -1, -1)
    return inverse, first


class _Counts:
    """Counts of grams of one task and class, merged now and then."""

    def __init__(self, order: int):
        self.order, self.parts, self.size = order, [], 0

    def add(self, hashes: np.ndarray, n: np.ndarray, grams: np.ndarray) -> None:
        self.parts.append((hashes, n, grams))
        self.size += len(n)

    def merge(self) -> None:
        hashes, n, grams = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        inverse, first = unique_keys(hashes)
        self.parts = [(hashes[first], np.bincount(inverse, weights=n).astype(np.int64), grams[first])]
        self.size = len(first)

    def rows(self, kind: str) -> pa.RecordBatch:
        self.merge()
        _, n, grams = self.parts[0]
        text = grams.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        step = self.order
        return pa.RecordBatch.from_arrays(
            [
                pa.array([kind] * len(n), pa.string()),
                pa.array([text[i : i + step] for i in range(0, len(text), step)], pa.string()),
                pa.array(n, pa.int64()),
            ],
            names=["kind", "gram", "n"],
        )


def gram_counts(df: DataFrame, kind: str, text: str, order: int, within_words: bool = False) -> DataFrame:
    """(kind, gram, n) of the highest order over all rows with a class and a text; short contexts are filled with zeros."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, _Counts] = {}
        for batch in batches:
            for start, end in text_slices(batch, "text", SLICE):
                part = batch.slice(start, end - start)
                kinds, texts = part.column("kind").to_pylist(), part.column("text").to_pylist()
                for name in sorted(set(kinds)):
                    codes, _ = folded([t for t, k in zip(texts, kinds, strict=True) if k == name], order)
                    at, reach = places(codes, order, within_words)
                    hashes = rolling(codes, at, reach, order)
                    inverse, first = unique_keys(hashes)
                    ends = at[first]
                    grams = np.stack([codes[ends - k] for k in range(order - 1, -1, -1)], axis=1)
                    if reach is not None:
                        grams[np.arange(order - 1, -1, -1)[None, :] > reach[first][:, None]] = 0
                    mine = counts.setdefault(name, _Counts(order))
                    mine.add(hashes[first], np.bincount(inverse), grams)
                    if mine.size > 1_000_000:
                        mine.merge()
                        if mine.size > 500_000:
                            yield mine.rows(name)
                            del counts[name]
        for name, mine in counts.items():
            yield mine.rows(name)

    rows = df.select(F.col(kind).cast("string").alias("kind"), F.col(text).cast("string").alias("text"))
    rows = rows.where("kind IS NOT NULL AND text IS NOT NULL")
    partial = rows.mapInArrow(count, "kind string, gram string, n long")
    return partial.groupBy("kind", "gram").agg(F.sum("n").alias("n"))


def places(codes: np.ndarray, order: int, within_words: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """The codes to predict, and how many codes before each its context may reach (None: as far as the order).

    ``within_words``: back to the space before the word, and the first space of a text is not predicted.
    """
    at = np.flatnonzero(codes)
    if not within_words:
        return at, None
    space = np.where(codes == 32, np.arange(len(codes)), 0)
    at = at[codes[at - 1] != 0]
    return at, np.minimum(at - np.maximum.accumulate(space)[at - 1], order - 1)


def rolling(codes: np.ndarray, at: np.ndarray, reach: np.ndarray | None, order: int, start: int = 0) -> np.ndarray:
    """Keys of the grams that end at ``at`` (``start`` = 1: of their contexts); codes out of reach count as absent."""
    total = np.zeros(len(at), dtype=np.uint64)
    for k in range(start, order):
        code = codes[at - k]
        if reach is not None:
            code[k > reach] = 0
        total += code.astype(np.uint64) * _FACTORS[k]
    return mix(total + np.uint64(start))


def estimate(counts: DataFrame, order: int, shared: int, path: str) -> DataFrame:
    """The model table (gram, kind, delta, bow), written below ``path``.

    With c(g) the count (lower orders: the number of different characters seen before g), h a gram without its last
    character and g' one without its first: p(g) = max(c - d, 0) / c(h) + d * types(h) / c(h) * p(g'), d being
    n1 / (n1 + 2 n2) of the order. ``delta`` is ln p(g) - ln bow(h) - ln p(g') with bow(h) = d * types(h) / c(h).
    Orders up to ``shared`` have the class ''. ``base``, below the lowest order, is one over the number of characters.
    """
    spark = counts.sparkSession
    levels = {order: cut(counts, path=f"{path}/n{order}")}
    for n in range(order - 1, 0, -1):
        above = levels[n + 1]
        kind = F.lit("") if n <= shared else F.col("kind")
        grams = above.select(kind.alias("kind"), F.substring("gram", 2, n).alias("gram"), F.substring("gram", 1, 1).alias("left"))
        seen = grams.distinct().groupBy("kind", "gram").agg(F.count(F.lit(1)).alias("n"))
        levels[n] = cut(seen, path=f"{path}/n{n}")
    size = max(1, levels[1].select("gram").distinct().count())
    below, out = None, []
    for n in range(1, order + 1):
        level = levels[n]
        tally = level.agg(F.count_if(F.col("n") == 1).alias("one"), F.count_if(F.col("n") == 2).alias("two")).first()
        d = tally["one"] / (tally["one"] + 2 * tally["two"]) if tally["one"] and tally["two"] else 0.5
        ctx = F.substring("gram", 1, n - 1) if n > 1 else F.lit("")
        level = level.withColumns({"ctx": ctx, "rest": F.substring("gram", 2, n - 1) if n > 1 else F.lit("")})
        sums = level.groupBy("kind", "ctx").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types"))
        sums = cut(sums, path=f"{path}/s{n}")
        bow = F.lit(d) * F.col("types") / F.col("total")
        rows = level.join(sums, ["kind", "ctx"])
        if n == 1:
            rows = rows.withColumn("p0", F.lit(1.0 / size))
        else:
            lower = below.select(F.col("kind").alias("lower_kind"), F.col("gram").alias("rest"), F.col("p").alias("p0"))
            lower_kind = F.lit("") if n - 1 <= shared else F.col("kind")
            rows = rows.withColumn("lower_kind", lower_kind).join(lower, ["lower_kind", "rest"])
        rows = rows.withColumn("p", F.greatest(F.col("n") - d, F.lit(0.0)) / F.col("total") + bow * F.col("p0"))
        below = cut(rows.select("kind", "gram", "p", (F.ln("p") - F.ln(bow) - F.ln("p0")).alias("delta")), path=f"{path}/p{n}")
        out.append(below.select("gram", "kind", F.col("delta").alias("delta"), F.lit(0.0).alias("bow")))
        if n > 1:
            out.append(sums.select(F.col("ctx").alias("gram"), "kind", F.lit(0.0).alias("delta"), F.ln(bow).alias("bow")))
        else:
            base = sums.select(F.lit("").alias("gram"), "kind", F.lit(0.0).alias("delta"), F.ln(bow / size).alias("bow"))
            out.append(base)
    table = out[0]
    for part in out[1:]:
        table = table.unionByName(part)
    table = table.groupBy("gram", "kind").agg(F.sum("delta").alias("delta"), F.sum("bow").alias("bow"))
    return cut(table, path=f"{path}/model")


class HashArrays:
    """One part of a model: per gram length sorted hashes, and two numbers per class (as gram, as context)."""

    def __init__(self, kinds: list[str], rows: pa.Table):
        self.lengths: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        grams = rows["gram"].to_pylist()
        column = {k: i for i, k in enumerate(kinds)}
        kind = np.array([column.get(k, -1) for k in rows["kind"].to_pylist()], dtype=np.int64)
        values = np.stack([rows["delta"].to_numpy(), rows["bow"].to_numpy()], axis=1).astype(np.float32)
        length = np.array([len(g) for g in grams], dtype=np.int64)
        for n in sorted(set(length.tolist())):
            at = np.flatnonzero(length == n)
            codes = np.frombuffer("".join(grams[i] for i in at).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            ends = np.arange(1, len(at) + 1) * n - 1
            hashes = gram_hashes(codes, ends, n)
            keys, where = np.unique(hashes, return_inverse=True)
            table = np.zeros((len(keys), len(kinds), 2), dtype=np.float32)
            of = kind[at]
            own = of >= 0
            np.add.at(table, (where[own], of[own]), values[at[own]])
            for i in range(len(kinds)):  # class '': shared by all
                np.add.at(table, (where[~own], i), values[at[~own]])
            self.lengths[n] = keys, table

    def add(self, out: np.ndarray, codes: np.ndarray, ends: np.ndarray, n: int, role: int) -> None:
        """Adds the numbers of the grams of length n that end at ``ends`` (role 0: as grams, 1: as contexts)."""
        if n not in self.lengths:
            return
        keys, table = self.lengths[n]
        hashes = gram_hashes(codes, ends, n) if n else np.full(len(ends), keys[0])
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        out += np.where((keys[at] == hashes)[:, None], table[at, :, role], np.float32(0))


def log_likelihoods(df: DataFrame, text: str, model: DataFrame, kinds: list[str], order: int, part_entries: int = PART_ENTRIES) -> DataFrame:
    """``df`` with ``n_codes``, ``n_letters`` and ``lls``, the log-likelihood of the text per class (0 for null).

    A model of at most ``part_entries`` rows is applied in one pass over the texts. A larger one is split by the hash
    of the gram; every pass adds its part of the sums and writes the rows for the next one.
    """
    spark, passes = df.sparkSession, max(1, -(-model.count() // part_entries))
    added = ["n_codes", "n_letters", "lls"]
    df = df.withColumns({"n_codes": F.lit(0).cast("long"), "n_letters": F.lit(0).cast("long"), "lls": F.array_repeat(F.lit(0.0), len(kinds))})
    for part in range(passes):
        chosen = model.where(F.pmod(F.xxhash64("gram"), F.lit(passes)) == part) if passes > 1 else model
        arrays = spark.sparkContext.broadcast(HashArrays(kinds, chosen.select("gram", "kind", "delta", "bow").toArrow()))
        names = [c for c in df.columns if c not in added]

        def score(batches: Iterator[pa.RecordBatch], arrays=arrays, names=names) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start, end in text_slices(batch, text, SLICE):
                    piece = batch.slice(start, end - start)
                    codes, rows = folded(piece.column(text).to_pylist(), order)
                    at, reach = places(codes, order, False)
                    inverse, first = unique_keys(rolling(codes, at, reach, order))
                    total = np.zeros((len(first), len(kinds)), dtype=np.float32)
                    for n in range(1, order + 1):
                        arrays.value.add(total, codes, at[first], n, 0)
                        arrays.value.add(total, codes, at[first] - 1, n - 1, 1)
                    row = rows[at]
                    sums = [np.bincount(row, weights=total[inverse, k], minlength=len(piece)) for k in range(len(kinds))]
                    sums = np.stack(sums, axis=1) + np.stack(piece.column("lls").to_numpy(zero_copy_only=False))
                    letters = np.bincount(row, weights=codes[at] != 32, minlength=len(piece))
                    values = [np.bincount(row, minlength=len(piece)), letters.astype(np.int64)]
                    flat = list_array(np.full(len(piece), len(kinds)), sums.ravel())
                    yield pa.RecordBatch.from_arrays([*map(piece.column, names), *map(pa.array, values), flat], [*names, *added])

        df = df.mapInArrow(score, StructType([f for f in df.schema if f.name in names] + [f for f in df.schema if f.name in added]))
        if part < passes - 1:
            df = cut(df)
    return df
