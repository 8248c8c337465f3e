"""Ranks, shares, top-n, period change, repeatable samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from punctual.runtime import cut


def _keys(keys: str | list[str] | tuple[str, ...]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def rank_by(
    df: DataFrame,
    measure: str,
    keys: str | list[str],
    partition: str | list[str] | None = None,
    ascending: bool = False,
    name: str = "Rank",
) -> DataFrame:
    """Number rows by a measure, ties broken by the keys, within ``partition`` or over all rows.

    For aggregated tables: without a partition the window runs in one task, so never pass the fact.
    """
    order = [F.asc(measure) if ascending else F.desc(measure), *[F.asc(k) for k in _keys(keys)]]
    window = Window.partitionBy(*(_keys(partition) if partition else [])).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window))


def share_of(
    df: DataFrame, measure: str, partition: str | list[str] | None = None, name: str = "Share_Pct"
) -> DataFrame:
    """Each row's percentage of the measure's total, over all rows or within ``partition``.

    For aggregated tables, as ``rank_by``.
    """
    total = F.sum(measure).over(Window.partitionBy(*(_keys(partition) if partition else [])))
    return df.withColumn(name, F.when(total > 0, F.col(measure) / total * 100.0).otherwise(0.0))


def top_n(
    df: DataFrame, measure: str, keys: str | list[str], n: int = 10, having: Column | str | None = None
) -> DataFrame:
    """The n rows with the largest measure among those passing ``having``, ties broken by the keys.

    Every task keeps its own n best rows, so there is no full sort. The rows come back ranked.
    """
    if having is not None:
        df = df.where(having)
    best = df.orderBy(F.desc(measure), *[F.asc(k) for k in _keys(keys)]).limit(n)
    return rank_by(best, measure, keys)


def preview(df: DataFrame, n: int = 10, order: str | list[str] | None = None) -> DataFrame:
    """The first n rows, under an order if one is given."""
    return (df.orderBy(*_keys(order)) if order else df).limit(n)


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Spark's random sample: repeats for the same seed and the same partitions."""
    return df.sample(fraction=fraction, seed=seed)


_BITS = 52  # of the row hash; a double holds them exactly


def row_hash(df: DataFrame, keys: list[str] | None = None, seed: int = 42) -> Column:
    """A number in [0, 2**52) that depends only on the key values, not on where the row is stored.

    The first 13 hexadecimal digits of the MD5 of the seed and the keys as text, with the character 31 between them
    and <null> for a null, so that any engine can repeat it. Name keys whose text is the same everywhere: whole
    numbers, texts, dates.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in (keys or df.columns)]
    text = F.concat_ws("\x1f", F.lit(str(seed)), *parts)
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def hash_position(df: DataFrame, keys: list[str] | None = None, seed: int = 42) -> Column:
    """The row hash scaled to [0, 1)."""
    return row_hash(df, keys, seed) / float(1 << _BITS)


def hash_sample(df: DataFrame, fraction: float, keys: list[str] | None = None, seed: int = 42) -> DataFrame:
    """Rows whose hash position is below ``fraction``; rows with equal keys are all in or all out."""
    return df.where(hash_position(df, keys, seed) < fraction)


_SLOT_BITS = 12


def repeatable_limit(df: DataFrame, n: int, keys: list[str] | None = None, seed: int = 42) -> DataFrame:
    """n rows (all, if there are fewer) in the order of a hash of ``keys`` (default: all columns), so that a
    second run picks the same.

    A plain limit sends up to n rows of every task to one task. Here rows are counted per hash slot first (at most 4096
    counts reach the driver) and those up to the slot that holds the n-th row are written with their hash. There the
    slot is split until one hash value is left. Rows below it are taken by a plain filter; only rows that share it are
    put in order, and no more than are missing pass through one task. With keys that are cheap, columns that are not (a
    model's output) are computed for the chosen slots only.
    """
    position, shift = row_hash(df, keys, seed), _BITS - _SLOT_BITS
    slot, below, rows = _slot(df, position, shift, n)
    if slot is None:
        return df
    name = "_position"
    while name in df.columns:
        name += "_"
    near = cut(df.where(position < (slot + 1) << shift).withColumn(name, position))
    low, need = slot << shift, n - below
    while shift > 0 and rows > need:
        width, shift = shift, max(0, shift - _SLOT_BITS)
        inside = near.where((F.col(name) >= low) & (F.col(name) < low + (1 << width)))
        slot, below, rows = _slot(inside, F.col(name), shift, need)
        low, need = slot << shift, need - below
    edge = near.where((F.col(name) >= low) & (F.col(name) < low + (1 << shift)))
    if rows > need:  # they share one hash value
        edge = edge.orderBy(*df.columns).limit(need)
    return near.where(F.col(name) < low).unionByName(edge).drop(name)


def _slot(df: DataFrame, position: Column, shift: int, n: int) -> tuple[int | None, int, int]:
    """The slot that holds the n-th row by ``position``, the rows in slots before it and in it; None with fewer rows."""
    counted = df.groupBy(F.shiftright(position, shift).alias("slot")).agg(F.count("*").alias("rows"))
    below = 0
    for slot, rows in sorted((r["slot"], r["rows"]) for r in counted.collect()):
        if below + rows >= n:
            return slot, below, rows
        below += rows
    return None, below, 0


def yoy_growth(df: DataFrame, measure: str = "Total_Flights", year: str = "Year") -> DataFrame:
    """Yearly totals with the change from the year before (null for the first year or after a gap)."""
    yearly = df.groupBy(year).agg(F.sum(measure).alias(measure))
    window = Window.orderBy(year)
    before, last = F.lag(measure).over(window), F.lag(year).over(window)
    yearly = yearly.withColumn("Previous", F.when(last == F.col(year) - 1, before))
    return yearly.select(
        year,
        measure,
        (F.col(measure) - F.col("Previous")).alias("Change"),
        F.when(F.col("Previous") > 0, (F.col(measure) - F.col("Previous")) / F.col("Previous") * 100.0).alias(
            "Growth_Pct"
        ),
    ).orderBy(year)
