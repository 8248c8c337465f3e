"""Exact top-k search: matrix products of tiles, a partial selection in each tile, a tree that merges the lists.

Queries and candidates are dealt into blocks of bounded size by a hash of the row; a tile is one block of each. It
multiplies both matrices and keeps k candidates a query. Lists of one query over neighbouring blocks are merged FAN_IN
at a time, so no task ever holds more than FAN_IN * k rows of a query, however many blocks there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from punctual.llm.text import ddl
from punctual.runtime import cut, kept_dir, scratch

#: One side of a tile, in bytes of numbers; queries multiplied at once inside a tile; lists merged at once.
TILE_BYTES, STRIP, FAN_IN = 4 << 20, 256, 32
#: Whole numbers below this are exact in double precision.
EXACT = 2.0**53
_LOW, _HIGH = -(2**63), 2**63 - 1


def top_k(df: DataFrame, asks: Column, k: int = 5, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` rows with the highest inner product for each row of ``df`` that meets ``asks``.

    Returns query_id, rank (from 1), id and score (long), for every query all rows if there are fewer than ``k``.
    Vectors are arrays of whole numbers (cast to long); a product beyond a long counts as the end of its range. A query
    is compared with every row but its own; a repeated row is another row, so it is found, and as a query it has a list
    of its own under the same id. Ties go to the smaller id, none last. Rows with a null vector, or one that holds a
    null, take no part; vectors of different lengths are not compared; empty ones have the product 0. ``asks`` that is
    null means no query. Other columns are not read unless ``asks`` does. An empty table gives an empty result.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(asks, F.lit(False)).alias("asks"), F.col(vector).cast("array<bigint>").alias("v"))
    rows = rows.where(F.forall("v", lambda x: x.isNotNull())).withColumn("row", F.monotonically_increasing_id())
    id_kind = ddl(rows.schema["id"].dataType)
    with scratch(spark, "topk") as work:
        rows = cut(rows, path=f"{work}/rows")
        n_bytes = 8 * F.greatest("d", F.lit(1))
        blocks = lambda n: F.ceil(F.col(n) * n_bytes / TILE_BYTES).cast("int")
        widths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("nq")).where("nq > 0")
        widths = cut(widths.select("d", blocks("n").alias("c_blocks"), blocks("nq").alias("q_blocks")), path=f"{work}/widths")
        dealt = rows.withColumn("d", F.size("v")).join(widths, "d")
        block = lambda n, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.col(n)).cast("int")
        each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        held = dealt.select("d", each("q_blocks").alias("q"), block("c_blocks", 1).alias("c"), F.lit(False).alias("asks"), "row", "id", "v")
        asked = dealt.where("asks").select("d", block("q_blocks", 2).alias("q"), each("c_blocks").alias("c"), "asks", "row", "id", "v")

        def tile(table: pa.Table) -> pa.Table:
            return _tile(table, k)

        kind = f"query long, query_id {id_kind}, part int, row long, id {id_kind}, score long"
        lists = held.unionByName(asked).groupBy("d", "q", "c").applyInArrow(tile, kind)
        lists = cut(lists, path=f"{work}/lists")
        parts = widths.agg(F.max("c_blocks")).first()[0] or 1
        best = [F.col("score").desc(), F.col("id").asc_nulls_last(), "row"]
        while parts > FAN_IN:
            parts = -(-parts // FAN_IN)
            lists = lists.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
            order = Window.partitionBy("query", "part").orderBy(*best)
            lists = lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")
        ranked = lists.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*best)))
        return cut(ranked.where(F.col("rank") <= k).select("query_id", "rank", "id", "score"), path=kept_dir(spark, "topk"))


def _tile(table: pa.Table, k: int) -> pa.Table:
    """The lists of one tile: per query its ``k`` best candidates here."""
    asks = table["asks"].to_numpy()
    queries, held = table.filter(pa.array(asks)), table.filter(pa.array(~asks))
    # in the order in which ties are settled, rows without an id last
    held = held.sort_by([("id", "ascending"), ("row", "ascending")])
    width = table["d"][0].as_py()
    a, b = _matrix(queries, width), _matrix(held, width)
    whole = _products_are_exact(a, b)
    if whole:
        a, b = a.astype(np.float64), b.astype(np.float64)
    else:
        a, b = a.astype(object), b.astype(object)
    held_rows = held["row"].to_numpy()
    by_row = np.argsort(held_rows, kind="stable")
    who, what, scores = [], [], []
    for start in range(0, len(a), STRIP):
        part = a[start : start + STRIP]
        found = part @ b.T if part.shape[1] else np.zeros((len(part), len(b)))
        if not whole:
            found = np.clip(found, _LOW, _HIGH)
        own = queries["row"].slice(start, STRIP).to_numpy()
        place = np.searchsorted(held_rows[by_row], own)
        there = np.flatnonzero(place < len(held_rows))
        there = there[held_rows[by_row[place[there]]] == own[there]]
        allowed = np.ones(found.shape, dtype=bool)
        allowed[there, by_row[place[there]]] = False
        i, j = _best(found, allowed, k)
        who.append(i + start)
        what.append(j)
        scores.append(found[i, j])
    i, j = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (who, what))
    score = np.concatenate(scores) if scores else np.zeros(0)
    part = table["c"][0].as_py()
    columns = [
        queries["row"].take(pa.array(i)), queries["id"].take(pa.array(i)), pa.array(np.full(len(i), part, dtype=np.int32)),
        held["row"].take(pa.array(j)), held["id"].take(pa.array(j)), pa.array(score.astype(np.int64)),
    ]
    return pa.table(columns, names=["query", "query_id", "part", "row", "id", "score"])


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    return table["v"].combine_chunks().flatten().to_numpy().reshape(len(table), width)


def _products_are_exact(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether no sum of products can leave the whole numbers that a double holds."""
    largest = [float(max(abs(float(x.max())), abs(float(x.min())))) if x.size else 0.0 for x in (a, b)]
    return max(largest) < EXACT and largest[0] * largest[1] * max(1, a.shape[1]) < EXACT


def _best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` highest allowed scores of each row, ties to smaller columns."""
    low = -np.inf if scores.dtype != object else _LOW - 1
    scores = np.where(allowed, scores, low)
    if scores.shape[1] > k:
        limit = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k][:, None]
        take = scores >= limit
        many = np.flatnonzero(take.sum(axis=1) > k)  # more ties at the limit than places
        if len(many):
            above, tied = scores[many] > limit[many], scores[many] == limit[many]
            left = k - above.sum(axis=1)
            take[many] = above | (tied & (np.cumsum(tied, axis=1) <= left[:, None]))
        take &= allowed
    else:
        take = allowed
    return np.nonzero(take)
