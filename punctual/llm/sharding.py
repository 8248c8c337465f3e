"""Sharding: a uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Rows lie in blocks. How many rows of each block go to each shard is drawn from the exact law that a uniform
permutation of all rows would give: without replacement, from what the shards still have room for. Then every block is
permuted on its own and dealt out by its row of the matrix, and every shard is permuted again. Only the sizes of the
blocks, 4,096 at most, reach the driver.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from punctual.runtime import cut

MOST_BLOCKS = 4096


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` things taken from good + bad are good: the exact law, cut where it is below 1e-20."""
    low, high, total = max(0, draws - bad), min(draws, good), good + bad
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    spread = math.sqrt(max(0.0, draws * (good / total) * (bad / total) * (total - draws) / max(1, total - 1)))
    reach = int(10 * spread) + 40
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1, dtype=np.float64)
    steps = np.log((good - k[:-1]) * (draws - k[:-1])) - np.log((k[1:]) * (bad - draws + k[1:]))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    chances = np.cumsum(np.exp(logs - logs.max()))
    return int(k[np.searchsorted(chances, rng.random() * chances[-1], side="right").clip(0, len(k) - 1)])


def communication_matrix(rows: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Counts per block and shard with the given sums, as a uniform permutation of all rows would give them."""
    rng, room, out = np.random.default_rng(seed), list(shards), []
    for n in rows:
        left, rest, line = n, sum(room), []
        for j, space in enumerate(room):
            rest -= space
            got = hypergeometric(rng, space, rest, left) if left else 0
            line.append(got)
            left -= got
            room[j] -= got
        out.append(line)
    return out


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (j < rows % shards) for j in range(shards)]


def shard(df: DataFrame, shards: int, seed: int = 42) -> DataFrame:
    """``df`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    Shard sizes differ by one row at most; every assignment of rows to places is equally likely, as far as a 64-bit
    hash is random. The numbering of the rows is written once, so a task that runs again repeats itself. Rows are
    never looked at: nulls, repeated rows and long texts are rows like any other. An empty table gives an empty one.
    Columns named shard or slot are replaced. Carry narrow columns and join wide ones afterwards, or write the result
    partitioned by shard: everything in ``df`` moves twice.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    names = df.drop("shard", "slot").columns
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"), F.monotonically_increasing_id().alias("_n"))
    rows = cut(rows)
    n = rows.count()
    blocks = max(1, min(MOST_BLOCKS, math.isqrt(max(0, n - 1)) + 1))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64(F.lit(seed), "_n"), F.lit(blocks)).cast("int"))
    tally = {r["_block"]: r["count"] for r in rows.groupBy("_block").count().collect()}
    matrix = communication_matrix([tally.get(b, 0) for b in range(blocks)], shard_sizes(n, shards), seed)
    ends = [{"_block": b, "_ends": np.cumsum(line).tolist()} for b, line in enumerate(matrix)]
    parsed = F.from_json(F.lit(json.dumps(ends)), "array<struct<_block:int,_ends:array<long>>>")
    deal = df.sparkSession.range(1).select(F.inline(parsed))

    local = Window.partitionBy("_block").orderBy(F.xxhash64(F.lit(seed + 1), "_n"), "_n")
    dealt = rows.withColumn("_at", F.row_number().over(local) - 1).join(deal, "_block")
    dealt = dealt.withColumn("shard", F.size(F.filter("_ends", lambda e: e <= F.col("_at"))))

    again = F.xxhash64(F.lit(seed + 2), "_n")
    dealt = cut(dealt.select("_row", "_n", "shard", F.pmod(again, F.lit(max(1, blocks // shards))).cast("int").alias("_part")))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_size"))
    bases = sizes.select("shard", "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("shard", "_part").orderBy(again, "_n")
    placed = dealt.withColumn("_at", F.row_number().over(inside) - 1).join(bases, ["shard", "_part"])
    return placed.select(*(F.col(f"_row.`{c}`").alias(c) for c in names), "shard", (F.col("_base") + F.col("_at")).alias("slot"))


def write_shards(df: DataFrame, path: str, shards: int, seed: int = 42) -> None:
    """The rows of ``df`` as one folder per shard, each file in ascending order of its slots."""
    shard(df, shards, seed).repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
