"""Embedding near-dedup: an inverted multi-index with multi-sequence traversal, verified by cosine.

Unit vectors are halved; each half has a codebook of its own, and the two together form a grid of cells. A vector lies
in the cell of its nearest centroids. From a vector, cells are visited in the order of how far a partner must have
moved to fall into them: the distance of the half to the bisector of two centroids, squared and summed over the halves.
Partners are at most r apart, and of a difference in a random direction only a part points to a bisector, so the
traversal ends where the target recall is reached (with target recall 1: where no partner can be, in any direction).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from punctual.llm.components import components
from punctual.runtime import cut, kept_dir, scratch

#: The codebooks are fitted on about this many vectors at most, drawn by a hash.
SAMPLE = 32_768
#: Vectors per cell aimed at; and rows of a cell compared at once.
CELL, BLOCK = 256, 1024


@dataclass
class Grid:
    """The codebooks of both halves, and how far the traversal goes."""

    books: tuple[np.ndarray, np.ndarray]
    reach: float

    @classmethod
    def fit(cls, sample: np.ndarray, size: int, threshold: float, target_recall: float, seed: int = 7) -> Grid:
        half, rng = sample.shape[1] // 2, np.random.default_rng(seed)
        books = tuple(_kmeans(part, size, rng) for part in (sample[:, :half], sample[:, half:]))
        r2, d = 2 - 2 * threshold, sample.shape[1]
        # of a random direction in d dimensions, the share of two squared coordinates exceeds q with (1 - q)^(d/2 - 1)
        share = 1.0 if target_recall >= 1 or d <= 4 else 1 - (1 - target_recall) ** (2 / (d - 2))
        return cls(books, r2 * share)

    def margins(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per half the squared distance to the bisector with each centroid's cell (0 for the own one)."""
        out, at = [], 0
        for book in self.books:
            part = unit[:, at : at + book.shape[1]]
            at += book.shape[1]
            d = ((part**2).sum(1)[:, None] - 2 * part @ book.T) + (book**2).sum(1)[None, :]
            own = d.argmin(1)
            # distances of the own centroids to all, per vector as many numbers as d has
            norms = (book**2).sum(1)
            gap2 = norms[own][:, None] + norms[None, :] - 2 * book[own] @ book.T
            same = gap2 <= 1e-12 * (norms[own][:, None] + norms[None, :])  # as good as one centroid: no bisector
            lower = np.maximum(d - d[np.arange(len(d)), own][:, None], 0) / (2 * np.sqrt(np.where(same, 1, gap2)))
            lower[same] = 0
            lower[np.arange(len(d)), own] = 0
            out.append(lower**2)
        return out[0], out[1]

    def cells(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Own cell of each vector."""
        out, at = [], 0
        for book in self.books:
            part = unit[:, at : at + book.shape[1]]
            at += book.shape[1]
            out.append((((part**2).sum(1)[:, None] - 2 * part @ book.T) + (book**2).sum(1)[None, :]).argmin(1))
        return out[0], out[1]

    def visited(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(vector, cell, whether it is the own one) of every visit, nearest first."""
        one, two = self.margins(unit)
        first, second = self.cells(unit)
        width = len(self.books[1])
        who, where = [], []
        for k in range(len(unit)):
            a, b = np.argsort(one[k], kind="stable"), np.argsort(two[k], kind="stable")
            far = two[k][b]
            for i in a:
                rest = self.reach - one[k][i]
                if rest < 0:
                    break
                n = int(np.searchsorted(far, rest, side="right"))
                where.append(i * width + b[:n])
                who.append(np.full(n, k))
        who, where = np.concatenate(who), np.concatenate(where)
        own = where == (first * width + second)[who]
        return who, where, own


def _kmeans(rows: np.ndarray, size: int, rng: np.random.Generator, steps: int = 12) -> np.ndarray:
    centres = rows[rng.choice(len(rows), min(size, len(rows)), replace=False)].copy()
    for _ in range(steps):
        d = (centres**2).sum(1)[None, :] - 2 * rows @ centres.T
        own = d.argmin(1)
        counts = np.bincount(own, minlength=len(centres))
        sums = np.stack([np.bincount(own, weights=rows[:, j], minlength=len(centres)) for j in range(rows.shape[1])], axis=1)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def link_vectors(
    df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.98,
    target_recall: float = 0.9999, sample: int = SAMPLE, cell: int = CELL,
) -> DataFrame:
    """Per row ``id``, n_links, component_id and kept.

    Two rows link if their labels are equal and not null, their vectors have the same number of components, and the
    cosine of these (double precision) is ``threshold`` or more. ``n_links`` counts other rows linked directly,
    ``component_id`` is the smallest id that links reach from the row, ``kept`` says that it is the row's own.
    A vector that is null, empty, zero, or holds nulls or numbers that are not finite links with nothing, as does a
    row with a null label or id. Equal vectors with one label are one node, named by their smallest id; rows that
    share an id are taken for one vector in what they reach. Other columns are not read.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col("id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    sound = F.coalesce(sound, F.lit(False))
    valid = rows.where(sound).withColumn("hash", F.xxhash64("label", "vector"))
    nodes = valid.groupBy("hash", "label", "vector").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"))
    with scratch(spark, "vectors") as work:
        nodes = cut(nodes, path=kept_dir(spark, "vectors"))
        found = cut(_found(nodes, threshold, target_recall, sample, cell, work), path=f"{work}/found")
        links = found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b"))
        groups = components(links)
        counts = found.where("other IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
        marked = nodes.join(counts, "node", "left").join(groups, "node", "left")
        marked = cut(
            marked.select("hash", "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id"))
        )
    linked = valid.join(marked, ["hash", "label", "vector"]).select("id", "n_links", "component_id")
    alone = rows.where(~sound).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))


def _found(nodes: DataFrame, threshold: float, target_recall: float, sample: int, cell: int, work: str) -> DataFrame:
    """(node, other, links): other null: direct links of the node; else a link, enough of them to connect a component."""
    spark = nodes.sparkSession
    labels = nodes.groupBy(F.size("vector").alias("d"), "label").agg(F.count(F.lit(1)).alias("n"))
    # labels of about one size share a grid: tiers by the number of hexadecimal digits
    labels = cut(labels.withColumn("tier", F.length(F.hex("n"))), path=f"{work}/labels")
    tally = labels.groupBy("d", "tier").agg(F.sum("n").alias("n"), F.max("n").alias("largest")).collect()
    out = spark.createDataFrame([], "node long, other long, links long")
    for r in tally:  # a table has one width of vectors and few tiers as a rule
        own = nodes.where(F.size("vector") == r["d"])
        if sum(x["d"] == r["d"] for x in tally) > 1:
            of = labels.where((F.col("d") == r["d"]) & (F.col("tier") == r["tier"])).select("label")
            own = own.join(of, "label", "left_semi")
        found = _of_width(own, r["d"], r["n"], r["largest"], threshold, target_recall, sample, cell, f"{work}/{r['d']}-{r['tier']}")
        out = out.unionByName(found)
    return out


def _of_width(nodes: DataFrame, d: int, n: int, largest: int, threshold: float, target_recall: float, sample: int, cell: int, work: str) -> DataFrame:
    spark = nodes.sparkSession
    drawn = nodes.where(F.pmod(F.col("hash"), F.lit(1_000_000)) < max(1, int(min(1.0, sample / n) * 1_000_000)))
    vectors = drawn.select("vector").toArrow()["vector"].combine_chunks()
    points = vectors.flatten().to_numpy().reshape(-1, d) if len(vectors) else np.ones((1, d))
    size = int(max(1, min(4096, np.ceil(np.sqrt(largest / cell)))))
    grid = spark.sparkContext.broadcast(Grid.fit(_units(points), size, threshold, target_recall))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 1024):
                part = batch.slice(start, 1024)
                unit = _units(part.column("vector").flatten().to_numpy().reshape(-1, d))
                who, where, own = grid.value.visited(unit)
                columns = [part.column(c).take(pa.array(who)) for c in ("node", "copies", "label", "vector")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(where.astype(np.int64)), pa.array(own)], names=["node", "copies", "label", "vector", "cell", "own"])

    visits = nodes.select("node", "copies", "label", "vector").mapInArrow(place, "node long, copies long, label string, vector array<double>, cell long, own boolean")
    visits = cut(visits, path=f"{work}/visits")
    sizes = visits.groupBy("label", "cell").agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("own")).alias("own_rows"))
    # a cell's residents and its visitors fall into chunks; every block has one chunk of each
    sizes = cut(sizes.where("own_rows > 0").select("label", "cell", F.ceil(F.col("all") / BLOCK).cast("int").alias("q"), F.ceil(F.col("own_rows") / BLOCK).cast("int").alias("r")), path=f"{work}/cells")
    rows = visits.join(sizes, ["label", "cell"])
    chunk = lambda of, c: F.pmod(F.xxhash64("node", F.lit(of)), F.col(c)).cast("int")
    asked = rows.select("*", F.lit(True).alias("asks"), chunk("q", "q").alias("qc"), F.explode(F.sequence(F.lit(0), F.col("r") - 1)).alias("rc"))
    held = rows.where("own").select("*", F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0), F.col("q") - 1)).alias("qc"), chunk("r", "r").alias("rc"))
    blocks = asked.unionByName(held).select("node", "copies", "label", "vector", "cell", "own", "asks", "qc", "rc")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        g = grid.value
        asks, holds = pdf[pdf.asks], pdf[~pdf.asks]
        a, b = (_units(np.stack(x.vector.to_numpy())) if len(x) else np.zeros((0, d)) for x in (asks, holds))
        na, nb, own = asks.node.to_numpy(), holds.node.to_numpy(), asks.own.to_numpy(dtype=bool)
        ca, cb = asks.copies.to_numpy(), holds.copies.to_numpy()
        i, j = np.nonzero(a @ b.T >= threshold) if len(a) and len(b) else (np.zeros(0, dtype=int),) * 2
        keep = na[i] != nb[j]
        # inside a cell a pair shows from both sides and counts for the one that asks; a pair of two cells counts for
        # both at once, where the smaller node asks if both visit each other, else where it shows at all
        outside = np.flatnonzero(~own)
        if len(outside) and len(b):
            first, second = g.cells(a)
            m1, m2 = g.margins(b)
            seen_back = m1[j][np.arange(len(j)), first[i]] + m2[j][np.arange(len(j)), second[i]] <= g.reach
            keep &= own[i] | ~seen_back | (na[i] < nb[j])
        i, j = i[keep], j[keep]
        both = ~own[i]
        links = pd.concat([pd.Series(cb[j], index=na[i]), pd.Series(ca[i[both]], index=nb[j[both]])]).groupby(level=0).sum()
        edges = _forest(na[i], nb[j])
        return pd.concat(
            [
                pd.DataFrame({"node": links.index.to_numpy(dtype=np.int64), "other": pd.array([None] * len(links), dtype="Int64"), "links": links.to_numpy(dtype=np.int64)}),
                pd.DataFrame({"node": edges[:, 0], "other": pd.array(edges[:, 1], dtype="Int64"), "links": np.zeros(len(edges), dtype=np.int64)}),
            ]
        )

    return blocks.groupBy("label", "cell", "qc", "rc").applyInPandas(compare, "node long, other long, links long")


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """As many of the links as connect what all of them connect: each node with the smallest it reaches."""
    if not len(a):
        return np.zeros((0, 2), dtype=np.int64)
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = where[: len(a)], where[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    own = root != np.arange(len(nodes))
    return np.stack([nodes[own], nodes[root[own]]], axis=1)
