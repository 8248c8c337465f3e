"""Benchmark decontamination: a prefix-filtered set join of item windows with document words.

An item is cut into windows of WINDOW words (a shorter item is one window), a window into shingles of up to three
words. A document's words are kept only where every shingle is one of the benchmark's, so the rest is small. Shingles
are ordered by rarity in the documents: since a window must be contained as a whole, its rarest shingle alone is the
prefix to join on. Length and position bounds drop pairs whose window would leave the kept stretch; the others are
compared word for word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from punctual.llm.text import (
    ddl, ALNUM, HashFilter, hash_filter, list_array, mix, per_row, shingles, signed, text_buffers, text_slices, words,
)
from punctual.runtime import TEXTS, cut, kept_dir, scratch, settings

WINDOW, SHINGLE = 10, 3
#: Bytes of texts that a task takes apart at once; its arrays take some fifty times as much.
SLICE = 1 << 19


def item_windows(items: DataFrame, id_col: str, text: str, window: int) -> DataFrame:
    """(item, window, words): all runs of ``window`` words of each item, or all its words if it has fewer."""

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in text_slices(batch, "text", SLICE):
                part = batch.slice(start, end - start)
                rows, hashes = words(*text_buffers(part.column("text")), ALNUM)
                n = per_row(rows, len(part))
                owners, lists = [], []
                for k, base in enumerate(np.cumsum(n) - n):
                    for i in range(max(1, n[k] - window + 1) if n[k] else 0):
                        owners.append(k)
                        lists.append(hashes[base + i : base + min(n[k], i + window)])
                sizes = np.array([len(x) for x in lists], dtype=np.int64)
                flat = np.concatenate(lists) if lists else np.zeros(0, dtype=np.uint64)
                names = [mix(np.add.reduce(mix(x) * mix(np.arange(1, len(x) + 1, dtype=np.uint64))) + np.uint64([len(x)])) for x in lists]
                name = signed(np.concatenate(names)) if names else np.zeros(0, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([part.column("item").take(pa.array(owners, pa.int64())), pa.array(name), list_array(sizes, signed(flat))], names=["item", "window", "words"])

    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    return rows.where("text IS NOT NULL").mapInArrow(cut_up, "item string, window long, words array<long>")


def window_shingles(windows: DataFrame) -> DataFrame:
    """(window, n, at, token): the shingles of each distinct window; of SHINGLE words, or of all if it has fewer."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("words")
            flat, sizes = lists.flatten().to_numpy().view(np.uint64), np.diff(lists.offsets.to_numpy())
            rows = np.repeat(np.arange(len(batch)), sizes)
            for size in range(1, SHINGLE + 1):
                own = sizes[rows] == size if size < SHINGLE else sizes[rows] >= size
                at, token = shingles(rows[own], flat[own], size)
                base = np.concatenate([[0], np.cumsum(np.bincount(rows[own], minlength=len(batch)))])
                row = rows[own][at]
                columns = [batch.column("window").take(pa.array(row)), pa.array(sizes[row].astype(np.int64)), pa.array(at - base[row]), pa.array(signed(token))]
                yield pa.RecordBatch.from_arrays(columns, names=["window", "n", "at", "token"])

    return windows.select("window", "words").dropDuplicates(["window"]).mapInArrow(tokens, "window long, n long, at long, token long")


def _stretches(docs: DataFrame, likely, sizes: list[int]) -> DataFrame:
    """Per row (row, id, n_words, stretches): runs of words all of whose shingles may be the benchmark's.

    One list per shingle size in use, since shorter items have shorter shingles; a stretch has at least as many words
    as the shortest window whose shingles are of that size.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[HashFilter, int]] = likely.value
        for batch in batches:
            for start, end in text_slices(batch, "text", SLICE):
                part = batch.slice(start, end - start)
                rows, hashes = words(*text_buffers(part.column("text")), ALNUM)
                first = np.concatenate([[0], np.cumsum(per_row(rows, len(part)))])
                owner, begin, kind, lists = [], [], [], []
                for size in sizes:
                    seen, shortest = held[size]
                    at, token = shingles(rows, hashes, size)
                    at = at[seen.has(token)]
                    new = np.ones(len(at), dtype=bool)
                    new[1:] = (at[1:] != at[:-1] + 1) | (rows[at[1:]] != rows[at[:-1]])
                    bounds = np.append(np.flatnonzero(new), len(at))
                    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                        low, high = at[a], at[b - 1] + size
                        if high - low >= shortest:
                            owner.append(rows[low])
                            begin.append(low - first[rows[low]])
                            kind.append(size)
                            lists.append(hashes[low:high])
                order = np.argsort(np.array(owner, dtype=np.int64), kind="stable")
                flat = [lists[i] for i in order]
                inner = list_array([len(x) for x in flat], signed(np.concatenate(flat)) if flat else np.zeros(0, dtype=np.int64))
                fields = [pa.array(np.array(begin, dtype=np.int64)[order]), pa.array(np.array(kind, dtype=np.int64)[order]), inner]
                structs = pa.StructArray.from_arrays(fields, names=["begin", "size", "words"])
                counts = np.bincount(np.array(owner, dtype=np.int64), minlength=len(part))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.diff(first)), list_array(counts, structs)], names=["id", "n_words", "stretches"])

    kind = ddl(docs.schema["id"].dataType)
    return docs.mapInArrow(keep, f"id {kind}, n_words long, stretches array<struct<begin:long,size:long,words:array<long>>>")


def _exploded(rows: DataFrame) -> DataFrame:
    """(row, begin, token, at, words): the shingles of all stretches."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 256):
                part = batch.slice(k, 256)
                stretch = part.column("words")
                flat, sizes = stretch.flatten().to_numpy().view(np.uint64), np.diff(stretch.offsets.to_numpy())
                owners = np.repeat(np.arange(len(part)), sizes)
                base = np.concatenate([[0], np.cumsum(sizes)])
                kind = part.column("size").to_numpy()
                for size in np.unique(kind):
                    at, token = shingles(owners, flat, int(size))
                    at, token = at[kind[owners[at]] == size], token[kind[owners[at]] == size]
                    who = owners[at]
                    near = [flat[max(base[w], a - WINDOW_REACH) : min(base[w + 1], a + WINDOW_REACH)] for w, a in zip(who, at, strict=True)]
                    left = np.minimum(at - base[who], WINDOW_REACH)
                    values = np.concatenate(near) if near else np.zeros(0, dtype=np.uint64)
                    columns = [
                        part.column("row").take(pa.array(who)), part.column("begin").take(pa.array(who)), pa.array(signed(token)),
                        pa.array(at - base[who]), pa.array(left.astype(np.int32)), list_array([len(x) for x in near], signed(values)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["row", "begin", "token", "at", "left", "near"])

    out = "row long, begin long, token long, at long, left int, near array<long>"
    return rows.select("row", F.inline("stretches")).mapInArrow(tokens, out)


#: Words on each side that go along with a joined shingle; no window reaches further.
WINDOW_REACH = 64


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: ``id``, n_words, n_hit, n_items and items (sorted texts of the item ids).

    Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z, compared by 64-bit hashes. A word of a document
    is hit if it lies in an occurrence of a window; an item counts if one of its windows occurs. A null or empty text
    has no words; an item without words has no window, one without an id hits words but is not listed. Rows of ``docs``
    stay apart even if they are equal or have no id; equal items, and items with the same id, are listed once. Other
    columns are not read. Nothing of the benchmark but bitmaps of fixed size is sent to all tasks.
    """
    if not 1 <= window <= WINDOW_REACH:
        raise ValueError(f"window must be from 1 to {WINDOW_REACH}")
    spark = docs.sparkSession
    with scratch(spark, "decontaminate") as work, settings(spark, TEXTS):
        listed = cut(item_windows(items, item_col, item_text, window), path=f"{work}/windows")
        tokens = cut(window_shingles(listed), path=f"{work}/shingles")
        of_size = F.least(F.col("n"), F.lit(SHINGLE))
        lengths = {r["size"]: r["n"] for r in tokens.groupBy(of_size.alias("size")).agg(F.min("n").alias("n")).collect()}
        filters = {size: (hash_filter(tokens.where(of_size == size), "token", 22), n) for size, n in lengths.items()}
        likely = spark.sparkContext.broadcast(filters)
        texts = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
        rows = _stretches(texts, likely, sorted(lengths)).withColumn("row", F.monotonically_increasing_id())
        rows = cut(rows, path=kept_dir(spark, "stretches"))
        found = cut(_exploded(rows.where(F.size("stretches") > 0)), path=f"{work}/found")
        rarity = found.groupBy("token").agg(F.count(F.lit(1)).alias("times"))
        # a window with a shingle that no document has cannot occur
        known = tokens.join(cut(rarity, path=f"{work}/rarity"), "token")
        whole = F.col("n") - F.least(F.col("n"), F.lit(SHINGLE)) + 1
        prefix = known.groupBy("window", "n").agg(F.min(F.struct("times", "token", "at")).alias("rarest"), F.count(F.lit(1)).alias("shingles"))
        prefix = prefix.where(F.col("shingles") == whole).select("window", "n", F.col("rarest.token").alias("token"), F.col("rarest.at").alias("offset"))
        content = listed.select("window", "words").dropDuplicates(["window"])
        prefix = cut(prefix.join(content, "window"), path=f"{work}/prefix")
        pairs = found.join(prefix, "token")
        start = F.col("left") - F.col("offset")
        fits = (start >= 0) & (start + F.col("n") <= F.size("near"))
        same = F.slice("near", F.greatest(start, F.lit(0)).cast("int") + 1, F.col("n").cast("int")) == F.col("words")
        hits = pairs.where(fits & same).select("row", "window", (F.col("begin") + F.col("at") - F.col("offset")).alias("s"), "n").distinct()
        hits = cut(hits, path=f"{work}/hits")
        places = hits.select("row", F.explode(F.sequence(F.col("s"), F.col("s") + F.col("n") - 1)).alias("word")).distinct()
        n_hit = places.groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
        named = listed.where("item IS NOT NULL").select("item", "window").distinct()
        items_of = hits.select("row", "window").distinct().join(named, "window").select("row", "item").distinct()
        items_of = items_of.groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
        marked = cut(n_hit.join(items_of, "row", "left"))
    out = rows.select("row", "id", "n_words").join(marked, "row", "left")
    none = F.array().cast("array<string>")
    return out.select("id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(F.coalesce("items", none)).cast("long").alias("n_items"), F.coalesce("items", none).alias("items"))
