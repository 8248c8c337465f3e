"""Suffix-array dedup: repeated byte strings over all documents, with a logarithmic family of suffix arrays.

Only some suffixes are kept: of every window of ``length`` bytes, the one that begins with the window's smallest hash
of ``GRAM`` bytes. Equal windows choose the same place, so each repeat shows as suffixes that begin alike, and an array
holds about one suffix per 85 bytes. An array is a table sorted by suffix key: the first two bytes, then 48 bits of
the hash of the first GRAM.

A new batch of documents gets its own array, which is merge-scanned against all levels: keys that stand there already,
or twice in the batch, may start a long match. Two levels of one size merge into a level of twice the size. Each array
entry also names its whole run, the bytes of all windows that chose the suffix: equal runs are long matches as they
are. Of runs that share a key but differ, the windows are compared one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from punctual.llm.text import (
    ddl, HashFilter, group_bounds, hash_filter, list_array, mix, partitions_for, prefix_hash, range_hash, signed, text_buffers,
    text_slices, unsigned, whole_groups,
)
from punctual.runtime import TEXTS, cut, kept_dir, scratch, settings

LENGTH, GRAM = 200, 32
SLICE = 512 << 10
#: Distinct runs of one key that a task compares at once; for more, the windows are counted as rows.
BLOCK = 20_000
BATCHES = 4


class Runs:
    """Chosen suffixes of the texts in a buffer, and the run of windows that chose each (places in the buffer)."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, length: int):
        self.data, n = data, len(data)
        gram = min(GRAM, length)
        self.prefix = prefix_hash(data)
        empty = np.zeros(0, dtype=np.int64)
        self.anchor, self.low, self.high, self.row = empty, empty, empty, empty
        self.key = self.context = np.zeros(0, dtype=np.uint64)
        if n < length:
            return
        hashes = range_hash(self.prefix, np.arange(n - gram + 1), np.arange(gram, n + 1))
        lowest = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        # minima of ever longer stretches, the last two overlapping
        window, width = length - gram + 1, 1
        while 2 * width <= window:
            lowest = np.minimum(lowest[:-width], lowest[width:])
            width *= 2
        if width < window:
            lowest = np.minimum(lowest[: len(lowest) - (window - width)], lowest[window - width :])
        chosen = (lowest & np.uint64(0xFFFFFFFF)).astype(np.int64)
        sizes = np.diff(offsets)
        whole = np.flatnonzero(sizes >= length)
        inside = np.zeros(n + 1, dtype=np.int32)
        inside[offsets[whole]] += 1
        inside[offsets[whole + 1] - length + 1] -= 1
        valid = np.flatnonzero(np.cumsum(inside[: len(chosen)]))
        if not len(valid):
            return
        at = chosen[valid]
        bounds = group_bounds(at)
        self.anchor, self.low, self.high = at[bounds[:-1]], valid[bounds[:-1]], valid[bounds[1:] - 1]
        self.row = np.searchsorted(offsets, self.low, side="right") - 1
        head = self.data[self.anchor].astype(np.uint64) << np.uint64(56) | self.data[self.anchor + 1].astype(np.uint64) << np.uint64(48)
        self.key = head | hashes[self.anchor] >> np.uint64(16)
        shape = ((self.anchor - self.low) << 20 | (self.high - self.low)).astype(np.uint64)
        self.context = mix(range_hash(self.prefix, self.low, self.high + length) ^ mix(shape))


def _slices(batch: pa.RecordBatch, length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, Runs]]:
    for start, end in text_slices(batch, "text", SLICE):
        part = batch.slice(start, end - start)
        offsets, data = text_buffers(part.column("text"))
        yield part, offsets, Runs(offsets, data, length)


def suffix_array(texts: DataFrame, length: int, path: str) -> DataFrame:
    """The array of a batch: (key, context, n) sorted by suffix key, equal runs counted."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, runs in _slices(batch, length):
                order = np.lexsort((runs.context, runs.key))
                key, context = runs.key[order], runs.context[order]
                bounds = group_bounds(key, context)
                first = bounds[:-1]
                columns = [signed(key[first]), signed(context[first]), np.diff(bounds)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "context", "n"])

    return _sorted(texts.select("text").mapInArrow(entries, "key long, context long, n long"), path)


def _sorted(entries: DataFrame, path: str) -> DataFrame:
    """One table sorted by key; equal runs are summed where the ranges bring them together.

    Spark chooses the number of ranges by their size, so that a small level is not hundreds of files.
    """
    ranged = entries.repartitionByRange("key", "context").groupBy("key", "context").agg(F.sum("n").alias("n"))
    return cut(ranged.sortWithinPartitions("key", "context"), path=path)


class SuffixFamily:
    """Levels of suffix arrays, each twice the size of the one before, in a folder of their own."""

    def __init__(self, spark: SparkSession, folder: str, length: int = LENGTH):
        self.spark, self.folder, self.length = spark, folder, length
        self.levels: dict[int, DataFrame] = {}
        self.written = 0

    def _path(self) -> str:
        self.written += 1
        return f"{self.folder}/array{self.written}"

    def add(self, texts: DataFrame) -> DataFrame:
        """Adds a batch (column ``text``); returns the keys that occur in it and at least twice in all."""
        array = suffix_array(texts, self.length, self._path())
        rows = array.select("key", "n", F.lit(1).alias("new"))
        for level in self.levels.values():
            rows = rows.unionByName(level.select("key", "n", F.lit(0).alias("new")))
        met = rows.groupBy("key").agg(F.sum("n").alias("n"), F.max("new").alias("new"))
        hits = cut(met.where("n > 1 AND new = 1").select("key"), path=self._path())
        rank = 0
        while rank in self.levels:
            array = _sorted(array.unionByName(self.levels.pop(rank)), self._path())
            rank += 1
        self.levels[rank] = array
        return hits


def repeated_spans(texts: DataFrame, length: int = LENGTH, batches: int = BATCHES) -> DataFrame:
    """(text_a, text_b, spans) per distinct text with repeats: its 128-bit digest and the covered byte ranges, merged."""
    spark = texts.sparkSession
    texts = texts.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    with scratch(spark, "suffix") as work, settings(spark, TEXTS):
        family, hits = SuffixFamily(spark, f"{work}/levels", length), None
        for k in range(batches):
            found = family.add(texts.where(F.pmod(F.xxhash64("text"), F.lit(batches)) == k))
            hits = found if hits is None else hits.unionByName(found)
        likely = spark.sparkContext.broadcast(hash_filter(hits, "key", 25))
        runs = cut(_runs(texts, likely, length), path=f"{work}/runs")
        kinds = runs.groupBy("key", "context").agg(F.count(F.lit(1)).alias("n"), F.max("bytes").alias("bytes"), F.first("back").alias("back"))
        kinds = cut(kinds, path=f"{work}/kinds")
        several = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
        several = cut(several.where("kinds > 1 AND least = 1").select("key", "kinds"), path=f"{work}/several")
        partly = cut(_compared(kinds, several, length, work), path=f"{work}/partly")
        whole = kinds.where("n > 1").select("key", "context", F.lit(None).cast("array<int>").alias("ranges"))
        member = runs.drop("bytes").join(whole.unionByName(partly), ["key", "context"])
        all_of = F.array(F.struct(F.col("low").alias("s"), (F.col("high") + length).alias("e")))
        pieces = F.transform(F.sequence(F.lit(0), F.floor(F.size("ranges") / 2).cast("int") - 1), lambda i: F.struct((F.col("low") + F.get("ranges", 2 * i)).alias("s"), (F.col("low") + F.get("ranges", 2 * i + 1)).alias("e")))
        spans = member.select("text_a", "text_b", F.explode(F.when(F.col("ranges").isNull(), all_of).otherwise(pieces)).alias("span")).distinct()
        grouped = spans.groupBy("text_a", "text_b").agg(F.sort_array(F.collect_list("span")).alias("spans"))
        return cut(grouped, path=kept_dir(spark, "spans"))


def digests(part: pa.RecordBatch, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """128-bit digests of the texts, as pairs of longs: the first half of their sha256, as in ``_with_digests``."""
    raw = data.tobytes()
    out = b"".join(hashlib.sha256(raw[a:b]).digest()[:16] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))
    return np.frombuffer(out, dtype=">i8").astype(np.int64).reshape(len(part), 2)


def _with_digests(rows: DataFrame) -> DataFrame:
    """``rows`` with the sha256 of their text (a null counts as empty) and its first half, text_a and text_b."""
    hashed = rows.withColumn("_sha", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    return hashed.withColumns({c: F.conv(F.substring("_sha", at, 16), 16, -10).cast("long") for c, at in (("text_a", 1), ("text_b", 17))})


def _runs(texts: DataFrame, likely, length: int) -> DataFrame:
    """All runs with a key that repeats, their places in the text; the bytes where a slice meets a run first."""

    def runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: HashFilter = likely.value
        for batch in batches:
            for part, offsets, runs in _slices(batch, length):
                take = np.flatnonzero(held.has(runs.key))
                if not len(take):
                    continue
                digest = digests(part, offsets, runs.data)
                row, low, high = runs.row[take], runs.low[take], runs.high[take]
                _, first = np.unique(mix(runs.key[take]) ^ runs.context[take], return_index=True)
                show = np.zeros(len(take), dtype=bool)
                show[first] = True
                raw = runs.data.tobytes()
                content = [raw[a : b + length] if s else None for a, b, s in zip(low.tolist(), high.tolist(), show.tolist(), strict=True)]
                base = offsets[row]
                columns = [
                    pa.array(signed(runs.key[take])), pa.array(signed(runs.context[take])), pa.array(digest[row, 0]), pa.array(digest[row, 1]),
                    pa.array((low - base).astype(np.int32)), pa.array((high - base).astype(np.int32)), pa.array((runs.anchor[take] - low).astype(np.int32)),
                    pa.array(content, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "context", "text_a", "text_b", "low", "high", "back", "bytes"])

    return texts.mapInArrow(runs_of, "key long, context long, text_a long, text_b long, low int, high int, back int, bytes binary")


def _windows(bytes_of: list[bytes], back: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, window start in the run, hash) of all windows; equal hashes also stand equally far before the suffix."""
    sizes = np.array([len(b) for b in bytes_of], dtype=np.int64)
    prefix = prefix_hash(np.frombuffer(b"".join(bytes_of), dtype=np.uint8))
    count = sizes - length + 1
    run = np.repeat(np.arange(len(sizes)), count)
    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = start + np.repeat(np.cumsum(sizes) - sizes, count)
    return run, start, range_hash(prefix, at, at + length) ^ mix((back[run] - start).astype(np.uint64))


def _ranges(run: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte ranges covered by repeated windows: (run, begin, end) of each, windows sorted by run and start."""
    new = np.ones(len(run), dtype=bool)
    new[1:] = (run[1:] != run[:-1]) | (start[1:] > start[:-1] + length)
    bounds = np.append(np.flatnonzero(new), len(run))
    first, last = bounds[:-1], bounds[1:] - 1
    return run[first], start[first], start[last] + length


def _compared(kinds: DataFrame, several: DataFrame, length: int, work: str) -> DataFrame:
    """(key, context, ranges) of runs that stand once and share windows with other runs of their key."""
    rows = kinds.join(several, "key")
    small = rows.where(F.col("kinds") <= BLOCK).select("key", "context", "n", "back", "bytes")
    tasks = partitions_for(several.agg(F.sum("kinds")).first()[0] or 0, 20_000, int(kinds.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    small = small.repartition(tasks, "key").sortWithinPartitions("key", "context")
    out = "key long, context long, ranges array<int>"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups((b.slice(i, 4096) for b in batches for i in range(0, len(b), 4096)), "key"):
            key, context, n, back = (table[c].to_numpy() for c in ("key", "context", "n", "back"))
            run, start, window = _windows(table["bytes"].to_pylist(), back, length)
            window = mix(window ^ mix(unsigned(key)[run]))
            order = np.argsort(window, kind="stable")
            bounds = group_bounds(window[order])
            times = np.add.reduceat(n[run[order]], bounds[:-1]) if len(order) else np.zeros(0, dtype=np.int64)
            repeated = np.zeros(len(run), dtype=bool)
            repeated[order] = np.repeat(times > 1, np.diff(bounds))
            repeated &= n[run] == 1
            yield _ranged(key, context, run[repeated], start[repeated], length)

    found = small.mapInArrow(compare, out)
    large = rows.where((F.col("kinds") > BLOCK)).select("key", "context", "n", "back", "bytes")
    if large.isEmpty():
        return found

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 2048):
                part = batch.slice(i, 2048)
                run, start, window = _windows(part.column("bytes").to_pylist(), part.column("back").to_numpy(), length)
                columns = [part.column(c).take(pa.array(run)) for c in ("key", "context", "n")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(start.astype(np.int32)), pa.array(signed(window))], names=["key", "context", "n", "start", "window"])

    windows = cut(large.mapInArrow(spread, "key long, context long, n long, start int, window long"), path=f"{work}/windows")
    repeated = cut(windows.groupBy("key", "window").agg(F.sum("n").alias("times")).where("times > 1").select("key", "window"), path=f"{work}/repeated")
    hit = windows.where("n = 1").join(repeated, ["key", "window"]).groupBy("key", "context").agg(F.sort_array(F.collect_list("start")).alias("starts"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = batch.column("starts")
            run = np.repeat(np.arange(len(batch)), np.diff(starts.offsets.to_numpy()))
            yield _ranged(batch.column("key").to_numpy(), batch.column("context").to_numpy(), run, starts.flatten().to_numpy().astype(np.int64), length)

    return found.unionByName(hit.mapInArrow(gather, out))


def _ranged(key: np.ndarray, context: np.ndarray, run: np.ndarray, start: np.ndarray, length: int) -> pa.RecordBatch:
    owner, begin, end = _ranges(run, start, length)
    runs, counts = np.unique(owner, return_counts=True)
    flat = np.stack([begin, end], axis=1).ravel().astype(np.int32)
    columns = [pa.array(key[runs]), pa.array(context[runs]), list_array(2 * counts, flat)]
    return pa.RecordBatch.from_arrays(columns, names=["key", "context", "ranges"])


def remove_repeats(df: DataFrame, text: str = "text", length: int = LENGTH, batches: int = BATCHES, keep_text: bool = True) -> DataFrame:
    """``df`` without each byte that lies in a string of ``length`` bytes which also starts anywhere else in it.

    Adds n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 of the remaining bytes and, with
    ``keep_text``, ``kept``, their text (a character that lost some of its bytes is left out). Texts are UTF-8 bytes, a null counts as empty;
    matches stay inside a text, but equal texts match each other, so every copy of one with ``length`` bytes or more
    goes whole. Strings are judged on the input. Other columns are kept, those with the names of the results replaced;
    ids are not used. Byte strings are known by hashes of 64 bits together with a key of 64. An empty table gives an
    empty one.
    """
    spark = df.sparkSession
    results = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    plain = df.drop(*results)
    names = [c for c in plain.columns if c != text]
    row = F.struct(*(F.col(f"`{c}`") for c in names)) if names else F.lit(0)
    rows = plain.select(F.col(text).cast("string").alias("text"), row.alias("_row"))
    spans = repeated_spans(rows, length, batches)
    likely = spark.sparkContext.broadcast(hash_filter(spans, "text_a", 23))
    kind = ddl(next(f for f in rows.schema if f.name == "_row").dataType)
    done = f"_row {kind}, text string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"

    @F.arrow_udf("boolean")
    def listed(digest: pa.Array) -> pa.Array:
        return pa.array(likely.value.has(unsigned(digest.to_numpy())))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in text_slices(batch, "text"):
                part = batch.slice(start, end - start)
                offsets, data = text_buffers(part.column("text"))
                raw, removed, count, kept = data.tobytes(), [], [], []
                for i, found in enumerate(part.column("spans").to_pylist()):
                    one, at, left, n = raw[offsets[i] : offsets[i + 1]], 0, [], 0
                    for span in found or []:
                        if span["s"] > at or n == 0:
                            left.append(one[at : span["s"]])
                            n += 1
                        at = max(at, span["e"])
                    left.append(one[at:])
                    kept.append(b"".join(left))
                    removed.append(len(one) - len(kept[-1]))
                    count.append(n)
                sha = [hashlib.sha256(k).hexdigest() for k in kept]
                text_left = [k.decode("utf-8", "ignore") if keep_text else None for k in kept]
                columns = [pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(sha, pa.string()), pa.array(text_left, pa.string())]
                yield pa.RecordBatch.from_arrays([part.column("_row"), part.column("text"), *columns], names=["_row", "text", *results])

    # rows without repeats stay with Spark, only digests go to the workers; bytes that are no UTF-8 are left out there
    known = _with_digests(rows)
    maybe = listed("text_a") | ~F.coalesce(F.is_valid_utf8("text"), F.lit(True))
    whole = F.coalesce("text", F.lit(""))
    zero = F.lit(0).cast("long")
    found = [F.octet_length(whole).cast("long"), zero, zero, F.col("_sha"), whole if keep_text else F.lit(None).cast("string")]
    clean = known.where(~maybe).select("_row", "text", *(c.alias(name) for c, name in zip(found, results, strict=True)))
    stripped = known.where(maybe).join(spans, ["text_a", "text_b"], "left").select("_row", "text", "spans").mapInArrow(strip, done)
    columns = [F.col("text").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in plain.columns]
    return clean.unionByName(stripped).select(*columns, *(results if keep_text else results[:-1]))
