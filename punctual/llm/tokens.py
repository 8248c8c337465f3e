"""Token-ID output: texts encoded, ordered by document, kept as wavelet matrices, read back from the files.

A shard is one file that Spark commits (Parquet, one row per block of documents): numbers of the shard and the block, the
documents' ids and token counts, bit-planes, zero counts and rank directories, each column compressed. Spark's
commit keeps files of lost or repeated tasks out, on any file system the session reaches. Ids are read back whole
(``read_tokens``), by place (``token_at``), or counted and found by id (``occurrences``, ``places_of``).
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from punctual.llm.kneser_ney import unique_keys
from punctual.llm.text import byte_class, group_bounds, list_array, partitions_for, prefix_hash, range_hash, text_buffers, text_slices
from punctual.llm.wavelet import WaveletMatrix
from punctual.runtime import cut

END = 0
#: Texts of a shard, in bytes of UTF-8 on the average.
SHARD_BYTES = 16 << 20
#: A matrix takes the documents that begin within so many tokens; a shard has several matrices, in order.
BLOCK_TOKENS = 200_000
CACHED_WORDS = 2_500_000
#: Shards whose totals are summed up in one task; the groups of so many are summed up in another.
GROUP = 4096
#: Places of one block that one row asks for, rows that one batch answers.
ASKED = 100_000

FILE = StructType(
    [
        StructField("shard", IntegerType()),
        StructField("block", IntegerType()),
        StructField("doc_ids", ArrayType(LongType())),
        StructField("doc_tokens", ArrayType(LongType())),
        StructField("size", LongType()),
        StructField("zeros", ArrayType(LongType())),
        StructField("planes", ArrayType(BinaryType())),
        StructField("ranks", ArrayType(BinaryType())),
    ]
)


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: ASCII bytes by class, for cutting texts.
_WHITE = byte_class((0x09, 0x0D), (0x20, 0x20))
_SOLID = byte_class((0x21, 0x7E))
_LETTER = byte_class((0x41, 0x5A), (0x61, 0x7A))
_MARK = byte_class((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))


#: A space at most, then letters (of one byte, or of two from U+00C0 to U+00FF without the two signs among them).
_WORD = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def _byte_letters() -> dict[int, int]:
    """How byte-level vocabularies write each byte: visible Latin-1 characters as they are, others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: b for b in visible} | {b: 0x100 + k for k, b in enumerate(hidden)}


_BYTES = _byte_letters()


class Encoder:
    """Ids of whole texts, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    The byte-level pre-tokenizer splits before a white space that follows none, and before a punctuation mark that
    follows a letter; what it does from there on does not depend on what stands before. So texts are cut at such
    places, and every distinct piece (by a 64-bit hash of its bytes) goes through the tokenizer once as long as the
    worker remembers it. New pieces go there many at a time, with a special token between them, which keeps them apart.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.kind = np.dtype("<u4" if self.tokenizer.get_vocab_size() > 1 << 16 else "<u2")
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self.between, self.between_id = next(iter(added.items()), (None, None))
        self.added = list(added)
        # with nothing but the byte-level split, letters after at most one space are one word for the model
        split = json.loads(self.tokenizer.to_str())
        kind, plain = split["pre_tokenizer"] or {}, split["normalizer"] is None
        byte_level = kind.get("type") == "ByteLevel" and not kind.get("add_prefix_space") and kind.get("use_regex", True)
        self.model = self.tokenizer.model if plain and byte_level else None
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.flat, self.starts, self.used = np.zeros(1 << 16, dtype=self.kind), np.zeros(1 << 16, dtype=np.int64), 0

    def _learn(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in a row, and their number per piece."""
        found: list[list[int]] = [[]] * len(texts)
        rest = []
        for k, t in enumerate(texts):
            if self.model is not None and _WORD.fullmatch(t):
                found[k] = [x.id for x in self.model.tokenize(t.decode("latin-1").translate(_BYTES))]
            else:
                rest.append(k)
        others = [texts[k].decode() for k in rest]
        if self.between is None or any(a in t for t in others for a in self.added):
            for k, e in zip(rest, self.tokenizer.encode_batch_fast(others, add_special_tokens=False), strict=True):
                found[k] = e.ids
        elif rest:
            ids, low = self.tokenizer.encode(self.between.join(others), add_special_tokens=False).ids, 0
            ids.append(self.between_id)
            for k in rest:
                high = ids.index(self.between_id, low)
                found[k], low = ids[low:high], high + 1
        return np.fromiter(chain.from_iterable(found), dtype=self.kind), np.fromiter(map(len, found), dtype=np.int64)

    def _remember(self, hashes: list[int], texts: list[bytes]) -> None:
        for k in range(0, len(texts), 8192):
            flat, sizes = self._learn(texts[k : k + 8192])
            n, ends = len(self.known), np.cumsum(sizes)
            while n + len(sizes) + 1 > len(self.starts):
                self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            while self.used + len(flat) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.starts[n + 1 : n + 1 + len(sizes)] = self.used + ends
            self.flat[self.used : self.used + len(flat)] = flat
            self.used += len(flat)
            self.known.update(zip(hashes[k : k + 8192], range(n, n + len(sizes)), strict=True))

    def encode(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a buffer in one array, and their number per text."""
        full = offsets[:-1][np.diff(offsets) > 0]
        low, before, lead = data[2:], data[1:-1], data[:-2]
        wide = (before >= 0x80) & (lead >= 0xC3) & (lead < 0xE0)  # two bytes, from U+00C0 on: no white space
        latin = (lead == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7)
        cut = (_WHITE[low] & (_SOLID[before] | wide)) | (_MARK[low] & (_LETTER[before] | latin))
        at = np.zeros(len(data), dtype=bool)
        at[2:] = cut
        for special in self.added:  # no cuts inside these
            for found in re.finditer(re.escape(special.encode()), data):
                at[found.start() + 1 : found.end()] = False
        at[full] = True
        starts = np.flatnonzero(at)
        ends = np.append(starts[1:], len(data))
        hashes = range_hash(prefix_hash(data), starts, ends) + (ends - starts).astype(np.uint64)
        inverse, first = unique_keys(hashes)
        kinds = hashes[first].tolist()
        if len(self.known) > CACHED_WORDS:
            self._forget()
        place = np.fromiter(map(self.known.get, kinds, repeat(-1)), dtype=np.int64, count=len(kinds))
        new = np.flatnonzero(place < 0)
        if len(new):
            raw, n = data.tobytes(), len(self.known)
            bounds = zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
            self._remember(hashes[first[new]].tolist(), [raw[a:b] for a, b in bounds])
            place[new] = np.arange(n, n + len(new))
        size, start = (self.starts[place + 1] - self.starts[place])[inverse], self.starts[place][inverse]
        total = np.cumsum(size)
        at = np.repeat(start - (total - size), size) + np.arange(total[-1] if len(total) else 0)
        row = np.searchsorted(offsets, starts, side="right") - 1
        return self.flat[at], np.bincount(row, weights=size, minlength=len(offsets) - 1).astype(np.int64)


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """One per worker, whatever the number of its tasks."""
    return Encoder(path)


def write_tokens(df: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> None:
    """Encodes every whole text (null: empty), ends it with id 0 and writes shards in ascending order of ``id_col``.

    Rows without an id come first, rows with equal ids are all kept, in the order of their texts. An empty table gives
    no shard. Columns other than the two are not read.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = partitions_for(n_bytes, shard_bytes, least)
    # a stable tie-break spreads rows of one id (or none) over several ranges
    ordered = rows.withColumn("_tie", F.xxhash64("text")).repartitionByRange(shards, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, encoder, block = TaskContext.get().partitionId(), encoder_of(tokenizer_path), 0
        for batch in batches:
            for start, stop in text_slices(batch, "text"):
                piece = batch.slice(start, stop - start)
                ids, n = encoder.encode(*text_buffers(piece.column("text")))
                ids, ends = np.insert(ids, np.cumsum(n), encoder.kind.type(END)), np.cumsum(n + 1)
                bounds = group_bounds((ends - n - 1) // BLOCK_TOKENS).tolist()
                for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                    own = ids[ends[low] - n[low] - 1 : ends[high - 1]]
                    matrix = WaveletMatrix.build(own, 8 * encoder.kind.itemsize)
                    docs = piece.column("doc_id").slice(low, high - low)
                    row = [[shard], [block], [docs], [n[low:high] + 1], [matrix.size], [matrix.zeros], [matrix.planes], [matrix.ranks]]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, _FILE_ARROW, strict=True)], names=FILE.names)
                    block += 1

    ordered.select("doc_id", "text").mapInArrow(encode, FILE).write.option("compression", "zstd").parquet(path)


_FILE_ARROW = [
    pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int64()),
    pa.list_(pa.binary()), pa.list_(pa.binary()),
]


def matrix_of(row) -> WaveletMatrix:
    """The wavelet matrix of one row of a shard file (a Row, or a dict)."""
    return WaveletMatrix(row["size"], [bytes(p) for p in row["planes"]], list(row["zeros"]), [bytes(r) for r in row["ranks"]])


def _before(value: str, order: str, *within: str) -> Column:
    """The sum of a column over the rows before, inside groups."""
    window = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def _bases(files: DataFrame) -> DataFrame:
    """(shard, block, base, size): the tokens before every block.

    Sums run inside shards, then over the shards of a group, then over the groups: no task gets all blocks or shards.
    Written, so that Spark knows how small it is when it joins.
    """
    sizes = files.select("shard", "block", "size")
    shards = sizes.groupBy("shard").agg(F.sum("size").alias("total"))
    shards = cut(shards.withColumn("group", F.floor(F.col("shard") / GROUP)))
    groups = shards.groupBy("group").agg(F.sum("total").alias("total")).select("group", _before("total", "group").alias("of_group"))
    shards = shards.join(groups, "group").select("shard", (F.col("of_group") + _before("total", "shard", "group")).alias("of_shard"))
    inside = sizes.withColumn("inside", _before("size", "block", "shard"))
    return cut(inside.join(shards, "shard").select("shard", "block", (F.col("of_shard") + F.col("inside")).alias("base"), "size"))


def read_tokens(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Per document of the files: doc_id, start (tokens of all documents before it), n_tokens, and its ids.

    The ids come as ``ids`` (array<long>), or with ``digest`` as ``ids_crc32``: the checksum of the ids as
    little-endian unsigned 32-bit integers. Both are read from the bit-planes.
    """
    files = spark.read.schema(FILE).parquet(path)
    starts = _bases(files).drop("size")
    names = ["shard", "block", "doc_id", "start", "n_tokens"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                ids = matrix_of(row).all().astype("<u4")
                counts = np.array(row["doc_tokens"], dtype=np.int64)
                ends = np.cumsum(counts)
                block = [pa.array([row[c]] * len(counts), pa.int32()) for c in ("shard", "block")]
                head = [*block, pa.array(row["doc_ids"], pa.int64()), pa.array(ends - counts), pa.array(counts)]
                if digest:
                    raw = memoryview(ids.tobytes())
                    crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([*head, pa.array(crc, pa.int64())], names=[*names, "ids_crc32"])
                    continue
                for i in range(0, len(counts), 1000):
                    n = counts[i : i + 1000]
                    flat = ids[ends[i] - counts[i] : ends[i] - counts[i] + n.sum()].astype(np.int64)
                    yield pa.RecordBatch.from_arrays([*(h.slice(i, 1000) for h in head), list_array(n, flat)], names=[*names, "ids"])

    last = "ids_crc32 long" if digest else "ids array<long>"
    rows = files.mapInArrow(decode, f"shard int, block int, doc_id long, start long, n_tokens long, {last}")
    rows = rows.join(starts, ["shard", "block"]).withColumn("start", F.col("start") + F.col("base"))
    return rows.drop("shard", "block", "base")


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Per block (shard, block, n): how often an id occurs, from ranks alone."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                counted = zip([row["shard"], row["block"], matrix_of(row).count(token)], (pa.int32(), pa.int32(), pa.int64()), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in counted], names=["shard", "block", "n"])

    files = spark.read.schema(FILE).parquet(path).select("shard", "block", "size", "zeros", "planes", "ranks")
    return files.mapInArrow(count, "shard int, block int, n long")


def places_of(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(doc_id, place): every place where an id occurs, found by selects; only blocks that hold it give rows.

    Places count from 0 over all tokens of the files, end ids included, as ``start`` of ``read_tokens`` does. An id
    that no plane can hold gives no row; documents without an id have a null there.
    """
    files = spark.read.schema(FILE).parquet(path)
    kinds = {"shard": pa.int32(), "block": pa.int32(), "doc_id": pa.int64(), "at": pa.int64()}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                at, docs = matrix_of(row).places(token), pa.array(row["doc_ids"], pa.int64())
                owner = np.searchsorted(np.cumsum(row["doc_tokens"]), at, side="right")
                for low in range(0, len(at), ASKED):
                    part = at[low : low + ASKED]
                    columns = [[row["shard"]] * len(part), [row["block"]] * len(part), docs.take(pa.array(owner[low : low + ASKED])), part]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    found = files.mapInArrow(find, "shard int, block int, doc_id long, at long")
    return found.join(_bases(files), ["shard", "block"]).select("doc_id", (F.col("base") + F.col("at")).alias("place"))


def token_at(spark: SparkSession, path: str, places: DataFrame, place: str = "place") -> DataFrame:
    """(place, token): the id at every different place asked for, by ranks in the block that holds it.

    Places count as in ``places_of``. Null ones give no row, negative ones and those behind the end a null token. Of
    ``places`` only the column ``place`` is read, as a long.
    """
    files = spark.read.schema(FILE).parquet(path)
    wanted = cut(places.select(F.col(place).cast("long").alias("place")).where("place IS NOT NULL").distinct())
    # blocks and places meet by stretches of the whole; a block lies in few of them, unless it is one giant document
    blocks = _bases(files).where("size > 0")
    stretches = F.sequence(F.expr(f"base div {BLOCK_TOKENS}"), F.expr(f"(base + size - 1) div {BLOCK_TOKENS}"))
    blocks = blocks.withColumn("stretch", F.explode(stretches))
    met = wanted.withColumn("stretch", F.expr(f"place div {BLOCK_TOKENS}")).join(blocks, "stretch")
    met = met.where("place >= base AND place < base + size").withColumn("at", F.col("place") - F.col("base"))
    lists = met.groupBy("shard", "block", "base", F.floor(F.col("at") / ASKED).alias("part")).agg(F.collect_list("at").alias("at"))
    asked = files.select("shard", "block", "size", "zeros", "planes", "ranks").join(cut(lists.drop("part")), ["shard", "block"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                matrix, at = matrix_of(row), row["at"]
                columns = [[row["base"] + i for i in at], [matrix.access(i) for i in at]]
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in columns], names=["place", "token"])

    return wanted.join(asked.mapInArrow(answer, "place long, token long"), "place", "left")
