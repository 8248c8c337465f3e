"""Whole texts inside tasks: slices of bounded size, byte-level words and their hashes, filters of fixed size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

SLICE_BYTES = 2 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags: true inside the given inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: [^\x20\x09-\x0D]+ after lower-casing A-Z, on UTF-8 bytes
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z, on UTF-8 bytes
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose texts together have at most ``limit`` bytes, or one row with a longer text."""
    offsets, _ = text_buffers(batch.column(column))
    start = 0
    while start < len(batch):
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), len(batch))
        yield start, end
        start = end


def text_buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (rows + 1) and bytes of a text array; a null counts as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    array = array.cast(pa.large_binary())
    if len(array) == 0:
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    _, where, data = array.buffers()
    offsets = np.frombuffer(where, dtype=np.int64, count=len(array) + 1, offset=array.offset * 8)
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    return offsets - offsets[0], raw[offsets[0] : offsets[-1]]


_RANDOM = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse modulo 2**64; the tables grow as longer texts come."""
    held = len(_powers["up"]) if _powers else 0
    if held < n:
        size = max(n, min(2 * held, SLICE_BYTES + 1), 1 << 16)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums, one longer than the data, from which the hash of any byte range follows (``range_hash``)."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.take(_RANDOM, data, out=out[1:], mode="clip")
    out[1:] *= up[:-1]
    np.cumsum(out[1:], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


def word_spans(offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of every word, in order. ``inside`` flags the bytes that words consist of."""
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = inside[begins]
    last[begins[1:] - 1] = inside[begins[1:] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return np.searchsorted(offsets, starts, side="right") - 1, starts, ends


def words(offsets: np.ndarray, data: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, 64-bit hash) of every word of lower-cased texts, in order. ``kind``: the bytes that words consist of."""
    low = _LOWER[data]
    rows, starts, ends = word_spans(offsets, kind[low])
    return rows, range_hash(prefix_hash(low), starts, ends)


_ORDERED = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(rows: np.ndarray, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of its first word, 64-bit hash) of every run of ``size`` words inside one row."""
    n = len(rows) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    total = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        total += hashes[k : n + k] * _ORDERED[k % 64]
    at = np.flatnonzero(rows[:n] == rows[size - 1 :])
    return at, mix(total[at])


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def unsigned(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, dtype=np.int64).view(np.uint64)


def list_array(counts: np.ndarray, values: np.ndarray | pa.Array, kind: pa.DataType | None = None) -> pa.ListArray:
    """Lists of the given lengths over consecutive values."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values if isinstance(values, pa.Array) else pa.array(values, kind))


# ---- filters of fixed size ------------------------------------------------------------------------


class HashFilter:
    """A bitmap of hashes, two places each: says no only for hashes that were not put in.

    Its size does not depend on the data. The two places are the lowest bits of both halves of a hash.
    """

    def __init__(self, bits: int, packed: bytes):
        self.bits, self.packed = bits, packed

    def has(self, hashes: np.ndarray) -> np.ndarray:
        table, mask = np.frombuffer(self.packed, dtype=np.uint8), np.uint64((1 << self.bits) - 1)

        def holds(place: np.ndarray) -> np.ndarray:
            return (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

        found = holds(hashes & mask)
        at = np.flatnonzero(found)
        found[at] = holds((hashes[at] >> np.uint64(32)) & mask)
        return found


def hash_filter(df: DataFrame, column: str, bits: int = 23) -> HashFilter:
    """A bitmap of a long column of hashes; ``bits`` (32 at most) is the logarithm of its size.

    The driver gets 2**(bits - 6) numbers at most (``bits`` = 23: 131,072 numbers, a bitmap of 1 MB), whatever the
    size of ``df``. What a filter lets through must be joined exactly afterwards.
    """
    mask = F.lit((1 << bits) - 1)
    halves = F.array(F.col(column).bitwiseAND(mask), F.shiftrightunsigned(column, 32).bitwiseAND(mask))
    groups = (
        df.where(F.col(column).isNotNull())
        .select(F.explode(halves).alias("place"))
        .select(F.shiftright("place", 6).alias("at"), F.expr("shiftleft(1L, int(place & 63))").alias("bit"))
        .groupBy("at")
        .agg(F.bit_or("bit").alias("bits"))
    )
    table = np.zeros(1 << (bits - 6), dtype=np.int64)
    got = groups.toArrow()
    table[got["at"].to_numpy()] = got["bits"].to_numpy()
    return HashFilter(bits, table.tobytes())


def ddl(kind: DataType) -> str:
    """A type as Spark reads it back, whatever the names of its fields."""
    if isinstance(kind, StructType):
        return "struct<" + ",".join(f"`{f.name.replace('`', '``')}`:{ddl(f.dataType)}" for f in kind.fields) + ">"
    if isinstance(kind, ArrayType):
        return f"array<{ddl(kind.elementType)}>"
    if isinstance(kind, MapType):
        return f"map<{ddl(kind.keyType)},{ddl(kind.valueType)}>"
    return kind.simpleString()


def filter_bits(n: int) -> int:
    """The logarithm of a bitmap that lets few others through with ``n`` hashes; 28 (32 MB) at most.

    From 2**24 hashes on it is less sharp; what depends on it then does more work, with the same result.
    """
    return min(28, max(16, n.bit_length() + 4))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column (case aside, as Spark resolves names)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _held_by(df: DataFrame, column: str, other: DataFrame, other_column: str, bits: int, want: bool) -> DataFrame:
    """The rows of ``df`` that a bitmap of the values of ``other`` takes for among them, or (``want`` false) does not.

    Only hashes go to the Python workers, the rows stay with Spark.
    """
    hashed = other.select(F.xxhash64(F.col(other_column)).alias("h"))
    held = df.sparkSession.sparkContext.broadcast(hash_filter(hashed, "h", bits))

    @F.arrow_udf("boolean")
    def wanted(hashes: pa.Array) -> pa.Array:
        return pa.array(held.value.has(unsigned(hashes.to_numpy())) == want)

    return df.where(wanted(F.xxhash64(F.col(column))))


def likely_rows(df: DataFrame, column: str, other: DataFrame, other_column: str, bits: int = 23) -> DataFrame:
    """The rows of ``df`` whose value may be among those of ``other``: all that are, and few others.

    For a join that needs few of many wide rows: what is left moves, the rest does not.
    """
    return _held_by(df, column, other, other_column, bits, True)


def without_rows(df: DataFrame, column: str, gone: DataFrame, gone_column: str, bits: int = 23) -> DataFrame:
    """The rows of ``df`` whose value is not among those of ``gone``; a null stays. Only rows that may go are moved."""
    ids = gone.select(F.col(gone_column).alias(column)).distinct()
    likely = _held_by(df, column, gone, gone_column, bits, True).join(ids, column, "left_anti").select(df.columns)
    return _held_by(df, column, gone, gone_column, bits, False).unionByName(likely)


# ---- groups that follow each other in a sorted partition ------------------------------------------


def whole_groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """The rows of a partition sorted by ``keys``, in tables that never cut a group in two."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        changed = np.zeros(len(batch), dtype=bool)
        for key in keys:
            values = batch.column(key).to_numpy(zero_copy_only=False)
            changed[1:] |= values[1:] != values[:-1]
            if rest and rest[-1].column(key)[-1].as_py() != batch.column(key)[0].as_py():
                changed[0] = True
        cuts = np.flatnonzero(changed)
        if len(cuts):
            head = batch.slice(0, cuts[-1])
            ready = [*rest, head] if len(head) else rest
            if ready:
                yield pa.Table.from_batches(ready)
            rest = [batch.slice(cuts[-1])]
        else:
            rest.append(batch)
    if rest:
        yield pa.Table.from_batches(rest)


def group_bounds(*columns: np.ndarray) -> np.ndarray:
    """Starts of the groups of equal neighbours, and the number of rows as the last bound."""
    changed = np.zeros(len(columns[0]), dtype=bool)
    changed[:1] = True
    for values in columns:
        changed[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(changed), len(changed))


def distinct_per_row(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (ascending) with their distinct hashes (ascending)."""
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    keep = np.ones(len(rows), dtype=bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[keep], hashes[keep]


def per_row(rows: np.ndarray, n_rows: int) -> np.ndarray:
    return np.bincount(rows, minlength=n_rows)


def crc_mod_4(column: str) -> Column:
    """crc32 of a value written as text, modulo 4; null for null."""
    return (F.crc32(F.col(column).cast("string")) % 4).cast("int")


def partitions_for(rows: int, rows_per_task: int, least: int) -> int:
    return max(least, -(-rows // rows_per_task))
