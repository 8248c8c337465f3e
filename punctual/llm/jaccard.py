"""N-gram Jaccard join: a partition of the token universe, the pigeonhole principle, exact verification.

Two sets of sizes x and y with a Jaccard similarity of t % differ in (100 - t) (x + y) / (100 + t) tokens at most. Sizes
fall into bands; a band's largest size bounds the difference by H. Hashing splits all tokens into segments. A segment
with threshold 0 finds partners whose tokens in it are the same; one with threshold 1 also those that differ in one
token, by indexing its tokens with each one left out in turn. If thresholds plus one sum to H + 1, partners must agree
within threshold on some segment. Per band, costs computed from counts over all sets decide how many segments pairs of
small ones merge into.

A set is indexed in its own band, and in the next one if a partner can be there; of equal sets one row is. Segment keys
travel as sorted runs of a few bytes each, dealt by their first bits, to find those that at least two sets share. These
lead to candidates, compared in blocks by a 1,024-bit parity sketch whose distance never exceeds the true
difference, then exactly by their sets, which are made anew from the texts of the pairs that are left. Sets are first
compared with the first one under their keys, later only with sets that they are not yet connected with, so that a group
of similar sets costs a star and not all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import erfc, sqrt

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from punctual.llm.components import components
from punctual.llm.text import (
    ddl, NOT_SPACE, HashFilter, distinct_per_row, filter_bits, group_bounds, hash_filter, likely_rows, list_array, mix, partitions_for,
    per_row, shingles, signed, text_buffers, text_slices, unsigned, whole_groups, without_rows, words,
)
from punctual.runtime import TEXTS, cut, kept_dir, scratch, settings

SLICE = 1 << 19
SKETCH_BITS = 1024
#: Larger sketches of large sets, by the least size that gets one: their distances still tell large sets apart.
LARGER = {"mid": (800, 1 << 14), "wide": (6400, 1 << 16)}
#: Rows of one segment's tokens that are compared in one block; more are compared chunk by chunk.
BLOCK = 2048
#: One in so many tokens takes part in the statistics of shared tokens.
UNIVERSE = 64
#: Keys that a task packs at once, and that it takes back at once on the average.
KEYS_AT_ONCE, KEYS_PER_PART = 1 << 20, 1 << 20
#: Repeated rows that readers leave out; beyond, the rest is written anew.
FEW = 100_000
#: What it costs to compare two sets, in rows of the index.
PAIR_COST = 0.05


@dataclass
class Bands:
    """Size bands for a threshold in percent, and per band how many merged segments of threshold 1 it has."""

    percent: int
    merged: dict[int, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.tops = [0]
        while self.tops[-1] < 1 << 40:
            low = self.tops[-1] + 1
            top = low
            while top < 1000 and self.difference(2 * top + 2) == 0:
                top += 1
            # two bands must reach as far as a partner's size
            self.tops.append(max(top, int(low * 1.41), low * 100 // self.percent))
        self.low = np.array([t + 1 for t in self.tops[:-1]], dtype=np.int64)
        self.top = np.array(self.tops[1:], dtype=np.int64)

    def difference(self, total: int | np.ndarray) -> int | np.ndarray:
        """Most tokens in which two sets of this total size can differ and still be partners."""
        return (100 - self.percent) * total // (100 + self.percent)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.top, sizes)

    def reaches_next(self, sizes: np.ndarray) -> np.ndarray:
        """Whether the smallest size of the next band can be a partner's."""
        return 100 * sizes >= self.percent * self.low[np.minimum(self.of(sizes) + 1, len(self.low) - 1)]

    def segments(self, band: int) -> tuple[int, int, int]:
        """Number of segments, how many of them (the first ones) have threshold 1, and the slack.

        Thresholds plus one sum to H + 1 + slack, so those of the segments on which partners agree exceed the slack.
        A segment is bare if a set has no token in it, or with threshold 1 no more than one: what it says there, all
        bare sets say. The slack is what the band's smallest sets have in bare segments with four standard deviations
        to spare: a set with no more needs none of them as a key, and only few sets have more.
        """
        errors = int(self.difference(2 * int(self.top[band])))
        merged = min(self.merged.get(band, 0), (errors + 1) // 2)
        slack = 0
        while errors and slack < errors + 2:
            mean, deviation = self.bare(band, errors + 1 + slack - merged, merged)
            if slack >= mean + 4 * deviation:
                break
            slack += 1
        return errors + 1 + slack - merged, merged, slack

    def bare(self, band: int, segments: int, merged: int) -> tuple[float, float]:
        """Mean and standard deviation of the thresholds plus one of bare segments, for the band's smallest sets."""
        held = int(self.low[band]) / max(1, segments)
        none, few = float(np.exp(-held)), float(np.exp(-held) * (1 + held))
        return (segments - merged) * none + 2 * merged * few, float(np.sqrt((segments - merged) * none + 4 * merged * few))

    def signatures(self, rows: np.ndarray, tokens: np.ndarray, sizes: np.ndarray, bands: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, key) of every signature; row k holds ``sizes[k]`` tokens and is indexed in ``bands[k]``."""
        plan = np.array([self.segments(b) if len(sizes) and b <= bands.max() else (1, 0, 0) for b in range(len(self.top))], dtype=np.int64)
        n_segments, n_merged, slack = plan[bands].T if len(bands) else np.zeros((3, 0), dtype=np.int64)
        base = np.concatenate([[0], np.cumsum(n_segments)])
        salt = mix(bands.astype(np.uint64) + np.uint64(77))
        segment = (mix(tokens ^ salt[rows]) % n_segments[rows].astype(np.uint64)).astype(np.int64)
        slot = base[rows] + segment
        value = mix(tokens + np.uint64(0x5851F42D4C957F2D))
        order = np.argsort(slot, kind="stable")
        running = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(value[order])])
        count = np.bincount(slot, minlength=base[-1])
        ends = np.cumsum(count)
        sums = running[ends] - running[ends - count]
        of_slot = np.repeat(np.arange(len(sizes)), n_segments)
        number = np.arange(base[-1]) - base[of_slot]
        name = mix(salt[of_slot] + number.astype(np.uint64))
        keys = mix(sums ^ name)
        lenient = number < n_merged[of_slot]
        bare = count <= lenient
        spared = np.bincount(of_slot, weights=bare * (1 + lenient), minlength=len(sizes)) <= slack
        # the key of no token: that of an empty segment, and of one with threshold 1 without its only token
        kept = ~((count == 0) & spared[of_slot])
        loose = (segment < n_merged[rows]) & ~((count[slot] == 1) & spared[rows])
        left_out = mix((sums[slot[loose]] - value[loose]) ^ name[slot[loose]])
        return np.concatenate([of_slot[kept], rows[loose]]), np.concatenate([keys[kept], left_out])


def sketches(rows: np.ndarray, tokens: np.ndarray, n: int, bits: int = SKETCH_BITS) -> np.ndarray:
    """Per row the parity of the number of its tokens in each of ``bits`` cells, packed into longs."""
    cell = (mix(tokens + np.uint64(991)) % np.uint64(bits)).astype(np.int64)
    odd, step = np.zeros((n, bits // 64), dtype=np.int64), max(1, (1 << 21) // bits)
    for start in range(0, n, step):
        own = (rows >= start) & (rows < start + step)
        counts = np.bincount((rows[own] - start) * bits + cell[own], minlength=min(step, n - start) * bits)
        odd[start : start + step] = np.packbits((counts & 1).astype(bool).reshape(-1, bits), axis=1).view(np.int64)
    return odd


def larger_sketches(rows: np.ndarray, tokens: np.ndarray, sizes: np.ndarray) -> list[pa.Array]:
    """The sketches of LARGER for the rows whose sets are large enough, null for the others."""
    out = []
    for least, bits in LARGER.values():
        large = np.flatnonzero(sizes >= least)
        own = np.isin(rows, large)
        made = sketches(np.searchsorted(large, rows[own]), tokens[own], len(large), bits)
        place = np.full(len(sizes), -1)
        place[large] = np.arange(len(large))
        lists = list_array(np.full(len(large), bits // 64), made.ravel())
        out.append(lists.take(pa.array(place, pa.int64(), mask=place < 0)))
    return out


def token_sets(part: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and their distinct shingles; a text with fewer words than ``size`` has its whole sequence as one."""
    rows, hashes = words(*text_buffers(part.column("text")), NOT_SPACE)
    n = per_row(rows, len(part))
    at, tokens = shingles(rows, hashes, size)
    owners = [rows[at]]
    found = [tokens]
    for short in range(1, size):
        few = np.flatnonzero(n == short)
        if len(few):
            own = np.isin(rows, few)
            at, tokens = shingles(rows[own], hashes[own], short)
            owners.append(rows[own][at])
            found.append(mix(tokens + np.uint64(short)))
    return distinct_per_row(np.concatenate(owners), np.concatenate(found))


def identities(rows: np.ndarray, tokens: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each row's set (0 for the empty set)."""
    out = np.zeros(n, dtype=np.uint64)
    if len(rows):
        bounds = group_bounds(rows)
        out[rows[bounds[:-1]]] = np.add.reduceat(mix(tokens ^ np.uint64(0xA5A5A5A5)), bounds[:-1])
    return mix(out)


def allocate(bands: Bands, sets: DataFrame) -> Bands:
    """The cheapest number of merged segments per band, from counts over all sets.

    With N sets of mean size n, and q the share of a set's tokens that it has in common with another one on the
    average, s segments cost s rows per set, a merged one as many rows more as it holds tokens. Of N^2 / 2 pairs those
    meet by chance in a segment that holds o tokens of a set who have common tokens there, Poisson with q o, and of
    2 o (1 - q) others none, or in a merged one at most one each; and those of sets with too many bare segments,
    where both have none.
    """
    of = {"band": F.expr(f"size(filter(array({', '.join(f'{t}L' for t in bands.tops[1:])}), t -> t < n))")}
    sized = sets.where("n > 0").withColumns(of)
    tally = sized.groupBy("band").agg(F.count(F.lit(1)).alias("sets"), F.avg("n").alias("mean"))
    common = sized.select("band", F.explode("probe").alias("token")).groupBy("band", "token").agg(F.count(F.lit(1)).alias("df"))
    common = common.groupBy("band").agg(F.sum(F.col("df") * (F.col("df") - 1.0)).alias("pairs"))
    merged = {}
    for r in tally.join(common, "band", "left").collect():  # a row per band, some dozens
        q = min(0.99, UNIVERSE * (r["pairs"] or 0.0) / max(1, r["sets"] * (r["sets"] - 1)) / r["mean"])
        errors = int(bands.difference(2 * int(bands.top[r["band"]])))

        def cost(d: int, n: int = r["sets"], mean: float = r["mean"], q: float = q, band: int = r["band"]) -> float:
            segments, few, slack = Bands(bands.percent, {band: d}).segments(band)
            held = mean / segments
            apart = held * (1 - q)
            chance = (segments - few + few * (1 + apart) ** 2) * np.exp(-2 * apart) * -np.expm1(-q * held)
            usual, deviation = bands.bare(band, segments, few)
            over = erfc((slack - usual) / deviation / sqrt(2)) / 2 if deviation else 0.0
            chance += over**2 * (segments - few + few * (1 + held) ** 2) * np.exp(-2 * held)
            return n * (segments + few * held) + PAIR_COST * n**2 / 2 * min(1.0, chance)

        steps = sorted({round((errors + 1) // 2 * k / 8) for k in range(9)})
        merged[r["band"]] = min(steps, key=cost)
    return Bands(bands.percent, merged)


def jaccard_join(df: DataFrame, id_col: str, text: str, size: int = 5, percent: int = 80, merged: dict[int, int] | None = None) -> DataFrame:
    """Per row of ``df`` its id (``id``), the size of its shingle set (``n_shingles``) and ``component_id``.

    Links join different rows whose sets of ``size``-word shingles have ``100 * common >= percent * union``;
    ``component_id`` is the smallest id that links reach from the row. Texts are lower-cased in A-Z and split at white
    space; with fewer words the whole sequence is one shingle. A null or empty text, or one without words, has an empty
    set, links with nothing and is its own component. Rows with a null id take part; their own component is null
    unless they reach a row with an id. Rows with equal sets are one node of the graph, known by a 64-bit hash, as are
    shingles. Other columns are not read. ``merged`` overrides the cost-based allocation (segments per band).
    """
    spark = df.sparkSession
    texts = df.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    tagged = texts.select("text", F.xxhash64("id").alias("tag"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in text_slices(batch, "text", SLICE):
                part = batch.slice(start, end - start)
                rows, tokens = token_sets(part, size)
                n = per_row(rows, len(part))
                drawn = tokens % np.uint64(UNIVERSE) == 0
                node = signed(identities(rows, tokens, len(part)))
                probe = list_array(per_row(rows[drawn], len(part)), signed(tokens[drawn]))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n), pa.array(node), probe], names=["id", "n", "node", "probe"])

    id_kind = ddl(texts.schema["id"].dataType)
    with scratch(spark, "jaccard") as work, settings(spark, TEXTS):
        sets = cut(texts.mapInArrow(measure, f"id {id_kind}, n long, node long, probe array<long>"), path=kept_dir(spark, "sets"))
        bands = Bands(percent, merged) if merged is not None else allocate(Bands(percent), sets)
        chosen = _chosen(sets, work)
        keys = _Keys.of(sets)
        shared = cut(_shared_keys(tagged, size, bands, chosen, keys), path=f"{work}/shared")
        links = _links(tagged, size, bands, chosen, keys, shared, work)
        groups = components(links) if links is not None else None
    sets = sets.drop("probe")
    if groups is None:
        smallest = sets.where("n > 0").groupBy("node").agg(F.min("id").alias("component_id"))
        return _rows(sets, smallest)
    lowest = sets.where("n > 0").groupBy("node").agg(F.min("id").alias("own")).join(groups, "node", "left")
    lowest = cut(lowest.withColumn("root", F.coalesce("root", "node")))
    of_root = cut(lowest.groupBy("root").agg(F.min("own").alias("component_id")))
    return _rows(sets, lowest.join(of_root, "root").select("node", "component_id"))


def _rows(sets: DataFrame, smallest: DataFrame) -> DataFrame:
    out = sets.where("n > 0").join(smallest, "node").select("id", "n", "component_id")
    empty = sets.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return out.unionByName(empty).withColumnRenamed("n", "n_shingles")


def _chosen(sets: DataFrame, work: str) -> Broadcast:
    """Bitmaps of the sets that several rows have, and of the one row that stands for each set that the first lets through."""
    context = sets.sparkSession.sparkContext
    copied = sets.where("n > 0").groupBy("node").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("node")
    copied = cut(copied, path=f"{work}/copied")
    bits = filter_bits(copied.count())
    first = hash_filter(copied, "node", bits)
    held = context.broadcast(first)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(held.value.has(unsigned(batch.column("node").to_numpy()))))

    likely = sets.where("n > 0").select("node", F.xxhash64("id").alias("tag")).mapInArrow(pick, "node long, tag long")
    own = likely.groupBy("node").agg(F.min("tag").alias("tag")).select(F.col("node").bitwiseXOR(F.col("tag")).alias("own"))
    return context.broadcast((first, hash_filter(own, "own", bits)))


def _indexed(part: pa.RecordBatch, size: int, bands: Bands, chosen: tuple[HashFilter, HashFilter]) -> tuple:
    """Sets of a slice, and the signatures of every (set, band) that it is indexed in.

    Of rows with equal sets one is looked at, or few more: those with one tag in several slices, and what the bitmaps
    mistake for the one."""
    rows, tokens = token_sets(part, size)
    n = per_row(rows, len(part))
    node = identities(rows, tokens, len(part))
    copied, own_row = chosen
    stands = ~copied.has(node) | own_row.has(node ^ unsigned(part.column("tag").to_numpy()))
    able = np.flatnonzero((n > 0) & stands)
    _, first = np.unique(node[able], return_index=True)
    of = np.sort(able[first])
    keep = np.isin(rows, of)
    rows, tokens, n, node = np.searchsorted(of, rows[keep]), tokens[keep], n[of], node[of]
    own = bands.of(n)
    up = bands.reaches_next(n)
    twice, moved = up[rows], np.cumsum(up) - 1 + len(n)
    all_rows = np.concatenate([rows, moved[rows[twice]]])
    all_tokens = np.concatenate([tokens, tokens[twice]])
    source = np.concatenate([np.arange(len(n)), np.flatnonzero(up)])
    in_band = np.concatenate([own, own[up] + 1])
    who, keys = bands.signatures(all_rows, all_tokens, n[source], in_band)
    return rows, tokens, n, node, part.column("tag").take(pa.array(of)), source[who], keys


@dataclass
class _Keys:
    """How keys travel: their first ``first`` bits say where to, ``width`` bytes follow, the rest is left out.

    Enough bits for one key in some thousands to be mistaken for another; such a key counts as shared, no more.
    """

    first: int
    width: int

    @classmethod
    def of(cls, sets: DataFrame) -> _Keys:
        total = int(sets.agg(F.sum("n")).first()[0] or 0)
        least = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        first = max(1, (max(least, total // KEYS_PER_PART) - 1).bit_length())
        return cls(first, min(8, max(1, -(-(total.bit_length() + 12 - first) // 8))))

    @property
    def rest(self) -> np.uint64:
        return np.uint64(max(0, 64 - self.first - 8 * self.width))

    def short(self, keys: np.ndarray) -> np.ndarray:
        """What is left of keys."""
        return keys >> self.rest

    def packed(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Keys dealt and packed, one that several sets have twice."""
        keys = np.sort(self.short(keys))
        keep = np.ones(len(keys), dtype=bool)
        keep[2:] = keys[2:] != keys[:-2]
        keys = keys[keep]
        low = np.uint64(64 - self.first) - self.rest
        part = (keys >> low).astype(np.int32)
        raw = np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, : -(-int(low) // 8)]
        bounds = group_bounds(part)
        offsets = pa.py_buffer((bounds * raw.shape[1]).astype(np.int32).tobytes())
        runs = pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(raw).tobytes())])
        yield pa.RecordBatch.from_arrays([pa.array(part[bounds[:-1]]), runs], names=["part", "keys"])

    def shared(self, part: int, runs: list[bytes]) -> np.ndarray:
        """Keys that stand there more than once."""
        low = 64 - self.first - int(self.rest)
        width = -(-low // 8)
        raw = np.frombuffer(b"".join(runs), dtype=np.uint8).reshape(-1, width)
        keys = np.zeros((len(raw), 8), dtype=np.uint8)
        keys[:, :width] = raw
        keys = np.sort(keys.view(np.uint64).ravel() & np.uint64((1 << low) - 1))
        again = np.flatnonzero(keys[1:] == keys[:-1])
        return np.unique(keys[again]) | np.uint64(part << low)


def _shared_keys(tagged: DataFrame, size: int, bands: Bands, chosen: Broadcast, keys: _Keys) -> DataFrame:
    """Hashes of all shortened keys that at least two different sets have, and of few others."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for start, end in text_slices(batch, "text", SLICE):
                found = _indexed(batch.slice(start, end - start), size, bands, chosen.value)
                held.append(found[-1])
                if sum(map(len, held)) > KEYS_AT_ONCE:
                    yield from keys.packed(np.concatenate(held))
                    held = []
        if held:
            yield from keys.packed(np.concatenate(held))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "part"):
            parts = table["part"].to_numpy()
            bounds = group_bounds(parts)
            for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                found = keys.shared(int(parts[low]), table["keys"].slice(low, high - low).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(signed(mix(found)))], names=["key"])

    rows = tagged.mapInArrow(deal, "part int, keys binary").repartition(1 << keys.first, "part").sortWithinPartitions("part")
    return rows.mapInArrow(meet, "key long")


def _links(tagged: DataFrame, size: int, bands: Bands, chosen: Broadcast, short: _Keys, shared: DataFrame, work: str) -> DataFrame | None:
    """Links enough to connect all partners, or None without any."""
    spark = tagged.sparkSession
    n_shared = shared.count()
    if not n_shared:
        return None
    maybe = spark.sparkContext.broadcast(hash_filter(shared, "key", filter_bits(n_shared)))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: HashFilter = maybe.value
        for batch in batches:
            for start, end in text_slices(batch, "text", SLICE):
                rows, tokens, n, node, tag, who, keys = _indexed(batch.slice(start, end - start), size, bands, chosen.value)
                likely = held.has(mix(short.short(keys)))
                who, keys = distinct_per_row(who[likely], keys[likely])
                own, place = np.unique(who, return_inverse=True)
                wanted = np.isin(rows, own)
                sketch = sketches(np.searchsorted(own, rows[wanted]), tokens[wanted], len(own))
                columns = [pa.array(signed(node[own])), tag.take(pa.array(own)), pa.array(n[own]), list_array(np.full(len(own), SKETCH_BITS // 64), sketch.ravel())]
                columns += [list_array(np.bincount(place, minlength=len(own)), signed(keys)), *larger_sketches(np.searchsorted(own, rows[wanted]), tokens[wanted], n[own])]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "tag", "n", "sketch", "keys", *LARGER])

    with scratch(spark, "entries") as path:
        kind = "node long, tag long, n long, sketch array<long>, keys array<long>, mid array<long>, wide array<long>"
        sets = _once(tagged.mapInArrow(entries, kind), path)
        # rows of 16 bytes; sizes and sketches come to them where pairs are weighed
        keyed = cut(sets.select(F.explode("keys").alias("key"), "node"), path=f"{work}/keyed")
        return _connected(keyed, sets, tagged, size, bands, work)


def _once(sets: DataFrame, path: str) -> DataFrame:
    """``sets`` written, a row per node; several have rows that share text and id, and the few that bitmaps let through."""
    sets = cut(sets.withColumn("row", F.monotonically_increasing_id()), path=f"{path}/all")
    again = sets.groupBy("node").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    again = cut(again, path=f"{path}/again")
    if again.isEmpty():
        return sets
    gone = cut(sets.select("node", "row").join(again, "node").where("row > first").select("row"), path=f"{path}/gone")
    return sets.join(gone, "row", "left_anti") if gone.count() <= FEW else cut(without_rows(sets, "row", gone, "row"), path=f"{path}/once")


def _tokens(tagged: DataFrame, size: int, wanted: DataFrame, path: str) -> DataFrame:
    """(node, n, tokens) of ``wanted`` (node, tag) and of few other sets, from the texts of the rows with these tags."""
    bits = filter_bits(wanted.count())
    held = tagged.sparkSession.sparkContext.broadcast((hash_filter(wanted, "tag", bits), hash_filter(wanted, "node", bits)))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tags, nodes = held.value
        for batch in batches:
            batch = batch.filter(pa.array(tags.has(unsigned(batch.column("tag").to_numpy()))))
            for start, end in text_slices(batch, "text", SLICE):
                part = batch.slice(start, end - start)
                rows, tokens = token_sets(part, size)
                n, node = per_row(rows, len(part)), identities(rows, tokens, len(part))
                own = np.flatnonzero((n > 0) & nodes.has(node))
                own = np.sort(own[np.unique(node[own], return_index=True)[1]])
                columns = [pa.array(signed(node[own])), pa.array(n[own]), list_array(n[own], signed(tokens[np.isin(rows, own)]))]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "tokens"])

    return _once(tagged.mapInArrow(fetch, "node long, n long, tokens array<long>"), path)


def _connected(keyed: DataFrame, sets: DataFrame, tagged: DataFrame, size: int, bands: Bands, work: str) -> DataFrame | None:
    tried, links = None, None
    for turn, mode in enumerate(("star", "tree", "all")):
        if mode == "star":
            pairs = _stars(keyed, sets, bands.percent, work)
        else:
            groups = components(links) if links is not None else None
            found = cut(_candidates(keyed, sets, groups, bands.percent, mode, work, turn), path=f"{work}/near{turn}")
            if found.isEmpty():
                break  # no block holds unconnected sets that may be partners
            pairs = found.select("a", "b").distinct()
            # a block without a tree has no such pair; only the others are worth another look
            keyed = cut(keyed.join(found.select("key").distinct(), "key", "left_semi"), path=f"{work}/keyed{turn}")
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = cut(pairs, path=f"{work}/weighed{turn}")
        wanted = cut(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), path=f"{work}/wanted{turn}")
        pairs = cut(_plausible(pairs, likely_rows(sets.where(F.col("mid").isNotNull()).select("node", "n", *LARGER), "node", wanted, "node"), bands.percent), path=f"{work}/pairs{turn}")
        if pairs.isEmpty():
            continue
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(sets.select("node", "tag"), "node")
        with scratch(keyed.sparkSession, "tokens") as path:
            own = _tokens(tagged, size, cut(wanted, path=f"{path}/wanted"), path)
            good = cut(_verified(pairs, own, bands.percent), path=f"{work}/links{turn}")
        links = good if links is None else links.unionByName(good)
        tried = pairs if tried is None else tried.unionByName(pairs)
    return cut(links) if links is not None else None


def _stars(keyed: DataFrame, sets: DataFrame, percent: int, work: str) -> DataFrame:
    """For each set one pair: with the nearest set that is first under one of its keys and may be a partner.

    In a group of similar sets nearly all have the same first one, so this connects most of what is to be connected.
    """
    first = cut(keyed.groupBy("key").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("rows")).where("rows > 1"), path=f"{work}/firsts")
    pairs = keyed.join(first, "key").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    a = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    both = cut(pairs, path=f"{work}/star_pairs").join(a, "a").join(b, "b")
    apart = _distance("sa", "sb")
    sizes = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    near = (100 + percent) * apart <= (100 - percent) * (F.col("na") + F.col("nb"))
    nearest = both.where(sizes).where(near).groupBy("b").agg(F.min(F.struct(apart.alias("apart"), "a")).alias("m"))
    return nearest.select(F.least("m.a", "b").alias("a"), F.greatest("m.a", "b").alias("b")).distinct()


def _distance(a: str, b: str) -> Column:
    """Cells in which two sketches differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)


def _plausible(pairs: DataFrame, large: DataFrame, percent: int) -> DataFrame:
    """Without the pairs of ``large`` sets that their larger sketches show to differ too much."""
    a, b = (large.select(F.col("node").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("n", *LARGER))) for x in "ab")
    both = pairs.join(a, "a", "left").join(b, "b", "left")
    apart = F.greatest(*(F.coalesce(_distance(f"{c}_a", f"{c}_b"), F.lit(0)) for c in LARGER))
    # null where a set has no larger sketch
    far = (100 + percent) * apart > (100 - percent) * (F.col("n_a") + F.col("n_b"))
    return both.where(~F.coalesce(far, F.lit(False))).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    a = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    b = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).alias("common"))
    return both.where(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def _candidates(keyed: DataFrame, sets: DataFrame, groups: DataFrame | None, percent: int, mode: str, work: str, turn: int) -> DataFrame:
    """Pairs (a, b) of unconnected sets that share a key and may be partners by sizes and sketches, with that key.

    ``tree``: per block a tree of nearest ones, a pair less than it has components; ``all``: all.
    """
    if groups is None:
        rooted = keyed.withColumn("root", F.col("node"))
    else:
        rooted = keyed.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = cut(rooted, path=f"{work}/rooted{turn}")
    sizes = rooted.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.min("root").alias("low"), F.max("root").alias("high"))
    sizes = cut(sizes.where("low < high").select("key", F.ceil(F.col("rows") / BLOCK).cast("int").alias("chunks")), path=f"{work}/open{turn}")
    rows = cut(rooted.join(sizes, "key"), path=f"{work}/rows{turn}")
    n = partitions_for(rows.count(), 200_000, int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.join(sets.select("node", "n", "sketch"), "node").withColumn("own", F.pmod(F.xxhash64("node"), "chunks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("key", "node", "n", "sketch", "root", "own", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))
    rows = rows.repartition(n, "key", "p", "q").sortWithinPartitions("key", "p", "q", "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups((b.slice(i, 2048) for b in batches for i in range(0, len(b), 2048)), "key", "p", "q"):
            key, p, q, own, node, size, root = (table[c].to_numpy() for c in ("key", "p", "q", "own", "node", "n", "root"))
            bits = table["sketch"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(table), -1)
            bounds = group_bounds(key, p, q)
            out: list[tuple[int, int, int]] = []
            for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                if high - low > 1:
                    pairs = _pairs(node[low:high], size[low:high], root[low:high], own[low:high], bits[low:high], p[low] != q[low], percent, mode)
                    out += [(int(key[low]), a, b) for a, b in pairs]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["key", "a", "b"])

    return rows.mapInArrow(compare, "key long, a long, b long")


FAR = 1 << 30


def _apart(i: int, node: np.ndarray, size: np.ndarray, own: np.ndarray, bits: np.ndarray, two: bool, percent: int) -> np.ndarray:
    """Sketch distances from row i to all rows of a block, FAR where sizes, sketches or chunks rule a link out."""
    apart = np.bitwise_count(bits ^ bits[i]).sum(axis=1).astype(np.int64)
    able = 100 * np.minimum(size[i], size) >= percent * np.maximum(size[i], size)
    able &= (100 + percent) * apart <= (100 - percent) * (size + size[i])
    if two:
        able &= own != own[i]
    return np.where(able, apart, FAR)


def _pairs(node: np.ndarray, size: np.ndarray, root: np.ndarray, own: np.ndarray, bits: np.ndarray, two: bool, percent: int, mode: str) -> list[tuple[int, int]]:
    """Pairs of a block between components; of ``two`` chunks only those across them."""
    pairs: list[tuple[int, int]] = []
    if mode == "all":
        for i in range(len(node) - 1):
            apart = _apart(i, node, size, own, bits, two, percent)
            pairs += [(i, int(j)) for j in np.flatnonzero((apart < FAR) & (root != root[i])) if j > i]
    else:
        # Prim's algorithm; rows of one component are joined at no cost
        left = np.ones(len(node), dtype=bool)
        cost, link = np.full(len(node), FAR), np.zeros(len(node), dtype=np.int64)
        while left.any():
            i = int(np.where(left, cost, FAR + 1).argmin())
            if 0 <= cost[i] < FAR:
                pairs.append((i, int(link[i])))
            elif cost[i] == FAR:
                cost[:] = FAR  # a new tree
            left[i] = False
            apart = np.where(root == root[i], -1, _apart(i, node, size, own, bits, two, percent))
            nearer = left & (apart < cost)
            cost[nearer], link[nearer] = apart[nearer], i
    return [(int(min(node[i], node[j])), int(max(node[i], node[j]))) for i, j in pairs]
