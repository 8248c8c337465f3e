"""Cross-tokenizer alignment: where the tokens of a byte-level BPE (A) and of a SentencePiece model (B) lie on one text.

The spans that both libraries report are coarse cuts: where a token's span ends and the next one begins no earlier, the
token ends there. Inside a character that several tokens share (A) and inside byte-fallback runs (B) the decoded bytes
of the tokens say where each ends. Byte offsets where a token of either side ends cut the text into groups; tokens of
the two sides whose byte ranges overlap are linked.

Texts are cut before a space that follows anything but white space (and is not the last character). No token of A or B reaches over such a place (B: no
piece has a space sign after another character, which is checked), and neither side looks over it, so a stretch has the
same tokens wherever it stands: a worker aligns every distinct stretch once as long as it remembers it.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from punctual.llm.kneser_ney import unique_keys
from punctual.llm.text import ddl, byte_class, group_bounds, list_array, per_row, prefix_hash, range_hash, text_buffers, text_slices
from punctual.runtime import cut, kept_dir, scratch

#: A worker forgets its stretches beyond so many, or so many bytes of their groups.
CACHED, CACHED_BYTES = 500_000, 64 << 20
#: Characters of new stretches that go through the tokenizers together.
BATCH = 1 << 15
#: Pairs of ids whose counts go to the tasks at once (24 bytes each); more take several passes over the written links.
PART = 1 << 21
#: A pair of ids as one number.
SHIFT = 32

_SOLID = byte_class((0x21, 0x7E))


def token_ends(spans: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Byte offsets at which the tokens end, from their spans (begin, end) in bytes and the sizes of their decoded bytes.

    A span that is not empty, and that the next one neither shares nor repeats, ends where its token does. From there on
    the decoded bytes count.
    """
    begin, end = spans[:, 0], spans[:, 1]
    clean = end > begin
    clean[:-1] &= (begin[1:] >= end[:-1]) & (end[1:] > end[:-1])
    total = np.cumsum(sizes)
    last = np.maximum.accumulate(np.where(clean, np.arange(len(end)), -1))
    return total + np.where(last >= 0, (end - total)[last], 0)


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs (i, j) of the tokens of both sides whose ranges overlap, and whether both end together there.

    Between two neighbouring ends, of whichever side, lie one token of A and one of B, and no pair twice.
    """
    ends = np.union1d(a_ends, b_ends)
    i, j = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
    return i, j, (a_ends[i] == ends) & (b_ends[j] == ends)


class Aligner:
    """Both tokenizers, and the stretches that the worker remembers as flat arrays."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings are plain text
        letters, vocabulary = _byte_letters(), self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(map(letters.get, token)) if all(c in letters for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.sizes = [np.array([len(x) for x in side], dtype=np.int64) for side in (self.a_bytes, self.b_bytes)]
        n = max(len(self.a_bytes), len(self.b_bytes))
        self.said = [[f"{i}{mark}" for i in range(n)] for mark in ",|;"]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.groups: list[str] = []
        self.held = 0
        self.counts = np.zeros((1 << 12, 5), dtype=np.int64)  # n_a, n_b, n_groups, n_links, sound
        self.starts = np.zeros((1 << 12) + 1, dtype=np.int64)
        self.links, self.used = np.zeros(1 << 16, dtype=np.int64), 0

    def tokens(self, text: str, raw: bytes) -> tuple[list[int], np.ndarray, list[int], np.ndarray] | None:
        """Ids and ends on both sides of a text that begins with a space; None if the bytes do not come back."""
        one = self.a.encode(text, add_special_tokens=False)
        pieces = self.b.encode(text[1:], return_type="proto").pieces
        a, b = one.ids, [p.id for p in pieces]
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return None
        first = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) & 0xC0 != 0x80)  # bytes at which characters begin
        spans = np.append(first, len(raw))[np.array(one.offsets, dtype=np.int64).reshape(-1, 2)]
        found = [token_ends(spans, sizes := self.sizes[0][a]), np.cumsum(sizes)]
        spans = np.array([(p.begin, p.end) for p in pieces], dtype=np.int64).reshape(-1, 2) + 1
        spans[:1, 0] = 0  # the space that B puts there
        found += [token_ends(spans, sizes := self.sizes[1][b]), np.cumsum(sizes)]
        # the bytes of all tokens are the text: spans that contradict them are of no use
        a_ends, b_ends = (ends if (ends == sure).all() else sure for ends, sure in (found[:2], found[2:]))
        return a, a_ends, b, b_ends

    def align(self, stretches: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
        """Counts (as in ``counts``), groups and links, one stretch after the other. All begin with a space, and all but
        the last end where a text may be cut, so together they have the tokens that they have one by one."""
        raws = [t.encode() for t in stretches]
        raw = b"".join(raws)
        found = self.tokens("".join(stretches), raw)
        if found is None:
            if len(stretches) == 1:
                return np.zeros((1, 5), dtype=np.int64), [""], np.zeros(0, dtype=np.int64)
            half = len(stretches) // 2
            parts = [self.align(stretches[:half]), self.align(stretches[half:])]
            return np.concatenate([p[0] for p in parts]), parts[0][1] + parts[1][1], np.concatenate([p[2] for p in parts])
        a, a_ends, b, b_ends = found
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        i, j, together = overlaps(a_ends, b_ends)
        group = np.cumsum(together) - together
        bounds = np.cumsum([len(r) for r in raws])
        link_of = np.searchsorted(bounds, np.maximum(a_ends[i], b_ends[j]))  # a stretch ends with both
        n = len(stretches)
        counts = np.stack([
            per_row(np.searchsorted(bounds, a_ends), n), per_row(np.searchsorted(bounds, b_ends), n),
            per_row(link_of[together], n), per_row(link_of, n), np.ones(n, dtype=np.int64),
        ], axis=1)
        # the ids of a group, first those of A; a mark behind each tells what follows
        of = np.concatenate([group[np.searchsorted(i, np.arange(len(a)))], group[np.searchsorted(j, np.arange(len(b)))]])
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.lexsort((side, of))
        ids, of, side = np.concatenate([a, b])[order], of[order], side[order]
        mark = np.full(len(ids), 2)
        mark[:-1] = np.where(of[1:] != of[:-1], 2, side[1:] != side[:-1])
        said = [self.said[m][x] for m, x in zip(mark.tolist(), ids.tolist(), strict=True)]
        edges = [0, *np.cumsum(counts[:, 0] + counts[:, 1]).tolist()]
        return counts, ["".join(said[x:y])[:-1] for x, y in zip(edges[:-1], edges[1:], strict=True)], a[i] << SHIFT | b[j]

    def _remember(self, hashes: list[int], texts: list[str]) -> None:
        size, low = np.cumsum([len(t) for t in texts]), 0
        while low < len(texts):
            high = max(low + 1, int(np.searchsorted(size, (size[low - 1] if low else 0) + BATCH, side="right")))
            counts, groups, links = self.align(texts[low:high])
            n, made = len(self.known), high - low
            while n + made + 1 > len(self.counts):
                self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
                self.starts = np.concatenate([self.starts, np.zeros_like(self.starts[1:])])
            self.counts[n : n + made] = counts
            while self.used + len(links) > len(self.links):
                self.links = np.concatenate([self.links, np.zeros_like(self.links)])
            self.links[self.used : self.used + len(links)] = links
            self.starts[n + 1 : n + 1 + made] = self.used + np.cumsum(counts[:, 3])
            self.used += len(links)
            self.groups += groups
            self.held += sum(map(len, groups))
            self.known.update(zip(hashes[low:high], range(n, n + made), strict=True))
            low = high

    def texts(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Per text (beginning with a space, or empty): the counts of ``counts`` summed, zeros where bytes do not come
        back, and its groups; then rows, distinct pairs and how often each is linked there."""
        n_rows = len(offsets) - 1
        cut_at = _cuts(data) if self.cuts else np.zeros(len(data), dtype=bool)
        cut_at[offsets[1:][np.diff(offsets) > 0] - 1] = False  # B puts no space before nothing
        cut_at[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(cut_at)
        ends = np.append(starts[1:], len(data))
        rows = np.searchsorted(offsets, starts, side="right") - 1
        hashes = range_hash(prefix_hash(data), starts, ends) + (ends - starts).astype(np.uint64)
        inverse, first = unique_keys(hashes)
        if len(self.known) > CACHED or self.held > CACHED_BYTES:
            self._forget()
        kinds = hashes[first].tolist()
        place = np.fromiter(map(self.known.get, kinds, repeat(-1)), dtype=np.int64, count=len(kinds))
        new = np.flatnonzero(place < 0)
        if len(new):
            raw = data.tobytes()
            bounds = zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
            learned = [raw[x:y].decode() for x, y in bounds]
            # first those that others may follow, then each of the rest on its own
            alone = ~_closed(data, ends[first[new]])
            for some in (np.flatnonzero(~alone), *np.flatnonzero(alone)[:, None]):
                self._remember(hashes[first[new[some]]].tolist(), [learned[k] for k in some.tolist()])
            place[new] = np.fromiter(map(self.known.get, hashes[first[new]].tolist()), dtype=np.int64)
        of = place[inverse]
        sums = np.stack([np.bincount(rows, weights=self.counts[of, c], minlength=n_rows).astype(np.int64) for c in range(5)], axis=1)
        sound = sums[:, 4] == per_row(rows, n_rows)
        sums[~sound] = 0
        edges = np.searchsorted(rows, np.arange(n_rows + 1)).tolist()
        names = [self.groups[k] for k in of.tolist()]
        said = [";".join(names[x:y]) if ok else "" for x, y, ok in zip(edges[:-1], edges[1:], sound.tolist(), strict=True)]
        # distinct stretches of each text first: most of a text's links repeat with them
        own = sound[rows]
        key = rows[own] * np.int64(len(self.known) + 1) + of[own]
        key, times = np.unique(key, return_counts=True)
        row, kind = key // (len(self.known) + 1), key % (len(self.known) + 1)
        size = self.counts[kind, 3]
        total = np.cumsum(size)
        at = np.repeat(self.starts[kind] - (total - size), size) + np.arange(total[-1] if len(total) else 0)
        row, pair, times = np.repeat(row, size), self.links[at], np.repeat(times, size)
        order = np.lexsort((pair, row))
        row, pair, times = row[order], pair[order], times[order]
        bounds = group_bounds(row, pair)
        if len(row):
            times = np.add.reduceat(times, bounds[:-1])
        return sums, said, row[bounds[:-1]], pair[bounds[:-1]], times


def _byte_letters() -> dict[str, int]:
    """Which byte each character of a byte-level vocabulary stands for."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


def _closed(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether what ends there ends with a character that is surely no white space: visible ASCII, two bytes from
    U+00C0 on, three from U+4000 on, or four."""
    last, *back = (np.where(ends >= k, data[np.maximum(ends - k, 0)], 0) for k in (1, 2, 3, 4))
    inner = back[0] < 0xC0
    two = (back[0] >= 0xC3) & (back[0] < 0xE0)
    three = inner & (back[1] >= 0xE4) & (back[1] < 0xF0)
    four = inner & (back[1] < 0xC0) & (back[2] >= 0xF0)
    return _SOLID[last] | (last >= 0x80) & (two | three | four)


def _cuts(data: np.ndarray) -> np.ndarray:
    """Spaces after such a character."""
    at = np.zeros(len(data), dtype=bool)
    space = np.flatnonzero(data[1:] == 0x20) + 1
    at[space[_closed(data, space)]] = True
    return at


@lru_cache(maxsize=1)
def aligner_of(a_path: str, b_path: str) -> Aligner:
    """One per worker, whatever the number of its tasks."""
    return Aligner(a_path, b_path)


def align(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """Per row of ``df``: id, n_a, n_b, n_groups, n_links, n_best, count_sum (long) and groups (text).

    A encodes a space and the text, B the text (it puts the space before it itself), both without special tokens and
    with their strings as plain text. ``groups`` lists the ids in order, ``a1,a2|b1;a3|b2``. A pair of ids counts in how
    many rows of the whole table it is linked; ``count_sum`` adds this up over a row's links and ``n_best`` counts the
    links whose pair counts as much as any of its A id. Texts that are null, empty, or not given back by the bytes of
    either side have zeros and the group text ''. With ``digest`` the text gives way to its SHA-256 (lowercase hex, '' for
    ''), as groups_sha256: a tenth of the data. Repeated rows count each. Other columns are not read. The ids of a
    row, null too, come as they are; an empty table gives an empty result.
    """
    spark = df.sparkSession
    filled = F.when(F.length(text) > 0, F.concat(F.lit(" "), F.col(text).cast("string")))
    rows = df.select(F.col(id_col).alias("id"), filled.alias("text"), F.monotonically_increasing_id().alias("row"))
    id_kind = ddl(rows.schema["id"].dataType)
    sums, last = ["n_a", "n_b", "n_groups", "n_links"], "groups_sha256" if digest else "groups"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(a_path, b_path)
        for batch in batches:
            for start, end in text_slices(batch, "text", 1 << 20):
                part = batch.slice(start, end - start)
                counts, said, row, pair, times = aligner.texts(*text_buffers(part.column("text")))
                n = per_row(row, len(part))
                if digest:
                    said = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in said]
                columns = [part.column("id"), part.column("row"), *(pa.array(counts[:, k]) for k in range(4)), pa.array(said, pa.string())]
                columns += [list_array(n, pair), list_array(n, times.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "row", *sums, last, "pairs", "times"])

    kind = f"id {id_kind}, row long, {', '.join(f'{c} long' for c in sums)}, {last} string, pairs array<long>, times array<int>"
    aligned = cut(rows.mapInArrow(measure, kind), path=kept_dir(spark, "aligned"))
    with scratch(spark, "pairs") as work:
        counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("df"))
        counts = cut(counts.withColumn("a", F.shiftright("pair", SHIFT)), path=f"{work}/counts")
        top = counts.groupBy("a").agg(F.max("df").alias("top"))
        n_parts = max(1, -(-counts.count() // PART))
        counts = counts.join(top, "a").select("pair", "df", (F.col("df") == F.col("top")).alias("best"), F.pmod(F.xxhash64("pair"), F.lit(n_parts)).alias("part"))
        counts = cut(counts, partition_by="part", path=f"{work}/best")
        weighed = [_weighed(aligned, counts.where(F.col("part") == k), f"{work}/weighed{k}") for k in range(n_parts)]
        found = weighed[0]
        for more in weighed[1:]:
            found = found.unionByName(more)
        if n_parts > 1:
            found = found.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
        found = cut(found, path=kept_dir(spark, "weighed"))
    return aligned.join(found, "row").select("id", *sums, "n_best", "count_sum", last)


def _weighed(aligned: DataFrame, counts: DataFrame, path: str) -> DataFrame:
    """(row, n_best, count_sum) over those links whose pairs are in ``counts``, PART rows of it or little more."""
    table = counts.select("pair", "df", "best").toArrow()
    order = np.argsort(table["pair"].to_numpy())
    columns = [table[c].to_numpy()[order] for c in ("pair", "df", "best")]
    shared = aligned.sparkSession.sparkContext.broadcast(columns)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, df, best = shared.value
        for batch in batches:
            lists = batch.column("pairs")
            n = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            row = np.repeat(np.arange(len(batch)), n)
            pair, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy().astype(np.int64)
            at = np.minimum(np.searchsorted(pairs, pair), max(len(pairs) - 1, 0))
            held = pairs[at] == pair if len(pairs) else np.zeros(len(pair), dtype=bool)
            row, at, times = row[held], at[held], times[held]
            sums = (np.zeros(len(batch), dtype=np.int64), np.zeros(len(batch), dtype=np.int64))
            np.add.at(sums[0], row, times * best[at])
            np.add.at(sums[1], row, times * df[at])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(sums[0]), pa.array(sums[1])], names=["row", "n_best", "count_sum"])

    return cut(aligned.select("row", "pairs", "times").mapInArrow(look_up, "row long, n_best long, count_sum long"), path=path)
