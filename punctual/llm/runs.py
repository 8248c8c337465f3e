"""Periodic run detection on grammar-compressed texts.

The words of a slice of texts become numbers, and Re-Pair compresses them: in each round every occurrence of an adjacent
pair that is more frequent than the pairs it overlaps becomes a nonterminal, which is the same wherever the pair is.
When no pair occurs twice, what is left of each text is paired two by two, until one symbol stands for it. Texts of a
slice share the grammar, so a passage that many of them hold is one nonterminal.

A run (at least four periods) lies inside the smallest nonterminal of the derivation that holds it, and crosses the
boundary of that one's two halves. So runs across the boundary are computed once for each nonterminal: two periods of it
stand on one side of the boundary, which gives the candidates, and hashes of word ranges say how far each extends inside
the nonterminal. All places where the nonterminal stands in the derivation get its runs; those that are cut off by its
ends lie inside the runs of a larger one with the same period, and only maximal ones stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from punctual.llm.text import ddl, NOT_SPACE, list_array, mix, per_row, powers, prefix_hash, range_hash, text_buffers, text_slices, word_spans

SLICE = 1 << 20
#: A run has at least so many periods, and so many words.
PERIODS, LEAST = 4, 6
#: Candidates looked at together.
CHUNK = 1 << 21


class Grammar:
    """The grammar of a sequence of words (numbers), which ``rows`` (ascending) divide into texts.

    Per nonterminal: ``first`` place of a derivation, ``split`` (words of its left half) and ``size`` in words; and every
    derivation as (``names``, ``places``).
    """

    def __init__(self, words: np.ndarray, rows: np.ndarray):
        self.known: dict[int, int] = {}
        self.kinds = int(words.max()) + 1 if len(words) else 0
        size, self._first, self._split, self._size = [np.ones(self.kinds, dtype=np.int64)], [], [], []
        self.sizes = size[0]
        names, places = [], []
        symbols, rows, place = words.astype(np.int64), rows, np.arange(len(words))
        fresh = np.ones(len(words), dtype=bool)
        repeating = True
        while len(symbols) > 1 and (rows[1:] == rows[:-1]).any():
            key = symbols[:-1] << 32 | symbols[1:]
            together = rows[:-1] == rows[1:]
            if repeating:
                chosen, fresh = _winners(key, symbols, together, fresh)
                if not len(chosen):
                    repeating = False
            if not repeating:
                begins = np.append(0, np.flatnonzero(rows[1:] != rows[:-1]) + 1)
                number = np.arange(len(rows)) - np.repeat(begins, np.diff(np.append(begins, len(rows))))
                chosen = np.flatnonzero((number[:-1] % 2 == 0) & together)
            symbols[chosen] = made = self._name(key[chosen], symbols[chosen], symbols[chosen + 1], place[chosen])
            names.append(made)
            places.append(place[chosen])
            keep = np.ones(len(symbols), dtype=bool)
            keep[chosen + 1] = False
            fresh[chosen] = True
            fresh[np.maximum(chosen - 1, 0)] = True
            symbols, rows, place, fresh = symbols[keep], rows[keep], place[keep], fresh[keep]
        join = lambda x: np.concatenate(x) if x else np.zeros(0, dtype=np.int64)
        self.names, self.places = join(names) - self.kinds, join(places)
        self.first, self.split, self.size = join(self._first), join(self._split), join(self._size)

    def _name(self, keys: np.ndarray, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The nonterminals of pairs, new ones where a pair has none."""
        inverse, pairs = pd.factorize(keys)
        first = np.empty(len(pairs), dtype=np.int64)
        first[inverse[::-1]] = np.arange(len(keys) - 1, -1, -1)
        listed = pairs.tolist()
        found = np.fromiter(map(self.known.get, listed, repeat(-1)), dtype=np.int64, count=len(listed))
        new = np.flatnonzero(found < 0)
        found[new] = self.kinds + len(self.known) + np.arange(len(new))
        at = first[new]
        split, size = self.sizes[left[at]], self.sizes[left[at]] + self.sizes[right[at]]
        self._first.append(place[at])
        self._split.append(split)
        self._size.append(size)
        self.sizes = np.concatenate([self.sizes, size])
        self.known.update(zip(pairs[new].tolist(), found[new].tolist(), strict=True))
        return found[inverse]


def _winners(key: np.ndarray, symbols: np.ndarray, together: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs that occur twice or more, and more often than the pairs they overlap (ties by a hash).

    ``fresh`` says which places may hold such a pair; of a stretch of one symbol only every second place may.
    """
    equal = together & (symbols[:-1] == symbols[1:])
    at = np.flatnonzero(equal)
    odd = np.zeros(len(key), dtype=bool)
    if len(at):
        begins = np.ones(len(at), dtype=bool)
        begins[1:] = at[1:] != at[:-1] + 1
        odd[at] = (at - np.maximum.accumulate(np.where(begins, at, 0))) % 2 == 1
    look = np.flatnonzero(together & ~odd & fresh[:-1])
    inverse, pairs = pd.factorize(key[look])
    times = np.bincount(inverse, minlength=len(pairs))
    often = times >= 2
    rank = (times.astype(np.uint64) << np.uint64(40)) | (mix(pairs) >> np.uint64(24))
    weight = np.zeros(len(key) + 2, dtype=np.uint64)
    weight[look + 1] = np.where(often, rank, np.uint64(0))[inverse]
    fresh = fresh.copy()
    fresh[look] = often[inverse]
    return np.flatnonzero((weight[1:-1] > weight[:-2]) & (weight[1:-1] > weight[2:])), fresh


def _extent(prefix: np.ndarray, low: np.ndarray, high: np.ndarray, most: np.ndarray, forward: bool) -> np.ndarray:
    """How many words (``most`` at most) from ``low`` on equal those from ``high`` on, or before both."""
    least, most = np.zeros(len(low), dtype=np.int64), most.copy()
    while (least < most).any():
        middle = (least + most + 1) // 2
        if forward:
            same = range_hash(prefix, low, low + middle) == range_hash(prefix, high, high + middle)
        else:
            same = range_hash(prefix, low - middle, low) == range_hash(prefix, high - middle, high)
        least, most = np.where(same, middle, least), np.where(same, most, middle - 1)
    return least


def _hashes(words: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of any word range follows (``range_hash``)."""
    up, _ = powers(len(words) + 1)
    out = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(mix(words.astype(np.uint64) + np.uint64(0x9E3779B9)) * up[: len(words)], out=out[1:])
    return out


def boundary_runs(words: np.ndarray, grammar: Grammar) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(nonterminal, start relative to it, length, period) of all runs across its boundary."""
    prefix = _hashes(words)
    able = np.flatnonzero(grammar.size >= LEAST)
    found = [np.zeros((0, 4), dtype=np.int64)]
    for right in (True, False):
        side = grammar.size - grammar.split if right else grammar.split
        most = np.minimum(side // 2, grammar.size // PERIODS)[able]
        ends = np.cumsum(most)
        low = 0
        while low < len(able):
            before = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + CHUNK, side="right")))
            some, n = able[low:high], most[low:high]
            low = high
            name = np.repeat(some, n)
            period = np.arange(len(name)) - np.repeat(np.cumsum(n) - n, n) + 1
            middle = grammar.first[name] + grammar.split[name]
            # two periods stand right of the boundary, or left of it
            begin = middle if right else middle - 2 * period
            for offset in (lambda q: 0, lambda q: q - 1, lambda q: q // 2):
                at = begin + offset(period)
                keep = words[at] == words[at + period]
                name, period, middle, begin = name[keep], period[keep], middle[keep], begin[keep]
            keep = range_hash(prefix, begin, begin + period) == range_hash(prefix, begin + period, begin + 2 * period)
            name, period, middle, begin = name[keep], period[keep], middle[keep], begin[keep]
            first, last = grammar.first[name], grammar.first[name] + grammar.size[name]
            after = _extent(prefix, begin + period, begin + 2 * period, last - begin - 2 * period, True)
            back = _extent(prefix, begin, begin + period, begin - first, False)
            start, stop = begin - back, begin + 2 * period + after
            wrong = ~_periodic(words, start, stop, period)
            for k in np.flatnonzero(wrong):  # two ranges with one hash
                start[k], stop[k] = _stretch(words, int(first[k]), int(last[k]), int(begin[k]), int(period[k]))
            keep = (stop - start >= np.maximum(LEAST, PERIODS * period)) & (start < middle) & (stop > middle)
            found.append(np.stack([name, start - first, stop - start, period], axis=1)[keep])
    runs = np.concatenate(found)
    # of one stretch of words only its smallest period
    runs = runs[np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))]
    keep = np.ones(len(runs), dtype=bool)
    keep[1:] = (runs[1:, :3] != runs[:-1, :3]).any(axis=1)
    return tuple(runs[keep].T)


def _periodic(words: np.ndarray, start: np.ndarray, stop: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether words ``period`` apart are the same from ``start`` to ``stop``, word by word."""
    out, n = np.ones(len(start), dtype=bool), stop - start - period
    ends, low = np.cumsum(n), 0
    while low < len(start):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + CHUNK, side="right")))
        many = n[low:high]
        of = np.repeat(np.arange(low, high), many)
        at = start[of] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
        out[of[words[at] != words[at + period[of]]]] = False
        low = high
    return out


def _stretch(words: np.ndarray, first: int, last: int, begin: int, period: int) -> tuple[int, int]:
    """The stretch of that period around two periods from ``begin`` on, word by word; empty if they are none."""
    differ = np.flatnonzero(words[first : last - period] != words[first + period : last]) + first
    k = int(np.searchsorted(differ, begin))
    if k < len(differ) and differ[k] < begin + period:
        return begin, begin
    return int(differ[k - 1]) + 1 if k else first, (int(differ[k]) if k < len(differ) else last - period) + period


def find_runs(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all maximal runs in texts of a slice, by start, then period; starts count all words."""
    grammar = Grammar(words, rows)
    name, offset, length, period = boundary_runs(words, grammar)
    if not len(name):
        return name, name, name
    n = np.bincount(name, minlength=len(grammar.size))
    begins = np.cumsum(n) - n
    held = np.flatnonzero(n[grammar.names] > 0)
    own, place = grammar.names[held], grammar.places[held]
    of = np.repeat(begins[own] - (np.cumsum(n[own]) - n[own]), n[own]) + np.arange(n[own].sum())
    start, length, period = np.repeat(place, n[own]) + offset[of], length[of], period[of]
    order = np.lexsort((-length, start, period))
    start, length, period = start[order], length[order], period[order]
    # with one period, what ends no later than something that begins no later lies inside it
    reach = period * np.int64(len(words) + 1) + start + length
    keep = np.ones(len(start), dtype=bool)
    keep[1:] = reach[1:] > np.maximum.accumulate(reach)[:-1]
    start, length, period = start[keep], length[keep], period[keep]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def collapse_runs(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: id, n_words, runs, strongest and collapsed.

    Words are what stands between white space (ASCII), told apart by 64-bit hashes of their bytes, numbered from 0.
    ``runs`` lists start, length and period (long) of every maximal stretch of at least six words and four periods, by
    start, then period; ``strongest`` is the one with the greatest length per period (ties: smallest start, then
    period), null without any. ``collapsed`` joins by one space the words that are in no run, or in the first period of
    every run that holds them. A null or empty text, or one without words, has no words, no runs and the text ''. Rows are
    judged one by one, so repeated rows, null ids and clashing columns are of no matter; an empty table gives none.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in text_slices(batch, "text", SLICE):
                part = batch.slice(low, high - low)
                offsets, data = text_buffers(part.column("text"))
                of, starts, ends = word_spans(offsets, NOT_SPACE[data])
                n_words = per_row(of, len(part))
                hashes = range_hash(prefix_hash(data), starts, ends) + (ends - starts).astype(np.uint64)
                start, length, period = find_runs(pd.factorize(hashes)[0], of)
                owner = of[start] if len(start) else np.zeros(0, dtype=np.int64)
                begin = (np.cumsum(n_words) - n_words)[owner]
                values = [pa.array(start - begin, pa.int64()), pa.array(length, pa.int64()), pa.array(period, pa.int64())]
                listed = pa.StructArray.from_arrays(values, fields=list(kind))
                strongest = [None] * len(part)
                for r, run in zip(owner.tolist(), zip(*(v.to_pylist() for v in values), strict=True), strict=True):
                    if strongest[r] is None or Fraction(run[1], run[2]) > Fraction(strongest[r][1], strongest[r][2]):
                        strongest[r] = run
                strongest = pa.array([r and dict(zip(("start", "length", "period"), r, strict=True)) for r in strongest], kind)
                depth = np.zeros(len(of) + 1, dtype=np.int64)
                np.add.at(depth, start + period, 1)
                np.add.at(depth, start + length, -1)
                kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n_words), list_array(per_row(owner, len(part)), listed), strongest, _joined(data, of[kept], starts[kept], ends[kept], len(part))],
                    names=["id", "n_words", "runs", "strongest", "collapsed"],
                )

    id_kind = ddl(rows.schema["id"].dataType)
    run = "struct<start:bigint,length:bigint,period:bigint>"
    return rows.mapInArrow(detect, f"id {id_kind}, n_words long, runs array<{run}>, strongest {run}, collapsed string")


def _joined(data: np.ndarray, rows: np.ndarray, starts: np.ndarray, ends: np.ndarray, n_rows: int) -> pa.Array:
    """Per row its words, joined by one space."""
    size = ends - starts + 1  # with the space behind it
    total = np.cumsum(size)
    at = np.repeat(starts - (total - size), size) + np.arange(total[-1] if len(total) else 0)
    out = data[np.minimum(at, max(len(data) - 1, 0))]
    out[total - 1] = 0x20
    last = np.ones(len(rows), dtype=bool)
    last[:-1] = rows[1:] != rows[:-1]
    out = np.delete(out, total[last] - 1)  # none at the end of a text
    n_bytes = np.bincount(rows, weights=size, minlength=n_rows).astype(np.int64)
    offsets = np.append(0, np.cumsum(n_bytes - (n_bytes > 0)))
    raw = pa.py_buffer(out.tobytes())
    return pa.LargeStringArray.from_buffers(n_rows, pa.py_buffer(offsets.tobytes()), raw).cast(pa.string())
