"""Runs, exact search and token alignment: operators and their registered queries against plain loops."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from punctual.llm import alignment, queries, runs, topk

random.seed(11)
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema).repartition(3)


# ---- periodic runs ------------------------------------------------------------------------------


def periodic(n_words: int, letters: int) -> list[str]:
    w = []
    while len(w) < n_words:
        some = [f"w{random.randrange(letters)}" for _ in range(random.randint(1, 7))]
        w += some * random.choice([1, 1, 1, 3, 4, 5, 9])
    return w


def odd_texts() -> list[str | None]:
    texts = [" ".join(periodic(random.randint(0, 90), k)) for k in (1, 2, 3, 40) for _ in range(25)]
    texts += [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "A a A a A a A a", "é é " * 9, "x\ty\n" * 400, "la " * 3001]
    long = periodic(6000, 500)
    return [*texts, " ".join(long), " ".join(long), "\0 \0 " * 7]


def test_runs_of_any_sequence():
    for _ in range(300):
        texts = [periodic(random.randint(0, 60), random.choice([1, 2, 3, 30])) for _ in range(random.randint(1, 5))]
        texts += texts[:1]
        kinds = {w: k for k, w in enumerate(sorted({w for t in texts for w in t}))}
        words = np.array([kinds[w] for t in texts for w in t], dtype=np.int64)
        rows = np.array([i for i, t in enumerate(texts) for _ in t], dtype=np.int64)
        want, begin = [], 0
        for t in texts:
            want += [(begin + s, n, q) for s, n, q in brute.runs(t)]
            begin += len(t)
        assert list(zip(*(x.tolist() for x in runs.find_runs(words, rows)), strict=True)) == want


def test_equal_hashes_do_not_make_runs(monkeypatch):
    """If all ranges of words had one hash, the words themselves would still decide."""
    monkeypatch.setattr(runs, "range_hash", lambda prefix, start, end: np.zeros(np.broadcast(start, end).shape, dtype=np.uint64))
    for _ in range(60):
        t = periodic(random.randint(6, 50), random.choice([1, 2, 3]))
        words = np.array([int(w[1:]) for w in t], dtype=np.int64)
        assert list(zip(*(x.tolist() for x in runs.find_runs(words, np.zeros(len(t), dtype=np.int64))), strict=True)) == brute.runs(t)


def test_grammar_derives_its_words():
    words = np.array([random.randrange(4) for _ in range(2000)] * 2, dtype=np.int64)
    grammar = runs.Grammar(words, np.repeat([0, 1], 2000))
    for name, place in zip(grammar.names.tolist(), grammar.places.tolist(), strict=True):
        first, size = grammar.first[name], grammar.size[name]
        assert 0 < grammar.split[name] < size
        assert (words[first : first + size] == words[place : place + size]).all()
    assert grammar.size.max() == 2000 and len(grammar.size) < 1400


def test_collapse_runs(spark):
    rows = list(enumerate(odd_texts())) + [(None, "b b b b b b b"), (3, "twice"), (3, "twice")]
    got = runs.collapse_runs(frame(spark, rows).withColumn("runs", F.lit("clash"))).collect()
    want = Counter((i, *brute.collapsed(t)) for i, t in rows)
    assert Counter((r.id, r.n_words, tuple(map(tuple, r.runs)), tuple(r.strongest) if r.strongest else None, r.collapsed) for r in got) == want
    assert runs.collapse_runs(frame(spark, rows).limit(0)).count() == 0


def planted(doc_id, text):
    w, h = brute.split(text), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return " ".join(w[i] if i < a else w[a + (i - a) % p] for i in range(n))
    return text


def test_op11_on_the_test_table(spark, sf_dir, documents):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, text in documents:
        _, found, best, left = brute.collapsed(planted(i, text))
        start, length, period = best or (None, None, None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        want.append((i, len(found), start, length, period, 1000 * length // period if best else None, sha(lines), sha(left)))
    got = queries.op11_runs(spark, sf_dir)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert dict(got.dtypes) | {"runs_sha256": "bigint", "collapsed_sha256": "bigint"} == dict.fromkeys(got.columns, "bigint")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sum(w[1] > 0 for w in want) > 10


# ---- exact search -------------------------------------------------------------------------------


def best_of(rows, k: int) -> Counter:
    """(query, rank, id, score) for rows (id, vector) whose id is divisible by 3."""
    sound = [(i, v) for i, v in rows if v is not None and None not in v]
    out = Counter()
    for at, (i, v) in enumerate(sound):
        if i is None or i % 3:
            continue
        scored = [(min(max(sum(a * b for a, b in zip(v, w, strict=True)), -(2**63)), 2**63 - 1), j) for x, (j, w) in enumerate(sound) if x != at and len(w) == len(v)]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out.update((i, r + 1, j, s) for r, (s, j) in enumerate(scored[:k]))
    return out


def vectors(n: int, width: int, top: int) -> list[list[int]]:
    return [[random.randint(-top, top) for _ in range(width)] for _ in range(n)]


@pytest.mark.parametrize("tile,strip,fan", [(4 << 20, 256, 32), (96, 2, 2), (400, 3, 3)])
def test_top_k(spark, monkeypatch, tile, strip, fan):
    for name, value in (("TILE_BYTES", tile), ("STRIP", strip), ("FAN_IN", fan)):
        monkeypatch.setattr(topk, name, value)
    rows = list(enumerate([*vectors(40, 2, 3), *vectors(6, 5, 10**6), *vectors(4, 3, 2**62), *[[1, 1]] * 20, None, [1, None], [], [], [7]]))
    rows += [(None, [3, 3]), (0, [3, 3]), (0, [3, 3]), (6, [2, 2])]
    df = frame(spark, rows, "vec_id int, embedding array<long>").withColumn("rank", F.lit("clash")).withColumn("row", F.lit("clash"))
    got = topk.top_k(df, F.col("vec_id") % 3 == 0, 4).collect()
    assert Counter(map(tuple, got)) == best_of(rows, 4)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 3 == 0).count() == 0
    assert topk.top_k(df, F.lit(None).cast("boolean")).count() == 0


def test_top_k_of_a_tile_without_candidates():
    """Small tables leave blocks empty: queries meet no row there."""
    rows = {"d": [3, 3], "asks": [True, True], "row": [1, 2], "id": [1, 2], "c": [0, 0], "v": [[1, 2, 3], [2**62, 0, 1]]}
    assert len(topk._tile(pa.table(rows), 4)) == 0


# ---- alignment ----------------------------------------------------------------------------------

ODD = [
    "two  spaces", "tab\t x", "a\n \nb", "end ", " start", "  two", "\n line", "a\n ", "x  y", "", None, " ", "\n", "<|endoftext|> <s> </s>",
    "it's 12 o'clock", "\x1c \x1c a", "中文 字 。 你", "😀 😀👩‍👩 a", "\u0085 a", "▁ ▁a", "a ▁b fine", "\0 \0", "﷐ a", "é" * 300, "ñ ñandú ö ÿ × ÷ x",
    "　 　a　 b", "  x  y", "ㄅ ㄆ", "½ ² ﬁ", "á é x", "𐍈 𐍈 b", "x" * 3000, "no space 中" * 40, "\r\n \r\n x",
]


def test_alignment(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CACHED", 40)  # workers of this test forget now and then
    rows = [*enumerate(ODD), (None, "no id here"), (3, "twice the same"), (3, "twice the same"), (99, " ".join(t for t in ODD if t and "▁" not in t) * 3)]
    want = Counter(brute.aligned(rows, A, B))
    df = frame(spark, rows).withColumns({"row": F.lit("clash"), "groups": F.lit("clash")})
    names = ("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    assert Counter(tuple(r[c] for c in names) for r in alignment.align(df, A, B).collect()) == want
    monkeypatch.setattr(alignment, "PART", 100)  # several passes over the links
    assert Counter(tuple(r[c] for c in names) for r in alignment.align(df, A, B).collect()) == want
    assert alignment.align(df.limit(0), A, B).count() == 0


def test_ends_inside_a_character():
    """Spans of whole characters, and empty ones, are refined by the bytes of the tokens."""
    ends = lambda spans, sizes: alignment.token_ends(np.array(spans), np.array(sizes)).tolist()
    assert ends([(0, 2), (2, 6), (2, 6)], [2, 2, 2]) == [2, 4, 6]  # é and half of 😀 twice
    assert ends([(0, 2), (2, 2), (2, 2), (2, 2), (2, 6)], [2, 1, 1, 1, 1]) == [2, 3, 4, 5, 6]
    assert ends([(0, 1), (1, 4)], [1, 2]) == [1, 4]  # a span counts more than the bytes
    i, j, together = alignment.overlaps(np.array([2, 4, 6]), np.array([1, 4, 5, 6]))
    assert list(zip(i.tolist(), j.tolist(), strict=True)) == [(0, 0), (0, 1), (1, 1), (2, 2), (2, 3)]
    assert together.tolist() == [False, False, True, False, True]


def test_op13_on_the_test_table(spark, sf_dir, documents):
    got = queries.op13_alignment(spark, sf_dir)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in brute.aligned(documents, A, B)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert all(Fraction(r[5], r[4]) <= 1 for r in want if r[4])
