"""Operators on texts against plain loops: copies, ties, nulls, empty and long texts, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece as library
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from punctual import runtime
from punctual.llm import components, decontaminate, jaccard, licenses, sentencepiece, sharding, suffix, text, tokens
from punctual.llm.text import likely_rows, without_rows
from punctual.llm.wavelet import WaveletMatrix
from punctual.runtime import kept_dir

SCHEMA = "doc_id long, text string"
random.seed(5)
WORDS = [random.choice("bcdfg") + random.choice("aeiou") + random.choice("lmnrs") for _ in range(60)] + ["é", "ñandú", "中文", "x"]


def sentence(n: int) -> str:
    return " ".join(random.choice(WORDS) for _ in range(n))


def edited(text: str, k: int) -> str:
    parts = text.split(" ")
    for _ in range(k):
        parts[random.randrange(len(parts))] = random.choice(WORDS)
    return " ".join(parts)


@pytest.fixture(scope="module")
def corpus():
    """Groups of exact and near copies, shared passages, short, empty, blank and null texts, one very long text."""
    base, passage = [sentence(80) for _ in range(6)], sentence(70)
    rows = [t for b in base for t in (b, b, edited(b, 1), edited(b, 2), edited(b, 6))]
    rows += [f"{sentence(20)} {passage} {sentence(30)}" for _ in range(5)]
    rows += [None, "", " \t\n", "One", "one", "one two", "ONE  two", "a b c", sentence(6000), passage, " " + passage]
    rows += [sentence(40) + "\n" + "la " * 120, "nul\0l " + sentence(10)]
    order = list(range(len(rows)))
    random.shuffle(order)
    return [(i, rows[k]) for i, k in enumerate(order)]


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80), (2, 50)])
@pytest.mark.parametrize("merged", [None, dict.fromkeys(range(60), 2)])
def test_jaccard_join(spark, corpus, size, percent, merged):
    got = jaccard.jaccard_join(frame(spark, corpus), "doc_id", "text", size, percent, merged).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == brute.jaccard(corpus, size, percent)
    assert len(got) == len(corpus)


def test_jaccard_join_on_the_test_table(spark, documents):
    got = jaccard.jaccard_join(frame(spark, documents), "doc_id", "text", 3, 90).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == brute.jaccard(documents, 3, 90)


def test_jaccard_join_compares_large_groups_by_chunks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    base = sentence(150)
    rows = [(i, edited(base, 2)) for i in range(25)]
    got = jaccard.jaccard_join(frame(spark, rows), "doc_id", "text", 3, 90).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == brute.jaccard(rows, 3, 90)


@pytest.mark.parametrize("bits", [6, 9, 12])
def test_jaccard_join_with_full_bitmaps(spark, corpus, monkeypatch, bits):
    """Bitmaps that let all or many others through change no link, neither do tiny packs of keys."""
    monkeypatch.setattr(jaccard, "filter_bits", lambda n: bits)
    monkeypatch.setattr(jaccard, "KEYS_AT_ONCE", 500)
    monkeypatch.setattr(jaccard, "FEW", 0 if bits < 9 else 100)
    rows = [*corpus, *((2000 + i, t) for i, t in corpus[:10])]
    got = jaccard.jaccard_join(frame(spark, rows).repartition(7), "doc_id", "text", 3, 80).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == brute.jaccard(rows, 3, 80)


@pytest.mark.parametrize("first,total", [(1, 10), (4, 10**6), (20, 10**13)])
def test_keys_packed_and_met(first, total):
    keys = jaccard._Keys(first, min(8, max(1, -(-(total.bit_length() + 12 - first) // 8))))
    one, two = (np.random.default_rng(k).integers(0, 2**64, 5000, dtype=np.uint64) for k in (1, 2))
    twice = np.concatenate([two[:7], two[:3], one[:40], one[:9]])
    runs = defaultdict(list)
    for some in (one, np.concatenate([two, two[:7]]), twice):
        for batch in keys.packed(some):
            for part, run in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                runs[part].append(run)
    met = np.concatenate([keys.shared(p, r) for p, r in runs.items()])
    assert set(keys.short(np.concatenate([two[:7], one[:40]])).tolist()) <= set(met.tolist())
    assert len(met) < 47 + 20 if total > 10 else True


def test_larger_sketches_lose_no_partner(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LARGER", {"mid": (80, 1 << 10), "wide": (400, 1 << 12)})
    rows = []
    for n in (60, 100, 390, 420, 900):
        base = sentence(n)
        rows += [base, *(edited(base, k) for k in (n // 60, n // 40, n // 25, n // 15)), sentence(n)]
    rows = list(enumerate(rows))
    got = jaccard.jaccard_join(frame(spark, rows), "doc_id", "text", 3, 80).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == brute.jaccard(rows, 3, 80)


def test_partners_behind_pairs_that_were_tried(spark, monkeypatch):
    """Trees that hold nothing but pairs already found wanting do not end the search."""
    one, two = sentence(80), sentence(150)
    rows = list(enumerate([one, edited(one, 1), two, edited(two, 1)]))
    candidates = jaccard._candidates

    def wrong(sets):
        a, b = (sets.select(F.col("node").alias(x), F.col("n").alias(f"n{x}")) for x in "ab")
        return a.join(b, (F.col("a") < F.col("b")) & (F.abs(F.col("na") - F.col("nb")) > 20)).select("a", "b")

    monkeypatch.setattr(jaccard, "_stars", lambda keyed, sets, *_: wrong(sets))
    monkeypatch.setattr(jaccard, "_candidates", lambda keyed, sets, groups, percent, mode, *x: wrong(sets).crossJoin(keyed.select("key").distinct()) if mode == "tree" else candidates(keyed, sets, groups, percent, mode, *x))
    got = jaccard.jaccard_join(frame(spark, rows), "doc_id", "text", 3, 80).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == brute.jaccard(rows, 3, 80)
    assert len({r.component_id for r in got}) == 2


@pytest.mark.parametrize("percent", [20, 50, 60, 70, 71, 80, 90])
def test_partners_of_any_size_share_a_band(percent):
    bands, sizes = jaccard.Bands(percent), np.arange(1, 2000)
    own, up = bands.of(sizes), bands.reaches_next(sizes)
    largest = np.minimum(sizes * 100 // percent, len(sizes))
    assert ((own[largest - 1] == own) | (up & (own[largest - 1] == own + 1))).all()


def test_partners_of_different_size(spark):
    text = [f"w{k}" for k in range(24)]
    rows = [(1, " ".join(text[:12])), (2, " ".join(text[:23])), (3, " ".join(text))]  # sets of 11, 22 and 23
    got = jaccard.jaccard_join(frame(spark, rows), "doc_id", "text", 2, 50).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == brute.jaccard(rows, 2, 50) == {1: (11, 1), 2: (22, 1), 3: (23, 1)}


def test_jaccard_join_writes_token_sets_of_pairs_only(spark, monkeypatch):
    kept, cut = [], jaccard.cut

    def noted(df, *args, **kwargs):
        out = cut(df, *args, **kwargs)
        if "tokens" in out.columns:
            kept.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "cut", noted)
    common = " ".join(f"w{i}" for i in range(18))
    rows = [(i, f"{common} {' '.join(f'x{i}y{k}' for k in range(4))}") for i in range(60)]  # 16 of 24 shingles in common
    assert {r.id: r.component_id for r in jaccard.jaccard_join(frame(spark, rows), "doc_id", "text", 3, 90).collect()} == {i: i for i in range(60)}
    assert sum(kept) == 0
    # two links among them, one with repeated rows of one id
    rows += [(100, rows[7][1] + " z"), (101, rows[9][1] + " z"), (101, rows[9][1] + " z"), (None, rows[9][1] + " z")]
    got = jaccard.jaccard_join(frame(spark, rows).repartition(6), "doc_id", "text", 3, 90).collect()
    assert len(got) == len(rows)
    assert {r.id: r.component_id for r in got} == {i: i for i in range(60)} | {100: 7, 101: 9, None: 9}
    assert 0 < sum(kept) < 20


@pytest.mark.parametrize("batch", [None, "3"])
def test_texts_go_to_workers_in_small_batches(spark, corpus, monkeypatch, batch):
    """While an operator reads texts, its settings hold; one of the session's own stays, and none is left behind."""
    seen, name = [], "spark.sql.execution.arrow.maxRecordsPerBatch"
    if batch:
        spark.conf.set(name, batch)
    try:
        for module in (jaccard, decontaminate):

            def noted(df, *args, cut=module.cut, **kwargs):
                seen.append({key: spark.conf.get(key, None) for key in runtime.TEXTS})
                return cut(df, *args, **kwargs)

            monkeypatch.setattr(module, "cut", noted)
        got = jaccard.jaccard_join(frame(spark, corpus), "doc_id", "text", 3, 90).collect()
        assert {r.id: (r.n_shingles, r.component_id) for r in got} == brute.jaccard(corpus, 3, 90)
        n = len(seen)
        items = spark.createDataFrame([("a", corpus[0][1])], "item_id string, text string")
        assert decontaminate.contaminated(frame(spark, corpus), items).count() == len(corpus)
        assert n > 0 and len(seen) > n
        inside = {key: batch if batch and key == name else value for key, value in runtime.TEXTS.items()}
        # what is written after the texts were read needs none of it
        assert all(x == inside for x in seen[: n - 2] + seen[n:])
        assert spark.conf.get(name, None) == batch
    finally:
        spark.conf.unset(name)
    assert all(spark.conf.get(key, None) is None for key in runtime.TEXTS)


def test_tables_of_powers_follow_the_texts(monkeypatch):
    monkeypatch.setattr(text, "_powers", {})
    data = np.arange(5000, dtype=np.uint8)
    first = text.range_hash(text.prefix_hash(data), np.array([3]), np.array([40]))
    assert len(text._powers["up"]) < 1 << 17
    text.powers(1 << 18)
    assert text.range_hash(text.prefix_hash(np.tile(data, 60)), np.array([3]), np.array([40])) == first
    up, down = text.powers(1 << 18)
    assert ((up * down) == 1).all()


def test_jaccard_join_without_ids_or_rows(spark):
    rows = [(None, "a b c d"), (7, "a b c d"), (None, "solo text here now"), (7, "a b c d"), (9, None)]
    got = jaccard.jaccard_join(frame(spark, rows), "doc_id", "text", 2, 80).collect()
    assert Counter((r.id, r.component_id) for r in got) == Counter({(None, 7): 1, (7, 7): 2, (None, None): 1, (9, 9): 1})
    assert jaccard.jaccard_join(frame(spark, [(1, None)]).limit(0), "doc_id", "text").count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(5, 5), (None, 3), (41, 40), (40, 41)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(42), 0), **dict.fromkeys(range(100, 130), 100)}


@pytest.mark.parametrize("block", [20_000, 1])
def test_repeats(spark, corpus, block, monkeypatch):
    monkeypatch.setattr(suffix, "BLOCK", block)
    df = frame(spark, corpus).withColumn("kept", F.lit("clash")).withColumn("_row", F.lit(1))
    got = {r.doc_id: r for r in suffix.remove_repeats(df, length=100).collect()}
    want = dict(zip([i for i, _ in corpus], brute.repeats([t for _, t in corpus], 100), strict=True))
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.kept) for i, r in got.items()} == want
    assert sum(w[1] for w in want.values()) > 1000


@pytest.mark.parametrize("batches", [1, 2, 7])
def test_repeats_for_any_number_of_batches(spark, documents, batches):
    got = suffix.remove_repeats(frame(spark, documents), batches=batches, keep_text=False).collect()
    want = dict(zip([i for i, _ in documents], brute.repeats([t for _, t in documents], 200), strict=True))
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == {i: w[:4] for i, w in want.items()}


def test_levels_double(spark, documents, tmp_path):
    family, arrays = suffix.SuffixFamily(spark, str(tmp_path), 200), []
    for k in range(6):
        family.add(frame(spark, documents[k::6]))
        arrays.append(sorted(family.levels))
    assert arrays == [[0], [1], [0, 1], [2], [0, 2], [1, 2]]
    keys = [r.key for r in spark.read.parquet(str(tmp_path) + "/array2").limit(0).collect()]
    assert keys == []


def test_repeats_of_nothing(spark):
    assert suffix.remove_repeats(frame(spark, [(1, "a")]).limit(0)).count() == 0
    rows = suffix.remove_repeats(frame(spark, [(1, None), (2, ""), (3, "x" * 199)])).collect()
    assert {(r.doc_id, r.n_bytes, r.n_removed) for r in rows} == {(1, 0, 0), (2, 0, 0), (3, 199, 0)}
    overlap = suffix.remove_repeats(frame(spark, [(1, "x" * 201)])).first()
    assert (overlap.n_removed, overlap.n_spans, overlap.kept) == (201, 1, "")


def test_repeats_read_texts_in_small_batches(spark, corpus, monkeypatch):
    seen = []

    def noted(df, *args, cut=suffix.cut, **kwargs):
        seen.append({key: spark.conf.get(key, None) for key in runtime.TEXTS})
        return cut(df, *args, **kwargs)

    monkeypatch.setattr(suffix, "cut", noted)
    suffix.remove_repeats(frame(spark, corpus), length=100)
    assert seen and all(x == runtime.TEXTS for x in seen)
    assert all(spark.conf.get(key, None) is None for key in runtime.TEXTS)


def test_rows_without_repeats_stay_with_spark(spark):
    """Only rows that may hold a repeat go to Python whole; the results of the others are Spark's own."""
    same = sentence(90)
    rows = [(1, same), (2, same + " é end"), (3, "x" * 201), (4, "é中" + sentence(80)), (5, None), (6, "")]
    out = suffix.remove_repeats(frame(spark, rows))
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    want = dict(zip([i for i, _ in rows], brute.repeats([t for _, t in rows], 200), strict=True))
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.kept) for r in out.collect()} == want
    assert [r.kept is None for r in out.orderBy("doc_id").collect()] == [False] * len(rows)


def test_repeats_in_bytes_that_are_no_text(spark):
    """Such bytes count and are hashed; ``kept`` leaves them out, with and without a repeat."""
    broken = "cast(concat(cast('{}' as binary), unhex('ff'), cast('z' as binary)) as string)"
    df = spark.sql(f"select 1 as doc_id, {broken.format('abc')} as text union all select 2, {broken.format('x' * 201)}")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.kept, r.kept_sha256) for r in suffix.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", "kept", "kept_sha256").collect()}
    assert got == {1: (5, 0, "abcz", hashlib.sha256(b"abc\xffz").hexdigest()), 2: (203, 201, "z", hashlib.sha256(b"\xffz").hexdigest())}


def test_digests_of_texts_are_the_same_in_spark_and_in_tasks(spark):
    rows = [(1, "é中"), (2, None), (3, ""), (4, "x" * 300), *((i, sentence(5)) for i in range(5, 40))]
    got = suffix._with_digests(frame(spark, rows)).orderBy("doc_id").collect()
    part = pa.RecordBatch.from_arrays([pa.array([t for _, t in rows], pa.string())], names=["text"])
    want = suffix.digests(part, *text.text_buffers(part.column("text")))
    assert [(r.text_a, r.text_b) for r in got] == [tuple(x) for x in want.tolist()]
    assert {r.text_a < 0 for r in got} == {True, False}


def test_a_small_level_is_few_files(spark, documents, tmp_path):
    """Each file costs an executor a moment of a second process (see README), so their number follows the size."""
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        array = suffix.suffix_array(frame(spark, documents), 200, str(tmp_path / "array"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert array.count() > 60 and len(list((tmp_path / "array").glob("part-*"))) <= 4
    parts = array.select(F.input_file_name().alias("file"), "key").groupBy("file").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    bounds = sorted((r.low, r.high) for r in parts.collect())
    assert all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:], strict=False))


def test_benchmark_windows(spark, corpus):
    long = next(t for _, t in corpus if t and len(t) > 10_000)
    items = [(1, " ".join(long.split(" ")[50:75])), (2, sentence(30)), (3, "one TWO"), (3, "a b c"), (None, "one"), (4, None), (5, " - "), (6, "bal")]
    items += [(1, items[0][1]), (12, " ".join(corpus[3][1].split(" ")[:10]) if corpus[3][1] else "one two")]
    docs = [*corpus, corpus[0], (None, "One two!")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit(1))
    got = decontaminate.contaminated(frame(spark, docs).withColumn("item", F.lit("clash")), benchmark).collect()
    assert sorted([(r.id, r.n_words, r.n_hit, list(r["items"])) for r in got], key=str) == brute.benchmark(docs, items)
    assert sum(r.n_hit > 0 for r in got) > 3


def test_benchmark_without_rows(spark, corpus):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.contaminated(frame(spark, corpus), none).collect()
    assert len(got) == len(corpus) and not any(r.n_hit for r in got)
    assert decontaminate.contaminated(frame(spark, corpus).limit(0), none.union(spark.createDataFrame([(1, "a")], none.schema))).count() == 0


def test_rows_without(spark):
    df = spark.createDataFrame([(i, None) for i in [*range(50), None, 3]], "id long, x string")
    gone = spark.createDataFrame([(3,), (4,), (None,), (99,)], "g long")
    got = Counter(r.id for r in without_rows(df, "id", gone, "g", bits=6).collect())
    assert got == Counter([i for i in [*range(50), None] if i not in (3, 4)])


@pytest.mark.parametrize("keep", [likely_rows, without_rows])
def test_rows_stay_with_spark_while_their_keys_are_looked_up(spark, keep):
    rows = [(i % 40 or None, {"k": i}, "a text") for i in range(80)]
    df = spark.createDataFrame(rows, "id long, `a b` struct<k:int>, text string")
    out = keep(df, "id", spark.createDataFrame([(3,), (None,)], "g long"), "g", bits=16)
    assert out.schema == df.schema
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan
    got = Counter((r.id, r["a b"].k) for r in out.collect())
    wanted = {(i, x["k"]) for i, x, _ in rows if (i == 3) == (keep is likely_rows) and i is not None}
    assert set(got) >= wanted and set(got.values()) == {1} and len(got) < 80


# ---- sharding -----------------------------------------------------------------------------------


def test_shards(spark):
    rows = [(i % 90, None if i % 7 == 0 else "t") for i in range(1003)]  # repeated rows and nulls
    got = sharding.shard(frame(spark, rows).withColumn("slot", F.lit("clash")), 8, seed=3).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert sorted(map(len, slots.values())) == [125] * 5 + [126] * 3
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(frame(spark, rows).limit(0), 8).count() == 0
    assert [(r.shard, r.slot) for r in sharding.shard(frame(spark, rows[:1]), 8).collect()] == [(0, 0)]


def test_shuffle_is_uniform(spark):
    """Every row is as likely in any place: chi-square over (tenth of the input, shard) and over slots."""
    df = spark.range(0, 4000, 1, 4).withColumnRenamed("id", "doc_id")
    got = sharding.shard(df, 8, seed=11).collect()
    cells = Counter((r.doc_id // 400, r.shard) for r in got)
    assert sum((cells[i, j] - 50) ** 2 / 50 for i in range(10) for j in range(8)) < 110  # 63 degrees of freedom
    halves = Counter((r.doc_id // 400, r.slot // 250) for r in got)
    assert sum((halves[i, j] - 200) ** 2 / 200 for i in range(10) for j in range(2)) < 30


def test_hypergeometric_law():
    rng = np.random.default_rng(1)
    drawn = [sharding.hypergeometric(rng, 30, 50, 20) for _ in range(20_000)]
    exact = np.random.default_rng(2).hypergeometric(30, 50, 20, 200_000)
    for k in range(3, 13):
        assert abs(np.mean(np.array(drawn) == k) - np.mean(exact == k)) < 0.012
    big = [sharding.hypergeometric(rng, 10**11, 7 * 10**11, 10**9) for _ in range(20)]
    assert all(abs(x - 125_000_000) < 100_000 for x in big)
    matrix = sharding.communication_matrix([5, 0, 17, 3], sharding.shard_sizes(25, 4), 9)
    assert [sum(line) for line in matrix] == [5, 0, 17, 3] and [sum(c) for c in zip(*matrix, strict=True)] == [7, 6, 6, 6]


# ---- tokens -------------------------------------------------------------------------------------

ODD = [
    "two  spaces", "tab\t x", "a\n \nb", "end ", " start", "a\n ", "x  y", "", None, "<|endoftext|>", "a\n <|endoftext|> b",
    "it's 12 o'clock", "\x1c \x1c a", "中文 字", "😀 😀", "\u0085 a", "▁ ▁a", "\0 \0", "﷐ a", "é" * 300,
]


def test_token_files(spark, documents, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_TOKENS", 5000)
    monkeypatch.setattr(tokens, "GROUP", 2)
    monkeypatch.setattr(tokens, "ASKED", 300)
    rows = [*documents, *((10_000 + i, t) for i, t in enumerate(ODD)), (None, "no id"), (3, "twice"), (3, "twice")]
    path, vocabulary = kept_dir(spark, "test"), public_tokenizers.path("byte_bpe_50k.json")
    tokens.write_tokens(frame(spark, rows).withColumn("shard", F.lit(1)), path, vocabulary, shard_bytes=40_000)
    library_ids = Tokenizer.from_file(vocabulary)
    want = [(i, [*library_ids.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in rows]
    got = sorted(tokens.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert sorted(((r.doc_id, list(r.ids)) for r in got), key=str) == sorted(want, key=str)
    assert [-1 if r.doc_id is None else r.doc_id for r in got] == sorted(-1 if i is None else i for i, _ in want)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got]).tolist()[:-1]]
    digests = {r.start: r.ids_crc32 for r in tokens.read_tokens(spark, path, digest=True).collect()}
    assert digests == {r.start: zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) for r in got}
    stream = Counter(x for _, ids in want for x in ids)
    for token in (0, 262, 50256, 50000):
        assert tokens.occurrences(spark, path, token).agg(F.sum("n")).first()[0] == stream[token]
    whole = [(r.doc_id, x) for r in got for x in r.ids]
    for token in (0, 262, 50256, 50000, 1 << 20):
        found = sorted(((r.place, r.doc_id) for r in tokens.places_of(spark, path, token).collect()), key=str)
        assert found == sorted(((k, i) for k, (i, x) in enumerate(whole) if x == token), key=str)
    asked = [*range(0, len(whole), 7), *range(0, len(whole), 7), -1, len(whole) - 1, len(whole), None]
    places = spark.createDataFrame([(k, 1) for k in asked], "place long, token int").repartition(3)
    answers = {r.place: r.token for r in tokens.token_at(spark, path, places).collect()}
    assert answers == {k: whole[k][1] if 0 <= k < len(whole) else None for k in asked if k is not None}
    assert tokens.token_at(spark, path, places.limit(0)).count() == 0
    nothing = kept_dir(spark, "test")
    tokens.write_tokens(frame(spark, rows).limit(0), nothing, vocabulary)
    assert tokens.read_tokens(spark, nothing).count() == tokens.places_of(spark, nothing, 0).count() == 0
    assert {r.token for r in tokens.token_at(spark, nothing, places).collect()} == {None}


@pytest.mark.parametrize("size,top,bits", [(0, 4, 3), (1, 1, 1), (511, 7, 3), (512, 3, 2), (1537, 300, 9), (5000, 70_000, 17)])
def test_wavelet_matrix(size, top, bits):
    ids = np.random.default_rng(size).integers(0, top, size).astype(np.uint32 if bits > 16 else np.uint16)
    matrix = WaveletMatrix.build(ids, bits)
    assert matrix.all().tolist() == ids.tolist()
    for at in range(0, size, max(1, size // 40)):
        token = int(ids[at])
        assert matrix.access(at) == token
        assert matrix.count(token, at // 2, at) == int((ids[at // 2 : at] == token).sum())
        before = int((ids[:at] == token).sum())
        assert matrix.select(token, before) == at
        assert matrix.places(token).tolist() == np.flatnonzero(ids == token).tolist()
    assert matrix.count(1 << bits) == len(matrix.places(1 << bits)) == 0 and matrix.select(0, size) is None


# ---- SentencePiece ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return sentencepiece.pieces(public_tokenizers.path("piece_bpe_32k.model"))


def test_pieces_are_the_best_path(model):
    for text in [*filter(None, ODD), sentence(20), "aaaaaaaaaaaa", "thethethe ing"]:
        whole = sentencepiece.marked(text)
        best = model.forward(whole)
        assert model.encode(text) == model.ids(model.back(whole, best, 0, len(whole)))
        ids = np.frombuffer(model.encode(text), dtype="<i4").tolist()
        assert model.decode(ids) == text


def test_no_other_segmentation_is_better(model):
    def all_paths(text):
        if not text:
            return [[]]
        return [[text[:n], *rest] for n in range(1, min(model.longest, len(text)) + 1) if model.cost(text[:n]) is not None for rest in all_paths(text[n:])]

    for text in ("abab a", "the in", "aaaaa", "xé▁"):
        whole = sentencepiece.marked(text)
        paths = all_paths(whole)
        score = lambda p: sum(model.cost(x) for x in p)
        top = max(map(score, paths))
        best = max((p for p in paths if score(p) == top), key=lambda p: [len(x) for x in reversed(p)])
        assert model.path(whole) == (top, best)


@pytest.mark.parametrize("chunk", [64, 100, 1000])
def test_chunks_change_nothing(spark, documents, model, chunk):
    rows = [*documents[:60], *((10_000 + i, t) for i, t in enumerate(ODD)), (None, "ab" * 500), (None, "▁" * 130), (5, "a" * 400 + " b"), (6, "no" * 64)]
    df = frame(spark, rows).withColumn("ids", F.lit("clash"))
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = sentencepiece.decode(sentencepiece.encode(df, path, chunk=chunk), path).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    for r in got:
        assert list(r.ids) == np.frombuffer(model.encode(r.text), dtype="<i4").tolist()
        assert r.decoded == (r.text or "")
        assert r.n_chunks == -(-len(r.text or "") // chunk)
    assert sentencepiece.encode(df.limit(0), path).count() == 0


def test_words_are_hashed_block_by_block(model, monkeypatch):
    texts = [sentencepiece.marked(t) if t else "" for t in (sentence(300) + " " + "x" * 200, "", sentence(50))]
    model.forget()
    whole = model.encode_all(texts)
    assert len(model.known) == len(set(model.known.tolist())) == len(model.places)
    monkeypatch.setattr(sentencepiece, "HASHED", 64)
    for again in (model.encode_all(texts), model.forget() or model.encode_all(texts)):
        assert all((x == y).all() for x, y in zip(whole, again, strict=True))


def test_encoding_takes_little_memory_beside_the_texts(model):
    whole = sentencepiece.marked("considerable arrangements notwithstanding " * 25_000)
    model.encode_all([whole[:100]])
    tracemalloc.start()
    model.encode_all([whole])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * len(whole)


def test_only_ids_go_to_the_decoder(spark, model):
    df = spark.createDataFrame([(1, "one two", model_ids(model, "one two")), (2, None, None), (3, "", [])], "Decoded long, text string, ids array<int>")
    out = sentencepiece.decode(df, public_tokenizers.path("piece_bpe_32k.model"), out="spelled")
    assert out.columns == ["Decoded", "text", "ids", "spelled"]
    assert {r.Decoded: r.spelled for r in out.collect()} == {1: "one two", 2: None, 3: ""}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan


def model_ids(model, text: str) -> list[int]:
    return np.frombuffer(model.encode(text), dtype="<i4").tolist()


def test_the_library_reads_the_ids(model):
    spoken = library.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for text in (sentence(30), "plain text, nothing odd", "tabs\tand\nlines"):
        assert spoken.decode(np.frombuffer(model.encode(text), dtype="<i4").tolist()) == text


def test_products_are_associative():
    rng = np.random.default_rng(3)
    matrices = rng.integers(-1000, 0, (600, 4, 4))
    matrices[rng.random(matrices.shape) < 0.4] = sentencepiece.NEVER
    got, one = sentencepiece.prefix_products(matrices), matrices[0]
    for k in range(1, len(matrices)):
        one = sentencepiece.compose(one, matrices[k])
        assert (got[k] == one).all()


# ---- licences -----------------------------------------------------------------------------------


def test_licence_places(spark):
    texts = [
        "Released under the MIT License.", "mit  LICENSE, mit-license", "MIT License", "the mit licenses", None, "", " -- ",
        "Licensed under the Apache License, Version 2.0.", "GNU General Public License and the general public\nlicense",
        "Licensed under CC BY-NC 4.0.", "cc and nc by themselves", "x " * 5000 + "released under the MIT license " + "y " * 5000,
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    ]
    rows = [*enumerate(texts), (0, texts[0]), *((100 + i, "of the and under with") for i in range(30))]
    got = licenses.scan(frame(spark, rows).withColumn("labels", F.lit("clash"))).collect()
    assert len(got) == len(rows)
    for r in got:
        w = brute.words(r.text)
        at = [(i, label) for i in range(len(w)) for phrase, label in licenses.PHRASES.items() if w[i : i + len(phrase.split())] == phrase.split()]
        want = (len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at})))
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1
    labels = {r.doc_id: r.labels for r in got}
    assert (labels[9], labels[10], labels[12], labels[7], labels[105]) == ("cc-by-nc", "", "isc", "apache", "")
    assert licenses.scan(frame(spark, rows).limit(0)).count() == 0


def test_all_licences_of_one_text(spark):
    """A text may hold all 72 licence words: every notice in it counts, however common its words are."""
    notices = [t for _, t, _ in licenses.TEMPLATES]
    common = sorted({w for t in notices for w in t.split(" ")})
    rows = [(0, ". ".join(notices)), (1, "x ".join(f"{t}. " for t in reversed(notices)))]
    rows += [(10 + i, " ".join(common[: 7 * i % 73])) for i in range(60)]
    got = {r.doc_id: r for r in licenses.scan(frame(spark, rows)).collect()}
    every = ",".join(sorted({label for label, _, _ in licenses.TEMPLATES}))
    assert (got[0].labels, got[1].labels, got[0].score, got[1].score) == (every, every, 1.0, 1.0)


def test_whole_licences_and_names_that_clash(spark):
    """Templates of several sentences as a parameter; helper names of the caller come back as they were."""
    long = " ".join(f"clause{i % 97} of part{i % 13}" for i in range(700)) + " the warranty ends here"
    given = [("long", long, "warranty ends here"), ("word", "solo", "solo")]
    rows = [(0, f"intro {long} outro"), (1, long.replace("warranty ends", "warranty never ends")), (2, "solo"), (3, " ".join(long.split()[:300]))]
    rows += [(10 + i, "of the part and the clause") for i in range(30)]
    clash = ["_words", "_at0", "_places", "_held", "_matches", "id", "held", "row", "base", "words", "found", "share", "t"]
    df = frame(spark, rows).withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in clash})
    got = {r.doc_id: r for r in licenses.scan(df, templates=given).collect()}
    assert [got[i].labels for i in (0, 1, 2, 3, 10)] == ["long", "", "word", "", ""] and got[0].score == 1.0
    assert all(got[i][c] == f"{c}{i}" and got[i].text == t for i, t in rows for c in clash)
    assert "text" not in licenses.scan(df, keep_text=False).columns
    with pytest.raises(ValueError):
        licenses.scan(df, templates=[("x", "a b c", "c a")])


def test_licences_meet_sql_on_a_text_of_all_templates(spark, tmp_path):
    import duckdb

    from punctual.llm import queries

    notices = [t for _, t, _ in licenses.TEMPLATES]
    rows = [(0, ". ".join(notices)), (1, "nothing"), (2, None), (3, ""), *((10 + i, t.upper()) for i, t in enumerate(notices))]
    rows += [(100 + i, f"some words {i} of the text and a license") for i in range(40)]
    frame(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op8_licenses(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE['op8_licenses']})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert not re.search("Python|Pandas|Arrow", got._jdf.queryExecution().toString())


def test_a_task_may_begin_with_nothing():
    """The tables behind the hashes exist from the first call on, whatever its size."""
    from punctual.llm import text

    kept = dict(text._powers)
    try:
        text._powers.clear()
        assert [len(x) for x in text.words(np.zeros(3, dtype=np.int64), np.zeros(0, dtype=np.uint8), text.ALNUM)] == [0, 0]
        text._powers.clear()
        assert len(text.powers(5)[0]) == 5
    finally:
        text._powers.update(kept)


def _signed(bands: jaccard.Bands, sets: list[np.ndarray], band: int) -> list[set[int]]:
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    sizes = np.array([len(s) for s in sets])
    who, keys = bands.signatures(rows, np.concatenate(sets), sizes, np.full(len(sets), band))
    out = [set() for _ in sets]
    for w, k in zip(who.tolist(), keys.tolist(), strict=True):
        out[w].add(k)
    return out


@pytest.mark.parametrize("merged", [0, 1, 4, 16])
def test_unrelated_sets_share_no_key(merged):
    """Segments without a token, or with the only one left out, say the same of all sets: few sets have them as keys."""
    rng = np.random.default_rng(merged)
    bands = jaccard.Bands(80, {12: merged})
    sets = [rng.integers(1, 2**63, n, dtype=np.uint64) for n in rng.integers(bands.low[12], bands.top[12] + 1, 1500)]
    shared = Counter(k for keys in _signed(bands, sets, 12) for k in keys)
    assert max(shared.values()) <= 15


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_partners_share_a_key(percent):
    """At the largest difference that partners may have, whatever segments merge, for small sets and larger ones."""
    rng = np.random.default_rng(percent)
    for merged in (0, 1, 2, 5, 40):
        for band in range(1, 13):
            bands = jaccard.Bands(percent, {band: merged})
            a, b = [], []
            for x, y in rng.integers(bands.low[band], bands.top[band] + 1, (60, 2)).tolist():
                common = -(-percent * (x + y) // (100 + percent))
                if common <= min(x, y):
                    tokens = rng.integers(1, 2**63, x + y - common, dtype=np.uint64)
                    a.append(tokens[:x])
                    b.append(tokens[x - common :])
            found = _signed(bands, a + b, band)
            assert a and all(found[k] & found[k + len(a)] for k in range(len(a))), (merged, band)
