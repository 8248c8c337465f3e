"""Language ID, toxicity, vectors and the pipeline."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import brute
import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from punctual import runtime
from punctual.llm import embeddings, kneser_ney, language, queries, toxicity
from punctual.runtime import kept_dir

SF = "/root/testdata/sf0.01"


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_estimates_are_interpolated_kneser_ney(spark):
    """Every log-probability of a small model, and that they sum to one over the characters seen."""
    texts, order = ["ab abba", "bab", "abab ba", "aab"], 3
    counts = kneser_ney.gram_counts(spark.createDataFrame([("x", t) for t in texts], "k string, t string"), "k", "t", order)
    model = kneser_ney.estimate(counts, order, 0, kept_dir(spark, "model"))
    grams = [Counter() for _ in range(order + 1)]
    for t in texts:
        codes = "\0" * (order - 1) + " " + t + " "
        for i in range(order - 1, len(codes)):
            grams[order][codes[i - order + 1 : i + 1]] += 1
    for n in range(order - 1, 0, -1):
        grams[n] = Counter(g[1:] for g in grams[n + 1])
    chars = len(grams[1])

    def discount(n):
        one, two = (sum(c == k for c in grams[n].values()) for k in (1, 2))
        return one / (one + 2 * two) if one and two else 0.5

    def p(context, char):
        if context is None:
            return 1 / chars
        n = len(context) + 1
        own = {g: c for g, c in grams[n].items() if g[:-1] == context}
        lower = p(context[1:] if context else None, char)
        if not own:
            return lower
        d, total = discount(n), sum(own.values())
        return max(own.get(context + char, 0) - d, 0) / total + d * len(own) / total * lower

    rows = model.collect()
    delta = {r.gram: r.delta for r in rows}
    bow = {r.gram: r.bow for r in rows}
    for context in ("ab", "ba", " a", "\0 ", "bb"):
        for char in "ab ":
            g = context + char
            got = sum(delta.get(g[-n:], 0) for n in range(1, order + 1)) + sum(bow.get(context[len(context) - n :], 0) for n in range(order))
            assert got == pytest.approx(math.log(p(context, char)), abs=1e-9)
    assert sum(p("ab", c) for c in {g for g in grams[1]}) == pytest.approx(1.0)


@pytest.fixture(scope="module")
def predicted(spark):
    return queries.op10_language(spark, SF).collect()


def test_held_out_languages(spark, predicted):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in predicted if r.held_out]
    assert len(predicted) == len(truth) and all(r.held_out == held_out(r.doc_id) for r in predicted)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) > 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in predicted)
    assert sum(r.rejected for r in predicted) < 0.01 * len(predicted)


def test_parts_of_a_model_add_up(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(80).select("doc_id", "text", "lang")
    one, many = (
        {r.doc_id: r for r in language.identify(docs, F.lit(True), order=3, part_entries=n).collect()} for n in (10**7, 2500)
    )
    assert all(one[i].lang_pred == r.lang_pred and abs(one[i].cross_entropy - r.cross_entropy) < 1e-4 for i, r in many.items())


def test_languages_of_odd_rows(spark):
    rows = [(i, "the cat sat on the mat again", "en") for i in range(8)] + [(20 + i, "le chat noir est ici encore", "fr") for i in range(8)]
    rows += [(50, None, "en"), (51, "", None), (52, "123 --- !", "fr"), (53, "le chat", None), (54, "qzx" * 4000, None), (None, "the mat", None), (1, "the cat sat on the mat again", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = language.identify(df, F.col("lang").isNotNull())
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score", "cross_entropy", "rejected"]
    by = {r.doc_id: r for r in got.collect()}
    assert [by[i].lang_pred for i in (50, 51, 52)] == ["und"] * 3 and all(by[i].rejected for i in (50, 51, 52))
    assert (by[53].lang_pred, by[None].lang_pred, by[0].lang_pred, by[20].lang_pred) == ("fr", "en", "en", "fr")
    assert by[54].rejected and not by[0].rejected
    assert got.count() == len(rows)
    assert {r.lang_pred for r in language.identify(df, F.lit(False)).collect()} == {"und"}
    assert language.identify(df.limit(0), F.lit(True)).count() == 0


def test_held_out_toxicity(spark):
    got = {r.doc_id: r for r in queries.op5_toxicity(spark, SF).collect()}
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [i for i in truth if held_out(i)]
    caught = sum(got[i].predicted == 1 for i in held if truth[i] == 1) / sum(truth[i] == 1 for i in held)
    wrong = sum(got[i].predicted == 1 for i in held if truth[i] == 0) / sum(truth[i] == 0 for i in held)
    assert caught >= 0.6 and wrong < 0.06
    assert all(0 <= r.score <= 1 for r in got.values()) and len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_toxicity_of_odd_rows(spark):
    random.seed(2)
    plain = [" ".join(random.choice(["sun", "sea", "rain", "wind", "tree", "leaf"]) for _ in range(30)) for _ in range(60)]
    bad = [p.replace("leaf", "vilefool") for p in plain[:20]]
    labelled = spark.createDataFrame([(t, 0) for t in plain] + [(t, 1) for t in bad] + [(None, 1), ("x", None), ("x", 7)], "text string, toxic int")
    rows = [(1, "the vilefool and the vilefool by the sea"), (2, "sun and sea"), (3, None), (4, ""), (5, "sun " * 20_000), (None, "vilefools vilefools"), (2, "sun and sea")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = toxicity.toxicity(df, labelled).collect()
    by = {r.doc_id: r.score for r in got}
    assert len(got) == len(rows) and by[1] > 0.3 and by[None] > 0.3 and max(by[2], by[3], by[4], by[5]) < 0.3
    many = {r.doc_id: r.score for r in toxicity.toxicity(df, labelled, part_entries=200).collect()}
    assert all(abs(by[i] - many[i]) < 1e-9 for i in by)
    one_class = toxicity.toxicity(df, labelled.where("toxic = 0")).collect()
    assert {r.score for r in one_class} == {0.0}
    assert toxicity.toxicity(df.limit(0), labelled).count() == 0


# ---- vectors ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vectors():
    rng, rows = np.random.default_rng(4), []
    for label in (0, 1, None):
        for _ in range(30):
            centre = rng.normal(size=16)
            centre /= np.linalg.norm(centre)
            for k in range(rng.integers(1, 9)):
                noise = rng.normal(size=16)
                noise *= 0.19 * rng.random() / np.linalg.norm(noise)
                rows.append((len(rows), label, (centre + noise * (k > 1)).tolist()))
    rows += [(9000, 0, None), (9001, 0, []), (9002, 0, [0.0] * 16), (9003, 0, [float("nan")] * 16), (9004, 0, [float("inf")] + [1.0] * 15)]
    rows += [(9005, 0, [None] + [1.0] * 15), (9006, 0, [1e300] * 16), (9007, 0, [1e-300] * 16), (9008, 1, [1.0] * 3), (9009, 1, [2.0] * 3)]
    return rows


@pytest.mark.parametrize("how", [{}, {"cell": 4}, {"cell": 2, "target_recall": 1.0}])
def test_links_between_vectors(spark, vectors, how, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 7)
    df = spark.createDataFrame(vectors, "vec_id long, label int, embedding array<double>").repartition(3).withColumn("cell", F.lit("clash"))
    got = {r.id: (r.n_links, r.component_id) for r in embeddings.link_vectors(df, **how).collect()}
    scaled = [(i, x, [v * 1e-300 for v in vec] if i == 9006 else [1.0] * 16 if i == 9007 else vec) for i, x, vec in vectors]
    want = brute.vectors(scaled)
    found = sum(n for n, _ in got.values()) / sum(n for n, _ in want.values())
    assert len(got) == len(vectors) and found >= 0.99  # of all links
    assert all(got[i][0] <= want[i][0] for i in want)
    if how.get("target_recall") == 1.0 or not how:
        assert got == want


def test_margins_are_distances_to_bisectors():
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(400, 10))
    grid = embeddings.Grid.fit(rows / np.linalg.norm(rows, axis=1, keepdims=True), 9, 0.98, 1.0)
    grid.books = tuple(np.concatenate([b, b[:1]]) for b in grid.books)  # one centroid twice: no bisector between them
    unit = rows[:50] / np.linalg.norm(rows[:50], axis=1, keepdims=True)
    for found, book, part in zip(grid.margins(unit), grid.books, (unit[:, :5], unit[:, 5:]), strict=True):
        for x, got in zip(part, found, strict=True):
            far = ((book - x) ** 2).sum(1)
            own = far.argmin()
            gap = np.sqrt(((book - book[own]) ** 2).sum(1))
            want = [0.0 if g == 0 else ((f - far[own]) / (2 * g)) ** 2 for f, g in zip(far, gap, strict=True)]
            assert np.allclose(got, want, rtol=1e-6, atol=1e-12)


def test_labels_of_different_sizes(spark):
    """A label with most rows has a grid of its own; links are those of brute force in all labels."""
    rng = np.random.default_rng(11)
    rows = []
    for k in range(700):
        label = 0 if k < 600 else 1 + k % 30
        base = rng.normal(size=6) if k % 3 == 0 or not rows or rows[-1][1] != label else np.array(rows[-1][2]) + rng.normal(size=6) * 0.05
        rows.append((k, label, [float(v) for v in base]))
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(3)
    got = {r.id: (r.n_links, r.component_id) for r in embeddings.link_vectors(df, target_recall=1.0, cell=40).collect()}
    assert got == brute.vectors(rows) and sum(n for n, _ in got.values()) > 200


def test_vectors_without_rows_or_ids(spark):
    rows = [(1, 0, [1.0, 2.0]), (1, 0, [1.0, 2.0]), (None, 0, [1.0, 2.0]), (3, 0, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = sorted(((r.id, r.n_links, r.component_id, r.kept) for r in embeddings.link_vectors(df).collect()), key=str)
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (3, 2, 1, False), (None, 0, None, False)]
    assert embeddings.link_vectors(df.limit(0)).count() == 0


# ---- pipeline -----------------------------------------------------------------------------------


def test_pipeline(spark):
    """Every stage against what it should decide, on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, spark.createDataFrame(spark.createDataFrame([], docs.schema).rdd, docs.schema), SF)
        assert out.count() == 0 and out.columns[: len(columns)] == columns
        path = kept_dir(spark, "stage")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        after = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        if name == "language":
            assert set(after) <= set(before) and len(after) > 0.99 * len(before)
        elif name == "near_duplicates":
            assert set(after) == {i for i, (_, c) in brute.jaccard(before.items(), 5, 80).items() if i == c}
        elif name == "repeated_passages":
            want = dict(zip(before, brute.repeats(before.values(), 200), strict=True))
            assert after == {i: w[4] for i, w in want.items() if w[1] == 0 or w[4].strip(" ")}
        elif name == "benchmark_free":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert set(after) == {i for i, _, hit, _ in brute.benchmark(before.items(), items) if not hit}
        else:
            assert after == before
            assert docs.where(F.size("ids") != F.col("n_tokens")).count() == 0
        before = after


def test_stages_take_odd_rows(spark):
    odd = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, None, "en", None, None), (3, "a b " * 30_000, "en", "s", 1), (3, "a b " * 30_000, "en", "s", 1), (None, "c d e f g", None, "s", 9)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long")
    kept = defaultdict(int)
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = stage(spark, docs, SF).count()
    assert kept["encoded"] == kept["benchmark_free"] == len(odd) and kept["near_duplicates"] == len(odd)
    assert kept["repeated_passages"] == len(odd) - 2


def test_texts_are_scored_before_the_caller_writes(spark, monkeypatch):
    """The language stage writes its rows itself, in small batches, and leaves none of its settings behind."""
    seen = []

    def noted(df, *args, cut=corpus_pipeline.cut, **kwargs):
        seen.append({key: spark.conf.get(key, None) for key in runtime.TEXTS})
        return cut(df, *args, **kwargs)

    monkeypatch.setattr(corpus_pipeline, "cut", noted)
    rows = [(i, f"some words {i}", "en", "s", 9) for i in range(40)] + [(40, "123", "en", "s", 3), (41, None, None, "s", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.known_language(spark, docs, SF)
    assert "InArrow" not in out._jdf.queryExecution().executedPlan().toString()
    assert seen == [runtime.TEXTS]
    assert all(spark.conf.get(key, None) is None for key in runtime.TEXTS)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == list(range(40))


def test_stages_keep_columns_of_any_name(spark):
    names = ["_key", "_hash", "_row", "_rest", "_text", "_lang", "score", "rejected", "kept", "n_removed", "n_hit", "id", "component_id", "row", "tag", "count", "n chars"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")  # a small table of its own
    docs = docs.withColumns({n: F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")) for n in names})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns[: len(docs.columns)] == docs.columns, name
        rows = out.select("doc_id", *(F.col(f"`{n}`") for n in names)).collect()
        assert rows and all(r[n] == f"{n} {r.doc_id}" for r in rows for n in names), name


def test_stages_judge_rows_without_ids_and_repeated_ids_one_by_one(spark, tmp_path):
    random.seed(9)
    one, two, three, four, five, item = (" ".join(random.choice("bcdfgklm") + random.choice("aeiou") + random.choice("lmnrst") for _ in range(90)) for _ in range(6))
    rows = [(None, one), (None, one), (None, one + " end"), (7, two), (None, two), (5, three), (5, four), (4, three), (9, five), (9, five), (9, five + " end")]
    rows += [(6, "clean words"), (6, "x " + item), (None, "y z " + item[:-4] + " odd"), (None, None), (None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema).repartition(3)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def after(name, df):
        path = kept_dir(spark, "stage")
        stages[name](spark, df, str(tmp_path)).write.parquet(path)
        out = spark.read.parquet(path)
        assert out.columns == docs.columns
        return out, Counter((r.doc_id, r.text) for r in out.collect())

    assert after("benchmark_free", docs)[1] == Counter(r for r in rows if item[:60] not in (r[1] or ""))
    clean = docs.where(~F.coalesce(F.col("text").contains(item[:60]), F.lit(False)))
    left, got = after("near_duplicates", clean)
    lone = [r for r in got if r[0] is None and r[1]]
    assert len(lone) == 1 and got[lone[0]] == 1 and lone[0][1] in (one, one + " end")
    of_nine = {t for i, t in got if i == 9}
    assert len(of_nine) == 1 and of_nine <= {five, five + " end"}
    assert {r for r in got if r[0] in (4, 5, 6, 7)} == {(4, three), (5, four), (6, "clean words"), (7, two)}
    assert got[None, None] == 2
    left, got = after("repeated_passages", left)
    assert got == Counter([lone[0], (4, three), (5, four), (6, "clean words"), (7, two), (9, of_nine.pop()), (None, ""), (None, "")])
    twice = spark.createDataFrame([(1, one, "en", "s", 1), (1, one, "en", "s", 1)], schema)
    assert after("repeated_passages", twice)[1] == Counter([(1, one)])
