"""Registered queries that SQL cannot state, against plain loops over a whole test table."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from functools import cache

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from punctual.llm import queries, sentencepiece, toxicity


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def folded(text: str | None) -> str:
    """Lower-case letters, one space for anything else, a space around."""
    low = (c if not c.isalpha() else c.lower() if len(c.lower()) == 1 else c for c in text or "")
    return " " + "".join(" ".join("".join(c if c.isalpha() else " " for c in low).split()) + " ").lstrip()


def continuations(top: Counter, order: int) -> list[Counter]:
    """Counts of all orders: lower ones are the numbers of different characters before a gram."""
    grams = [Counter() for _ in range(order)] + [top]
    for n in range(order - 1, 0, -1):
        grams[n] = Counter(g[1:] for g in grams[n + 1])
    return grams


def discounts(levels: list[Counter], order: int) -> list[float]:
    out = [0.0]
    for n in range(1, order + 1):
        one, two = (sum(c == k for c in levels[n].values()) for k in (1, 2))
        out.append(one / (one + 2 * two) if one and two else 0.5)
    return out


def interpolated(grams: list[Counter], d: list[float], chars: int):
    """p(gram): of its last character after the others, by interpolated Kneser-Ney."""
    after = defaultdict(lambda: [0, 0])
    for level in grams:
        for g, c in level.items():
            own = after[len(g), g[:-1]]
            own[0] += c
            own[1] += 1

    @cache
    def p(gram: str) -> float:
        if not gram:
            return 1 / chars
        n, lower = len(gram), p(gram[1:])
        total, kinds = after.get((n, gram[:-1]), (0, 0))
        return max(grams[n][gram] - d[n], 0) / total + d[n] * kinds / total * lower if total else lower

    return p


def test_op2(spark, sf_dir, documents):
    got = queries.op2_sharding(spark, sf_dir).collect()
    raw = {i: (t or "").encode() for i, t in documents}
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted((i, len(b) + 1, zlib.crc32(b)) for i, b in raw.items())
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


def test_op3(spark, sf_dir, documents):
    got = {r.doc_id: r for r in queries.op3_sentencepiece(spark, sf_dir).collect()}
    model = sentencepiece.pieces(public_tokenizers.path("piece_bpe_32k.model"))
    assert len(got) == len(documents) and all(r.round_trip for r in got.values())
    for i, text in documents:
        whole = sentencepiece.marked(text) if text else ""
        want = model.ids(model.back(whole, model.forward(whole), 0, len(whole))) if text else b""
        assert got[i].n_tokens == len(np.frombuffer(want, dtype="<i4"))


def test_op6(spark, sf_dir, documents):
    got = {r.doc_id: r for r in queries.op6_suffix_dedup(spark, sf_dir).collect()}
    assert len(got) == len(documents)
    for (i, _), want in zip(documents, brute.repeats([t for _, t in documents], 200), strict=True):
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == want[:4]


def test_op9(spark, sf_dir, documents):
    got = {r.doc_id: r for r in queries.op9_tokens(spark, sf_dir).collect()}
    library, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    assert len(got) == len(documents)
    for i, text in sorted(documents):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)


def test_op10(spark, sf_dir):
    order, sharpness = 4, 20.0
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()
    codes = {r.doc_id: "\0" * (order - 1) + folded(r.text) for r in docs}
    grams_of = lambda c: [c[i - order + 1 : i + 1] for i in range(order - 1, len(c))]
    counts = defaultdict(Counter)
    for r in docs:
        if r.lang is not None and r.text is not None and not held_out(r.doc_id):
            counts[r.lang].update(grams_of(codes[r.doc_id]))
    models = {k: continuations(c, order) for k, c in counts.items()}
    levels = [Counter({(k, g): c for k, m in models.items() for g, c in m[n].items()}) for n in range(order + 1)]
    d, chars = discounts(levels, order), len({g for _, g in levels[1]})
    ps = {k: interpolated(m, d, chars) for k, m in sorted(models.items())}
    got = {r.doc_id: r for r in queries.op10_language(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for r in docs:
        mine = got[r.doc_id]
        assert mine.held_out == held_out(r.doc_id)
        if not any(c.isalpha() for c in r.text or ""):
            assert (mine.lang_pred, mine.score) == ("und", 0.0)
            continue
        grams = grams_of(codes[r.doc_id])
        entropy = {k: -sum(math.log(p(g)) for g in grams) / len(grams) for k, p in ps.items()}
        best = min(entropy, key=lambda k: (entropy[k], k))
        weights = sum(math.exp(sharpness * (entropy[best] - e)) for e in entropy.values())
        assert mine.lang_pred == best and mine.score == pytest.approx(1 / weights, abs=1e-3)


def test_op5(spark, sf_dir, documents):
    """The class models are Kneser-Ney estimates that share their lower orders; the score follows from their ratios."""
    order = toxicity.ORDER
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy("doc_id").agg({"toxic": "max"}).withColumnRenamed("max(toxic)", "toxic").collect()}

    def words(text):
        """Per word its grams: each character after those back to the space before the word."""
        return [[(" " + w + " ")[max(0, k - order + 1) : k + 1].rjust(order, "\0") for k in range(1, len(w) + 2)] for w in folded(text).split()]

    known = [(t, labels[i]) for i, t in documents if t is not None and labels.get(i) in (0, 1) and not held_out(i)]
    counts = {0: Counter(), 1: Counter()}
    for text, kind in known:
        for w in words(text):
            counts[kind].update(w)
    pooled = continuations(counts[0] + counts[1], order)
    shared = interpolated(pooled, discounts(pooled, order), len(pooled[1]))
    total, kinds = ({c: Counter() for c in counts} for _ in range(2))
    for c, own in counts.items():
        for g, n in own.items():
            total[c][g[:-1]] += n
            kinds[c][g[:-1]] += 1

    @cache
    def p(c, gram):
        context, rest = gram[:-1], 0.75 * kinds[c][gram[:-1]] + toxicity.STRENGTH
        return (max(counts[c][gram] - 0.75, 0) + rest * shared(gram)) / (total[c][context] + toxicity.STRENGTH)

    contexts = {g[:-1] for g in pooled[order]}
    for context in sorted(contexts)[:: max(1, len(contexts) // 40)]:
        for c in counts:  # what the class has seen, and the shared mass of all the rest, sum to one
            seen = [g for g in pooled[order] if g[:-1] == context]
            rest = (0.75 * kinds[c][context] + toxicity.STRENGTH) / (total[c][context] + toxicity.STRENGTH)
            assert sum(p(c, g) for g in seen) + rest * (1 - sum(map(shared, seen))) == pytest.approx(1.0)

    def evidence(text):
        sums = [sum(math.log(p(1, g)) - math.log(p(0, g)) for g in w) for w in words(text)]
        return sum(max(s - toxicity.MARGIN, 0) for s in sums) / (len(sums) + toxicity.SHORT)

    def log_ratio(text):
        """Of the whole text's likelihoods, a character."""
        grams = [g for w in words(text) for g in w]
        return sum(math.log(p(1, g)) - math.log(p(0, g)) for g in grams) / max(1, len(grams))

    intercept, slope = toxicity.logistic(np.array([evidence(t) for t, _ in known]), np.array([k == 1 for _, k in known]))
    got = {r.doc_id: r for r in queries.op5_toxicity(spark, sf_dir).collect()}
    assert len(got) == len(documents)
    for i, text in documents:
        want = 1 / (1 + math.exp(-(intercept + slope * evidence(text))))
        assert got[i].held_out == held_out(i) and got[i].score == pytest.approx(want, abs=1e-5)
        assert got[i].predicted == int(got[i].score >= 0.3)
        assert got[i].log_ratio == pytest.approx(log_ratio(text), abs=1e-9)
