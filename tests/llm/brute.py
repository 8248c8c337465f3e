"""The same results by plain loops."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text: str | None) -> list[str]:
    return [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text)) if w]


def roots(ids, links) -> dict:
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def jaccard(rows, size: int, percent: int) -> dict:
    """{id: (set size, component)} for rows with different ids."""
    sets = {}
    for i, text in rows:
        w = [x for x in re.split("[\x20\x09-\x0d]+", lower(text)) if x]
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    where, links = defaultdict(list), []
    for i in sorted(sets):
        common = defaultdict(int)
        for s in sets[i]:
            for j in where[s]:
                common[j] += 1
            where[s].append(i)
        links += [(i, j) for j, c in common.items() if 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c)]
    root = roots(sets, links)
    return {i: (len(s), root[i]) for i, s in sets.items()}


def repeats(texts, length: int) -> list[tuple]:
    """(bytes, removed, spans, sha256 of the rest, rest) per text."""
    raw, count = [(t or "").encode() for t in texts], defaultdict(int)
    for b in raw:
        for p in range(len(b) - length + 1):
            count[b[p : p + length]] += 1
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if count[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        rest = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "ignore")))
    return out


def benchmark(docs, items, window: int = 10) -> list[tuple]:
    """(id, words, hit words, sorted item ids) per row, sorted."""
    windows = defaultdict(set)
    for i, text in items:
        w = words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows[tuple(w[k : k + window])].add(i)
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((i, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=str)


def vectors(rows, threshold: float = 0.98) -> dict:
    """{id: (links, component)} for rows (id, label, vector) with different ids."""
    def sound(label, v):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)

    unit = {i: np.array(v, dtype=float) / np.linalg.norm(np.array(v, dtype=float)) for i, label, v in rows if sound(label, v)}
    labels, links = {i: label for i, label, _ in rows}, []
    for a in unit:
        for b in unit:
            if a < b and labels[a] == labels[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links.append((a, b))
    root = roots(labels, links)
    return {i: (sum(i in x for x in links), root[i]) for i in labels}


def split(text: str | None) -> list[str]:
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def runs(w: list) -> list[tuple]:
    """(start, length, period) of all runs of four periods and six words, by start, then period."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            smaller = any(w[i : j + q - r] == w[i + r : j + q] for r in range(1, q)) if j + q - i >= 4 * q else True
            if j + q - i >= max(6, 4 * q) and not smaller:
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(text: str | None) -> tuple:
    """(words, runs, strongest run, the text without what repeats)."""
    w = split(text)
    found = runs(w)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else None
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return len(w), tuple(found), best, " ".join(x for k, x in enumerate(w) if k not in gone)


def aligned(rows, a_path: str, b_path: str) -> list[tuple]:
    """Whole texts by both libraries; token ends from decoded bytes alone."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in shown)}
    tokens, linked, holders = [], [], Counter()
    for _, text in rows:
        said, one, two = (" " + text).encode() if text else b"", [], []
        if text:
            ids = a.encode(" " + text, add_special_tokens=False).ids
            one = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in ids]
            two = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
        if any(b"".join(x for _, x in side) != said for side in (one, two)):
            one, two = [], []
        sides = [(side, np.cumsum([len(x) for _, x in side]).tolist()) for side in (one, two)]
        tokens.append(sides)
        at = 0
        links = []
        for (i, x), end in zip(one, sides[0][1], strict=True):
            while at and sides[1][1][at - 1] > end - len(x):
                at -= 1
            while at < len(two) and sides[1][1][at] <= end - len(x):
                at += 1
            while at < len(two) and sides[1][1][at] - len(two[at][1]) < end:
                links.append((i, two[at][0]))
                at += 1
        linked.append(links)
        holders.update(set(links))
    top = defaultdict(int)
    for (i, _), n in holders.items():
        top[i] = max(top[i], n)
    out = []
    for (doc_id, _), ((one, x), (two, y)), links in zip(rows, tokens, linked, strict=True):
        common, groups, i, j = sorted(set(x) & set(y)), [], 0, 0
        for end in common:
            k, m = x.index(end, i) + 1, y.index(end, j) + 1
            groups.append(",".join(str(t) for t, _ in one[i:k]) + "|" + ",".join(str(t) for t, _ in two[j:m]))
            i, j = k, m
        best = sum(holders[p] == top[p[0]] for p in links)
        out.append((doc_id, len(one), len(two), len(groups), len(links), best, sum(holders[p] for p in links), ";".join(groups)))
    return out
