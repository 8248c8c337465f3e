"""SentencePiece encoding and decoding: the best segmentation under additive piece scores, by a max-plus scan.

A text is read with a space put in front and every space as U+2581. Its segmentation is the one of the highest total
score; among equals the one whose last piece is longest, then whose last but one is longest, and so on. Characters
without a piece, and U+2581 itself, are spelled by byte pieces, so decoding gives back every text exactly.

A long text is cut into chunks. At a cut, the state is how many characters the piece across it reaches into the next
chunk. Each chunk yields the matrix of its best scores from each state before to each state after it; matrices combine
associatively in the (max, +) algebra, a parallel prefix scan of them fixes the state at every cut, and every chunk
then picks its pieces on its own.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from punctual.llm.kneser_ney import unique_keys
from punctual.llm.text import list_array, mix, powers, range_hash, text_slices

SPACE = "▁"
#: Texts of more characters are cut into chunks of this many.
CHUNK = 16_384
#: Characters that a chunk sees of the next one; no piece is longer.
AHEAD = 64
CACHED_WORDS = 200_000
#: Words of up to so many characters are solved in step with others of their length.
IN_STEP = 40
#: Codes whose words are hashed at once.
HASHED = 1 << 15
NEVER = -(1 << 60)
UNIT = 1 << 20


class Pieces:
    """Vocabulary with integer scores: ln of a Zipf probability of the piece's rank, in units of 2**-20.

    The public file holds a merge vocabulary, whose scores are ranks. Ranks turn into the probability
    1 / (rank + 2), normalised over all pieces, since a max-plus scan needs scores that add up.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(size)]
        self.byte = {int(t[3:5], 16): i for i, t in enumerate(self.text) if model.is_byte(i)}
        self.value = {i: b for b, i in self.byte.items()}
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        ranks = sorted(plain, key=lambda i: (-model.get_score(i), i))
        total = math.log(sum(1 / (r + 2) for r in range(len(ranks))))
        self.score, self.id = {}, {}
        for rank, i in enumerate(ranks):
            if self.text[i] not in self.id and self.text[i]:
                self.id[self.text[i]] = i
                self.score[self.text[i]] = round((-math.log(rank + 2) - total) * UNIT)
        self.by_bytes = min(self.score.values()) - 10 * UNIT
        self.longest = max(map(len, self.score))
        if self.longest > AHEAD:
            raise ValueError(f"a piece has more than {AHEAD} characters")
        #: No piece reaches over a space that follows something else, so there a text falls apart.
        self.words_apart = not any(SPACE in t.lstrip(SPACE) for t in self.score)
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+") if self.words_apart else re.compile(r"(?s).+")
        texts = list(self.score)
        codes = [np.array([ord(c) + 1 for c in t], dtype=np.uint64) for t in texts]  # a zero would not show in a hash
        up, _ = powers(AHEAD)
        keys = np.array([int(mix(np.array([(mix(c) * up[: len(c)]).sum(dtype=np.uint64)]))[0]) for c in codes], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array([self.id[t] for t in texts], dtype=np.int32)[order]
        self.key_scores = np.array([self.score[t] for t in texts], dtype=np.int64)[order]
        self.forget()

    def cost(self, piece: str) -> int | None:
        """The score of a piece, or None; a character without one costs its bytes."""
        got = self.score.get(piece)
        if got is None and len(piece) == 1:
            return self.by_bytes * len(piece.encode("utf-8", "surrogatepass"))
        return got

    def ids(self, pieces: list[str]) -> bytes:
        out: list[int] = []
        for p in pieces:
            if p in self.id:
                out.append(self.id[p])
            else:
                # the second mark stands for a U+2581 of the text, which must not come back as a space
                out += [self.byte[b] for b in (SPACE if p == MARK else p).encode("utf-8", "surrogatepass")]
        return np.array(out, dtype="<i4").tobytes()

    def forward(self, text: str, start: int = 0) -> list[int]:
        """Best scores of text[start:t] for every t (NEVER before ``start``)."""
        best = [NEVER] * (len(text) + 1)
        best[start] = 0
        for end in range(start + 1, len(text) + 1):
            top = NEVER
            for begin in range(max(start, end - self.longest), end):
                value = self.cost(text[begin:end])
                if value is not None and best[begin] + value > top:
                    top = best[begin] + value
            best[end] = top
        return best

    def back(self, text: str, best: list[int], start: int, end: int) -> list[str]:
        """The pieces of the best path from start to end, the longest possible one first from the right."""
        out = []
        while end > start:
            for begin in range(max(start, end - self.longest), end):
                value = self.cost(text[begin:end])
                if value is not None and best[begin] > NEVER and best[begin] + value == best[end]:
                    out.append(text[begin:end])
                    end = begin
                    break
        return out[::-1]

    def path(self, text: str) -> tuple[int, list[str]]:
        best = self.forward(text)
        return best[-1], self.back(text, best, 0, len(text))

    # ---- many words at once ----

    def forget(self) -> None:
        #: Hashes of the words that are remembered, in order, and the places that their ids have.
        self.known, self.places = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.flat, self.starts, self.used = np.zeros(1 << 16, dtype="<i4"), np.zeros(1 << 16, dtype=np.int64), 0
        self.scores = np.zeros(1 << 16, dtype=np.int64)

    def _remember(self, hashes: np.ndarray, words: list[np.ndarray], scores: np.ndarray) -> None:
        n, sizes = len(self.known), np.array([len(w) for w in words], dtype=np.int64)
        ends = self.used + np.cumsum(sizes)
        while n + len(words) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        while ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.starts[n + 1 : n + 1 + len(words)] = ends
        self.scores[n : n + len(words)] = scores
        self.flat[self.used : ends[-1]] = np.concatenate(words)
        self.used = int(ends[-1])
        known, places = np.append(self.known, hashes), np.append(self.places, np.arange(n, n + len(words)))
        order = np.argsort(known, kind="stable")
        self.known, self.places = known[order], places[order]

    def _recall(self, hashes: np.ndarray) -> np.ndarray:
        """The places of words, -1 for those that are not remembered."""
        if not len(self.known):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.places[at], -1)

    def _solve(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids and score of the best path of every word (a range of codes); words of one length go in step."""
        ids: list = [None] * len(starts)
        scores, lengths = np.zeros(len(starts), dtype=np.int64), ends - starts
        for n in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == n)
            if n > IN_STEP:
                for k in rows.tolist():
                    word = codes[starts[k] : ends[k]].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
                    scores[k], pieces_of = self.path(word)
                    ids[k] = np.frombuffer(self.ids(pieces_of), dtype="<i4")
                continue
            place = starts[rows][:, None] + np.arange(n)
            scores[rows], back, piece = self._in_step(codes[place], n)
            at, all_rows = np.full(len(rows), n), np.arange(len(rows))
            found = []
            while True:
                live = np.flatnonzero(at > 0)
                if not len(live):
                    break
                step = back[at[live], live]
                found.append((live, at[live] - step, piece[at[live], live]))
                at[live] -= step
            row, start, of = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((start, row))
            row, start, of = row[order], start[order], of[order]
            spelled = np.flatnonzero(of < 0)
            count = np.ones(len(of), dtype=np.int64)
            chars = codes[starts[rows][row[spelled]] + start[spelled]]
            bytes_of = {c: [self.byte[x] for x in (SPACE if chr(c) == MARK else chr(c)).encode()] for c in np.unique(chars).tolist()}
            count[spelled] = [len(bytes_of[c]) for c in chars.tolist()]
            flat = np.repeat(of, count)
            if len(spelled):
                first = np.cumsum(count) - count
                flat[np.repeat(first[spelled] - (np.cumsum(count[spelled]) - count[spelled]), count[spelled]) + np.arange(count[spelled].sum())] = [b for c in chars.tolist() for b in bytes_of[c]]
            cuts = np.cumsum(np.bincount(row, weights=count, minlength=len(rows)).astype(np.int64))[:-1]
            for k, own in zip(rows[all_rows].tolist(), np.split(flat, cuts), strict=True):
                ids[k] = own
        return ids, scores

    def _in_step(self, codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best scores of words of n codes; per end and word the length and the id (-1: bytes) of the last piece."""
        up, down = powers(IN_STEP + 1)
        prefix = np.zeros((n + 1, len(codes)), dtype=np.uint64)
        np.cumsum(mix(codes.T.astype(np.uint64) + np.uint64(1)) * up[:n, None], axis=0, out=prefix[1:])
        wide = codes.T
        n_bytes = 1 + (wide >= 0x80).astype(np.int64) + (wide >= 0x800) + (wide >= 0x10000)
        best = np.full((n + 1, len(codes)), NEVER, dtype=np.int64)
        best[0] = 0
        back, piece = np.zeros((n + 1, len(codes)), dtype=np.int64), np.full((n + 1, len(codes)), -1, dtype=np.int32)
        for end in range(1, n + 1):
            for size in range(min(self.longest, end), 0, -1):
                begin = end - size
                wanted = mix((prefix[end] - prefix[begin]) * down[begin])
                at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
                known = self.keys[at] == wanted
                value = np.where(known, self.key_scores[at], self.by_bytes * n_bytes[begin] if size == 1 else NEVER)
                total = np.maximum(best[begin] + value, NEVER)
                better = total > best[end]
                best[end][better] = total[better]
                back[end][better] = size
                piece[end][better] = np.where(known, self.key_ids[at], -1)[better]
        return best[n], back, piece

    def encode_all(self, marked_texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts (already ``marked``, or parts that begin where no piece crosses) in a row; number and score per text."""
        lengths = np.array([len(t) for t in marked_texts], dtype=np.int64)
        codes = np.frombuffer("".join(marked_texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        first = np.zeros(len(codes), dtype=bool)
        if self.words_apart and len(codes):
            space = codes == ord(SPACE)
            first[1:] = space[1:] & ~space[:-1]
        first[offsets[:-1][lengths > 0]] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(codes))
        hashes = word_hashes(codes, starts, ends)
        inverse, kinds = unique_keys(hashes)
        if len(self.known) > CACHED_WORDS or self.used > 8 * CACHED_WORDS:
            self.forget()
        place = self._recall(hashes[kinds])
        new = np.flatnonzero(place < 0)
        if len(new):
            n = len(self.known)
            self._remember(hashes[kinds[new]], *self._solve(codes, starts[kinds[new]], ends[kinds[new]]))
            place[new] = np.arange(n, n + len(new))
        place = place[inverse]
        size, start = self.starts[place + 1] - self.starts[place], self.starts[place]
        total = np.cumsum(size)
        at = np.repeat(start - (total - size), size) + np.arange(total[-1] if len(total) else 0)
        row = np.searchsorted(offsets, starts, side="right") - 1
        count = np.bincount(row, weights=size, minlength=len(lengths)).astype(np.int64)
        scores = np.zeros(len(lengths), dtype=np.int64)
        np.add.at(scores, row, self.scores[place])
        return self.flat[at], count, scores

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers; none for null or empty."""
        return self.encode_all([marked(text)])[0].tobytes() if text else b""

    def decode_all(self, flat: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The texts that lists of ids spell, without the space that encoding puts in front."""
        if not hasattr(self, "spelling"):
            raw = [bytes([self.value[i]]) if i in self.value else t.replace(SPACE, " ").encode() for i, t in enumerate(self.text)]
            self.spelling = np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        letters, starts = self.spelling
        size = starts[flat + 1] - starts[flat]
        total = np.cumsum(size)
        data = letters[np.repeat(starts[flat] - (total - size), size) + np.arange(total[-1] if len(total) else 0)]
        ends = np.concatenate([[0], total])[np.cumsum(counts)]
        begins = np.concatenate([[0], ends[:-1]])
        keep = np.ones(len(data), dtype=bool)
        keep[begins[ends > begins]] = False
        left = np.concatenate([[0], np.cumsum(ends - begins - (ends > begins))])
        return pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(left.astype(np.int64).tobytes()), pa.py_buffer(data[keep].tobytes()))

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(np.array(ids, dtype=np.int64), np.array([len(ids)]))[0].as_py()

    # ---- chunks ----

    def middle(self, text: str, n: int) -> tuple[int, int] | None:
        """The first and the last place of a chunk that no piece crosses."""
        apart = [m.start() for m in self.words.finditer(text[:n]) if m.start()] if self.words_apart else []
        return (apart[0], apart[-1]) if apart else None

    def summaries(self, chunks: list[tuple[str, int, bool]]) -> list[dict]:
        """``summary`` of several chunks (text, n, last), the words between their cuts solved together."""
        cuts = [self.middle(text, n) for text, n, _ in chunks]
        flat, counts, scores = self.encode_all([t[c[0] : c[1]] if c else "" for (t, _, _), c in zip(chunks, cuts, strict=True)])
        ends = np.cumsum(counts)
        bodies = [(flat[e - c : e].tobytes(), int(x)) for e, c, x in zip(ends.tolist(), counts.tolist(), scores, strict=True)]
        return [self.summary(*c, cut, body) for c, cut, body in zip(chunks, cuts, bodies, strict=True)]

    def summary(self, text: str, n: int, last: bool, cut: tuple[int, int] | None, body: tuple[bytes, int]) -> dict:
        """What a chunk says about itself: text[:n] is the chunk, the rest what a piece across its end can reach.

        ``matrix``: best scores from state s to state e. If the chunk holds a place that no piece crosses: ``heads``
        (pieces from s to the first such place), ``body`` (ids between the first and last one) and ``tails`` (pieces
        from the last one to e). Else ``text``, since the pieces depend on both states at once.
        """
        states = self.longest
        matrix = np.full((states, states), NEVER, dtype=np.int64)
        if cut is None:
            for s in range(min(states, n + 1)):
                best = self.forward(text[:n], s)
                for e, (score, _) in self.exits(text, best, n, last).items():
                    matrix[s, e] = score
            return {"matrix": matrix, "heads": {}, "body": b"", "tails": {}, "text": text}
        first, final = cut
        head, heads = text[:first], {}
        scores = np.full(states, NEVER, dtype=np.int64)
        for s in range(min(states, first + 1)):
            best = self.forward(head, s)
            if best[-1] > NEVER:
                scores[s] = best[-1]
                heads[s] = self.back(head, best, s, first)
        tails, ends = {}, np.full(states, NEVER, dtype=np.int64)
        rest = text[final:]
        best = self.forward(rest[: n - final])
        for e, (score, begin) in self.exits(rest, best, n - final, last).items():
            ends[e] = score
            pieces = self.back(rest, best, 0, begin) + ([rest[begin : n - final + e]] if n - final + e > begin else [])
            tails[e] = pieces
        total = scores[:, None] + ends[None, :] + body[1]
        matrix = np.where((scores[:, None] > NEVER) & (ends[None, :] > NEVER), total, NEVER)
        return {"matrix": matrix, "heads": heads, "body": body[0], "tails": tails, "text": None}

    def exits(self, text: str, best: list[int], n: int, last: bool) -> dict[int, tuple[int, int]]:
        """State after the chunk: its best score and where the last piece begins (n for state 0)."""
        out = {0: (best[n], n)} if best[n] > NEVER else {}
        if last:
            return out
        for e in range(1, min(self.longest, len(text) - n + 1)):
            for begin in range(max(0, n + e - self.longest), n):
                value = self.cost(text[begin : n + e])
                if value is not None and best[begin] > NEVER and best[begin] + value > out.get(e, (NEVER, 0))[0]:
                    out[e] = best[begin] + value, begin
        return out

    def chosen(self, chunk: dict, before: np.ndarray, e: int) -> tuple[int, bytes]:
        """State before a chunk and the ids of its pieces, given best scores up to every state before and the state after."""
        total = np.where((before > NEVER) & (chunk["matrix"][:, e] > NEVER), before + chunk["matrix"][:, e], NEVER)
        options = np.flatnonzero(total == total.max()).tolist()
        found = []
        if chunk["text"] is None:
            found = [(s, chunk["heads"][s], chunk["body"], chunk["tails"][e]) for s in options]
        else:
            n = chunk["n"]
            for s in options:
                best = self.forward(chunk["text"][:n], s)
                begin = self.exits(chunk["text"], best, n, chunk["last"])[e][1]
                crossing = [chunk["text"][begin : n + e]] if n + e > begin else []
                found.append((s, self.back(chunk["text"], best, s, begin) + crossing, b"", []))
        # a path that leaves the chunk goes on with a piece longer than any inside it
        s, head, body, tail = max(found, key=lambda f: [*(len(p) for p in reversed(f[1])), 1 << 30])
        return s, self.ids(head) + body + self.ids(tail)


#: Stands for a U+2581 of the text: a code that no text holds, of as many bytes.
MARK = "\ud800"


def marked(text: str) -> str:
    return SPACE + text.replace(SPACE, MARK).replace(" ", SPACE)


def word_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of every word, which are ranges of codes that follow each other; a block of them takes the working memory."""
    out, low = np.zeros(len(starts), dtype=np.uint64), 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + HASHED, side="right")))
        block = codes[starts[low] : ends[high - 1]]
        up, _ = powers(len(block))
        prefix = np.zeros(len(block) + 1, dtype=np.uint64)
        np.cumsum(mix(block.astype(np.uint64) + np.uint64(1)) * up, out=prefix[1:])
        out[low:high] = range_hash(prefix, starts[low:high] - starts[low], ends[low:high] - starts[low])
        low = high
    return out + (ends - starts).astype(np.uint64)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def compose(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The (max, +) product of matrices; leading axes go together."""
    return np.maximum((a[..., :, :, None] + b[..., None, :, :]).max(axis=-2), NEVER)


def prefix_products(matrices: np.ndarray) -> np.ndarray:
    """All products of the first 1, 2, ... matrices, by doubling: as many steps as the logarithm of their number."""
    out, step = matrices.copy(), 1
    while step < len(out):
        for at in range(len(out) - 1, step - 1, -256):  # from the right, so that a step only reads what it had before
            low = max(step, at - 255)
            out[low : at + 1] = compose(out[low - step : at + 1 - step], out[low : at + 1])
        step *= 2
    return out


def encode(df: DataFrame, model_path: str, text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``df`` with ``ids`` (array<int>) and ``n_chunks``; every whole text, long ones cut and spread over the tasks.

    A null or empty text has no ids and no chunk. Other columns are kept, columns with the names of the results are
    replaced; repeated rows get equal results, an empty table an empty one. What one task holds of a document - its
    ids and a matrix per chunk - is of the size of the document's own row.
    """
    if chunk < AHEAD:
        raise ValueError(f"chunk must be at least {AHEAD}")
    plain = df.drop("ids", "n_chunks")
    kept = [c for c in plain.columns if c != text]
    row = F.struct(*(F.col(f"`{c}`") for c in kept)) if kept else F.lit(0)
    rows = plain.select(F.col(text).cast("string").alias("_text"), row.alias("_row"))
    long = F.coalesce(F.length("_text") > chunk, F.lit(False))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        for batch in batches:
            for start, end in text_slices(batch, "_text"):
                part = batch.slice(start, end - start)
                texts = part.column("_text").to_pylist()
                flat, counts, _ = model.encode_all([marked(t) if t else "" for t in texts])
                flat = list_array(counts, flat)
                yield pa.RecordBatch.from_arrays([part.column("_row"), part.column("_text"), flat, pa.array([int(bool(t)) for t in texts], pa.int32())], names=["_row", "_text", "ids", "n_chunks"])

    row_kind = StructField("_row", rows.schema["_row"].dataType, True)  # only the first chunk carries it
    done = StructType([row_kind, rows.schema["_text"], StructField("ids", ArrayType(IntegerType())), StructField("n_chunks", IntegerType())])
    short = rows.where(~long).mapInArrow(whole, done)

    # the key is the same whenever a task runs again on the same part of the input
    cuts = rows.where(long).withColumn("_key", F.monotonically_increasing_id())
    apart = StructType.fromDDL("_key long, chunk int, last boolean, here string, next string").add(row_kind)

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                one = batch.column("_text")[k].as_py()
                starts = range(0, len(one), chunk)
                for low in range(0, len(starts), 64):
                    some = starts[low : low + 64]
                    own = batch.column("_row").take(pa.array([k if x == 0 else None for x in some], pa.int32()))
                    columns = [
                        pa.array([batch.column("_key")[k].as_py()] * len(some), pa.int64()),
                        pa.array([x // chunk for x in some], pa.int32()),
                        pa.array([x + chunk >= len(one) for x in some]),
                        pa.array([one[x : x + chunk] for x in some]),
                        pa.array([one[x + chunk : x + chunk + AHEAD] for x in some]),
                        own,
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=apart.names)

    chunks = cuts.mapInArrow(cut_up, apart).repartition("_key", "chunk")

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        for batch in batches:
            for start, end in text_slices(batch, "here"):
                part = batch.slice(start, end - start)
                pieces_of, out = [], []
                for number, last, here, following in zip(*(part.column(c).to_pylist() for c in ("chunk", "last", "here", "next")), strict=True):
                    pieces_of.append((marked(here + following)[0 if number == 0 else 1 :], len(here) + (number == 0), last))
                for (_, n, last), got in zip(pieces_of, model.summaries(pieces_of), strict=True):
                    said = json.dumps({"n": n, "last": last, **{c: got[c] for c in ("heads", "tails", "text")}})
                    out.append((got["matrix"].tobytes(), got["body"], said))
                columns = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.binary(), pa.binary(), pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("_key", "chunk", "here", "_row")), *columns], names=told.names)

    told = StructType.fromDDL("_key long, chunk int, here string").add(row_kind)
    told = told.add("matrix", "binary").add("body", "binary").add("said", "string")
    summaries = chunks.mapInArrow(summarise, told)

    def join(table: pa.Table) -> pa.Table:
        model = pieces(model_path)
        parts = sorted(table.select([c for c in table.column_names if c != "_row"]).to_pylist(), key=lambda r: r["chunk"])
        side = model.longest
        for p in parts:
            p |= json.loads(p.pop("said"))
            p["matrix"] = np.frombuffer(p["matrix"], dtype=np.int64).reshape(side, side)
            p["heads"], p["tails"] = ({int(s): x for s, x in p[c].items()} for c in ("heads", "tails"))
        start = np.full((1, side, side), NEVER, dtype=np.int64)
        start[0, 0, 0] = 0
        scan = prefix_products(np.concatenate([start, np.stack([p["matrix"] for p in parts])]))
        state, ids = 0, []
        for k in range(len(parts) - 1, -1, -1):
            state, got = model.chosen(parts[k], scan[k][0], state)
            ids.append(got)
        own = table.column("_row").combine_chunks().filter(pa.compute.equal(table.column("chunk"), 0))
        flat = np.frombuffer(b"".join(ids[::-1]), dtype="<i4")
        columns = [own, pa.array(["".join(p["here"] for p in parts)]), list_array([len(flat)], flat), pa.array([len(parts)], pa.int32())]
        return pa.table(columns, names=["_row", "_text", "ids", "n_chunks"])

    joined = summaries.groupBy("_key").applyInArrow(join, done)
    both = short.unionByName(joined)
    columns = [F.col("_text").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in plain.columns]
    return both.select(*columns, "ids", "n_chunks")


def decode(df: DataFrame, model_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text that ``ids`` spell in the column ``out``; null ids give null, none the empty text."""

    @F.arrow_udf("string")
    def texts(lists: pa.Array) -> pa.Array:
        model, spelled = pieces(model_path), [pa.array([], pa.string())]
        for k in range(0, len(lists), 500):
            part = lists.slice(k, 500)
            counts = pa.compute.fill_null(pa.compute.list_value_length(part), 0).to_numpy().astype(np.int64)
            got = model.decode_all(part.flatten().to_numpy().astype(np.int64), counts).cast(pa.string())
            spelled.append(pa.compute.if_else(part.is_valid(), got, pa.scalar(None, pa.string())))
        return pa.concat_arrays(spelled)

    # only the ids go to the Python workers
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c != out), texts(F.col(f"`{ids}`")).alias(out))
