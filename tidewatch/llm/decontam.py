"""Benchmark passages in documents, by the q-gram lemma.

Two texts of length L within e edits share at least L - q + 1 - q * e of their q-grams, all on
diagonals (place in the document less place in the item) that differ by e at most. So the shared
q-grams of a document and an item are counted in bands of diagonals that overlap by half; a stretch
of the item whose count meets the bound is retained, and a banded alignment decides.

A document holds an item if any stretch of SPAN characters of the item, or the whole item if that
is shorter, is found in it within an edit for every RATE characters. Where q-grams of 12 would leave a
bound below one, an item's are shorter; items below EDITED characters must be found exactly, as words.

Only an item's distinct stretches are looked for, in pieces of a bounded length, and a document's
shared q-grams are listed a bounded number at a time: text that repeats itself takes no more memory.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.words import CHUNK_BYTES, runs, text_bytes

Q = 12
SPAN, RATE = 80, 16
# Normalised characters from which an item may be edited, and below which it cannot be told from chance.
EDITED, LEAST = 24, 12
# Characters of a piece of an item, and places of shared q-grams that are listed at once.
PIECE, LISTED = 1024, 1 << 19
# Characters of benchmark items that are broadcast at once; a larger benchmark takes more passes.
ITEM_CHARS = 4_000_000
_FILTER_BITS = 22

# Letters and digits in lower case, all else a space; bytes of longer UTF-8 characters stay.
_FORM = np.full(256, 32, np.uint8)
_FORM[48:58], _FORM[65:91], _FORM[97:123], _FORM[128:] = range(48, 58), range(97, 123), range(97, 123), range(128, 256)


def normal_form(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised bytes, their row offsets, and the place in ``data`` that each came from."""
    z = _FORM[data]
    space = z == 32
    again = np.zeros(len(z), bool)
    again[1:] = space[1:] & space[:-1]
    again[offsets[:-1][offsets[:-1] < len(z)]] = False
    place = np.flatnonzero(~again)
    return z[place], np.searchsorted(place, offsets), place


def budget(length: int) -> tuple[int, int, int]:
    """(span, edits, q-grams in common at least) for an item of a normalised length."""
    span = min(length, SPAN)
    edits = span // RATE if length >= EDITED else 0
    q = gram(span, edits)
    return span, edits, span - q + 1 - q * edits


def gram(span: int, edits: int) -> int:
    """The q up to Q that leaves a bound of one or more."""
    return min(Q, span // (edits + 1))


def pieces(z: np.ndarray, span: int) -> list[np.ndarray]:
    """Parts of an item that hold each of its distinct stretches of ``span`` characters."""
    if len(z) <= span:
        return [z]
    h = runs(z.astype(np.uint64) + np.uint64(1), span)[: len(z) - span + 1]
    begin = np.sort(np.unique(h, return_index=True)[1])
    cut = np.flatnonzero(np.diff(begin) > 1) + 1
    step = PIECE - span + 1
    return [
        z[at : min(at + PIECE, part[-1] + span)]
        for part in np.split(begin, cut)
        for at in range(int(part[0]), int(part[-1]) + 1, step)
    ]


class _Grams:
    """Places of all q-grams of some pieces."""

    def __init__(self, q: int, held: list[tuple[int, np.ndarray]]):
        self.q = q
        codes = [runs(z.astype(np.uint64) + np.uint64(1), q)[: len(z) - q + 1] for _, z in held]
        owner = np.concatenate([np.full(len(c), k) for c, (k, _) in zip(codes, held)])
        place = np.concatenate([np.arange(len(c)) for c in codes])
        codes = np.concatenate(codes)
        order = np.argsort(codes, kind="stable")
        self.codes, first = np.unique(codes[order], return_index=True)
        self.first = np.r_[first, len(order)]
        self.owner, self.place = owner[order], place[order]
        self.reach = max(len(z) for _, z in held)
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        self.seen[self._cell(codes)] = True

    @staticmethod
    def _cell(codes: np.ndarray) -> np.ndarray:
        return (codes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def hits(self, z: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in ``z`` of q-grams that pieces have too, their rows, and which they are."""
        h = runs(z.astype(np.uint64) + np.uint64(1), self.q)
        hit = np.flatnonzero(self.seen[self._cell(h)]) if len(h) else np.zeros(0, np.int64)
        row = np.searchsorted(starts, hit, "right") - 1
        inside = hit + self.q <= starts[row + 1]
        hit, row = hit[inside], row[inside]
        at = np.searchsorted(self.codes, h[hit])
        exact = self.codes[np.minimum(at, len(self.codes) - 1)] == h[hit]
        return hit[exact], row[exact], at[exact]

    def windows(self, hit: np.ndarray, at: np.ndarray, overlap: int) -> Iterator[tuple[int, int, float, float]]:
        """Runs of hits of a bounded number of places, so long that any band lies in one of them whole.

        First and end of a run, and the hits just outside of it.
        """
        total = np.cumsum(self.first[at + 1] - self.first[at])
        i, n = 0, len(hit)
        while i < n:
            before = total[i - 1] if i else 0
            j = max(int(np.searchsorted(total, before + LISTED, "right")), int(np.searchsorted(hit, hit[i] + 2 * overlap, "right")))
            yield i, min(j, n), float(hit[i - 1]) if i else -np.inf, float(hit[j]) if j < n else np.inf
            if j >= n:
                return
            i = max(i + 1, int(np.searchsorted(hit, hit[j - 1] - overlap)))


class Finder:
    """Q-grams of some benchmark items, and the search for them in texts."""

    def __init__(self, items: list[tuple[int, str]], least: int = LEAST):
        self.ids, self.pieces, self.length = [], [], []
        by_gram: dict[int, list[tuple[int, np.ndarray]]] = defaultdict(list)
        for ident, text in items:
            raw = np.frombuffer((text or "").encode(), np.uint8)
            z = normal_form(raw, np.array([0, len(raw)]))[0] if len(raw) else raw
            z = np.frombuffer(z.tobytes().strip(), np.uint8)
            if len(z) < max(least, 1):
                continue
            span, edits, _ = budget(len(z))
            for piece in pieces(z, span):
                by_gram[gram(span, edits)].append((len(self.pieces), piece))
                self.pieces.append(piece)
                self.ids.append(ident)
                self.length.append(len(z))
        self.grams = [_Grams(q, held) for q, held in sorted(by_gram.items())]
        self.need = np.array([budget(n)[2] for n in self.length], np.int64)
        self.size = np.array([len(z) for z in self.pieces], np.int64)

    def find(self, column: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item id, edits, start, end): code points of the shared stretch, per row and item."""
        data, offsets = text_bytes(column)
        at, n = 0, len(offsets) - 1
        while at < n and self.ids:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
            if offsets[to] > offsets[at]:
                yield from self._find(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
            at = to

    def _find(self, first: int, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        z, starts, place = normal_form(data, offsets)
        step = SPAN // RATE + 1
        best: dict[tuple[int, int], tuple] = {}
        for grams in self.grams:
            hit, row, at = grams.hits(z, starts)
            for i, j, *outside in grams.windows(hit, at, grams.reach + 2 * step):
                self._window(grams, z, starts, hit[i:j], row[i:j], at[i:j], step, outside, best)
        for (r, ident), (edits, _, lo, hi) in sorted(best.items()):
            origin = data[offsets[r] : offsets[r + 1]]
            points = np.cumsum((origin & 0xC0) != 0x80)
            start, end = (int(place[p] - offsets[r]) for p in (lo, hi - 1))
            yield first + r, ident, edits, int(points[start]) - 1, int(points[end])

    def _window(
        self, grams: _Grams, z: np.ndarray, starts: np.ndarray, hit: np.ndarray, row: np.ndarray, at: np.ndarray, step: int, outside: list[float], best: dict
    ) -> None:
        """Puts into ``best`` what the bands hold that lie among some hits whole.

        Of the bands that hold an item, the one that shares most q-grams with it counts, then the first.
        """
        times = grams.first[at + 1] - grams.first[at]
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        source = np.repeat(grams.first[at], times) + nth
        hit, row = np.repeat(hit, times), np.repeat(row, times)
        item, ipos = grams.owner[source], grams.place[source]
        band = (hit - starts[row] - ipos) // step
        # Bands of two steps, one step apart: every shared q-gram lies in two of them.
        row, item, hit, ipos = (np.r_[x, x] for x in (row, item, hit, ipos))
        band = np.r_[band, band - 1]
        order = np.lexsort((ipos, band, item, row))
        row, item, band, hit, ipos = (x[order] for x in (row, item, band, hit, ipos))
        changes = np.r_[True, (np.diff(row) != 0) | (np.diff(item) != 0) | (np.diff(band) != 0)]
        new = np.flatnonzero(changes)
        ends = np.r_[new[1:], len(row)]
        # A place of the item counts once, however often the band's part of the text repeats it.
        shared = np.add.reduceat(changes | np.r_[True, np.diff(ipos) != 0], new)
        low = starts[row[new]] + band[new] * step
        whole = (low > outside[0]) & (low + 2 * step + self.size[item[new]] <= outside[1])
        enough = np.flatnonzero(whole & (shared >= self.need[item[new]]))
        for k in enough[np.argsort(-shared[enough], kind="stable")]:
            a, b, count = new[k], ends[k], int(shared[k])
            r, i = int(row[a]), int(item[a])
            key = (r, self.ids[i])
            if key in best and count <= best[key][1]:
                continue
            edits = self._retained(i, ipos[a:b], z[starts[r] : starts[r + 1]], int(band[a]) * step, 2 * step, grams.q)
            if edits is not None:
                best[key] = (edits, count, int(hit[a:b].min()), int(hit[a:b].max()) + grams.q)

    def _retained(self, i: int, ipos: np.ndarray, text: np.ndarray, low: int, width: int, q: int) -> int | None:
        """Fewest edits of a stretch of piece i that meets the bound, or None if beyond the budget."""
        pattern = self.pieces[i]
        span, edits, need = budget(self.length[i])
        if self.length[i] < EDITED:
            begin, end = max(low - 1, 0), low + width + len(pattern) + 1
            around = (b" " if begin == 0 else b"") + text[begin:end].tobytes() + (b" " if end >= len(text) else b"")
            return 0 if b" " + pattern.tobytes() + b" " in around else None
        ipos = np.unique(ipos)
        begin = np.arange(len(pattern) - span + 1)
        count = np.searchsorted(ipos, begin + span - q, "right") - np.searchsorted(ipos, begin)
        begin = begin[count >= need]
        if not len(begin):
            return None
        if count.max() == span - q + 1:
            # All q-grams of a stretch in one band: mostly an exact copy, seen at the first try.
            begin = np.r_[begin[np.argmax(count[count >= need])], begin]
        fewest = edits + 1
        for part in ([begin[:1]] if len(begin) > 1 else []) + [begin]:
            fewest = min(fewest, int(_aligned(pattern, part, span, text, low - edits, width + 2 * edits)))
            if fewest == 0:
                break
        return fewest if fewest <= edits else None


def _aligned(pattern: np.ndarray, begin: np.ndarray, span: int, text: np.ndarray, low: int, width: int) -> int:
    """Least edit distance of any stretch ``pattern[b : b + span]`` to a part of ``text`` in a band.

    All stretches at once, one character a step, over ``width`` diagonals from ``low``.
    """
    diagonals = low + np.arange(width)
    offset = np.arange(width)
    cost = np.zeros((len(begin), width), np.int64)
    for i in range(span):
        at = begin[:, None] + i + diagonals
        same = (at >= 0) & (at < len(text)) & (text[np.clip(at, 0, len(text) - 1)] == pattern[begin + i][:, None])
        step = cost + ~same
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(step - offset, axis=1) + offset
    return cost.min()


def finders(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Finder]:
    """The benchmark in blocks of a bounded size."""
    held, size = [], 0
    for ident, text in benchmark.select(id_col, text_col).toLocalIterator():
        held.append((ident, text))
        size += len(text or "")
        if size > ITEM_CHARS:
            yield Finder(held)
            held, size = [], 0
    if held:
        yield Finder(held)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, edits, start, end) of each document and item it holds; clean ones give no row.

    ``edits`` are those of the part of the text that shares most q-grams with the item, ``start`` and
    ``end`` its code points. Case, punctuation and the width of white space make no difference. Null and
    empty texts and items hold nothing; items of fewer than LEAST normalised characters are never found,
    those of fewer than EDITED only as whole words without an edit. Rows that repeat an id give rows of
    their own, an item counts once per row. Without documents or items the result is empty.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id long, edits int, start int, end int"
    result = docs.sparkSession.createDataFrame([], schema)
    for finder in finders(items):
        shared = docs.sparkSession.sparkContext.broadcast(finder)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = list(zip(*shared.value.find(batch.column("text"))))
                if found:
                    row, item, edits, start, end = found
                    columns = [batch.column("doc_id").take(pa.array(row)), pa.array(item, pa.int64()), *(pa.array(x, pa.int32()) for x in (edits, start, end))]
                    yield pa.record_batch(columns, names=["doc_id", "item_id", "edits", "start", "end"])

        result = result.unionByName(texts.mapInArrow(run, schema))
    return result


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    for finder in finders(items):
        shared = docs.sparkSession.sparkContext.broadcast(finder)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[r for r, *_ in shared.value.find(batch.column(text_col).cast(pa.string()))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
