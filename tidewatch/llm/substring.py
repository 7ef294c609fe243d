"""Removal of passages that occur more than once, with a count-min prefilter.

A window is 35 consecutive words. Windows are counted in a count-min sketch under their anchor,
the least hash among the window's runs of 8 words: equal windows have equal anchors, so a cell
never counts fewer than there are windows of one kind, and neighbouring windows mostly share one
anchor, so that a sketch sees a small part of the windows. Cells stop counting at two.

1. Every task fills a sketch of its own; sketches of tasks are merged block by block.
2. Documents with a window whose anchor is counted twice in every row of the sketch go on.
3. Just their windows under such anchors are grouped exactly. A window found once was overestimated
   and is sent back to its document; all the others repeat, and their words go.

The merged sketch has a size set by a parameter, whatever the input. Past that many anchors it tells
less and step 3 groups more windows; the result stays the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.words import Words, mix, runs, words
from tidewatch.sources.tables import stage

WINDOW = 35
ANCHOR = 8
# Rows of the sketch and bits of a cell's number in each: two bitmaps of 16 MB.
DEPTH, CELL_BITS = 2, 27
# Bits of a cell's number within a block, the part of a row that one task merges.
_BLOCK_BITS = 20


def _anchors(w: Words, size: int, short: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of every window and the window's anchor."""
    lengths = np.diff(w.rows)
    has = np.maximum(lengths - size + 1, 0)
    if not has.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = runs(w.hashes, short)
    reach = size - short + 1
    # Least of `reach` values from each place on, by doubling.
    span, least = 1, h
    while 2 * span <= reach:
        least = np.r_[np.minimum(least[:-span], least[span:]), least[len(least) - span :]]
        span *= 2
    if span < reach:
        move = reach - span
        least = np.r_[np.minimum(least[:-move], least[move:]), least[len(least) - move :]]
    starts = np.repeat(w.rows[:-1] - np.r_[0, np.cumsum(has)[:-1]], has) + np.arange(has.sum())
    return starts, least[starts]


def _cells(anchors: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix(anchors + np.uint64(row * 0x632BE59BD9B4E019 & (1 << 64) - 1)) >> np.uint64(64 - bits)).astype(np.int64)


def _anchor_places(w: Words, size: int, short: int) -> np.ndarray:
    """The anchor at every place that serves as one, however many windows it serves.

    A run is an anchor if it is the least of some window over it, that is, if it equals the
    greatest of those least values. Equal windows have their anchors at different places, so each
    of them is counted.
    """
    starts, anchors = _anchors(w, size, short)
    if not len(starts):
        return anchors
    reach = size - short + 1
    # Rows are set apart so that no window of one reaches into the next.
    place = np.arange(len(w.hashes)) + np.repeat(np.arange(len(w)), np.diff(w.rows)) * reach
    most = np.zeros(len(w.hashes) + len(w) * reach, np.uint64)
    most[place[starts]] = anchors
    span = 1
    while span < reach:
        move = min(span, reach - span)
        most[move:] = np.maximum(most[move:], most[:-move])
        span += move
    most, h = most[place], runs(w.hashes, short)
    return h[(h == most) & (most > 0)]


def sketch(texts: DataFrame, size: int = WINDOW, short: int = ANCHOR, bits: int = CELL_BITS, depth: int = DEPTH) -> list[np.ndarray]:
    """Bitmaps, one per row of the sketch, of the cells that count two or more."""
    block_bits = min(_BLOCK_BITS, bits)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = [[] for _ in range(depth)]
        held = 0

        def give() -> Iterator[pa.RecordBatch]:
            for row in range(depth):
                cells, times = np.unique(np.concatenate(parts[row]), return_counts=True)
                cut = np.searchsorted(cells >> block_bits, np.arange((1 << bits - block_bits) + 1))
                for block in np.flatnonzero(np.diff(cut)):
                    a, b = cut[block], cut[block + 1]
                    inside = (cells[a:b] & ((1 << block_bits) - 1)).astype("<u4")
                    yield pa.record_batch(
                        [pa.array([row * (1 << bits - block_bits) + block], pa.int64()),
                         pa.array([inside.tobytes()], pa.binary()),
                         pa.array([np.packbits(times[a:b] > 1).tobytes()], pa.binary())],
                        names=["block", "cells", "twice"],
                    )

        for batch in batches:
            for w in words(batch.column("text")):
                seen = _anchor_places(w, size, short)
                held += len(seen)
                for row in range(depth):
                    parts[row].append(_cells(seen, row, bits))
            if held > 1 << 21:  # a sketch is given up in parts, so that a task's memory is bounded
                yield from give()
                parts, held = [[] for _ in range(depth)], 0
        if held:
            yield from give()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, count = None, None

        def close() -> pa.RecordBatch:
            return pa.record_batch([pa.array([block], pa.int64()), pa.array([np.packbits(count > 1).tobytes()], pa.binary())], names=["block", "bits"])

        for batch in batches:
            for k, cells, twice in zip(*(batch.column(c).to_pylist() for c in ("block", "cells", "twice"))):
                if k != block:
                    if block is not None:
                        yield close()
                    block, count = k, np.zeros(1 << block_bits, np.uint8)
                cells = np.frombuffer(cells, "<u4")
                more = 1 + np.unpackbits(np.frombuffer(twice, np.uint8), count=len(cells))
                count[cells] = np.minimum(count[cells] + more, 2)
        if block is not None:
            yield close()

    filled = texts.mapInArrow(fill, "block long, cells binary, twice binary")
    merged = filled.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block long, bits binary")
    maps = [np.zeros(1 << bits - 3, np.uint8) for _ in range(depth)]
    width = 1 << block_bits - 3
    # At most depth * 2 ** bits bits, block by block.
    for k, found in merged.collect():
        row, block = divmod(k, 1 << bits - block_bits)
        maps[row][block * width : (block + 1) * width] = np.frombuffer(found, np.uint8)
    return maps


def _suspects(w: Words, maps: list[np.ndarray], size: int, short: int, bits: int) -> np.ndarray:
    """First words of windows whose anchor may occur more than once."""
    starts, anchors = _anchors(w, size, short)
    for row, bitmap in enumerate(maps):
        cell = _cells(anchors, row, bits)
        ok = (bitmap[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
        starts, anchors = starts[ok], anchors[ok]
    return starts


def remove_repeats(
    docs: DataFrame,
    size: int = WINDOW,
    short: int = ANCHOR,
    bits: int = CELL_BITS,
    depth: int = DEPTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = False,
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept_text]), one row per row of ``docs``.

    A word goes if a window over it occurs at any other place of the table, the same document
    included. Kept words are joined by one space. Null and empty texts have no words. Rows that
    repeat an id are separate documents, and repeat each other's windows if their texts are equal.
    Texts of fewer than ``size`` words are kept whole. An empty table gives an empty table; other
    columns are ignored.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(sketch(texts.select("text"), size, short, bits, depth))
    out = ["n_words", "n_removed", "kept_sha256", "kept_text"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]

    def result(w: Words, row: int, gone: np.ndarray) -> tuple:
        a, b = w.rows[row], w.rows[row + 1]
        found = w.data[w.starts[a] : w.ends[b - 1]].tobytes().split() if b > a else []
        text = b" ".join(compress(found, ~gone))
        return int(b - a), int(gone.sum()), hashlib.sha256(text).hexdigest(), text.decode() if with_text else None

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, open_ = [], []
            for w in words(batch.column("text")):
                some = np.diff(np.searchsorted(_suspects(w, shared.value, size, short, bits), w.rows)) > 0
                for row in range(len(w)):
                    open_.append(bool(some[row]))
                    if some[row]:
                        done.append((None,) * 4)
                    else:
                        done.append(result(w, row, np.zeros(w.rows[row + 1] - w.rows[row], bool)))
            text = pa.array([t if o else None for t, o in zip(batch.column("text").to_pylist(), open_)], pa.string())
            results = [pa.array([r[i] for r in done], k) for i, k in enumerate(kinds)]
            yield pa.record_batch([batch.column("doc_id"), text, *results], names=["doc_id", "text", *out])

    id_type = texts.schema["doc_id"].dataType.simpleString()
    found = "n_words long, n_removed long, kept_sha256 string, kept_text string"
    looked = texts.mapInArrow(first, f"doc_id {id_type}, text string, {found}")
    looked = stage(looked.withColumn("place", F.monotonically_increasing_id()), "repeat-texts")
    suspects = looked.where("text is not null").select("place", "text")

    def list_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("place").to_numpy()
            for w in words(batch.column("text")):
                starts = _suspects(w, shared.value, size, short, bits)
                row = np.searchsorted(w.rows, starts, "right") - 1
                hashed = runs(w.hashes, size)
                # Two hashes of 64 bits: the window's words, and the same words mixed once more.
                again = runs(mix(w.hashes ^ np.uint64(0x2545F4914F6CDD1D)), size)
                yield pa.record_batch(
                    [pa.array(hashed[starts].view(np.int64)), pa.array(again[starts].view(np.int64)),
                     pa.array(places[w.first + row]), pa.array((starts - w.rows[row]).astype(np.int32))],
                    names=["h", "g", "place", "start"],
                )

    listed = suspects.mapInArrow(list_windows, "h long, g long, place long, start int")
    # A window found once has one place, which is then the least of its places.
    once = (
        listed.groupBy("h", "g")
        .agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("place"), F.min("start").alias("start"))
        .where("n = 1")
    )
    spared = once.groupBy("place").agg(F.collect_list("start").alias("spared"))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, done = batch.column("spared").to_pylist(), []
            for w in words(batch.column("text")):
                starts = _suspects(w, shared.value, size, short, bits)
                bounds = np.searchsorted(starts, w.rows)
                for row in range(len(w)):
                    a, b = w.rows[row], w.rows[row + 1]
                    step = np.zeros(b - a + 1, np.int64)
                    mine = starts[bounds[row] : bounds[row + 1]] - a
                    if lists[w.first + row]:
                        mine = np.setdiff1d(mine, np.array(lists[w.first + row]))
                    step[mine] += 1
                    step[mine + size] -= 1
                    done.append(result(w, row, np.cumsum(step)[:-1] > 0))
            results = [pa.array([r[i] for r in done], k) for i, k in enumerate(kinds)]
            yield pa.record_batch([batch.column("doc_id"), *results], names=["doc_id", *out])

    open_ = looked.where("text is not null").select("doc_id", "place", "text").join(spared, "place", "left")
    finished = open_.select("doc_id", "text", "spared").mapInArrow(second, f"doc_id {id_type}, {found}")
    both = looked.where("text is null").select("doc_id", *out).unionByName(finished)
    return both.select("doc_id", *out[: 4 if with_text else 3])
