"""Collocations of two to five words, mined set by set (SETM) from sorted occurrence relations.

The relation R(k) holds the occurrences of frequent phrases of k words, sorted by text, piece and
position. A row holds the occurrences of one text as stretches: a stretch lists the words from one
position on as long as a frequent phrase of k words begins at each next position, so occurrences that
are adjacent in a piece lie side by side, and a gap begins a new stretch. One step

1. merge-joins R(k) with itself by piece and adjacent position: both sides are in one order, so each
   occurrence meets the one at the next position, and every pair is a phrase of k + 1 words;
2. counts groups of equal phrases, added up by each task first;
3. keeps, by a semi-join with the frequent groups, the occurrences of frequent phrases as R(k + 1),
   which is written before the next length is tried.

Groups are told apart by 40-bit hashes first, and the semi-join asks a Bloom filter of the frequent
ones, whose size is a parameter. Both can only let more occurrences pass. What passes is counted once
more by its words, so the counts are exact; single words are counted if a frequent pair holds them, as
only parts of phrases are asked for. No occurrence is shuffled, only counts are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.llm.words import CHUNK_BYTES, mix, runs, text_bytes
from tidewatch.llm.words import _words as words_of
from tidewatch.sources.tables import stage, unstage

LEAST = 100
LONGEST = 5
TOP = 2000
# Percent of a candidate's occurrences that lie inside one longer candidate if it says no more.
WITHIN = 100
# Bits of the filter's cell numbers (a bitmap of 16 MB) and cells per phrase.
FILTER_BITS, FILTER_CELLS = 27, 3
# Occurrences, and distinct phrases, that a task holds before it hands on their counts.
_HELD, _DISTINCT = 1 << 20, 1 << 18
# Files of a relation that one task counts together: most of a task's phrases are those of the others too.
_COUNTED_AT_ONCE = 4
# Bits of a group's hash that are left out: what is shuffled most are hashes, which do not compress.
_LEFT_OUT = np.uint64(24)
_BLOCK_BITS = 20
UNKNOWN = "und"

# Bytes that end a piece: . , ; : ! ? and \x0A-\x0D.
_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
# For the words' sake all of them count as white space.
_FORM = np.arange(256, dtype=np.uint8)
_FORM[_ENDS] = 0x0A
_FORM[65:91] += 32


class Stretches:
    """Words of some rows, their hashes, and whether the next word is adjacent."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.w = w = words_of(first, data, offsets, False)
        self.rows = np.repeat(np.arange(len(w)), np.diff(w.rows))
        pieces = np.cumsum(data == 0x0A)[w.starts] if len(w.starts) else np.zeros(0, np.int64)
        self.next = np.zeros(len(w.starts), bool)
        self.next[:-1] = (self.rows[1:] == self.rows[:-1]) & (pieces[1:] == pieces[:-1])

    def phrases(self, k: int) -> np.ndarray:
        """Places of words from which k words lie in one stretch: the merge-join of k - 1 adjacent pairs."""
        ok = np.ones(len(self.next), bool)
        for n in range(1, k):
            ok[: len(ok) - n + 1] &= self.next[n - 1 :]
            ok[len(ok) - n + 1 :] = False
        return np.flatnonzero(ok)


def _parts(column: pa.Array, raw: bool) -> Iterator[Stretches]:
    data, offsets = text_bytes(column)
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        part = data[offsets[at] : offsets[to]]
        yield Stretches(at, _FORM[part] if raw else part, offsets[at : to + 1] - offsets[at])
        at = to


def _hashes(s: Stretches, langs: np.ndarray, k: int, at: np.ndarray) -> np.ndarray:
    """Hash of the language and the k words from each place in ``at``."""
    if not len(at):
        return np.zeros(0, np.uint64)
    return mix(runs(s.w.hashes, k)[at] + langs[s.w.first + s.rows[at]])


def _lang_hashes(column: pa.Array) -> np.ndarray:
    """One hash per row's language, the same wherever the language is met."""
    known = column.dictionary_encode()
    names = known.dictionary.to_pylist()
    data, offsets = text_bytes(pa.array([f"{n}\n" for n in names], pa.string()))
    hashed = [mix(runs(data[a:b].astype(np.uint64) + np.uint64(1), b - a)[:1])[0] for a, b in zip(offsets[:-1], offsets[1:])]
    return np.array(hashed, np.uint64)[known.indices.to_numpy()] if names else np.zeros(0, np.uint64)


def _texts_of(s: Stretches, at: np.ndarray, k: int) -> list[bytes]:
    """The k words from each place on; those of a stretch are one space apart."""
    raw = s.w.data.tobytes()
    return [raw[a:b] for a, b in zip(s.w.starts[at].tolist(), s.w.ends[at + k - 1].tolist())]


def _written(s: Stretches, at: np.ndarray, k: int) -> pa.Array:
    """The relation's rows from the ascending places of their occurrences."""
    n = len(s.w)
    if not len(at):
        return pa.array([""] * n, pa.string())
    begins = np.r_[True, (np.diff(at) != 1) | ~s.next[at[:-1]]]
    first, last = at[begins], at[np.r_[np.flatnonzero(begins)[1:] - 1, len(at) - 1]] + k
    size = last - first
    word = np.repeat(first - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
    # Every word with one byte behind it, which becomes a space or the stretch's end.
    length = s.w.ends[word] - s.w.starts[word] + 1
    stop = np.cumsum(length)
    place = np.repeat(s.w.starts[word] - (stop - length), length) + np.arange(stop[-1])
    out = s.w.data[np.minimum(place, len(s.w.data) - 1)]
    out[stop - 1] = 0x20
    out[stop[np.cumsum(size) - 1] - 1] = 0x0A
    ends = np.r_[0, stop][np.searchsorted(s.rows[word], np.arange(n + 1))]
    return pa.StringArray.from_buffers(n, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(out.tobytes()))


def count_hashes(relation: DataFrame, k: int, least: int) -> DataFrame:
    """(h): hashes of phrases of k words with ``least`` occurrences or more in R(k - 1)."""
    counted = relation.select("lang", "text").mapInArrow(_hash_counter(k, False), "h long, n long")
    return counted.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("h")


def count_words(texts: DataFrame, least: int) -> DataFrame:
    """(lang, h, n) of raw texts: frequent hashes of words, lang being null, and words per lang, h being null."""
    counted = texts.select("lang", "text").mapInArrow(_hash_counter(1, True), "lang string, h long, n long")
    return counted.groupBy("lang", "h").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | F.col("h").isNull())


def _hash_counter(k: int, raw: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []
        held = 0

        def give() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(parts), return_counts=True)
            columns = {"h": pa.array(h.view(np.int64)), "n": pa.array(n, pa.int64())}
            return pa.RecordBatch.from_pydict(({"lang": pa.nulls(len(h), pa.string())} if raw else {}) | columns)

        for batch in batches:
            langs = _lang_hashes(batch.column("lang"))
            words = np.zeros(batch.num_rows, np.int64)
            for s in _parts(batch.column("text"), raw):
                parts.append(_hashes(s, langs, k, s.phrases(k)) >> _LEFT_OUT)
                held += len(parts[-1])
                words[s.w.first : s.w.first + len(s.w)] = np.diff(s.w.rows)
                if held > _HELD:
                    yield give()
                    parts, held = [], 0
            if raw and batch.num_rows:
                sums = pa.table([batch.column("lang"), pa.array(words)], names=["lang", "n"]).group_by("lang").aggregate([("n", "sum")])
                sums = sums.combine_chunks().to_batches()[0]
                yield pa.record_batch([sums.column("lang"), pa.nulls(len(sums), pa.int64()), sums.column("n_sum")], names=["lang", "h", "n"])
        if held:
            yield give()

    return run


def count_phrases(relation: DataFrame, k: int, least: int, among: Broadcast | None = None, bits: int = FILTER_BITS) -> DataFrame:
    """(lang, phrase, n): exact counts of phrases of k words in R(k), ``least`` or more.

    With ``among``, a Bloom filter, of those only that it holds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def give() -> pa.RecordBatch:
            texts = pa.array([t for _, t in counts], pa.binary()).cast(pa.string())
            return pa.record_batch([pa.array([x for x, _ in counts], pa.string()), texts, pa.array(counts.values(), pa.int64())], names=["lang", "phrase", "n"])

        for batch in batches:
            langs, names = _lang_hashes(batch.column("lang")), batch.column("lang").to_pylist()
            for s in _parts(batch.column("text"), False):
                at = s.phrases(k)
                h = _hashes(s, langs, k, at)
                if among is not None:
                    ok = _holds(among.value, h >> _LEFT_OUT, bits)
                    at, h = at[ok], h[ok]
                _, first, which, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
                texts, rows = _texts_of(s, at, k), (s.w.first + s.rows[at]).tolist()
                if all(t == texts[i] for t, i in zip(texts, first[which].tolist())):
                    for i, c in zip(first.tolist(), n.tolist()):
                        counts[names[rows[i]], texts[i]] += c
                else:  # two phrases of one hash: every occurrence is counted by its words
                    counts.update((names[r], t) for r, t in zip(rows, texts))
                if len(counts) > _DISTINCT:
                    yield give()
                    counts.clear()
        if counts:
            yield give()

    parts = max(len(relation.inputFiles()) // _COUNTED_AT_ONCE, 1)
    counted = relation.coalesce(parts).mapInArrow(run, "lang string, phrase string, n long")
    return counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def bloom(hashes: DataFrame, bits: int = FILTER_BITS, cells: int = FILTER_CELLS) -> np.ndarray:
    """A bitmap of ``2 ** bits`` bits that holds every hash; built in blocks by tasks."""
    block_bits = min(_BLOCK_BITS, bits)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("h").to_numpy().view(np.uint64)
            cell = np.concatenate([_cell(h, row, bits) for row in range(cells)])
            yield pa.record_batch([pa.array(cell >> block_bits), pa.array(cell & ((1 << block_bits) - 1))], names=["block", "cell"])

    # Cells of a block are gathered as distinct numbers: at most 2 ** _BLOCK_BITS of them.
    found = hashes.mapInArrow(spread, "block long, cell long").distinct()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, None

        def close() -> pa.RecordBatch:
            return pa.record_batch([pa.array([block], pa.int64()), pa.array([np.packbits(held).tobytes()], pa.binary())], names=["block", "bits"])

        for batch in batches:
            blocks, cell = batch.column("block").to_numpy(), batch.column("cell").to_numpy()
            cut = np.r_[0, np.flatnonzero(np.diff(blocks)) + 1, len(blocks)]
            for a, b in zip(cut[:-1], cut[1:]):
                if a == b:
                    continue
                if block != int(blocks[a]):
                    if block is not None:
                        yield close()
                    block, held = int(blocks[a]), np.zeros(1 << block_bits, bool)
                held[cell[a:b]] = True
        if block is not None:
            yield close()

    packed = found.repartition("block").sortWithinPartitions("block").mapInArrow(pack, "block long, bits binary")
    out = np.zeros(1 << bits - 3, np.uint8)
    width = 1 << block_bits - 3
    for block, held in packed.collect():  # 2 ** bits bits in all
        out[block * width : (block + 1) * width] = np.frombuffer(held, np.uint8)
    return out


def _cell(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix(h + np.uint64(row * 0x632BE59BD9B4E019 & (1 << 64) - 1)) >> np.uint64(64 - bits)).astype(np.int64)


def _holds(bitmap: np.ndarray, h: np.ndarray, bits: int, cells: int = FILTER_CELLS) -> np.ndarray:
    ok = np.ones(len(h), bool)
    for row in range(cells):
        c = _cell(h, row, bits)
        ok &= (bitmap[c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1 == 1
    return ok


def semi_join(relation: DataFrame, frequent: DataFrame, k: int, bits: int = FILTER_BITS, raw: bool = False) -> DataFrame:
    """R(k) from R(k - 1), written: occurrences of phrases of k words whose hash is in ``frequent`` (h)."""
    shared = relation.sparkSession.sparkContext.broadcast(bloom(frequent, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = _lang_hashes(batch.column("lang"))
            for s in _parts(batch.column("text"), raw):
                at = s.phrases(k)
                at = at[_holds(shared.value, _hashes(s, langs, k, at) >> _LEFT_OUT, bits)]
                yield pa.record_batch([batch.column("lang").slice(s.w.first, len(s.w)), _written(s, at, k)], names=["lang", "text"])

    kept = relation.select("lang", "text").mapInArrow(run, "lang string, text string").where("text != ''")
    kept = stage(kept, "phrase-occurrences")
    shared.destroy()
    return kept


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases (lang, phrase, size, n) of up to ``longest`` words, and words per lang (lang, n).

    Of single words those that a frequent pair holds. ``docs`` has ``lang`` and ``text``, neither null.
    """
    seen = stage(count_words(docs, least), "phrase-words")
    words = relation = semi_join(docs, seen.where("h is not null"), 1, bits, raw=True)
    found = []
    for k in range(2, longest + 1):
        longer = semi_join(relation, count_hashes(relation, k, least), k, bits)
        found.append(stage(count_phrases(longer, k, least).withColumn("size", F.lit(k)), "phrase-counts"))
        if k > 2:
            unstage(relation)
        else:
            held = count_hashes(found[0].select("lang", F.col("phrase").alias("text")), 1, 1)
            among = docs.sparkSession.sparkContext.broadcast(bloom(held, bits))
            found.append(stage(count_phrases(words, 1, least, among, bits).withColumn("size", F.lit(1)), "phrase-counts"))
            among.destroy()
            unstage(words)
        relation = longer
    unstage(relation)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.select("lang", "phrase", "size", "n"), seen.where("h is null").select("lang", "n")


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    within: int = WITHIN,
    lang_col: str = "lang",
    text_col: str = "text",
    bits: int = FILTER_BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``longest`` words.

    Words are lower-cased (A-Z), phrases lie within pieces between the characters ``.,;:!?`` and line
    ends. ``a`` is a phrase's count, ``least`` at least, and l and r those of its two parts at the cut
    that scores least, the first of equal ones; the score is floor(1000 * a * n / (l * r)) with n words
    in the language. A phrase goes if ``within`` percent of its count or more fall to a longer one that
    contains it, whatever becomes of that one. Ranks go by score, then a, then the phrase's bytes.

    A null language is ``und``. Null and empty texts have no words; texts of any length are read as a
    whole; rows that repeat each count. Without frequent phrases, and on an empty table, the result is
    empty; other columns, of whatever name, are not read.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    every, words = mine(texts, least, longest, bits)
    longer = every.where("size > 2").withColumn("w", F.split("phrase", " "))
    inside = longer.select(
        "lang", F.explode(F.array(F.expr("slice(w, 1, size - 1)"), F.expr("slice(w, 2, size - 1)"))).alias("w"), F.col("n").alias("most")
    )
    # What holds a phrase and is much longer holds it within one that is one word longer, as often at least.
    inside = inside.groupBy("lang", F.array_join("w", " ").alias("phrase")).agg(F.max("most").alias("most"))
    pairs = every.where("size > 1").join(inside, ["lang", "phrase"], "left").where(f"most is null or 100 * most < {int(within)} * n")
    cuts = pairs.withColumn("w", F.split("phrase", " ")).select(
        "lang", "phrase", F.col("n").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    )
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.expr("slice(w, 1, k)"), " ").alias("head"), F.array_join(F.expr("slice(w, k + 1, size(w) - k)"), " ").alias("rest"),
    )
    known = every.select("lang", "phrase", "n")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    # Products of counts have up to 38 digits.
    score = F.expr("(cast(1000 * a as decimal(19, 0)) * cast(n as decimal(18, 0))) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))")
    best = (
        cuts.join(words, "lang")
        .select("lang", "phrase", "a", "n", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
        .groupBy("lang", "phrase")
        .agg(F.first("a").alias("a"), F.first("n").alias("n"), F.min("cut").alias("cut"))
    )
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
