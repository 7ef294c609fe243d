"""Quality by nearest neighbours in a latent space.

A text is a bag of style terms: triples of neighbouring character classes, and how often its words
repeat and how long they are. Weighted by inverse document frequency over the whole corpus and
projected by a truncated singular value decomposition of labelled documents (latent semantic
analysis), it is compared with every labelled document: exact cosines, one block product at a
time. The nearest labels vote with their similarities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.words import Words, least_hashes, words

# Labelled documents that are broadcast at most, half of them of each label.
REFERENCES = 6_000
DIMENSIONS = 64
NEIGHBOURS = 15
# Similarities are raised to this power, so that near neighbours outvote far ones.
SHARPNESS = 8
# Weight of the prior, far below that of any real neighbour.
_PRIOR = 1e-6

# Character classes: letters, capitals, digits, blanks, line ends, and the common signs by themselves.
_GROUPS = ("A-Z", "0-9", " \t", "\n\r", ".", ",", "!?", "|", "%", "$#", "&", "*", "<>[]{}()=", "\"'-_/:;+@\\~^`")
_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91], _CLASS[48:58] = 1, 2
for _i, _g in enumerate(_GROUPS[2:], 3):
    _CLASS[[ord(_c) for _c in _g]] = _i
_N = len(_GROUPS) + 1
_TRIPLES = _N**3
_REPEATS, _LENGTHS = 16, 24
TERMS = _TRIPLES + _REPEATS + _LENGTHS


def term_counts(w: Words) -> np.ndarray:
    """(rows x TERMS) counts."""
    n = len(w)
    out = np.zeros((n, TERMS), np.float32)
    data = w.data
    # Later bytes of a longer UTF-8 character say nothing more than its first one.
    keep = (data & 0xC0) != 0x80
    c = _CLASS[data[keep]].astype(np.int64)
    row = np.repeat(np.arange(n), np.diff(w.offsets))[keep]
    if len(c) > 2:
        code = (c[:-2] * _N + c[1:-1]) * _N + c[2:]
        inside = row[:-2] == row[2:]
        out[:, :_TRIPLES] = np.bincount(row[:-2][inside] * _TRIPLES + code[inside], minlength=n * _TRIPLES).reshape(n, -1)
    count = np.diff(w.rows)
    word_row = np.repeat(np.arange(n), count)
    if len(word_row):
        length = np.minimum(w.ends - w.starts, _LENGTHS) - 1
        out[:, _TRIPLES + _REPEATS :] = np.bincount(word_row * _LENGTHS + length, minlength=n * _LENGTHS).reshape(n, -1)
        for r in range(n):
            a, b = w.rows[r], w.rows[r + 1]
            if b > a:
                times = np.unique(w.hashes[a:b], return_counts=True)[1]
                # Share of the words that occur about 2 ** i times, as a count of 100.
                grade = np.minimum(np.log2(times).astype(int), _REPEATS - 1)
                out[r, _TRIPLES : _TRIPLES + _REPEATS] = 100 * np.bincount(grade, times, minlength=_REPEATS) / (b - a)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass
class Neighbours:
    idf: np.ndarray
    project: np.ndarray  # terms x dimensions
    vectors: np.ndarray  # references x dimensions, unit length
    labels: np.ndarray
    prior: float

    def weigh(self, counts: np.ndarray) -> np.ndarray:
        return _unit(np.log1p(counts) * self.idf)

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return _unit(self.weigh(counts) @ self.project)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Weighted share of label 1 among the nearest references; the prior where nothing is near."""
        near = self.latent(counts) @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, top, 1), 0).astype(float) ** SHARPNESS
        return (_PRIOR * self.prior + (weight * self.labels[top]).sum(1)) / (_PRIOR + weight.sum(1))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts of the corpus each term occurs, and the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            for w in words(batch.column("text"), lower=True):
                total += (term_counts(w) > 0).sum(0)
                rows += len(w)
        if rows:
            term = np.r_[np.flatnonzero(total), -1]
            yield pa.record_batch([pa.array(term), pa.array(np.r_[total[term[:-1]], rows])], names=["term", "n"])

    # At most one row per term.
    sums = texts.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found, rows = np.zeros(TERMS), 0
    for term, n in sums:
        if term < 0:
            rows = n
        else:
            found[term] = n
    return found, rows


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    references: int = REFERENCES,
) -> Neighbours | None:
    """References from the labelled rows that ``learn`` (over the id column) admits.

    Of each label the ``references / 2`` rows of least hash of id and text are taken, rows that repeat
    both being one. None without any.
    """
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("t", F.xxhash64("text"))
    marked = labels.where(learn & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).distinct()
    # Only labelled ids that have a row take a place, each row its own; texts come along for those taken.
    known = rows.select("id", "t").join(marked, "id").distinct()
    h, half, sizes = F.xxhash64("id", "t"), references // 2, dict(known.groupBy("y").count().collect())
    halves = [known.where((F.col("y") == y) & least_hashes(h, half, sizes.get(y, 0))).orderBy(h, "id", "t").limit(half) for y in (0, 1)]
    picked = halves[0].unionByName(halves[1])
    # At most `references` rows, so they may be broadcast.
    rows = rows.join(F.broadcast(picked), ["id", "t"]).groupBy("id", "t", "y").agg(F.first("text").alias("text")).select("y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column("y").to_pylist()
            for w in words(batch.column("text"), lower=True):
                for r, counts in enumerate(term_counts(w)):
                    term = np.flatnonzero(counts).astype("<u2")
                    yield pa.record_batch(
                        [pa.array([y[w.first + r]], pa.int64()), pa.array([term.tobytes()]), pa.array([counts[term].astype("<f4").tobytes()])],
                        names=["y", "term", "count"],
                    )

    held = rows.mapInArrow(run, "y long, term binary, count binary").collect()
    if not held:
        return None
    # The order in which rows arrive must not matter.
    held.sort(key=lambda r: (bytes(r["term"]), bytes(r["count"]), r["y"]))
    df, n = document_frequencies(texts)
    y = np.array([r["y"] for r in held], float)
    idf = (np.log((1 + n) / (1 + df)) + 0.1).astype(np.float32)
    # Built in place: one copy of the weighted references is all that the driver holds.
    x = np.zeros((len(held), TERMS), np.float32)
    for i, r in enumerate(held):
        term = np.frombuffer(r["term"], "<u2")
        weight = np.log1p(np.frombuffer(r["count"], "<f4")) * idf[term]
        x[i, term] = weight / max(np.linalg.norm(weight), 1e-12)
    del held
    d = min(DIMENSIONS, *x.shape)
    # Randomised range finder; four passes sharpen it.
    q = np.linalg.qr(x.T @ np.random.default_rng(3).normal(size=(len(x), min(d + 16, len(x)))).astype(np.float32))[0]
    for _ in range(4):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    right = np.linalg.svd(x @ q, full_matrices=False)[2]
    project = (q @ right[:d].T).astype(np.float32)
    return Neighbours(idf, project, _unit(x @ project).astype(np.float32), y, float(y.mean()))


def score(docs: DataFrame, model: Neighbours | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row from its whole text, 0 to 1, higher for label 1.

    Null and empty texts, and all texts where nothing could be learned, get the share of label 1
    among the references (0.5 without any). Rows that repeat an id are separate; an empty table
    gives an empty table; other columns are ignored.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            parts = [np.zeros(0)]
            for w in words(batch.column("text"), lower=True):
                parts.append(np.full(len(w), 0.5) if model is None else model.scores(term_counts(w)))
            yield pa.record_batch([batch.column("doc_id"), pa.array(np.concatenate(parts))], names=["doc_id", "score"])

    return texts.mapInArrow(run, f"doc_id {kind}, score double")


def select_rows(docs: DataFrame, model: Neighbours | None, at_least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores ``at_least``; all without a model."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            parts = [np.zeros(0)]
            for w in words(batch.column(text_col).cast(pa.string()), lower=True):
                parts.append(np.ones(len(w)) if model is None else model.scores(term_counts(w)))
            yield batch.filter(pa.array(np.concatenate(parts) >= at_least))

    return docs.mapInArrow(run, docs.schema)
