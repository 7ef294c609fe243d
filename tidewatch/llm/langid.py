"""Language identification by a convolutional network over bytes, trained in numpy.

The network reads windows of a fixed number of bytes. A filter of width ``w`` over one-hot bytes is
``w`` tables of one weight per byte value, so a convolution is a sum of table look-ups; the
greatest value of each filter over the window goes through a rectifier into a softmax. A text is
cut into windows that cover all of it, and the windows' probabilities are averaged by length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.llm.words import least_hash, text_bytes

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 24
# Distinct texts that the network is trained on, one of each language at least, and windows taken of each.
SAMPLE = 3_000
_WINDOWS_EACH = 4
_EPOCHS = 8
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def windows(data: np.ndarray, offsets: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows x size) bytes, zero behind a text's end; the row and the length of each window."""
    lengths = np.diff(offsets)
    n = -(-lengths // size)
    row = np.repeat(np.arange(len(lengths)), n)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start = offsets[row] + nth * size
    held = np.minimum(lengths[row] - nth * size, size)
    at = np.arange(size)
    inside = at < held[:, None]
    return np.where(inside, data[np.minimum(start[:, None] + at, max(len(data) - 1, 0))], 0).astype(np.uint8), row, held


@dataclass
class ByteNet:
    """Weights: per width a (width x 256 x filters) table, biases, and the softmax layer."""

    labels: list[str]
    tables: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    def pairs(self) -> ByteNet:
        """Tables of two neighbouring bytes at once: the same sums with about half the look-ups."""
        joined = []
        for t in self.tables:
            parts = [(t[k][:, None, :] + t[k + 1][None, :, :]).reshape(1 << 16, -1) for k in range(0, len(t) - 1, 2)]
            joined.append((parts, t[-1] if len(t) % 2 else None))
        self.joined = joined
        return self

    def probabilities(self, w: np.ndarray) -> np.ndarray:
        """Softmax of every window, a few at a time."""
        found = np.empty((len(w), len(self.labels)), np.float32)
        for at in range(0, len(w), 128):
            b = w[at : at + 128].astype(np.int32)
            pair = (b[:, :-1] << 8) | b[:, 1:]
            top = []
            for width, (parts, single), bias in zip(WIDTHS, self.joined, self.bias):
                n = b.shape[1] - width + 1
                total = parts[0].take(pair[:, :n], axis=0)
                for k, part in enumerate(parts[1:], 1):
                    total += part.take(pair[:, 2 * k : 2 * k + n], axis=0)
                if single is not None:
                    total += single.take(b[:, width - 1 : width - 1 + n], axis=0)
                top.append(total.max(1) + bias)
            z = np.maximum(np.concatenate(top, 1), 0) @ self.out + self.out_bias
            z = np.exp(z - z.max(1, keepdims=True))
            found[at : at + 128] = z / z.sum(1, keepdims=True)
        return found


def train(w: np.ndarray, y: np.ndarray, labels: list[str], seed: int = 7) -> ByteNet:
    """Adam on cross entropy; a filter's gradient reaches only the bytes of its greatest value."""
    rng = np.random.default_rng(seed)
    f, c = FILTERS, len(labels)
    net = ByteNet(
        labels,
        [rng.normal(0, 0.15, (k, 256, f)).astype(np.float32) for k in WIDTHS],
        [np.zeros(f, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.15, (f * len(WIDTHS), c)).astype(np.float32),
        np.zeros(c, np.float32),
    )
    weights = [*net.tables, *net.bias, net.out, net.out_bias]
    first, second = ([np.zeros_like(x) for x in weights] for _ in range(2))
    # Classes count alike, however many documents they have.
    share = np.bincount(y, minlength=c)
    step = 0
    for _ in range(_EPOCHS):
        order = rng.permutation(len(w))
        for at in range(0, len(order), 64):
            pick = order[at : at + 64]
            b, t = w[pick].astype(np.int64), y[pick]
            m = len(pick)
            tops, best = [], []
            for table, bias, width in zip(net.tables, net.bias, WIDTHS):
                n = b.shape[1] - width + 1
                z = sum(table[k].take(b[:, k : k + n], axis=0) for k in range(width))
                best.append(z.argmax(1))
                tops.append(np.take_along_axis(z, best[-1][:, None, :], 1)[:, 0] + bias)
            h = np.concatenate(tops, 1)
            a = np.maximum(h, 0)
            z = a @ net.out + net.out_bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(m), t] -= 1
            p *= (len(y) / (c * share[t]))[:, None] / m
            grads = [np.zeros_like(x) for x in weights]
            grads[-1], grads[-2] = p.sum(0), a.T @ p
            back = (p @ net.out.T) * (h > 0)
            for i, width in enumerate(WIDTHS):
                g = back[:, i * f : (i + 1) * f]
                grads[len(WIDTHS) + i] = g.sum(0)
                for k in range(width):
                    byte = np.take_along_axis(b, best[i] + k, 1)
                    np.add.at(grads[i][k], (byte, np.arange(f)), g)
            step += 1
            for x, g, u, v in zip(weights, grads, first, second):
                u += 0.1 * (g - u)
                v += 0.001 * (g * g - v)
                x -= (0.004 * (u / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def _windows_of(text: Column) -> Column:
    """An array of ``_WINDOWS_EACH`` windows of a text's bytes, at places by its hash.

    Every second one is of a length between 16 bytes and a window, so that short texts and last
    windows are known too.
    """
    raw = F.encode(text, "utf-8")
    n = F.octet_length(text)
    taken = []
    for k in range(_WINDOWS_EACH):
        size = F.lit(WINDOW) if k % 2 == 0 else (F.pmod(F.xxhash64(text, F.lit(2 * k)), F.lit(WINDOW - 15)) + 16).cast("int")
        at = F.pmod(F.xxhash64(text, F.lit(2 * k + 1)), F.greatest(n - size + 1, F.lit(1))).cast("int")
        taken.append(F.substring(raw, at + 1, size))
    return F.array(*taken)


def fit(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> ByteNet | None:
    """Train on distinct texts that ``learn`` admits: at most ``sample``, evenly over languages.

    Every language with a text is learned, from one text at least, so more than ``sample`` languages
    take one text each. The sample is the texts of least hash, so it does not depend on how rows lie or
    repeat; texts are told apart by 64 bits of hash. Windows of them are cut in tasks, anywhere in
    the text, and only these reach the driver. None if no row has a text and a language.
    """
    rows = docs.where(learn & F.col(lang_col).isNotNull() & (F.length(text_col) > 0))
    keyed = rows.select(F.col(lang_col).alias("lang"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    sizes = dict(keyed.select("lang", "h").distinct().groupBy("lang").count().collect())
    langs = sorted(sizes)
    if not langs:
        return None
    each = max(1, sample // len(langs))
    # About twice the texts that are needed; hashes are uniform over distinct texts.
    cuts = docs.sparkSession.createDataFrame(
        [(lang, least_hash(each, n)) for lang, n in sizes.items()], f"lang {keyed.schema['lang'].dataType.simpleString()}, cut long"
    )
    few = keyed.join(F.broadcast(cuts), "lang").where(F.col("h") <= F.col("cut"))
    # Copies become one row within their tasks, ahead of the shuffle and the order.
    once = few.select("lang", "h", _windows_of(F.col("text")).alias("w")).groupBy("lang", "h").agg(F.min("w").alias("w"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    held = sorted(once.withColumn("nth", nth).where(F.col("nth") <= each).select("lang", "h", "w").collect(), key=lambda r: (r["lang"], r["h"]))
    place = {lang: k for k, lang in enumerate(langs)}
    blocks = np.zeros((len(held) * _WINDOWS_EACH, WINDOW), np.uint8)
    for k, part in enumerate(part for r in held for part in r["w"]):
        blocks[k, : len(part)] = np.frombuffer(part, np.uint8)
    return train(blocks, np.repeat([place[r["lang"]] for r in held], _WINDOWS_EACH), langs)


def predict(docs: DataFrame, net: ByteNet | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row, over the whole text.

    ``und`` with score 0 for a null text, one without a letter, and where nothing could be learned.
    Rows that repeat an id are separate; an empty table gives an empty table; other columns are
    ignored.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(net)
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value.pairs() if shared.value is not None else None
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            n = batch.num_rows
            known = np.array([t is not None and _LETTER.search(t) is not None for t in batch.column("text").to_pylist()], bool)
            best, score = np.zeros(n, int), np.zeros(n)
            if net is None:
                known[:] = False
            else:
                total = np.zeros((n, len(net.labels)))
                at = 0
                while at < n:  # rows of about a megabyte at a time
                    to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (1 << 20), "right")) - 1)
                    w, row, held = windows(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
                    if len(w):
                        p = net.probabilities(w) * held[:, None]
                        np.add.at(total[at:to], row, p)
                    at = to
                total /= np.maximum(np.diff(offsets), 1)[:, None]
                best, score = total.argmax(1), np.clip(total.max(1), 0, 1)
            names = [net.labels[b] if k else UNKNOWN for b, k in zip(best, known)]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0))],
                names=["doc_id", "lang_pred", "score"],
            )

    return texts.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
