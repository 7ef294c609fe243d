"""Importance resampling of documents towards a target distribution, by hashed word features.

Words come from an untrained Regex Split of the tokenizers library over ASCII-lowered text, with their
offsets. Windows of one to ``longest`` neighbouring offset pairs are the features; a feature's bucket
is the CRC-32 of its words, joined by one space, modulo the number of buckets. The CRC of a window
goes on from the CRC of the window that is one word shorter, so no window is ever built as a string.

1. One pass splits every text and stages its buckets, two bytes a feature.
2. Bucket histograms of all documents and of all target texts give each bucket's gain, the logarithm
   of its smoothed share in the target over its smoothed share in the documents.
3. A document weighs the mean gain of its features; Gumbel noise from the hash of its id is added, and
   the highest scores are drawn: sampling without replacement in proportion to the weights' exponents.

The gains are one number per bucket, the only thing that passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Regex, pre_tokenizers

from tidewatch.llm.words import text_bytes
from tidewatch.sources.tables import stage

BUCKETS = 10_000
LONGEST = 2
# Percent of the documents with LEAST_WORDS words or more that are drawn, and the seed of the noise.
PERCENT, LEAST_WORDS, SEED = 25, 20, 7
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Features:
    """Words with offsets, and buckets of their windows."""

    def __init__(self, buckets: int, longest: int):
        self.split = pre_tokenizers.Split(Regex(WORD), "removed", invert=True)
        self.buckets, self.longest = buckets, longest
        self.kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def words(self, raw: bytes) -> list[tuple[str, tuple[int, int]]]:
        """Words of a text and the code points they reach from and to."""
        return self.split.pre_tokenize_str(raw.lower().decode())  # bytes.lower() knows A-Z only

    def of(self, raw: bytes) -> tuple[int, np.ndarray]:
        """Number of words, and the bucket of each window, shorter windows first."""
        found = [w.encode() for w, _ in self.words(raw)]
        sums = list(map(crc32, found))
        every = [sums]
        spaced = [b" " + w for w in found]
        for n in range(1, self.longest):
            # The window of n + 1 words from each word on; the last n words begin none.
            sums = list(map(crc32, spaced[n:], sums))
            every.append(sums)
        hashed = np.concatenate([np.array(s, np.uint32) for s in every])
        return len(found), (hashed % np.uint32(self.buckets)).astype(self.kind)


def featurize(docs: DataFrame, id_col: str | None, text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(doc_id, n_words, n_features, buckets) of each row; buckets are packed unsigned integers."""
    ident = F.lit(None).cast("long") if id_col is None else F.col(id_col)
    texts = docs.select(ident.alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(buckets, longest)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            # A few hundred rows at once, so that what is held beside the batch is bounded by its texts.
            for a in range(0, batch.num_rows, 256):
                b = min(a + 256, batch.num_rows)
                found = [features.of(data[offsets[i] : offsets[i + 1]].tobytes()) for i in range(a, b)]
                yield pa.record_batch(
                    [batch.column("doc_id").slice(a, b - a), pa.array([n for n, _ in found], pa.int64()),
                     pa.array([len(f) for _, f in found], pa.int64()), pa.array([f.tobytes() for _, f in found], pa.binary())],
                    names=["doc_id", "n_words", "n_features", "buckets"],
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, buckets binary")


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def histogram(features: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all rows; every task adds up its own rows first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column("buckets"):
                sums += np.bincount(np.frombuffer(packed.as_py(), _kind(buckets)), minlength=buckets)
        some = np.flatnonzero(sums)
        yield pa.record_batch([pa.array(some, pa.int64()), pa.array(sums[some], pa.int64())], names=["bucket", "n"])

    counted = features.select("buckets").mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket: thousandths of the log ratio of its smoothed shares, floored."""
    both = source.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(
        target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t"))
    )
    every = source.sparkSession.range(buckets).select(F.col("id").alias("bucket"), *[F.lit(0).cast("long").alias(c) for c in "st"])
    counts = both.unionByName(every).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    total = counts.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    up = (F.col("t") + 1).cast("double") * (F.col("all_s") + buckets).cast("double")
    down = (F.col("s") + 1).cast("double") * (F.col("all_t") + buckets).cast("double")
    whole = counts.withColumns({c: total.select(c).scalar() for c in ("all_s", "all_t")})
    return whole.select("bucket", F.floor(1000 * F.log(up / down)).cast("long").alias("gain"))


def weigh(features: DataFrame, gain: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``features`` without buckets, with ``weight``: the floored mean gain, 0 without features."""
    table = np.zeros(buckets, np.int64)
    for k, value in gain.collect():  # one row per bucket
        table[k] = value
    shared = features.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = []
            for packed in batch.column("buckets"):
                found = np.frombuffer(packed.as_py(), _kind(buckets))
                weight.append(int(shared.value[found].sum()) // len(found) if len(found) else 0)
            columns = [batch.column(c) for c in ("doc_id", "n_words", "n_features")]
            yield pa.record_batch([*columns, pa.array(weight, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    kind = features.schema["doc_id"].dataType.simpleString()
    return features.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def draw(weighed: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """``weighed`` with ``score`` and ``rank``; ``percent`` of the rows of ``least_words`` words have a rank."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    noise = F.floor(-1000 * F.log(-F.log((h.cast("long") + 0.5) / 4294967296.0))).cast("long")
    scored = weighed.withColumns({"score": F.col("weight") + noise, "__row": F.monotonically_increasing_id()})
    # Ranges of the order, written once: counting and ranking see the same ranges, and rows that
    # share score and id are divided by their number.
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("__row")]
    enough = F.col("n_words") >= least_words
    ranged = stage(
        scored.repartitionByRange(F.when(enough, F.col("score")).desc_nulls_last(), *order[1:]).withColumn("__range", F.spark_partition_id()),
        "resample-ranges",
    )
    sizes = ranged.groupBy("__range").agg(F.count_if(enough).alias("n"))
    # One row per range.
    ahead = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__range", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start"))
    drawn = sizes.agg(F.expr(f"{int(percent)} * sum(n) div 100"))
    within = F.row_number().over(Window.partitionBy("__range").orderBy(F.when(enough, 0).otherwise(1), *order))
    placed = ranged.withColumn("at", within).join(F.broadcast(starts), "__range").withColumn("at", F.col("at") + F.col("start"))
    rank = F.when(enough & (F.col("at") <= drawn.scalar()), F.col("at").cast("long"))
    return placed.withColumn("rank", rank).drop("__range", "__row", "at", "start")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank), one row per row of ``docs``.

    ``target`` has its texts in a column of the same name. ``rank`` counts the drawn rows from 1, the
    highest score first, ties by the smaller id; it is null for rows that are not drawn. Rows that
    repeat an id are rows of their own with one noise; those alike in score and id follow each other
    in no fixed order, a null id last. Null and empty texts, and texts without words, have no features,
    weight 0, and are never drawn. Without target texts each bucket counts as seen once. An empty table
    gives an empty table; other columns, of whatever name, are not read.
    """
    features = stage(featurize(docs, id_col, text_col, buckets, longest), "resample-features")
    wanted = featurize(target, None, text_col, buckets, longest)
    gain = gains(histogram(features, buckets), histogram(wanted, buckets), buckets)
    return draw(weigh(features, gain, buckets), percent, least_words, seed)
