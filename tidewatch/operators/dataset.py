"""Model tables: joins, filling, encoding, splits, class weights."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.config import ANCHOR_KEYS, KEYS, SplitFractions
from tidewatch.functions import hash_bucket, murmur3_bucket
from tidewatch.operators.ranking import exact_cutoffs, order_after
from tidewatch.sources import numeric_columns

# Anchors that one task joins with their labels.
ROWS_PER_PART = 250_000


def fill_nulls(
    df: DataFrame, value: float = 0.0, exclude: Sequence[str] = ("label",), columns: Sequence[str] | None = None
) -> DataFrame:
    """Replace nulls of the numeric columns by ``value``; they become double, like ``value``."""
    chosen = numeric_columns(df, exclude) if columns is None else columns
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(value))) for c in chosen})


def encode_binary(df: DataFrame, column: str, value: str, out: str) -> DataFrame:
    """1 where ``column`` equals ``value``, else 0 (also for null); the column is dropped."""
    return df.withColumn(out, F.when(F.col(column) == value, 1).otherwise(0)).drop(column)


def split_name(bucket: Column, fractions: SplitFractions) -> Column:
    train, val = fractions.cuts
    return F.when(bucket < train, "train").when(bucket < val, "val").otherwise("test")


def split_assign(
    df: DataFrame,
    key: str = "patient_id",
    fractions: SplitFractions = SplitFractions(),
    method: str = "md5",
) -> DataFrame:
    """Assign whole entities to train, val and test by a hash of their key.

    ``md5`` gives the same split in every engine, ``murmur3`` the one of Spark's own ``hash``.
    """
    bucket = {"md5": hash_bucket, "murmur3": murmur3_bucket}[method](key)
    return df.withColumn("split", split_name(bucket, fractions))


def split_temporal(df: DataFrame, time: str = "admit_time", fractions: SplitFractions = SplitFractions()) -> DataFrame:
    """Earlier rows train, later rows test. Equal times share a split, so a part may exceed its share."""
    position = F.unix_micros(F.col(time).cast("timestamp")).cast("double")
    timed = df.withColumn("__t", position)
    train, val = exact_cutoffs(timed, "__t", [fractions.train, fractions.train + fractions.val], None)
    after_train, after_val = order_after(F.col("__t"), None, train), order_after(F.col("__t"), None, val)
    split = F.when(F.col("__t").isNull(), F.lit(None).cast("string")).when(after_val, "test").when(after_train, "val")
    return timed.withColumn("split", split.otherwise("train")).drop("__t")


def class_weights(
    df: DataFrame, reference: DataFrame | None = None, label: str = "label", out: str = "weight"
) -> DataFrame:
    """Weight negatives/positives for positive rows and 1 for others.

    The ratio comes from ``reference`` (the training part) as a scalar subquery within the plan;
    it is 1 without positives.
    """
    counts = (df if reference is None else reference).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    ratio = counts.select(
        F.when(F.col("pos") > 0, F.col("neg").cast("double") / F.col("pos")).otherwise(F.lit(1.0)).alias("ratio")
    )
    return df.withColumn(out, F.when(F.col(label) == 1, ratio.scalar()).otherwise(F.lit(1.0)))


def parts_of(rows: DataFrame) -> int:
    """Parts of ``ROWS_PER_PART`` of ``rows`` on average, in as many as the session shuffles into at least."""
    session = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(session, math.ceil(rows.count() / ROWS_PER_PART))


def training_set(
    features: DataFrame,
    labels: DataFrame,
    attributes: DataFrame,
    fractions: SplitFractions = SplitFractions(),
    attribute_keys: Sequence[str] = KEYS,
    encode: Mapping[str, tuple[str, str]] | None = None,
    fill: float = 0.0,
    label: str = "label",
    method: str = "md5",
    deal: bool = False,
) -> DataFrame:
    """Features with labels and static attributes, filled, encoded and split by patient.

    ``encode`` maps a category column to the value coded as 1 and the name of the new column.
    Keys are never filled. ``deal`` counts the labels and joins in parts of ``ROWS_PER_PART`` anchors, in as
    many as the session shuffles into at least; it is not meant for features that are bucketed by anchor.
    """
    # The narrow sides meet first, so that the wide rows of features take part in one join only, and in
    # no exchange at all where they are bucketed by anchor (see ``write_bucketed``).
    known = labels.select(*ANCHOR_KEYS, label).join(attributes, list(attribute_keys), "left")
    if deal:
        known = known.repartition(parts_of(labels), *ANCHOR_KEYS)
    own = [c for c in attributes.columns if c not in attribute_keys]
    ds = features.join(known, list(ANCHOR_KEYS)).select(*features.columns, label, *own)
    return split_assign(_filled(ds, encode, fill, (label,)), "patient_id", fractions, method)


def model_table(
    labelled: DataFrame,
    attributes: DataFrame,
    fractions: SplitFractions = SplitFractions(),
    attribute_keys: Sequence[str] = KEYS,
    encode: Mapping[str, tuple[str, str]] | None = None,
    fill: float = 0.0,
    label: str = "label",
    method: str = "md5",
    parts: int | None = None,
) -> DataFrame:
    """``training_set`` for features that carry their label already (see ``with_labels``)."""
    ds = model_inputs(labelled, attributes, attribute_keys, encode, fill, keep=(label,), parts=parts)
    return split_assign(ds, "patient_id", fractions, method)


def model_inputs(
    features: DataFrame,
    attributes: DataFrame,
    attribute_keys: Sequence[str] = KEYS,
    encode: Mapping[str, tuple[str, str]] | None = None,
    fill: float = 0.0,
    keep: Sequence[str] = (),
    parts: int | None = None,
) -> DataFrame:
    """What a model reads: features and static attributes, filled and encoded. No label is needed.

    Keys and the columns of ``keep`` are never filled. ``parts`` is how many the wide rows are joined in
    (see ``parts_of``), else as many as the session shuffles into.
    """
    if parts is not None:
        attributes = attributes.repartition(parts, *attribute_keys)
    return _filled(features.join(attributes, list(attribute_keys), "left"), encode, fill, keep)


def _filled(ds: DataFrame, encode: Mapping[str, tuple[str, str]] | None, fill: float, keep: Sequence[str]) -> DataFrame:
    ds = fill_nulls(ds, fill, exclude=(*keep, *ANCHOR_KEYS))
    for column, (value, out) in (encode or {}).items():
        ds = encode_binary(ds, column, value, out)
    return ds


def unscored(inputs: DataFrame, scores: DataFrame, keys: Sequence[str] = ANCHOR_KEYS) -> DataFrame:
    """Rows of ``inputs`` whose keys have no row in ``scores``; what is scored already is not scored again."""
    return inputs.join(scores.select(*keys).distinct(), list(keys), "left_anti")


def score_dataset(training: DataFrame, label: str = "label") -> DataFrame:
    """The model table without its label and split, for inference."""
    return training.drop(label, "split")


def split_stats(df: DataFrame, label: str = "label", entity: str = "patient_id") -> DataFrame:
    """Rows, positives, prevalence and entities per split, and of the whole table as split ``all``.

    A rollup: the table is read once for both levels.
    """
    out = df.rollup("split").agg(
        F.grouping("split").alias("__whole"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(label) == 1).alias("n_pos"),
        F.avg(F.col(label).cast("double")).alias("prevalence"),
        F.count_distinct(entity).alias("n_entities"),
    )
    named = F.when(F.col("__whole") == 1, F.lit("all")).otherwise(F.col("split"))
    return out.withColumn("split", named).drop("__whole")
