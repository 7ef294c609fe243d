"""From raw documents to a training mix: filter, deduplicate, decontaminate, mix.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before it kept. All
but the last return the columns of ``docs``; the last adds each document's place in the mix.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.llm import decontam, exact, mixing, neardup, quality
from tidewatch.sources.tables import stage, staged_tables, unstage

# Names a row, so that rows which repeat an id, or have none, are told apart.
_ROW = "__row"

# The part of the labels, by hash of the id, that the classifier never sees.
_FOLDS, _HELD_OUT = 3, 1
# Words of a shingle and percent of similarity of near-duplicates.
SHINGLE, SIMILAR = 5, 80


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more; a null or empty text scores the labels' mean."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learn = F.crc32(F.col("doc_id").cast("string")) % _FOLDS != _HELD_OUT
    return quality.select_rows(docs, quality.fit(docs, labels, learn), at_least=0.5)


def _named(docs: DataFrame, name: str, *order: Column) -> DataFrame:
    """``docs`` with a struct that names each row: ``order`` and its place in the files it is read from.

    A stage's input has been written, so its rows need no number of their own. What is no scan of files
    is written once with a number.
    """
    if "_metadata" not in docs.columns:
        with suppress(AnalysisException):
            return docs.withColumn(_ROW, F.struct(*order, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("nth")))
    numbered = stage(docs.withColumn("__nth", F.monotonically_increasing_id()), name)
    return numbered.withColumn(_ROW, F.struct(*order, F.lit("").alias("file"), F.col("__nth").alias("nth"))).drop("__nth")


def _without(rows: DataFrame, dropped: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` without those that ``dropped`` (``row``) names."""
    keys = rows.withColumns({"__file": F.col(f"{_ROW}.file"), "__nth": F.col(f"{_ROW}.nth")})
    gone = dropped.select(F.col("row.file").alias("__file"), F.col("row.nth").alias("__nth"))
    return keys.join(gone, ["__file", "__nth"], "left_anti").select(columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row, with the largest id; a null id is less than any other."""
    rows = _named(docs, "exact-numbered", F.col("doc_id"))
    found = exact.exact_dedup(rows, id_col=_ROW, carry=[F.col(_ROW)])
    return _without(rows, found.where("not kept").select(F.col(f"row.{_ROW}").alias("row")), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row, with the least id; a null id only if there is no other."""
    rows = _named(docs, "near-numbered", F.col("doc_id").isNull().alias("none"), F.col("doc_id"))
    found = neardup.near_duplicates(rows, k=SHINGLE, percent=SIMILAR, id_col=_ROW)
    return _without(rows, found.where("not kept").select(F.col("doc_id").alias("row")), docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the slot of the mix that each is read in.

    A column that is named like one of the mix is returned as ``row_<name>``.
    """
    places = ("block", "slot", "on_target")
    own = [F.col(f"row.`{c}`").alias(f"row_{c}" if c.lower() in places else c) for c in docs.columns]
    return mixing.mix_sources(docs).select(*own, *places)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
]
# A trained classifier is no SQL; tests compare run() with a plain version of each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; a stage's input and its private tables go as soon as its output is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held: list[DataFrame] = []
    for k, (name, step) in enumerate(STAGES, 1):
        with staged_tables() as made:
            out = step(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = stage(out, name.replace(" ", "-"))
            unstage(*held, *made)
            held = [docs]
    return out
