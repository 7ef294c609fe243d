"""The logical tables of the domain, derived from the shared star-schema tables.

Every user is a patient, every five days of the month a stay; events of the types view, click
and signup are vital signs, purchases are lab results, large errors are outcomes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

ORIGIN = "2024-01-01 00:00:00"
STAY_DAYS = 5
OUTCOME_ABOVE = 100.0


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _keyed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    origin = F.lit(ORIGIN).cast("timestamp_ntz")
    block = F.floor(F.datediff("ts", origin) / STAY_DAYS)
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("patient_id"),
        (F.col("user_id") * 100 + block).alias("admission_id"),
        block.cast("int").alias("block"),
        F.col("ts").alias("event_time"),
        "event_id",
        "event_type",
        "value",
        "props",
    )


def stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    origin = F.lit(ORIGIN).cast("timestamp_ntz")
    keyed = _keyed_events(spark, sf_dir).select("patient_id", "admission_id", "block").distinct()
    return keyed.select(
        "patient_id",
        "admission_id",
        F.timestamp_add("DAY", F.col("block") * STAY_DAYS, origin).alias("admit_time"),
        F.timestamp_add("DAY", (F.col("block") + 1) * STAY_DAYS, origin).alias("discharge_time"),
    )


def _of_type(event_type: str, value="value"):
    return F.when(F.col("event_type") == event_type, F.col(value) if isinstance(value, str) else value)


def vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _keyed_events(spark, sf_dir).where(F.col("event_type").isin("view", "click", "signup"))
    return keyed.select(
        "patient_id",
        "admission_id",
        "event_time",
        _of_type("view").alias("hr"),
        _of_type("click").alias("sbp"),
        _of_type("signup").alias("spo2"),
    )


def labs(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _keyed_events(spark, sf_dir).where(F.col("event_type") == "purchase")
    return keyed.select(
        "patient_id",
        "admission_id",
        "event_time",
        F.col("value").alias("lactate"),
        F.get_json_object("props", "$.k").cast("double").alias("creatinine"),
    )


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most one outcome per stay: its first large error."""
    keyed = _keyed_events(spark, sf_dir).where((F.col("event_type") == "error") & (F.col("value") > OUTCOME_ABOVE))
    return keyed.groupBy("patient_id", "admission_id").agg(
        F.lit(1).alias("deterioration"), F.min("event_time").alias("deterioration_time")
    )


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("patient_id"),
        F.col("c_acctbal").alias("admit_acuity"),
        F.col("c_nationkey").alias("comorbidity_count"),
        F.col("c_mktsegment").alias("segment"),
    )


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents scored by their length."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return (
        table(spark, sf_dir, "labels")
        .join(docs, "doc_id")
        .select(
            "doc_id",
            "lang",
            F.col("quality").alias("label"),
            F.least(F.col("n_chars") / F.lit(20000.0), F.lit(1.0)).alias("prob"),
        )
    )
