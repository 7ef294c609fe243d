"""Session settings the operators are tuned for. All are optional: results do not depend on them."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Time arithmetic on zone-less timestamps is read in the session's zone.
REQUIRED = {"spark.sql.session.timeZone": "UTC"}
# AQE splits oversized partitions of joins and of writes by partition column.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also where what follows the join then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in {**REQUIRED, **RECOMMENDED}.items():
        builder = builder.config(key, value)
    return builder
