"""Drift of whole distributions, from quantile sketches kept per run.

A run keeps one KLL sketch per signal: a few kilobytes, whatever the number of values, combined by
each task before the shuffle and mergeable ever after. Two runs are compared by their sketches alone,
without the tables they were taken of.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.functions import null_if_nan
from tidewatch.operators.quality import WARN

# Values a sketch keeps per level, and the rank error that it has at most with 99 % confidence.
SKETCH_K, RANK_ERROR = 200, 0.0165
# Quantiles at which two sketches are compared.
STEPS = 100


def signal_sketches(df: DataFrame, signals: Sequence[str], run_id: str, k: int = SKETCH_K) -> DataFrame:
    """(signal, n, sketch, run_id) of each signal's values, null and NaN left out; one aggregation.

    A signal without a value has a null sketch.
    """
    values = {s: null_if_nan(F.col(s).cast("double")) for s in signals}
    one = df.agg(
        F.array(
            *[
                F.struct(F.lit(s).alias("signal"), F.count(v).alias("n"), F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch"))
                for s, v in values.items()
            ]
        ).alias("rows")
    )
    rows = one.select(F.explode("rows").alias("r")).select("r.signal", "r.n", "r.sketch")
    return rows.withColumns({"sketch": F.when(F.col("n") > 0, F.col("sketch")), "run_id": F.lit(run_id)})


def merged(sketches: DataFrame, by: Sequence[str] = ("signal",)) -> DataFrame:
    """Sketches of several runs as one per group, as if their values had been sketched together."""
    some = sketches.where(F.col("sketch").isNotNull())
    return some.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def rank_distance(a: Column, b: Column, steps: int = STEPS) -> Column:
    """Largest difference of two sketches' ranks over the quantiles of both (Kolmogorov and Smirnov's distance).

    A value's rank in a sketch is told by how many of the sketch's quantiles do not exceed it.
    """
    grid = F.array(*[F.lit(i / steps) for i in range(steps + 1)])
    qa, qb = (F.kll_sketch_get_quantile_double(x, grid) for x in (a, b))

    def rank(quantiles: Column, x: Column) -> Column:
        return F.size(F.filter(quantiles, lambda q: q <= x))

    both = F.struct(qa.alias("a"), qb.alias("b"))
    # Bound to a name, so that a sketch is read once and not once per value.
    gaps = F.transform(
        F.array(both), lambda q: F.array_max(F.transform(F.concat(q["a"], q["b"]), lambda x: F.abs(rank(q["a"], x) - rank(q["b"], x))))
    )
    return F.element_at(gaps, 1) / steps


def distribution_drift(sketches: DataFrame, limit: float = 0.10, steps: int = STEPS) -> DataFrame:
    """(signal, run_id, before, distance, at_least, at_most, passed): each run against the one before.

    The true distance lies between ``at_least`` and ``at_most``, by the sketches' errors and the grid's.
    A run passes unless it is sure that the distance exceeds ``limit``. Runs without a value are
    passed over.
    """
    runs = Window.partitionBy("signal").orderBy("run_id")
    some = sketches.where(F.col("sketch").isNotNull())
    pairs = some.withColumns({"before": F.lag("run_id").over(runs), "earlier": F.lag("sketch").over(runs)}).where("before is not null")
    off = 2 * (RANK_ERROR + 1 / steps)
    measured = pairs.withColumn("distance", rank_distance(F.col("sketch"), F.col("earlier"), steps))
    return measured.select(
        "signal",
        "run_id",
        "before",
        "distance",
        F.greatest(F.col("distance") - off, F.lit(0.0)).alias("at_least"),
        F.least(F.col("distance") + off, F.lit(1.0)).alias("at_most"),
        (F.col("distance") - off <= limit).alias("passed"),
    )


def check_distribution(sketches: DataFrame, limit: float = 0.10, layer: str = "silver") -> DataFrame:
    """``distribution_drift`` as rows of the quality table."""
    found = distribution_drift(sketches, limit)
    return found.select(
        F.lit("distribution").alias("check"),
        F.lit(layer).alias("layer"),
        F.lit(WARN).alias("severity"),
        F.concat_ws("@", "signal", F.col("run_id").cast("string")).alias("metric"),
        F.col("distance").alias("value"),
        "passed",
    )
