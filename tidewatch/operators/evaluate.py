"""Model quality: areas under the curves, calibration, lead time, metrics tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from tidewatch.config import ANCHOR_KEYS, KEYS
from tidewatch.functions import hours_between, null_if_nan
from tidewatch.operators.ranking import staged_ranges, topk_metrics


def curve_areas(df: DataFrame, label: str = "label", score: str = "prob", by: Sequence[str] = ()) -> DataFrame:
    """Exact AUROC and AUPRC (trapezoids over all distinct scores), one row per group of ``by``.

    Rows collapse to one per distinct score before anything is ordered, so a common score costs
    nothing. The distinct scores are staged once, cut into ranges; running counts within a range
    plus the counts of the ranges below give the running counts overall.
    """
    rows = df.select(*by, null_if_nan(F.col(score).cast("double")).alias("s"), F.col(label).alias("y")).where(
        F.col("s").isNotNull() & F.col("y").isNotNull()
    )
    points = rows.groupBy(*by, "s").agg(
        F.count_if(F.col("y") == 1).cast("double").alias("pos"), F.count_if(F.col("y") != 1).cast("double").alias("neg")
    )
    ranged = staged_ranges(points, ["s"], "score-points")

    group = [F.col(c) for c in by] or [F.lit(0)]
    up_to_here = Window.partitionBy(*by, "__range").orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumns({"lpos": F.sum("pos").over(up_to_here), "lneg": F.sum("neg").over(up_to_here)})

    # One row per range: the windows below only see a bounded number of rows per group.
    below = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    totals = (
        ranged.groupBy(*by, "__range")
        .agg(F.sum("pos").alias("rpos"), F.sum("neg").alias("rneg"))
        .withColumns(
            {
                "bpos": F.coalesce(F.sum("rpos").over(below), F.lit(0.0)),
                "bneg": F.coalesce(F.sum("rneg").over(below), F.lit(0.0)),
                "P": F.sum("rpos").over(whole),
                "N": F.sum("rneg").over(whole),
            }
        )
        .drop("rpos", "rneg")
    )
    # Null-safe, so that rows with a null group are kept as a group.
    lookup = totals.withColumnsRenamed({c: f"__of_{c}" for c in (*by, "__range")})
    same = F.col("__range") == F.col("__of___range")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    placed = local.join(lookup, same)
    # Counts at or above a score (tp, fp) and strictly above it.
    tp = F.col("P") - (F.col("bpos") + F.col("lpos") - F.col("pos"))
    fp = F.col("N") - (F.col("bneg") + F.col("lneg") - F.col("neg"))
    tp_above, fp_above = tp - F.col("pos"), fp - F.col("neg")
    precision = tp / (tp + fp)
    above = F.coalesce(F.try_divide(tp_above, tp_above + fp_above), precision)
    pr = F.col("pos") * (precision + above) / 2.0
    roc = F.col("pos") * (F.col("bneg") + F.col("lneg") - F.col("neg") / 2.0)
    pairs = F.max("P") * F.max("N")
    return placed.groupBy(*by).agg(
        F.try_divide(F.sum(roc), pairs).alias("auroc"),
        F.try_divide(F.sum(pr), F.max("P")).alias("auprc"),
        *_counts(F.max("P"), F.max("N")),
    )


def _counts(pos: Column, neg: Column) -> list[Column]:
    return [pos.cast("bigint").alias("n_pos"), neg.cast("bigint").alias("n_neg")]


def auroc_exact(df: DataFrame, label: str = "label", score: str = "prob", by: Sequence[str] = ()) -> DataFrame:
    return curve_areas(df, label, score, by).select(*by, "auroc")


def auprc_exact(df: DataFrame, label: str = "label", score: str = "prob", by: Sequence[str] = ()) -> DataFrame:
    return curve_areas(df, label, score, by).select(*by, "auprc")


def brier(df: DataFrame, label: str = "label", score: str = "prob", by: Sequence[str] = ()) -> DataFrame:
    error = F.col(score) - F.col(label).cast("double")
    return df.groupBy(*by).agg(F.avg(error * error).alias("brier"))


def calibration(df: DataFrame, bins: int = 10, label: str = "label", score: str = "prob") -> DataFrame:
    """Rows, mean score and event rate per equal-width bin; a score of 1 belongs to the last bin."""
    s = null_if_nan(F.col(score).cast("double"))
    return (
        df.where(s.isNotNull())
        .withColumn("bin", F.least(F.floor(s * F.lit(bins)), F.lit(bins - 1)).cast("bigint"))
        .groupBy("bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(score).alias("avg_pred"),
            F.avg(F.col(label).cast("double")).alias("event_rate"),
        )
        .orderBy("bin")
    )


def lead_time(
    alerts: DataFrame,
    outcomes: DataFrame,
    keys: Sequence[str] = KEYS,
    flag: str = "alert_flag",
    outcome_time: str = "deterioration_time",
) -> DataFrame:
    """First alert ahead of each outcome and the hours between them; null where it was missed.

    Alerts shrink to one row per stay before the join.
    """
    first = alerts.where(F.col(flag) == 1).groupBy(*keys).agg(F.min("anchor_time").alias("__first"))
    ahead = F.when(F.col("__first") < F.col(outcome_time), F.col("__first"))
    return (
        outcomes.where(F.col(outcome_time).isNotNull())
        .select(*keys, outcome_time)
        .join(first, list(keys), "left")
        .select(*keys, outcome_time, ahead.alias("first_alert_time"))
        .withColumn("lead_hours", hours_between("first_alert_time", outcome_time))
    )


def lead_time_summary(leads: DataFrame) -> DataFrame:
    return leads.agg(
        F.count(F.lit(1)).alias("n_outcomes"),
        F.count("lead_hours").alias("n_caught"),
        F.avg("lead_hours").alias("mean_lead_hours"),
        F.min("lead_hours").alias("min_lead_hours"),
        F.max("lead_hours").alias("max_lead_hours"),
    )


def to_long(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Metric columns to rows ``(ids, metric, value)``."""
    wide = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(list(ids), list(metrics), "metric", "value")


def metrics_long(
    scored: DataFrame,
    run_id: str,
    label: str = "label",
    score: str = "prob",
    by: Sequence[str] = ("model", "split"),
) -> DataFrame:
    """Metrics table ``(run_id, model, split, metric, value)`` of scored rows."""
    areas = curve_areas(scored, label, score, by)
    error = F.col(score) - F.col(label).cast("double")
    simple = scored.where(F.col(score).isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.col(label).cast("double")).alias("prevalence"),
        F.avg(error * error).alias("brier"),
    )
    wide = areas.join(simple, list(by)).withColumn("run_id", F.lit(run_id))
    return to_long(wide, ["run_id", *by], ["rows", "prevalence", "brier", "auroc", "auprc"])


def topk_long(
    scored: DataFrame,
    rates: Sequence[float],
    ids: Mapping[str, str],
    label: str = "label",
    score: str = "prob",
    tie_keys: Sequence[str] = ANCHOR_KEYS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Top-k metrics in the shape of ``metrics_long``, named like ``recall_at_0.1``.

    ``ids`` are constant columns, ``by`` columns of the table whose groups are measured apart.
    """
    wide = topk_metrics(scored, rates, label, score, tie_keys, by).withColumns({k: F.lit(v) for k, v in ids.items()})
    long = to_long(wide, [*ids, *by, "k_rate"], ["precision_at_k", "recall_at_k", "lift_at_k", "base_rate"])
    name = F.concat(F.regexp_replace("metric", "_k$", "_"), F.col("k_rate").cast("string"))
    return long.withColumn("metric", F.when(F.col("metric") == "base_rate", F.col("metric")).otherwise(name)).drop("k_rate")


def select_model(metrics: DataFrame, metric: str = "auprc", split: str = "val") -> DataFrame:
    """Best model of each run by one metric. ``split='test'`` selects on the test part instead."""
    best = F.max_by("model", F.struct("value", "model"))
    return (
        metrics.where((F.col("metric") == metric) & (F.col("split") == split) & F.col("value").isNotNull())
        .groupBy("run_id")
        .agg(best.alias("model"), F.max("value").alias("value"))
    )
