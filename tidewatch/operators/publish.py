"""Scored tables for readers: bands, previews, the dashboard extract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from tidewatch.config import ANCHOR_KEYS, KEYS, BandCutoffs, DashboardSpec
from tidewatch.functions import risk_band_of
from tidewatch.operators.ranking import deciles_and_alerts, stratified_sample
from tidewatch.sources import existing_columns, stage


def risk_band(df: DataFrame, cutoffs: BandCutoffs = BandCutoffs(), score: str = "risk_score") -> DataFrame:
    return df.withColumn("risk_band", risk_band_of(score, cutoffs))


def score_output(
    scored: DataFrame,
    model_version: str,
    scored_at: Column,
    cutoffs: BandCutoffs = BandCutoffs(),
    keep: Sequence[str] = ("label", "split"),
) -> DataFrame:
    """Scores with band, model version and scoring time."""
    out = risk_band(scored, cutoffs).withColumns({"model_version": F.lit(model_version), "scored_at": scored_at})
    columns = [*ANCHOR_KEYS, "anchor_date", "risk_score", "risk_band", *keep, "model_version", "scored_at"]
    return out.select(*existing_columns(out, columns))


def top_risk_preview(
    scored: DataFrame, n: int = 200, score: str = "risk_score", keys: Sequence[str] = ANCHOR_KEYS
) -> DataFrame:
    """The ``n`` highest scores. Every task keeps its own ``n`` best rows, no table-wide sort."""
    return scored.orderBy(F.col(score).desc_nulls_last(), *[F.col(k).asc() for k in keys]).limit(n)


def dashboard_extract(
    scored: DataFrame,
    features: DataFrame,
    spec: DashboardSpec = DashboardSpec(),
    keys: Sequence[str] = ANCHOR_KEYS,
) -> DataFrame:
    """Sample of the scored table, half alerted, with deciles, bands and tooltip columns.

    Deciles and alerts are found on the narrow scored table. The sample, at most ``spec.rows`` rows,
    is staged once; tooltips are looked up for its rows only, and Spark picks the join by its size.
    """
    flagged = deciles_and_alerts(scored, spec.alert_rate, spec.tiles, "risk_score", keys)
    sample = stratified_sample(flagged, spec.rows, spec.alerted_fraction, spec.seed, "alert_flag", keys)
    sample = stage(sample, "dashboard-sample")
    match = [*keys, "anchor_date"]
    wanted = [c for c in existing_columns(features, spec.tooltips) if c not in sample.columns]
    tips = features.select(*match, *wanted).join(sample.select(*match), match, "left_semi")
    return (
        risk_band(sample.join(tips, match, "left"), spec.bands)
        .withColumn("anchor_datetime", F.col("anchor_time").cast("timestamp"))
        .drop("anchor_time")
    )


def alert_volume_daily(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("anchor_date").agg(
        F.count(F.lit(1)).alias("n_anchors"),
        F.count_if(F.col("alert_flag") == 1).alias("n_alerts"),
        F.avg(F.col("alert_flag").cast("double")).alias("alert_share"),
        F.avg("risk_score").alias("mean_score"),
        F.max("risk_score").alias("max_score"),
    )


def latest_risk(scored: DataFrame, score: str = "risk_score", keys: Sequence[str] = KEYS) -> DataFrame:
    """Latest score of each stay and its change since the anchor before.

    Only the two latest rows of a stay are kept, already ahead of the shuffle, so the length of a
    stay does not matter.
    """
    newest = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("anchor_time").desc()))
    two = scored.where(F.col(score).isNotNull()).select(*keys, "anchor_time", score).withColumn("__age", newest).where(F.col("__age") <= 2)

    def of_age(age: int, column: str) -> Column:
        return F.max(F.when(F.col("__age") == age, F.col(column)))

    return (
        two.groupBy(*keys)
        .agg(
            of_age(1, "anchor_time").alias("anchor_time"),
            of_age(1, score).alias("risk_score"),
            of_age(2, score).alias("previous_score"),
        )
        .withColumn("score_change", F.col("risk_score") - F.col("previous_score"))
    )
