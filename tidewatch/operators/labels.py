"""Horizon labels at the anchors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidewatch.config import KEYS, Horizon
from tidewatch.functions import add_micros
from tidewatch.functions.columns import MICROS_PER_HOUR


def label_horizon(
    anchors: DataFrame,
    outcomes: DataFrame,
    horizon: Horizon = Horizon(),
    keys: Sequence[str] = KEYS,
    flag: str = "deterioration",
    outcome_time: str = "deterioration_time",
) -> DataFrame:
    """1 if the outcome lies in ``(anchor + min, anchor + max]``, else 0, also without an outcome.

    ``outcomes`` holds at most one row per stay; Spark broadcasts it when its size permits, and
    AQE splits a stay that holds very many anchors.
    """
    bare = anchors.select(*keys, "anchor_time", "anchor_date")
    labelled = with_labels(bare, outcomes, horizon, keys, flag, outcome_time)
    return labelled.select(*keys, "anchor_time", "anchor_date", "label", outcome_time)


def with_labels(
    rows: DataFrame,
    outcomes: DataFrame,
    horizon: Horizon = Horizon(),
    keys: Sequence[str] = KEYS,
    flag: str = "deterioration",
    outcome_time: str = "deterioration_time",
) -> DataFrame:
    """Label rows that carry an ``anchor_time``, such as features, where they are.

    Equals joining them with ``label_horizon`` by anchor, without shuffling the wide rows by
    anchor for it.
    """
    opens = add_micros("anchor_time", F.lit(horizon.min_h * MICROS_PER_HOUR))
    closes = add_micros("anchor_time", F.lit(horizon.max_h * MICROS_PER_HOUR))
    at = F.col(outcome_time)
    hit = (F.col(flag) == 1) & (at > opens) & (at <= closes)
    return (
        rows.join(outcomes.select(*keys, flag, outcome_time), list(keys), "left")
        .withColumn("label", F.when(hit, 1).otherwise(0))
        .drop(flag)
    )
