"""Regular grid of anchor times over the stays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.config import KEYS, TimeGrid
from tidewatch.functions import add_micros, ceil_div, floor_div, micros_between
from tidewatch.functions.columns import MICROS_PER_HOUR


def last_anchor_index(grid: TimeGrid, stop_before: str | None = None) -> Column:
    """Index of a stay's last anchor; negative if the stay is too short, null if it has no end.

    Anchors end one cadence before the end of the stay. ``stop_before`` names a nullable
    timestamp that all anchors have to precede.
    """
    cadence = grid.cadence_h * MICROS_PER_HOUR
    offset = (grid.cadence_h + grid.warmup_h) * MICROS_PER_HOUR
    last = floor_div(micros_between(grid.start, grid.end) - F.lit(offset), cadence)
    if stop_before is not None:
        before = micros_between(grid.start, stop_before) - F.lit(grid.warmup_h * MICROS_PER_HOUR)
        # least() skips nulls, so a stay without such a time keeps its full grid.
        last = F.when(last.isNotNull(), F.least(last, ceil_div(before, cadence) - 1))
    return last


def anchor_time_of(grid: TimeGrid, index: Column) -> Column:
    step = F.lit(grid.cadence_h * MICROS_PER_HOUR).cast("bigint")
    return add_micros(grid.start, index * step + F.lit(grid.warmup_h * MICROS_PER_HOUR))


def anchor_grid(
    stays: DataFrame,
    grid: TimeGrid = TimeGrid(),
    keys: Sequence[str] = KEYS,
    stop_before: str | None = None,
    metadata: bool = False,
) -> DataFrame:
    """One row per anchor: keys, ``anchor_time``, ``anchor_date``.

    ``metadata`` starts the grid at the beginning of the stay and adds ``anchor_seq``,
    ``warmup_hours`` and ``is_valid_anchor`` instead of leaving out the warm-up.
    """
    laid = TimeGrid(grid.cadence_h, 0, grid.windows_h, grid.start, grid.end) if metadata else grid
    # explode() of null yields no row, for stays that are too short.
    steps = F.when(F.col("__last") >= 0, F.sequence(F.lit(0).cast("bigint"), F.col("__last")))
    out = (
        stays.withColumn("__last", last_anchor_index(laid, stop_before))
        .withColumn("__k", F.explode(steps))
        .withColumn("anchor_time", anchor_time_of(laid, F.col("__k")))
        .withColumn("anchor_date", F.to_date("anchor_time"))
    )
    columns = [*keys, "anchor_time", "anchor_date"]
    if metadata:
        warm = F.col("__k") * grid.cadence_h >= grid.warmup_h
        out = out.withColumns(
            {
                "anchor_seq": F.col("__k").cast("int"),
                "warmup_hours": F.lit(grid.warmup_h),
                "is_valid_anchor": F.when(warm, 1).otherwise(0),
            }
        )
        columns += ["anchor_seq", "warmup_hours", "is_valid_anchor"]
    return out.select(*columns)


def anchor_grid_censored(
    stays: DataFrame,
    outcomes: DataFrame,
    grid: TimeGrid = TimeGrid(),
    keys: Sequence[str] = KEYS,
    outcome_time: str = "deterioration_time",
    buffer_h: int = 0,
) -> DataFrame:
    """Grid that stops before the outcome, or ``buffer_h`` hours ahead of it.

    The outcome is joined to the stays, before the grid multiplies their rows.
    """
    stop = add_micros(F.col(outcome_time), F.lit(-buffer_h * MICROS_PER_HOUR))
    ends = outcomes.where(F.col(outcome_time).isNotNull()).groupBy(*keys).agg(F.min(stop).alias("__stop"))
    return anchor_grid(stays.join(ends, list(keys), "left"), grid, keys, stop_before="__stop")
