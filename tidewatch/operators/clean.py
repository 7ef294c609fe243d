"""Bronze to silver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from tidewatch.config import CLIP_RANGES, KEYS, SEX_VALUES, SOFT_RANGES
from tidewatch.functions import canonical_enum, clip, null_if_nan
from tidewatch.sources import existing_columns


def clip_signals(df: DataFrame, ranges: Mapping[str, tuple[float, float]] = CLIP_RANGES) -> DataFrame:
    """Winsorise every signal that is present, in one projection."""
    return df.withColumns({c: clip(c, *ranges[c]) for c in existing_columns(df, list(ranges))})


def range_flags(df: DataFrame, ranges: Mapping[str, tuple[float, float]] = SOFT_RANGES) -> DataFrame:
    """Add ``<signal>_oor`` (1 outside its soft range, else 0); values stay as they are."""

    def outside(c: str) -> Column:
        lo, hi = ranges[c]
        v = null_if_nan(c)
        return F.when((v < lo) | (v > hi), 1).otherwise(0)

    return df.withColumns({f"{c}_oor": outside(c) for c in existing_columns(df, list(ranges))})


def dedupe_latest(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], tie_break: Sequence[str] | None = None
) -> DataFrame:
    """Keep the row of each key that is last by ``order_by``, then by ``tie_break``.

    The tie-break defaults to all other columns, so the survivor is the same on every run.
    Filtering row_number to 1 lets Spark reduce each key within its task before the shuffle:
    a key with many copies arrives as one row per task.
    """
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in {*keys, *order_by}]
    latest_first = [F.col(c).desc_nulls_last() for c in (*order_by, *tie_break)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*latest_first))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def standardize_enum(
    df: DataFrame, column: str, allowed: Sequence[str] = SEX_VALUES, other: str | None = "U"
) -> DataFrame:
    return df.withColumn(column, canonical_enum(column, allowed, other))


def normalize_time(df: DataFrame, column: str, zone: str | None = None, fmt: str | None = None) -> DataFrame:
    """Parse text to a timestamp (unparseable becomes null) and shift local time of ``zone`` to UTC."""
    c = F.col(column)
    if df.schema[column].dataType.simpleString() == "string":
        c = F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)
    if zone is not None:
        c = F.to_utc_timestamp(c, zone)
    return df.withColumn(column, c)


def to_utc(df: DataFrame, columns: Sequence[str], zone: str | None) -> DataFrame:
    """Local times of ``zone`` as UTC, and the date partition that follows from an event's time."""
    if zone is None:
        return df
    for c in columns:
        df = normalize_time(df, c, zone)
    return df.withColumn("event_date", F.to_date("event_time")) if {"event_time", "event_date"} <= set(df.columns) else df


def valid_intervals(df: DataFrame, start: str = "admit_time", end: str = "discharge_time") -> DataFrame:
    """Stays with a start that lies before their end; a stay without an end is still going on."""
    return df.where(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(start) < F.col(end))))


def valid_outcomes(
    outcomes: DataFrame,
    stays: DataFrame,
    keys: Sequence[str] = KEYS,
    outcome_time: str = "deterioration_time",
    start: str = "admit_time",
    end: str = "discharge_time",
) -> DataFrame:
    """Outcomes without a time, or with one inside their stay."""
    t = F.col(outcome_time)
    inside = t.isNull() | ((t >= F.col(start)) & (F.col(end).isNull() | (t <= F.col(end))))
    bounds = stays.select(*keys, start, end)
    return outcomes.join(bounds, list(keys)).where(inside).select(*outcomes.columns)


def silver_events(
    bronze: DataFrame,
    ranges: Mapping[str, tuple[float, float]] = CLIP_RANGES,
    keys: Sequence[str] = (*KEYS, "event_time"),
    order_by: Sequence[str] = ("_ingest_ts",),
) -> DataFrame:
    """Clip, drop rows without keys, keep the latest record of each key."""
    keyed = clip_signals(bronze, ranges).dropna(subset=list(keys))
    return dedupe_latest(keyed, keys, existing_columns(keyed, order_by))
