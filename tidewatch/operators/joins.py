"""Joins whose large side may hold most of its rows under a few keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions import floor_div, micros_between
from tidewatch.functions.columns import MICROS_PER_HOUR, micros_of

# A key below this many rows is comfortable for one task.
HOT_ROWS = 5_000_000

_SALT = "__salt"
_SALTS = "__salts"


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """All keys with more than ``hot_rows`` rows and the number of parts (``__salts``) to cut each into.

    A lazy aggregation over the key columns, combined before its shuffle.
    """
    counted = df.where(_all_set(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > hot_rows).select(*keys, F.ceil(F.col("n") / F.lit(hot_rows)).cast("int").alias(_SALTS))


def _all_set(keys: Sequence[str]) -> Column:
    cond = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        cond = cond & F.col(k).isNotNull()
    return cond


def spread_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    spread_on: Sequence[str],
    how: str = "inner",
    hot_rows: int | None = None,
) -> DataFrame:
    """Equi-join of many rows with few rows per key (``inner`` or ``left``), safe for hot keys.

    Without ``hot_rows`` this is a plain join: Spark chooses the strategy, and its adaptive
    execution splits a skewed partition (see ``session``). With it, rows of any key above that many
    are spread over parts by the hash of ``spread_on`` and the matching rows of ``small`` are
    repeated once per part, so every pair still meets exactly once, at the price of one more pass
    over the keys. Nothing is collected; the table of hot keys is joined as Spark sees fit.
    """
    if how not in ("inner", "left"):
        raise ValueError("spread_join supports inner and left joins")
    keys = list(keys)
    if hot_rows is None:
        return big.join(small, keys, how)

    hot = hot_keys(big, keys, hot_rows)
    parts = F.coalesce(F.col(_SALTS), F.lit(1))
    left = (
        big.join(hot, keys, "left")
        .withColumn(_SALT, F.pmod(F.xxhash64(*spread_on), parts).cast("int"))
        .drop(_SALTS)
    )
    right = (
        small.join(hot, keys, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop(_SALTS)
    )
    return left.join(right, [*keys, _SALT], how).drop(_SALT)


def range_join_bucketed(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    width_h: float,
    hot_rows: int | None = None,
) -> DataFrame:
    """Pairs with ``left_ts - width < right_ts <= left_ts`` under equal keys, for irregular times.

    Time is cut into buckets of the width. A left row looks into its own bucket and the one
    before, so an equi-join on keys and bucket meets every pair once, and a left row only meets
    right rows at most two widths away. ``right`` is spread where one bucket of a key is hot.
    """
    width = int(width_h * MICROS_PER_HOUR)
    bucket = floor_div(micros_of(left_ts), width)
    lefts = left.withColumn("__bucket", F.explode(F.array(bucket - 1, bucket)))
    rights = right.where(F.col(right_ts).isNotNull()).withColumn(
        "__bucket", floor_div(micros_of(right_ts), width)
    )
    gap = micros_between(right_ts, left_ts)
    return (
        spread_join(rights, lefts, [*keys, "__bucket"], [right_ts], "inner", hot_rows)
        .where((gap >= 0) & (gap < width))
        .drop("__bucket")
    )


def orphan_rows(events: DataFrame, stays: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Event rows whose keys have no stay."""
    return events.join(stays.select(*keys), list(keys), "left_anti")


def orphan_keys(events: DataFrame, stays: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys without a stay and their number of events.

    Events are counted per key first: a hot key reaches the join as one row.
    """
    per_key = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_events"))
    return per_key.join(stays.select(*keys), list(keys), "left_anti")
