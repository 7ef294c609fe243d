"""Trailing-window features at the anchors.

The anchors of a stay form a regular grid, so nothing has to compare events with anchors. Time
since the start of a stay is cut into panes whose width divides the cadence and every window;
each event lies in exactly one pane. Events are reduced to one row per pane (combined before the
shuffle), and only pane rows are repeated for the anchors that look back on them. All windows
and signals come out of the same two aggregations.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, Window

from tidewatch.config import (
    ANCHOR_KEYS,
    DEFAULT_LAB_STATS,
    DEFAULT_VITAL_STATS,
    KEYS,
    SignalStats,
    TimeGrid,
)
from tidewatch.functions import ceil_div, derived_from_last, floor_div, micros_between
from tidewatch.functions.columns import MICROS_PER_HOUR, micros_of
from tidewatch.operators.anchors import anchor_time_of, last_anchor_index
from tidewatch.operators.joins import range_join_bucketed, spread_join

# Pane columns each statistic is computed from.
_NEEDS = {
    "mean": {"n", "sum"},
    "min": {"min"},
    "max": {"max"},
    "range": {"min", "max"},
    "std": {"n", "sum", "m2"},
    "last": {"last"},
    "delta": {"first", "last", "first_ts", "last_ts"},
    "slope": {"first", "last", "first_ts", "last_ts"},
    "slope_fit": {"n", "sum", "sx", "sxx", "cxy", "first", "last", "first_ts", "last_ts"},
    "count": {"n"},
    "missing_rate": {"n"},
    "tslm": {"last_ts"},
}
ALL_STATS = tuple(_NEEDS)

# Rows of anchors that one task sorts; a few hundred MB with many signals and statistics.
ROWS_PER_PART = 250_000


@dataclass(frozen=True)
class EventFamily:
    """Events that are recorded together (vitals, labs) and the statistics wanted of them.

    Keys and ``event_time`` are expected to be unique, as after ``dedupe_latest``.
    """

    name: str
    events: DataFrame
    stats: tuple[SignalStats, ...]

    @property
    def signals(self) -> list[str]:
        return [s.signal for s in self.stats]


def vitals_family(events: DataFrame, stats: Sequence[SignalStats] = DEFAULT_VITAL_STATS) -> EventFamily:
    return EventFamily("vitals", events, tuple(stats))


def labs_family(events: DataFrame, stats: Sequence[SignalStats] = DEFAULT_LAB_STATS) -> EventFamily:
    return EventFamily("labs", events, tuple(stats))


def feature_name(signal: str, stat: str, window_h: int) -> str:
    return f"{signal}_{stat}_{window_h}h"


def _pane_hours(grid: TimeGrid) -> int:
    return math.gcd(grid.cadence_h, grid.warmup_h, *grid.windows_h)


def _reach(grid: TimeGrid) -> int:
    """Panes of the longest window."""
    return max(grid.windows_h) // _pane_hours(grid)


def _anchor_pane(k: Column, grid: TimeGrid) -> Column:
    """The pane that ends at the k-th anchor."""
    pane_h = _pane_hours(grid)
    return k * (grid.cadence_h // pane_h) + F.lit(grid.warmup_h // pane_h)


def _parts(stays: DataFrame, families: Sequence[EventFamily], grid: TimeGrid, keys: Sequence[str], whole_grid: bool) -> int:
    """Parts that keep the rows of anchors of one task at ``ROWS_PER_PART``, however many there are.

    An event is repeated for as many anchors as fit into the longest window, a bare grid for all of its
    anchors. Rows are counted in one pass over keys and times.
    """
    copies = math.ceil(max(grid.windows_h) / grid.cadence_h)
    rows = _event_stream(families, keys).select(F.lit(copies).cast("bigint").alias("n"))
    if whole_grid:
        rows = rows.unionByName(stays.select(F.greatest(last_anchor_index(grid) + 1, F.lit(0)).cast("bigint").alias("n")))
    session = int(stays.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(session, math.ceil((rows.agg(F.sum("n")).first()[0] or 0) / ROWS_PER_PART))


def _dealt(df: DataFrame, keys: Sequence[str], parts: int | None) -> DataFrame:
    """Rows by stay, in ``parts`` or else in as many as the session shuffles into.

    A few bytes of events become wide rows for each anchor that looks back on them, so parts that are
    merged by the bytes of events would hold far more than a task should.
    """
    return df.repartition(parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _event_stream(families: Sequence[EventFamily], keys: Sequence[str]) -> DataFrame:
    """All families as one stream of rows; columns of the other families are null."""
    stream = None
    for f in families:
        part = f.events.select(*keys, "event_time", *f.signals).withColumn("__family", F.lit(f.name))
        stream = part if stream is None else stream.unionByName(part, allowMissingColumns=True)
    return stream.where(F.col("event_time").isNotNull())


def _wanted(spec: SignalStats) -> set[str]:
    unknown = [s for s in spec.stats if s not in _NEEDS]
    if unknown:
        raise ValueError(f"unknown statistics for {spec.signal}: {unknown}")
    return set().union(*(_NEEDS[s] for s in spec.stats))


def _pivoted(spec: SignalStats) -> bool:
    return not {"std", "slope_fit"}.isdisjoint(spec.stats)


def _pane_aggregates(family: EventFamily) -> list[Column]:
    """Partial statistics of one pane. ``__hours`` is the time from the pane's end (<= 0)."""
    aggs = [f"count_if(__family = '{family.name}') AS rows__{family.name}"]
    for spec in family.stats:
        v = f"`{spec.signal}`"
        seen_at = f"CASE WHEN {v} IS NOT NULL THEN event_time END"
        hours = f"CASE WHEN {v} IS NOT NULL THEN __hours END"
        available = {
            "n": f"count({v})",
            "sum": f"sum({v})",
            "min": f"min({v})",
            "max": f"max({v})",
            "m2": f"var_pop({v}) * count({v})",
            "first": f"min_by({v}, {seen_at})",
            "last": f"max_by({v}, {seen_at})",
            "first_ts": f"min({seen_at})",
            "last_ts": f"max({seen_at})",
            "sx": f"sum({hours})",
            "sxx": f"sum({hours} * __hours)",
            "cxy": f"covar_pop({hours}, {v}) * count({v})",
        }
        wanted = _wanted(spec)
        aggs += [f"{sql} AS {name}__{spec.signal}" for name, sql in available.items() if name in wanted]
    return [F.expr(a) for a in aggs]


def build_panes(
    stays: DataFrame,
    families: Sequence[EventFamily],
    grid: TimeGrid,
    keys: Sequence[str] = KEYS,
    hot_rows: int | None = None,
    whole_grid: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """One row per stay and non-empty pane, holding combinable partial statistics.

    Pane j covers ``(start + (j-1)*width, start + j*width]``; events ahead of the stay fall into
    pane 0 and below. Events too old for the first anchor or after the last one are left out.
    ``whole_grid`` adds a row without a pane for every stay. It travels with the events, so that
    panes stay clustered by the one shuffle that brings events and stays together.
    """
    width = _pane_hours(grid) * MICROS_PER_HOUR
    bounded = stays.select(*keys, grid.start, last_anchor_index(grid).alias("__last"))
    since = micros_between(grid.start, "event_time")
    stream = _event_stream(families, keys)
    if whole_grid:
        stream = stream.unionByName(stays.select(*keys), allowMissingColumns=True)
    if hot_rows is None:
        # Both sides: adaptive execution may broadcast either, and would merge the parts of the other.
        stream, bounded = _dealt(stream, keys, parts), _dealt(bounded, keys, parts)
    seen = F.col("__pane").between(1 - _reach(grid), _anchor_pane(F.col("__last"), grid))
    events = (
        spread_join(stream, bounded, keys, ["event_time"], "inner", hot_rows)
        .withColumn("__pane", ceil_div(since, width))
        .where(seen | F.col("event_time").isNull() if whole_grid else seen)
        .withColumn("__hours", (since - F.col("__pane") * F.lit(width)).cast("double") / float(MICROS_PER_HOUR))
    )
    aggs = [a for f in families for a in _pane_aggregates(f)]
    return events.groupBy(*keys, grid.start, "__last", "__pane").agg(
        F.max("event_time").alias("max_event_time"), *aggs
    )


def _panes_at_anchors(
    panes: DataFrame, grid: TimeGrid, keys: Sequence[str], pivots: Sequence[str] = (), parts: int | None = None
) -> DataFrame:
    """Repeat each pane for the anchors whose longest window covers it.

    ``__back`` counts the panes between a pane and its anchor; a window of m panes covers
    ``__back < m``. A row without a pane is repeated for all anchors of its stay, with null
    ``__back``.

    Panes are brought together by stay first. A stay has no more panes than its duration allows,
    however many events it holds, and the aggregation per anchor then needs no further shuffle.
    """
    pane_h, reach = _pane_hours(grid), _reach(grid)
    first = F.greatest(
        F.lit(0).cast("bigint"), ceil_div(F.col("__pane") * pane_h - F.lit(grid.warmup_h), grid.cadence_h)
    )
    last = F.least(
        F.col("__last"),
        floor_div((F.col("__pane") + F.lit(reach - 1)) * pane_h - F.lit(grid.warmup_h), grid.cadence_h),
    )
    anchor_pane = _anchor_pane(F.col("__k"), grid)
    # explode() of null yields no row, for panes that no anchor looks back on.
    clustered = _dealt(panes, keys, parts)
    repeated = (
        clustered.withColumns({"__first": first, "__until": last})
        .withColumn("__k", F.explode(F.when(F.col("__first") <= F.col("__until"), F.sequence("__first", "__until"))))
        .withColumns({"anchor_time": anchor_time_of(grid, F.col("__k")), "__back": anchor_pane - F.col("__pane")})
        .drop(grid.start, "__last", "__pane", "__first", "__until", "__k")
    )
    if not pivots:
        return repeated
    # The latest pane with a value lies in each window of the anchor that holds any value at all.
    latest_first = Window.partitionBy(*keys, "anchor_time").orderBy("__back").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    means = {f"pivot__{s}": F.first(F.try_divide(f"sum__{s}", f"n__{s}"), True).over(latest_first) for s in pivots}
    return repeated.withColumns(means)


def _window_aggregates(family: EventFamily, window_h: int, grid: TimeGrid) -> tuple[list[Column], list[Column]]:
    """Aggregates over the panes of one window, and the features computed from them."""
    pane_h = _pane_hours(grid)
    inside = f"__back < {window_h // pane_h}"
    lag_h = f"(__back * {float(pane_h)}D)"
    rows = f"rows__{family.name}__{window_h}"
    aggs = [f"sum(CASE WHEN {inside} THEN rows__{family.name} END) AS {rows}"]
    features = []
    for spec in family.stats:
        s = spec.signal
        n, total, sx = f"n__{s}", f"sum__{s}", f"sx__{s}"
        off = f"({total} / {n} - pivot__{s})"

        def seen(column: str) -> str:
            return f"CASE WHEN {inside} AND {column} IS NOT NULL THEN -__back END"

        available = {
            "n": f"sum(CASE WHEN {inside} THEN {n} END)",
            "sum": f"sum(CASE WHEN {inside} THEN {total} END)",
            "min": f"min(CASE WHEN {inside} THEN min__{s} END)",
            "max": f"max(CASE WHEN {inside} THEN max__{s} END)",
            # Squares and products are taken about the mean of the window's latest pane: values far from
            # zero, or far from this window's, would leave no digits for their differences.
            "dev": f"sum(CASE WHEN {inside} THEN {n} * {off} END)",
            "m2": f"sum(CASE WHEN {inside} THEN m2__{s} + {n} * {off} * {off} END)",
            "first": f"min_by(first__{s}, {seen(f'first__{s}')})",
            "last": f"max_by(last__{s}, {seen(f'last__{s}')})",
            "first_ts": f"min(CASE WHEN {inside} THEN first_ts__{s} END)",
            "last_ts": f"max(CASE WHEN {inside} THEN last_ts__{s} END)",
            # Times of the fit are shifted from the pane's end to the anchor.
            "sx": f"sum(CASE WHEN {inside} THEN {sx} - {n} * {lag_h} END)",
            "sxx": f"sum(CASE WHEN {inside} THEN sxx__{s} - 2.0D * {lag_h} * {sx} + {n} * {lag_h} * {lag_h} END)",
            "cxy": f"sum(CASE WHEN {inside} THEN cxy__{s} + ({sx} - {n} * {lag_h}) * {off} END)",
        }
        wanted = _wanted(spec)
        if _pivoted(spec):
            wanted = wanted | {"dev"}
        got = {name: f"{name}__{s}__{window_h}" for name in available if name in wanted}
        aggs += [f"{available[name]} AS {alias}" for name, alias in got.items()]
        features += [f"{_finish(stat, got, rows)} AS {feature_name(s, stat, window_h)}" for stat in spec.stats]
    return [F.expr(a) for a in aggs], [F.expr(f) for f in features]


def _hours_sql(start: str, end: str) -> str:
    return f"((unix_micros(CAST({end} AS timestamp)) - unix_micros(CAST({start} AS timestamp))) / {MICROS_PER_HOUR}D)"


def _finish(stat: str, g: dict[str, str], rows: str) -> str:
    """SQL of a feature from the combined statistics ``g`` of its window."""
    if stat == "mean":
        return f"try_divide({g['sum']}, {g['n']})"
    if stat in ("min", "max", "last"):
        return g[stat]
    if stat == "range":
        return f"{g['max']} - {g['min']}"
    if stat == "std":
        centred = f"greatest({g['m2']} - {g['dev']} * {g['dev']} / {g['n']}, 0.0D)"
        return f"CASE WHEN {g['n']} > 1 THEN sqrt({centred} / ({g['n']} - 1)) END"
    if stat in ("delta", "slope", "slope_fit"):
        two_times = f"{g['first_ts']} < {g['last_ts']}"
        delta = f"({g['last']} - {g['first']})"
        if stat == "delta":
            return f"CASE WHEN {two_times} THEN {delta} END"
        slope = f"{delta} / {_hours_sql(g['first_ts'], g['last_ts'])}"
        if stat == "slope":
            return f"CASE WHEN {two_times} THEN {slope} END"
        # Two points define the line exactly; sums of squares would lose digits when they are close.
        co = f"{g['n']} * {g['cxy']} - {g['sx']} * {g['dev']}"
        spread = f"{g['n']} * {g['sxx']} - {g['sx']} * {g['sx']}"
        return f"CASE WHEN {two_times} AND {g['n']} = 2 THEN {slope} WHEN {two_times} THEN try_divide({co}, {spread}) END"
    if stat == "count":
        # Null, not zero, where the window holds no row of the family at all.
        return f"CASE WHEN {rows} > 0 THEN {g['n']} END"
    if stat == "missing_rate":
        return f"CASE WHEN {rows} > 0 THEN 1.0D - CAST({g['n']} AS double) / {rows} END"
    if stat == "tslm":
        return _hours_sql(g["last_ts"], "anchor_time")
    raise ValueError(stat)


def _features(
    stays: DataFrame,
    families: Sequence[EventFamily],
    grid: TimeGrid,
    keys: Sequence[str],
    hot_rows: int | None,
    whole_grid: bool,
    audit: bool,
) -> DataFrame:
    # The row without a pane stands for a stay's bare grid and keeps anchors without events, so the
    # features need no join with the anchors.
    parts = _parts(stays, families, grid, keys, whole_grid)
    panes = build_panes(stays, families, grid, keys, hot_rows, whole_grid, parts)
    pivots = [s.signal for f in families for s in f.stats if _pivoted(s)]
    at_anchors = _panes_at_anchors(panes, grid, keys, pivots, parts)
    aggs: list[Column] = []
    features: list[Column] = []
    for w in grid.windows_h:
        for f in families:
            combined, finished = _window_aggregates(f, w, grid)
            aggs += combined
            features += finished
    if audit:
        aggs.append(F.max("max_event_time").alias("max_event_time"))
    # A struct among the aggregates has Spark sort the rows, which spill one by one, and finish anchor
    # after anchor; without it two maps of all anchors of a task would be held in memory.
    aggs.append(F.max(F.struct("anchor_time")).alias("__at"))
    out = at_anchors.groupBy(*keys, "anchor_time").agg(*aggs).where(F.col("__at").isNotNull())
    tail = [F.col("max_event_time")] if audit else []
    return out.select(*keys, "anchor_time", *features, *tail)


def window_features(
    stays: DataFrame,
    families: Sequence[EventFamily],
    grid: TimeGrid = TimeGrid(),
    keys: Sequence[str] = KEYS,
    hot_rows: int | None = None,
    audit: bool = False,
) -> DataFrame:
    """Features named ``<signal>_<stat>_<w>h`` for anchors with an event in their longest window.

    ``audit`` adds ``max_event_time``, the latest event an anchor's features were computed from.
    """
    return _features(stays, families, grid, keys, hot_rows, whole_grid=False, audit=audit)


def gold_features(
    stays: DataFrame,
    families: Sequence[EventFamily],
    grid: TimeGrid = TimeGrid(),
    keys: Sequence[str] = KEYS,
    hot_rows: int | None = None,
    count_fill_zero: bool = False,
    audit: bool = False,
) -> DataFrame:
    """Features of every anchor of the grid, with ``anchor_date``; anchors without events keep nulls."""
    out = _features(stays, families, grid, keys, hot_rows, whole_grid=True, audit=audit)
    out = out.withColumn("anchor_date", F.to_date("anchor_time"))
    return fill_counts(out) if count_fill_zero else out


def fill_counts(features: DataFrame) -> DataFrame:
    """Zero instead of null in the ``*_count_*h`` columns."""
    counts = [c for c in features.columns if "_count_" in c]
    return features.fillna(0, counts)


def merge_on_anchors(parts: Sequence[DataFrame], how: str = "full_outer", keys: Sequence[str] = ANCHOR_KEYS) -> DataFrame:
    """Merge feature tables that were computed apart (unneeded within ``window_features``)."""
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.join(p, list(keys), how)
    return merged


def asof_last(
    stays: DataFrame,
    family: EventFamily,
    within_h: int,
    grid: TimeGrid = TimeGrid(),
    keys: Sequence[str] = KEYS,
    hot_rows: int | None = None,
) -> DataFrame:
    """Latest non-null value of each signal at or before the anchor, at most ``within_h`` back."""
    only = EventFamily(family.name, family.events, tuple(SignalStats(s, ("last", "tslm")) for s in family.signals))
    one = TimeGrid(grid.cadence_h, grid.warmup_h, (within_h,), grid.start, grid.end)
    return window_features(stays, [only], one, keys, hot_rows)


IRREGULAR_STATS = ("mean", "min", "max", "std", "last", "count")


def irregular_window_features(
    anchors: DataFrame,
    events: DataFrame,
    signal: str,
    window_h: int,
    keys: Sequence[str] = KEYS,
    hot_rows: int | None = None,
    stats: Sequence[str] = ("mean", "last", "count"),
) -> DataFrame:
    """Statistics of a signal at arbitrary anchor times (no grid to rely on).

    One row per distinct anchor that has an event in its window. Time is cut into buckets of the
    window's length, so a window is the end of one bucket and the beginning of the next. Running
    statistics from a bucket's beginning on, and from its end back, are read at the window's two ends
    and combined, never subtracted: what lies outside a window, however far or infinite, has no part
    in it. Rows in proportion to events and anchors, no pairs. With ``hot_rows``, for keys of which
    even one bucket is too large for a task, the pairs of a spread range join are combined instead.
    Rows with a null key match nothing.
    """
    unknown = [s for s in stats if s not in IRREGULAR_STATS]
    if unknown:
        raise ValueError(f"unknown statistics: {unknown}")
    v = F.col(signal)
    points = anchors.select(*keys, "anchor_time").dropna().distinct()
    if hot_rows is not None:
        pairs = range_join_bucketed(
            points, events.select(*keys, "event_time", signal), keys, "anchor_time", "event_time", window_h, hot_rows
        )
        values = {
            "mean": F.avg(v),
            "min": F.min(v),
            "max": F.max(v),
            "std": F.stddev_samp(v),
            "last": F.max_by(v, F.when(v.isNotNull(), F.col("event_time"))),
            "count": F.count(v),
        }
        return pairs.groupBy(*keys, "anchor_time").agg(*[values[s].alias(feature_name(signal, s, window_h)) for s in stats])

    width = int(window_h * MICROS_PER_HOUR)
    at, bucket = F.col("__at"), floor_div(F.col("__at"), width)
    # Part 0 runs forward through the anchor's bucket up to the anchor, part 1 back through the bucket
    # ahead of it as far as the window's start, which is not in the window.
    parts = [(0, bucket, at, F.lit(1)), (1, bucket + 1, -at, F.lit(-1))]

    def placed(df: DataFrame, is_anchor: bool) -> DataFrame:
        sides = []
        for k, home, order, edge in parts:
            order = order + F.lit(width) if is_anchor and k == 1 else order
            home = bucket if is_anchor else home
            sides.append(F.struct(F.lit(k).alias("part"), home.alias("bucket"), order.alias("order"), (edge if is_anchor else F.lit(0)).alias("edge")))
        return df.withColumn("__p", F.explode(F.array(*sides))).select("*", *[F.col(f"__p.{c}").alias(f"__{c}") for c in ("part", "bucket", "order", "edge")]).drop("__p")

    timed = events.dropna(subset=[*keys, "event_time"])
    seen = timed.select(*keys, micros_of("event_time").alias("__at"), v.alias("__v"))
    ends = points.withColumn("__at", micros_of("anchor_time"))
    both = placed(seen, False).unionByName(placed(ends, True), allowMissingColumns=True)
    # One exchange: both parts of a bucket, and then its anchors, are aggregated where they are.
    both = both.repartition(*keys, "__bucket")
    upto = Window.partitionBy(*keys, "__bucket", "__part").orderBy("__order", "__edge").rowsBetween(Window.unboundedPreceding, 0)
    value = F.when(F.col("__v").isNotNull(), F.struct(at.alias("at"), F.col("__v").alias("v")))
    running = {
        "__rows": F.count_if(F.col("__edge") == 0).over(upto),
        "__n": F.count("__v").over(upto),
        "__sum": F.sum("__v").over(upto),
    }
    if "min" in stats:
        running["__min"] = F.min("__v").over(upto)
    if "max" in stats:
        running["__max"] = F.max("__v").over(upto)
    if "std" in stats:
        running["__m2"] = F.var_pop("__v").over(upto) * F.count("__v").over(upto)
    if "last" in stats:
        latest = F.when(F.col("__part") == 0, F.last(value, True).over(upto)).otherwise(F.first(value, True).over(upto))
        running["__last"] = latest
    at_anchor = both.withColumns(running).where("__edge != 0").groupBy(*keys, "__bucket", "anchor_time")
    part = {k: F.col("__part") == k for k in (0, 1)}
    combined = [F.sum("__rows").alias("__rows"), F.sum("__n").alias("__n"), F.sum("__sum").alias("__sum")]
    if "min" in stats:
        combined.append(F.min("__min").alias("__min"))
    if "max" in stats:
        combined.append(F.max("__max").alias("__max"))
    if "std" in stats:
        combined += [F.max(F.when(part[k], F.col(c))).alias(f"{c}{k}") for k in part for c in ("__n", "__sum", "__m2")]
    if "last" in stats:
        combined.append(F.max("__last").alias("__last"))
    found = at_anchor.agg(*combined).where("__rows > 0")
    # Two groups of (n, mean, m2) as one, about their own means.
    gap = F.col("__sum0") / F.col("__n0") - F.col("__sum1") / F.col("__n1")
    between = F.when((F.col("__n0") > 0) & (F.col("__n1") > 0), gap * gap * F.col("__n0") * F.col("__n1") / F.col("__n"))
    m2 = F.coalesce("__m20", F.lit(0.0)) + F.coalesce("__m21", F.lit(0.0)) + F.coalesce(between, F.lit(0.0))
    finished = {
        "mean": lambda: F.try_divide("__sum", "__n"),
        "min": lambda: F.col("__min"),
        "max": lambda: F.col("__max"),
        "std": lambda: F.when(F.col("__n") > 1, F.sqrt(m2 / (F.col("__n") - 1))),
        "last": lambda: F.col("__last.v"),
        "count": lambda: F.col("__n"),
    }
    return found.select(*keys, "anchor_time", *[finished[s]().alias(feature_name(signal, s, window_h)) for s in stats])


def with_derived_features(features: DataFrame, windows_h: Sequence[int], last: tuple[str, str, str] = ("hr", "sbp", "dbp")) -> DataFrame:
    """Add pulse pressure, mean arterial pressure and shock index per window."""
    added = {}
    for w in windows_h:
        hr, sbp, dbp = (feature_name(s, "last", w) for s in last)
        added |= {f"{n}_{w}h": c for n, c in derived_from_last(hr, sbp, dbp).items()}
    return features.withColumns(added)
