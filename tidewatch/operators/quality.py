"""Quality checks. Each returns rows ``(check, layer, severity, metric, value, passed)``.

A check is one aggregation over its table; only its handful of results is turned into rows.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T, Window

from tidewatch.config import ANCHOR_KEYS, KEYS, SOFT_RANGES
from tidewatch.functions import null_if_nan
from tidewatch.operators.joins import spread_join
from tidewatch.sources import existing_columns
from tidewatch.sources.schemas import missing_columns, struct_of

ERROR, WARN, INFO = "ERROR", "WARN", "INFO"
REPORT = struct_of("check string, layer string, severity string, metric string, value double, passed boolean")


class QualityError(Exception):
    """Raised by ``run_checks`` when a check of severity ERROR fails."""


Line = tuple[str, str, str, str]


def _report(aggregated: DataFrame, check: str, layer: str, lines: Sequence[Line]) -> DataFrame:
    """``lines`` are (severity, metric, value, passed), the last two as SQL over ``aggregated``.

    A ``passed`` that is null, for want of data, counts as passed.
    """
    rows = ", ".join(
        f"named_struct('check', '{check}', 'layer', '{layer}', 'severity', '{severity}', 'metric', '{metric}', "
        f"'value', CAST({value} AS double), 'passed', coalesce({passed}, true))"
        for severity, metric, value, passed in lines
    )
    return aggregated.selectExpr(f"inline(array({rows}))")


def _none_of(severity: str, metric: str, column: str) -> Line:
    """A count that has to be zero."""
    return severity, metric, f"`{column}`", f"`{column}` = 0"


def _info(metric: str, value: str) -> Line:
    return INFO, metric, value, "true"


@dataclass(frozen=True)
class Check:
    """A check as what it aggregates of its table, so that checks of one table can share an aggregation.

    ``lines`` are SQL over the names of ``aggregates``.
    """

    table: DataFrame
    check: str
    layer: str
    aggregates: Mapping[str, Column]
    lines: Sequence[Line]

    def report(self) -> DataFrame:
        return reports([self])


def reports(checks: Sequence[Check]) -> DataFrame:
    """The rows of several checks on one table, from a single aggregation."""
    table = checks[0].table
    if any(c.table is not table for c in checks):
        raise ValueError("checks of one aggregation need one table")
    named = [{name: f"c{i}_{k}" for k, name in enumerate(c.aggregates)} for i, c in enumerate(checks)]
    every = [value.alias(names[name]) for c, names in zip(checks, named) for name, value in c.aggregates.items()]
    lines = []
    for c, names in zip(checks, named):
        for severity, metric, value, passed in c.lines:
            lines.append((c.check, c.layer, severity, metric, _renamed(value, names), _renamed(passed, names)))
    rows = ", ".join(
        f"named_struct('check', '{check}', 'layer', '{layer}', 'severity', '{severity}', 'metric', '{metric}', "
        f"'value', CAST({value} AS double), 'passed', coalesce({passed}, true))"
        for check, layer, severity, metric, value, passed in lines
    )
    return table.agg(*every).selectExpr(f"inline(array({rows}))")


def _renamed(sql: str, names: Mapping[str, str]) -> str:
    """``sql`` with each name of ``names``, plain or in back-ticks, replaced."""
    if not names:
        return sql
    either = "|".join(re.escape(n) for n in sorted(names, key=len, reverse=True))
    return re.sub(rf"`({either})`|(?<![\w`'])({either})(?![\w`'(])", lambda m: names[m[1] or m[2]], sql)


def fused(checks: Sequence[DataFrame | Check]) -> DataFrame:
    """All rows of ``checks``: those on the same table object come out of one aggregation over it."""
    by_table: dict[int, list[Check]] = {}
    parts: list[DataFrame] = []
    for c in checks:
        if isinstance(c, Check):
            by_table.setdefault(id(c.table), []).append(c)
        else:
            parts.append(c)
    parts += [reports(some) for some in by_table.values()]
    report = parts[0]
    for more in parts[1:]:
        report = report.unionByName(more)
    return report


def schema_check(df: DataFrame, required: Sequence[str], layer: str = "bronze") -> Check:
    """Per required column whether it is there (an error if not) and how many values it has, and all rows.

    One aggregation over the table; an absent column has no values. A present one without any value in
    a table with rows is a warning.
    """
    absent = set(missing_columns(df, required))
    values = {f"n_{i}": F.count(F.lit(None) if c in absent else F.col(c)) for i, c in enumerate(required)}
    lines: list[Line] = [_info("rows", "rows")]
    for i, c in enumerate(required):
        there = c not in absent
        lines += [
            (ERROR, f"has_{c}", str(int(there)), str(there).lower()),
            (WARN, f"values_{c}", f"n_{i}", f"rows = 0 OR n_{i} > 0" if there else "false"),
        ]
    return Check(df, "schema", layer, {"rows": F.count(F.lit(1))} | values, lines)


def check_schema(df: DataFrame, required: Sequence[str], layer: str = "bronze") -> DataFrame:
    return schema_check(df, required, layer).report()


def audit_files(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """(file, rows, values_<column>...) of a table's files, grouped by the file that each row is read from.

    A file that lacks a column, or has it without a value, shows as zero. Columns that the table does
    not have count as zero in every file.
    """
    absent = set(missing_columns(df, required))
    values = [(F.sum(F.lit(0)) if c in absent else F.count(c)).cast("bigint").alias(f"values_{c}") for c in required]
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *values)


def parse_check(df: DataFrame, column: str, layer: str = "bronze") -> Check:
    c = F.col(column)
    parsed = F.try_to_timestamp(c) if df.schema[column].dataType == T.StringType() else c
    return Check(
        df,
        "timestamp_parse",
        layer,
        {"given": F.count(c), "parsed": F.count(parsed)},
        [
            _info("parse_success_rate", "coalesce(try_divide(parsed, given), 1.0D)"),
            (ERROR, "unparseable", "given - parsed", "given = parsed"),
        ],
    )


def check_timestamp_parse(df: DataFrame, column: str, layer: str = "bronze") -> DataFrame:
    return parse_check(df, column, layer).report()


def check_duplicates(df: DataFrame, keys: Sequence[str], layer: str, remaining_is_error: bool = False) -> DataFrame:
    """Rows beyond the first of their key: counted in bronze, an error after deduplication."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    out = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra"),
        F.count_if(F.col("n") > 1).alias("repeated"),
    )
    return _report(
        out,
        "duplicates",
        layer,
        [
            _none_of(ERROR if remaining_is_error else WARN, "duplicate_rows", "extra"),
            _info("repeated_keys", "repeated"),
            _info("duplicate_rate", "coalesce(try_divide(extra, rows), 0.0D)"),
        ],
    )


def check_dedupe_removed(before: DataFrame, after: DataFrame, layer: str = "silver") -> DataFrame:
    counts = before.agg(F.count(F.lit(1)).alias("before")).withColumn(
        "after", after.agg(F.count(F.lit(1)).alias("n")).scalar()
    )
    return _report(counts, "dedupe", layer, [_info("rows_removed", "before - after")])


def check_temporal(
    events: DataFrame,
    stays: DataFrame,
    run_time: Column,
    layer: str = "bronze",
    keys: Sequence[str] = KEYS,
    hot_rows: int | None = None,
) -> DataFrame:
    """Events outside their stay, without a stay, or in the future of the run.

    Events go straight into the join and are counted where they are; ``hot_rows`` spreads hot stays.
    """
    bounds = stays.select(*keys, "admit_time", "discharge_time", F.lit(1).alias("__stay"))
    placed = spread_join(events.select(*keys, "event_time"), bounds, keys, ["event_time"], "left", hot_rows)
    t = F.col("event_time")
    out = placed.agg(
        F.count_if((t < F.col("admit_time")) | (t > F.col("discharge_time"))).alias("outside"),
        F.count_if(F.col("__stay").isNull()).alias("orphans"),
        F.count_if(t > run_time).alias("future"),
    )
    return _report(
        out,
        "temporal",
        layer,
        [
            _none_of(ERROR, "events_outside_stay", "outside"),
            _none_of(ERROR, "events_without_stay", "orphans"),
            _none_of(WARN, "events_in_future", "future"),
        ],
    )


def ranges_check(df: DataFrame, ranges: Mapping[str, tuple[float, float]] = SOFT_RANGES, layer: str = "bronze") -> Check:
    signals = existing_columns(df, list(ranges))

    def outside(c: str) -> Column:
        lo, hi = ranges[c]
        return F.count_if((null_if_nan(c) < lo) | (null_if_nan(c) > hi))

    return Check(df, "ranges", layer, {c: outside(c) for c in signals}, [_none_of(WARN, f"{c}_out_of_range", c) for c in signals])


def check_ranges(
    df: DataFrame, ranges: Mapping[str, tuple[float, float]] = SOFT_RANGES, layer: str = "bronze"
) -> DataFrame:
    return ranges_check(df, ranges, layer).report()


def interval_checks(events: DataFrame, stays: DataFrame, layer: str = "silver") -> list[Check]:
    """Events without a time, and stays whose start does not lie before their end."""
    nulls = {"nulls": F.count_if(F.col("event_time").isNull())}
    wrong = {"wrong": F.count_if(F.col("admit_time") >= F.col("discharge_time"))}
    return [
        Check(events, "intervals", layer, nulls, [_none_of(ERROR, "null_event_time", "nulls")]),
        Check(stays, "intervals", layer, wrong, [_none_of(ERROR, "admit_not_before_discharge", "wrong")]),
    ]


def check_intervals(events: DataFrame, stays: DataFrame, layer: str = "silver") -> DataFrame:
    return fused(interval_checks(events, stays, layer))


def check_units(df: DataFrame, signal: str, unit: str, layer: str = "silver") -> DataFrame:
    """Number of units per signal, for tables in long form with a unit column."""
    per_signal = df.where(F.col(unit).isNotNull()).groupBy(F.col(signal).alias("signal")).agg(
        F.count_distinct(unit).alias("units")
    )
    row = F.struct(
        F.lit("units").alias("check"),
        F.lit(layer).alias("layer"),
        F.lit(ERROR).alias("severity"),
        F.concat(F.lit("units_of_"), F.col("signal").cast("string")).alias("metric"),
        F.col("units").cast("double").alias("value"),
        (F.col("units") <= 1).alias("passed"),
    )
    return per_signal.select(row.alias("r")).select("r.*")


def nulls_check(df: DataFrame, columns: Sequence[str], layer: str, empty_is: str = WARN) -> Check:
    """Null share per column; a column without any value is reported with severity ``empty_is``."""
    lines = []
    for c in columns:
        empty = f"(`{c}` = 0 AND __n > 0)"
        lines.append(_info(f"{c}_null_share", f"coalesce(1.0D - try_divide(`{c}`, __n), 0.0D)"))
        lines.append((empty_is, f"{c}_all_null", f"CAST({empty} AS int)", f"NOT {empty}"))
    return Check(df, "null_profile", layer, {"__n": F.count(F.lit(1))} | {c: F.count(c) for c in columns}, lines)


def check_nulls(df: DataFrame, columns: Sequence[str], layer: str, empty_is: str = WARN) -> DataFrame:
    return nulls_check(df, columns, layer, empty_is).report()


def check_drift(
    history: DataFrame,
    limit: float = 0.10,
    layer: str = "silver",
    run_col: str = "run_id",
    relative: str = r"(^|:)(rows|duplicate_rows|repeated_keys|rows_removed|n_)|_per_stay$",
    limits: Mapping[str, float] | None = None,
) -> DataFrame:
    """Change of every metric against the run before, from a table ``(run_id, metric, value)``.

    Shares change by their difference. Counts, whose names match ``relative``, change by the
    difference over the value before; one that was zero changes by infinity, or not at all.
    ``limits`` sets other limits for single metrics.
    """
    runs = Window.partitionBy("metric").orderBy(run_col)
    before = F.lag("value").over(runs)
    difference = F.col("value") - before
    share = F.when(before != 0, difference / F.abs(before)).otherwise(
        F.when(difference == 0, F.lit(0.0)).otherwise(F.signum(difference) * F.lit(float("inf")))
    )
    # A change against no run before stays null.
    change = F.when(before.isNotNull(), F.when(F.col("metric").rlike(relative), share).otherwise(difference))
    allowed = F.lit(float(limit))
    for name, own in (limits or {}).items():
        allowed = F.when(F.col("metric") == name, F.lit(float(own))).otherwise(allowed)
    return history.withColumns({"change": change, "allowed": allowed}).where(F.col("change").isNotNull()).select(
        F.lit("drift").alias("check"),
        F.lit(layer).alias("layer"),
        F.lit(WARN).alias("severity"),
        F.concat_ws("@", "metric", F.col(run_col).cast("string")).alias("metric"),
        F.col("change").cast("double").alias("value"),
        (F.abs("change") <= F.col("allowed")).alias("passed"),
    )


def check_anchors(
    anchors: DataFrame,
    stays: DataFrame,
    outcomes: DataFrame,
    layer: str = "gold",
    keys: Sequence[str] = KEYS,
    after_outcome: str = ERROR,
) -> DataFrame:
    """Repeated anchors, anchors outside their stay, anchors at or after the outcome.

    ``after_outcome`` is the severity of the last: a grid that is not censored runs on after it.

    Repeated anchors are counted ahead of the join, so a stay brings no more rows to it than its
    duration has anchor times.
    """
    per_anchor = anchors.groupBy(*keys, "anchor_time").agg(F.count(F.lit(1)).alias("n"))
    bounds = stays.select(*keys, "admit_time", "discharge_time")
    ends = outcomes.where(F.col("deterioration_time").isNotNull()).select(*keys, "deterioration_time")
    placed = per_anchor.join(bounds.join(ends, list(keys), "left"), list(keys), "left")
    a = F.col("anchor_time")
    outside = F.col("admit_time").isNull() | (a < F.col("admit_time")) | (a > F.col("discharge_time"))

    def rows_where(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))

    out = placed.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated"),
        rows_where(outside).alias("outside"),
        rows_where(a >= F.col("deterioration_time")).alias("late"),
    )
    return _report(
        out,
        "anchors",
        layer,
        [
            _none_of(ERROR, "duplicate_anchors", "repeated"),
            _none_of(ERROR, "anchors_outside_stay", "outside"),
            _none_of(after_outcome, "anchors_after_outcome", "late"),
        ],
    )


def anchor_distribution(anchors: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """How many stays have how many anchors."""
    per_stay = anchors.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_anchors"))
    return per_stay.groupBy("n_anchors").agg(F.count(F.lit(1)).alias("n_stays"))


def leakage_check(features: DataFrame, windows_h: Sequence[int], layer: str = "gold") -> Check:
    """No feature may use an event after its anchor (needs the audit column ``max_event_time``)."""
    bad = sum(1 for w in windows_h if w <= 0)
    return Check(
        features,
        "leakage",
        layer,
        {"leaks": F.count_if(F.col("max_event_time") > F.col("anchor_time"))},
        [
            _none_of(ERROR, "features_after_anchor", "leaks"),
            (ERROR, "non_positive_windows", f"{bad}", f"{bad} = 0"),
        ],
    )


def check_leakage(features: DataFrame, windows_h: Sequence[int], layer: str = "gold") -> DataFrame:
    return leakage_check(features, windows_h, layer).report()


def features_check(features: DataFrame, tslm: Mapping[str, int], layer: str = "gold") -> Check:
    """Hours since the last measurement must lie within their window; maps column to hours."""
    counts = {f"neg_{c}": F.count_if(F.col(c) < 0) for c in tslm} | {f"far_{c}": F.count_if(F.col(c) > h) for c, h in tslm.items()}
    lines = [_none_of(ERROR, f"{c}_negative", f"neg_{c}") for c in tslm]
    lines += [_none_of(WARN, f"{c}_beyond_window", f"far_{c}") for c in tslm]
    return Check(features, "features", layer, counts, lines)


def check_features(features: DataFrame, tslm: Mapping[str, int], layer: str = "gold") -> DataFrame:
    return features_check(features, tslm, layer).report()


def check_labels(
    labels: DataFrame, expected: float | None = None, tolerance: float = 0.05, layer: str = "gold"
) -> DataFrame:
    """Positive labels whose outcome does not follow the anchor, and the share of positives."""
    positive = F.col("label") == 1
    out = labels.agg(
        F.count_if(positive & (F.col("deterioration_time") <= F.col("anchor_time"))).alias("past"),
        F.count_if(positive & F.col("deterioration_time").isNull()).alias("without"),
        F.avg(F.col("label").cast("double")).alias("prevalence"),
    )
    deviation = f"abs(prevalence - {float(expected or 0.0)}D)"
    close = "true" if expected is None else f"{deviation} <= {float(tolerance)}D"
    return _report(
        out,
        "labels",
        layer,
        [
            _none_of(ERROR, "outcome_not_after_anchor", "past"),
            _none_of(ERROR, "positive_without_outcome", "without"),
            _info("prevalence", "prevalence"),
            (WARN, "prevalence_deviation", deviation, close),
        ],
    )


def check_split_overlap(df: DataFrame, entity: str = "patient_id", layer: str = "gold") -> DataFrame:
    """Entities that occur in more than one split."""
    spread = df.groupBy(entity).agg(F.min("split").alias("lo"), F.max("split").alias("hi"))
    out = spread.agg(F.count_if(F.col("lo") != F.col("hi")).alias("overlap"))
    return _report(out, "split_overlap", layer, [_none_of(ERROR, "entities_in_several_splits", "overlap")])


def shared_entities(df: DataFrame, first: str = "train", second: str = "test", entity: str = "patient_id") -> DataFrame:
    """The entities found in both of two splits."""
    def members(name: str) -> DataFrame:
        return df.where(F.col("split") == name).select(entity)

    return members(first).intersect(members(second))


def check_scores(df: DataFrame, score: str = "risk_score", layer: str = "scores") -> DataFrame:
    s = F.col(score)
    out = df.agg(
        F.count_if((s < 0) | (s > 1) | F.isnan(s)).alias("outside"),
        F.count(s).alias("n"),
        F.min(s).alias("lowest"),
        F.max(s).alias("highest"),
        F.avg(s).alias("mean"),
    )
    collapsed = "(n > 1 AND lowest = highest)"
    return _report(
        out,
        "scores",
        layer,
        [
            _none_of(ERROR, "score_outside_0_1", "outside"),
            (WARN, "collapsed_model", f"CAST({collapsed} AS int)", f"NOT {collapsed}"),
            _info("score_min", "lowest"),
            _info("score_max", "highest"),
            _info("score_mean", "mean"),
        ],
    )


def run_checks(checks: Sequence[DataFrame | Check], sink: str | None = None, run_id: str | None = None) -> DataFrame:
    """Evaluate checks, append them to the quality table at ``sink`` and raise on failed ERRORs.

    Those given as ``Check`` take one aggregation per table. A report has a few rows per check, whatever the size of the tables behind it.
    """
    report = fused(checks)
    if run_id is not None:
        report = report.withColumn("run_id", F.lit(run_id))
    rows = report.coalesce(1).collect()
    done = report.sparkSession.createDataFrame(rows, report.schema)
    if sink is not None:
        # A run that is repeated replaces its own rows.
        writer = done.coalesce(1).write
        if run_id is None:
            writer.mode("append").parquet(sink)
        else:
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(sink)
    failed = [f"{r['check']}.{r['metric']}={r['value']}" for r in rows if r["severity"] == ERROR and not r["passed"]]
    if failed:
        raise QualityError("; ".join(failed))
    return done
