from __future__ import annotations

import datetime as dt
import itertools
import math
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from tidewatch.config import SignalStats, TimeGrid
from tidewatch.operators import anchors, dataset, joins, windows
from tidewatch.plans import catalog

T0 = dt.datetime(2024, 1, 1, 3, 17, 5, 250_000)
H = dt.timedelta(hours=1)
US = dt.timedelta(microseconds=1)
STAY = "patient_id string, admission_id string, admit_time timestamp_ntz, discharge_time timestamp_ntz"
EVENT = "patient_id string, admission_id string, event_time timestamp_ntz, hr double, sbp double"
GRID = TimeGrid(windows_h=(6, 12, 24))


def stays_of(spark, hours):
    return spark.createDataFrame([(f"P{i}", f"A{i}", T0, T0 + h * H) for i, h in enumerate(hours)], STAY)


def features_of(spark, stays, events, stats, grid=GRID, whole=False, **kw):
    df = spark.createDataFrame(events, EVENT)
    family = windows.vitals_family(df, [SignalStats("hr", stats)])
    make = windows.gold_features if whole else windows.window_features
    rows = make(stays, [family], grid, **kw).collect()
    return {(r["patient_id"], r["anchor_time"]): r for r in rows}


def test_short_stays_have_no_anchor_and_one_cadence_has_one(spark):
    grid = anchors.anchor_grid(stays_of(spark, [3, 4, 7.999, 8]))
    per = {r["patient_id"]: r["count"] for r in grid.groupBy("patient_id").count().collect()}
    assert per == {"P1": 1, "P2": 1, "P3": 2}
    first = grid.where("patient_id = 'P1'").first()
    assert first["anchor_time"] == T0 and first["anchor_date"] == T0.date()


def test_stay_without_end_or_reversed_has_no_anchor(spark):
    rows = [("P0", "A0", T0, None), ("P1", "A1", T0, T0 - 9 * H)]
    assert anchors.anchor_grid(spark.createDataFrame(rows, STAY)).count() == 0


def test_warmup_moves_the_start_and_metadata_marks_it(spark):
    grid = TimeGrid(warmup_h=6)
    times = [r["anchor_time"] for r in anchors.anchor_grid(stays_of(spark, [16]), grid).orderBy("anchor_time").collect()]
    assert times == [T0 + 6 * H, T0 + 10 * H]
    marked = anchors.anchor_grid(stays_of(spark, [16]), grid, metadata=True).orderBy("anchor_seq").collect()
    assert [(r["anchor_seq"], r["is_valid_anchor"]) for r in marked] == [(0, 0), (1, 0), (2, 1), (3, 1)]


def test_censored_grid_stops_before_the_outcome(spark):
    outcomes = spark.createDataFrame(
        [("P0", "A0", T0 + 8 * H), ("P1", "A1", T0 + 8 * H + US), ("P2", "A2", None), ("P3", "A3", T0 - H)],
        "patient_id string, admission_id string, deterioration_time timestamp_ntz",
    )
    grid = anchors.anchor_grid_censored(stays_of(spark, [24, 24, 24, 24]), outcomes)
    assert {r["patient_id"]: r["count"] for r in grid.groupBy("patient_id").count().collect()} == {"P0": 2, "P1": 3, "P2": 6}
    early = anchors.anchor_grid_censored(stays_of(spark, [24]), outcomes, buffer_h=4)
    assert early.count() == 1


def test_window_edges(spark):
    at = T0 + 24 * H
    edge = [(0 * US, 1.0), (US, 2.0), (-6 * H, 4.0), (-6 * H + US, 8.0), (-24 * H, 16.0), (-24 * H + US, 32.0)]
    got = features_of(
        spark, stays_of(spark, [48]), [("P0", "A0", at + d, v, None) for d, v in edge], ("mean", "count", "last")
    )[("P0", at)]
    assert got["hr_count_6h"] == 2 and got["hr_mean_6h"] == pytest.approx((1 + 8) / 2)
    assert got["hr_count_24h"] == 4 and got["hr_mean_24h"] == pytest.approx((1 + 4 + 8 + 32) / 4)
    assert got["hr_last_6h"] == 1.0


def test_events_ahead_of_the_stay_count_for_its_first_anchors(spark):
    got = features_of(spark, stays_of(spark, [24]), [("P0", "A0", T0 - 2 * H, 50.0, None)], ("mean", "count"))
    assert got[("P0", T0)]["hr_mean_6h"] == 50.0
    assert got[("P0", T0 + 4 * H)]["hr_mean_6h"] is None
    assert got[("P0", T0 + 4 * H)]["hr_mean_12h"] == 50.0


def test_count_is_zero_with_rows_and_null_without(spark):
    got = features_of(spark, stays_of(spark, [40]), [("P0", "A0", T0 + H, None, 7.0)], ("count", "missing_rate", "mean"), whole=True)
    assert got[("P0", T0 + 4 * H)]["hr_count_6h"] == 0 and got[("P0", T0 + 4 * H)]["hr_missing_rate_6h"] == 1.0
    assert got[("P0", T0 + 8 * H)]["hr_count_6h"] is None and got[("P0", T0 + 8 * H)]["hr_count_12h"] == 0
    assert got[("P0", T0)]["hr_count_24h"] is None and got[("P0", T0)]["hr_mean_24h"] is None
    filled = features_of(spark, stays_of(spark, [40]), [("P0", "A0", T0 + H, None, 7.0)], ("count",), whole=True, count_fill_zero=True)
    assert {r["hr_count_6h"] for r in filled.values()} == {0}


def test_whole_grid_keeps_stays_without_events(spark):
    got = features_of(spark, stays_of(spark, [12, 12]), [("P0", "A0", T0, 60.0, None)], ("mean",), whole=True)
    assert sorted(k[0] for k in got) == ["P0"] * 3 + ["P1"] * 3
    assert all(r["anchor_date"] == r["anchor_time"].date() for r in got.values())


def brute(points, at, w):
    seen = sorted((t, v) for t, v in points if at - w * H < t <= at)
    vals = [v for _, v in seen]
    hours = [(t - at) / H for t, _ in seen]
    n = len(seen)
    out = {
        "count": n,
        "mean": statistics.fmean(vals) if n else None,
        "min": min(vals, default=None),
        "max": max(vals, default=None),
        "range": max(vals) - min(vals) if n else None,
        "std": statistics.stdev(vals) if n > 1 else None,
        "last": vals[-1] if n else None,
        "delta": vals[-1] - vals[0] if n > 1 else None,
        "slope": (vals[-1] - vals[0]) / (hours[-1] - hours[0]) if n > 1 else None,
        "slope_fit": statistics.linear_regression(hours, vals).slope if n > 1 else None,
        "tslm": -hours[-1] if n else None,
        "missing_rate": 0.0 if n else None,
    }
    return out


@pytest.mark.parametrize("grid", [TimeGrid(), TimeGrid(3, 2, (5, 7)), TimeGrid(5, 0, (4,)), TimeGrid(1, 0, (24,))])
def test_all_statistics_against_brute_force(spark, grid):
    rng = random.Random(grid.cadence_h)
    hours = [30, 55]
    points = {
        f"P{i}": [(T0 + rng.uniform(-5, h + 5) * H, round(rng.uniform(40, 140), 2)) for _ in range(40)] for i, h in enumerate(hours)
    }
    points = {p: [(t.replace(microsecond=t.microsecond // 1000 * 1000), v) for t, v in ps] for p, ps in points.items()}
    events = [(p, "A" + p[1:], t, v, None) for p, ps in points.items() for t, v in ps]
    got = features_of(spark, stays_of(spark, hours), events, windows.ALL_STATS, grid, whole=True)
    wanted = {(f"P{i}", T0 + (grid.warmup_h + k * grid.cadence_h) * H) for i, h in enumerate(hours) for k in range(100) if grid.warmup_h + (k + 1) * grid.cadence_h <= h}
    assert set(got) == wanted
    for (p, at), w in itertools.product(wanted, grid.windows_h):
        expected = brute(points[p], at, w)
        for stat, value in expected.items():
            actual = got[(p, at)][windows.feature_name("hr", stat, w)]
            if expected["count"] == 0:
                assert actual in (None, 0) if stat == "count" else actual is None
            else:
                assert (actual is None) == (value is None) and (value is None or math.isclose(actual, value, rel_tol=1e-7, abs_tol=1e-9)), (stat, w)


def test_close_points_keep_their_slope(spark):
    at = T0 + 4 * H
    events = [("P0", "A0", at - 3 * H, 100.0, None), ("P0", "A0", at - 3 * H + US, 101.0, None)]
    got = features_of(spark, stays_of(spark, [24]), events, ("slope", "slope_fit"))[("P0", at)]
    assert got["hr_slope_6h"] == pytest.approx(3.6e9) and got["hr_slope_fit_6h"] == pytest.approx(3.6e9)


def test_hot_stay_is_spread_without_changing_results(spark):
    rng = random.Random(5)
    events = [("P0", "A0", T0 + rng.uniform(0, 40) * H, rng.uniform(50, 90), None) for _ in range(600)]
    events += [(f"P{i}", f"A{i}", T0 + rng.uniform(0, 40) * H, 70.0, None) for i in range(1, 4) for _ in range(20)]
    df = spark.createDataFrame(events, EVENT)
    stays = stays_of(spark, [40, 40, 40, 40])
    family = [windows.vitals_family(df, [SignalStats("hr", ("min", "max", "count", "last"))])]
    plain = windows.window_features(stays, family, GRID, hot_rows=None)
    spread = windows.window_features(stays, family, GRID, hot_rows=50)
    hot = joins.hot_keys(df, ["patient_id", "admission_id"], 50).collect()
    assert [(r["patient_id"], r["__salts"]) for r in hot] == [("P0", 12)]
    assert "__salt" in spread._jdf.queryExecution().toString()
    assert plain.exceptAll(spread).count() == 0 and spread.exceptAll(plain).count() == 0


def test_spread_join_left_keeps_unmatched_and_null_keys(spark):
    big = spark.createDataFrame([("a", i) for i in range(30)] + [("b", 1), (None, 2)], "k string, v int")
    small = spark.createDataFrame([("a", 10), ("c", 11)], "k string, w int")
    plain = big.join(small, "k", "left")
    spread = joins.spread_join(big, small, ["k"], ["v"], "left", hot_rows=5)
    assert spread.count() == 32 and spread.exceptAll(plain).count() == 0


def test_irregular_anchors_agree_with_the_grid(spark):
    rng = random.Random(9)
    events = [(f"P{i}", f"A{i}", T0 + rng.uniform(-2, 60) * H, rng.choice([None, rng.uniform(50, 90)]), None) for i in range(2) for _ in range(80)]
    df, stays = spark.createDataFrame(events, EVENT), stays_of(spark, [48, 48])
    grid = anchors.anchor_grid(stays)
    on_grid = windows.window_features(stays, [windows.vitals_family(df, [SignalStats("hr", ("mean", "last", "count"))])], TimeGrid(windows_h=(12,)))
    for hot in (None, 4):
        irregular = windows.irregular_window_features(grid, df, "hr", 12, hot_rows=hot)
        rounded = lambda d: d.select("patient_id", "anchor_time", F.round("hr_mean_12h", 9), "hr_last_12h", "hr_count_12h")
        assert rounded(on_grid).exceptAll(rounded(irregular)).count() == 0
        assert rounded(irregular).exceptAll(rounded(on_grid)).count() == 0


@pytest.mark.parametrize("hot", [None, 4])
def test_irregular_windows_of_repeated_and_event_less_anchors(spark, hot):
    rng = random.Random(11)
    events = [("P0", "A0", T0 + rng.randrange(0, 50) * H, rng.choice([None, float(rng.randrange(60, 90))]), None) for _ in range(40)]
    anchors_at = [T0 + h * H for h in (0, 5, 5, 12, 24, 24, 49, 400)]
    df = spark.createDataFrame(events, EVENT)
    points = spark.createDataFrame([("P0", "A0", t) for t in anchors_at], "patient_id string, admission_id string, anchor_time timestamp_ntz")
    got = {r["anchor_time"]: (r["hr_mean_12h"], r["hr_count_12h"]) for r in windows.irregular_window_features(points, df, "hr", 12, hot_rows=hot).collect()}
    for t in set(anchors_at):
        inside = [v for _, _, e, v, _ in events if t - 12 * H < e <= t]
        values = [v for v in inside if v is not None]
        assert (t in got) == bool(inside)
        if inside:
            assert got[t] == (pytest.approx(sum(values) / len(values)) if values else None, len(values))


def test_no_event_after_the_anchor_is_used(spark):
    events = [("P0", "A0", T0 + i * H / 7, 60.0, None) for i in range(200)]
    got = features_of(spark, stays_of(spark, [28]), events, ("mean",), audit=True)
    assert got and all(r["max_event_time"] <= r["anchor_time"] for r in got.values())


def test_unknown_statistic_is_refused(spark):
    with pytest.raises(ValueError):
        features_of(spark, stays_of(spark, [24]), [("P0", "A0", T0, 1.0, None)], ("median",))


@pytest.mark.parametrize("make", [windows.window_features, windows.gold_features])
@pytest.mark.parametrize("stat", ["mean", "std"])
def test_feature_plan_has_no_pairs_and_one_shuffle_of_events(spark, make, stat):
    df = spark.createDataFrame([("P0", "A0", T0, 1.0, 2.0)], EVENT)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = make(stays_of(spark, [24]), [windows.vitals_family(df, [SignalStats("hr", (stat,))])])
    text = plan._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Cartesian" not in text and "NestedLoop" not in text and "Python" not in text
    # Events and stays come together by stay; panes and anchors are aggregated where they are.
    assert text.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("make", [windows.window_features, windows.gold_features])
@pytest.mark.parametrize("stat", ["mean", "std", "slope_fit", "tslm"])
def test_no_map_of_all_anchors_of_a_task_is_held(spark, make, stat):
    df = spark.createDataFrame([("P0", "A0", T0 + i * H, 1.0, 2.0) for i in range(9)], EVENT)
    made = make(stays_of(spark, [24]), [windows.vitals_family(df, [SignalStats("hr", (stat,))])])
    made.collect()
    lines = made._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0].splitlines()
    by_anchor = [line for line in lines if "Aggregate(key=" in line and "anchor_time" in line.partition("functions=")[0]]
    assert by_anchor and all("SortAggregate" in line for line in by_anchor)
    # Parts of stays are not merged by the few bytes that their events take.
    assert any("REPARTITION_BY_NUM" in line for line in lines)


@pytest.mark.parametrize(
    "name", ["window_stats_full", "window_trend", "gold_features", "fill_nulls", "dq_null_profile", "training_set", "training_set_direct"]
)
def test_queries_finish_features_anchor_by_anchor(spark, small, name):
    text = catalog.queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    keys = [line.partition("functions=")[0] for line in text.splitlines() if "Aggregate(key" in line]
    by_anchor = [k for k in keys if "anchor_time" in k]
    assert by_anchor and all("SortAggregate" in k for k in by_anchor)


@pytest.mark.parametrize("hot", [None, 3])
@pytest.mark.parametrize("make, rows", [(windows.window_features, 9 * 6), (windows.gold_features, 9 * 6 + 12)])
def test_parts_grow_with_the_rows_of_anchors(spark, monkeypatch, make, rows, hot):
    df = spark.createDataFrame([("P0", "A0", T0 + i * H, 1.0, 2.0) for i in range(9)], EVENT)
    stays, families = stays_of(spark, [24, 2, 24]), [windows.vitals_family(df, [SignalStats("hr", ("std",))])]
    few = make(stays, families, hot_rows=hot)
    # No more rows to a part than told, whatever the session shuffles into.
    monkeypatch.setattr(windows, "ROWS_PER_PART", 2)
    many = make(stays, families, hot_rows=hot)
    if hot is None:
        assert [few.rdd.getNumPartitions(), many.rdd.getNumPartitions()] == [4, rows // 2]
    else:
        assert f"_id#0, {rows // 2})" in re.sub(r"#\d+L?", "#0", many._jdf.queryExecution().executedPlan().toString())
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
    assert make(stays, [windows.vitals_family(df.limit(0), families[0].stats)]).count() == (12 if make is windows.gold_features else 0)


def test_training_set_is_joined_in_parts_that_grow_with_its_anchors(spark, small, monkeypatch):
    whole = catalog._training_set(spark, small)
    monkeypatch.setattr(dataset, "ROWS_PER_PART", 100)
    parts = math.ceil(catalog.labels(spark, small).count() / 100)
    many = catalog._training_set(spark, small)
    text = many._jdf.queryExecution().executedPlan().toString()
    assert parts > 4 and len(re.findall(rf"Exchange hashpartitioning\([^)]*anchor_time#\d+, {parts}\)", text)) == 2
    assert whole.exceptAll(many).isEmpty() and many.exceptAll(whole).isEmpty()


def test_buckets_of_gold_features_grow_with_their_anchors(spark, small, monkeypatch):
    monkeypatch.setattr(catalog, "_staged", {})
    whole = catalog.q_training_set_bucketed(spark, small)
    monkeypatch.setattr(catalog, "_staged", {})
    monkeypatch.setattr(dataset, "ROWS_PER_PART", 100)
    parts = math.ceil(catalog.gold(spark, small).count() / 100)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = catalog.q_training_set_bucketed(spark, small)
        text = many._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert parts > 4 and f"SelectedBucketsCount: {parts} out of {parts}" in text
    # The features lie as they are read; labels are dealt to their buckets.
    assert len(re.findall(rf"Exchange hashpartitioning\([^)]*anchor_time#\d+, {parts}\)", text)) == 1
    assert whole.exceptAll(many).isEmpty() and many.exceptAll(whole).isEmpty()


def test_wide_rows_meet_attributes_in_parts_that_grow_with_their_anchors(spark, small, monkeypatch):
    whole = catalog.q_training_set_direct(spark, small)
    monkeypatch.setattr(dataset, "ROWS_PER_PART", 100)
    parts = math.ceil(catalog.gold(spark, small).count() / 100)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = catalog.q_training_set_direct(spark, small)
        text = many._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert parts > 4 and len(re.findall(rf"Exchange hashpartitioning\(patient_id#\d+L, {parts}\)", text)) == 2
    assert whole.exceptAll(many).isEmpty() and many.exceptAll(whole).isEmpty()


@pytest.mark.parametrize("base", [0.0, 1e6, 1e9])
def test_deviations_of_values_far_from_zero(spark, base):
    values = [0.0, 1.0, 2.0, 1.0, 0.0, 2.0, 2.0, 1.0]
    events = [("P0", "A0", T0 + (i + 0.5) * H, base + v, None) for i, v in enumerate(values)]
    got = features_of(spark, stays_of(spark, [24]), events, ("std", "slope_fit"))
    row = got[("P0", T0 + 8 * H)]
    mean, hours = sum(values) / 8, [i + 0.5 for i in range(8)]
    std = (sum((v - mean) ** 2 for v in values) / 7) ** 0.5
    slope = sum((h - 4) * (v - mean) for h, v in zip(hours, values)) / sum((h - 4) ** 2 for h in hours)
    assert row["hr_std_24h"] == pytest.approx(std, abs=1e-6) and row["hr_slope_fit_24h"] == pytest.approx(slope, abs=1e-6)


def test_more_hot_keys_than_any_list_would_hold(spark):
    big = spark.range(36_000).select((F.col("id") % 12_000).alias("k"), "id")
    small = spark.range(12_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    assert joins.hot_keys(big, ["k"], 2).count() == 12_000
    assert joins.spread_join(big, small, ["k"], ["id"], hot_rows=2).where("w = 2 * k").count() == 36_000


def test_events_that_no_anchor_sees_are_not_aggregated(spark):
    events = [("P0", "A0", T0 + d * 24 * H, 70.0, None) for d in range(-30, 30)]
    df = spark.createDataFrame(events, EVENT)
    panes = windows.build_panes(stays_of(spark, [24]), [windows.vitals_family(df, [SignalStats("hr", ("mean",))])], GRID)
    assert panes.count() == 1


FAR = [-1e9, 1e9, 1e17, float("inf"), float("nan")]


@pytest.mark.parametrize("far", FAR)
def test_far_values_outside_a_window_have_no_part_in_its_deviation(spark, far):
    at = T0 + 60 * H
    near = [(-0.5, 70.0), (-2.5, 71.0), (-2.75, 72.0), (-5.0, 71.5)]
    events = [("P0", "A0", at + h * H, v, None) for h, v in [*near, (-30.0, far), (-48.0, far), (10.0, far)]]
    got = features_of(spark, stays_of(spark, [72]), events, ("std", "slope_fit", "mean"))[("P0", at)]
    values, hours = [v for _, v in near], [h for h, _ in near]
    for w in (6, 12, 24):
        assert got[f"hr_std_{w}h"] == pytest.approx(statistics.stdev(values), rel=1e-9)
        assert got[f"hr_slope_fit_{w}h"] == pytest.approx(statistics.linear_regression(hours, values).slope, rel=1e-9)
    # An outlier in the longer windows only leaves the short one alone.
    events = [("P0", "A0", at + h * H, v, None) for h, v in [*near, (-8.0, far)]]
    got = features_of(spark, stays_of(spark, [72]), events, ("std",))[("P0", at)]
    assert got["hr_std_6h"] == pytest.approx(statistics.stdev(values), rel=1e-9)
    if math.isfinite(far):
        assert got["hr_std_12h"] == pytest.approx(statistics.stdev([*values, far]), rel=1e-9)


@pytest.mark.parametrize("offset", [0.0, 1e6, -1e9])
def test_deviation_at_any_offset_with_an_outlier_elsewhere(spark, offset):
    at = T0 + 48 * H
    values = [offset + v for v in (0.0, 1.0, 2.0, 4.0)]
    events = [("P0", "A0", at - (i + 0.5) * H, v, None) for i, v in enumerate(values)] + [("P0", "A0", at - 40 * H, offset - 1e9, None)]
    got = features_of(spark, stays_of(spark, [72]), events, ("std",))[("P0", at)]
    assert got["hr_std_6h"] == got["hr_std_24h"] == pytest.approx(statistics.stdev((0.0, 1.0, 2.0, 4.0)), abs=1e-6)


POINT = "patient_id string, admission_id string, anchor_time timestamp_ntz"


def irregular(spark, events, at, w, hot=None, stats=windows.IRREGULAR_STATS):
    points = spark.createDataFrame([("P0", "A0", t) for t in at], POINT)
    rows = windows.irregular_window_features(points, spark.createDataFrame(events, EVENT), "hr", w, hot_rows=hot, stats=stats).collect()
    return {r["anchor_time"]: [r[f"hr_{s}_{w}h"] for s in stats] for r in rows}


@pytest.mark.parametrize("hot", [None, 3])
@pytest.mark.parametrize("far", FAR)
def test_far_values_ahead_of_an_irregular_window_stay_outside(spark, far, hot):
    events = [("P0", "A0", T0 + h * H, v, None) for h, v in ((0.0, far), (7.0, 1.0), (8.0, 1.0), (9.0, None), (14.0, 3.0), (30.0, far))]
    got = irregular(spark, events, [T0 + 10 * H, T0 + 15 * H, T0 + 19 * H], 6, hot)
    assert got == {T0 + 10 * H: [1.0, 1.0, 1.0, 0.0, 1.0, 2], T0 + 15 * H: [3.0, 3.0, 3.0, None, 3.0, 1], T0 + 19 * H: [3.0, 3.0, 3.0, None, 3.0, 1]}


@pytest.mark.parametrize("hot", [None, 4])
def test_irregular_statistics_against_brute_force(spark, hot):
    rng = random.Random(17)
    pick = lambda: rng.choice([None, rng.uniform(-5, 5), 1e9 + rng.random(), float(rng.randrange(3))])
    times = rng.sample(range(60 * 60), 150)  # distinct minutes
    events = [("P0", "A0", T0 + m / 60 * H, pick(), None) for m in times]
    at = sorted({T0 + rng.choice(times) / 60 * H for _ in range(25)} | {T0 + rng.uniform(0, 70) * H for _ in range(25)})
    got = irregular(spark, events, at, 7, hot)
    for t in at:
        inside = sorted((e, v) for _, _, e, v, _ in events if t - 7 * H < e <= t and v is not None)
        rows = any(t - 7 * H < e <= t for _, _, e, _, _ in events)
        assert (t in got) == rows
        if rows:
            v = [x for _, x in inside]
            want = [statistics.fmean(v), min(v), max(v), statistics.stdev(v) if len(v) > 1 else None, v[-1], len(v)] if v else [None] * 5 + [0]
            for a, b in zip(got[t], want):
                assert (a is None) == (b is None) and (b is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)), (t, got[t], want)


def test_irregular_windows_take_one_exchange_of_events(spark):
    events = spark.createDataFrame([("P0", "A0", T0, 1.0, 2.0)], EVENT)
    points = spark.createDataFrame([("P0", "A0", T0)], POINT)
    plan = windows.irregular_window_features(points, events, "hr", 6, stats=windows.IRREGULAR_STATS)
    text = plan._jdf.queryExecution().executedPlan().toString()
    # One makes anchors distinct, one brings buckets together.
    assert text.count("Exchange hashpartitioning") == 2 and "Join" not in text
    with pytest.raises(ValueError):
        windows.irregular_window_features(points, events, "hr", 6, stats=("median",))
