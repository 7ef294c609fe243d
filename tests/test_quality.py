from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import quality as Q

T0 = dt.datetime(2024, 1, 1)
H = dt.timedelta(hours=1)
EVENT = "patient_id string, admission_id string, event_time timestamp_ntz, hr double"
STAY = "patient_id string, admission_id string, admit_time timestamp_ntz, discharge_time timestamp_ntz"


def report(df):
    return {r["metric"]: (r["value"], r["passed"], r["severity"]) for r in df.collect()}


@pytest.fixture
def stays(spark):
    return spark.createDataFrame([("p", "a", T0, T0 + 24 * H), ("q", "b", T0, T0)], STAY)


def test_schema_and_parse(spark):
    df = spark.createDataFrame([("2024-01-01",), ("never",), (None,)], "event_time string")
    got = report(Q.check_schema(df, ["event_time", "patient_id"]))
    assert got["has_event_time"][1] and not got["has_patient_id"][1]
    got = report(Q.check_timestamp_parse(df, "event_time"))
    assert got["parse_success_rate"][0] == 0.5 and got["unparseable"] == (1.0, False, "ERROR")


def test_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,)], "k int")
    got = report(Q.check_duplicates(df, ["k"], "bronze"))
    assert got["duplicate_rows"] == (2.0, False, "WARN") and got["repeated_keys"][0] == 1 and got["duplicate_rate"][0] == 0.5
    assert report(Q.check_duplicates(df, ["k"], "silver", True))["duplicate_rows"][2] == "ERROR"
    assert report(Q.check_duplicates(df.where("k > 5"), ["k"], "bronze"))["duplicate_rows"] == (0.0, True, "WARN")
    assert report(Q.check_dedupe_removed(df, df.distinct()))["rows_removed"][0] == 2


@pytest.mark.parametrize("hot_rows", [None, 3])
def test_temporal(spark, stays, hot_rows):
    rows = [("p", "a", T0 + i * H, 1.0) for i in range(-1, 27)] + [("p", "a", T0 - H, 1.0)] * 2 + [("z", "z", T0, 1.0)]
    events = spark.createDataFrame(rows, EVENT)
    got = report(Q.check_temporal(events, stays, F.lit(T0 + 20 * H).cast("timestamp_ntz"), hot_rows=hot_rows))
    assert got["events_outside_stay"][0] == 3 + 2
    assert got["events_without_stay"][0] == 1 and got["events_in_future"][0] == 6


def test_ranges_intervals_units_nulls(spark, stays):
    events = spark.createDataFrame([("p", "a", T0, 300.0), ("p", "a", None, None)], EVENT)
    assert report(Q.check_ranges(events))["hr_out_of_range"] == (1.0, False, "WARN")
    got = report(Q.check_intervals(events, stays))
    assert got["null_event_time"][0] == 1 and got["admit_not_before_discharge"][0] == 1
    units = spark.createDataFrame([("hr", "bpm"), ("hr", "hz"), ("t", "C"), ("t", None)], "signal string, unit string")
    got = report(Q.check_units(units, "signal", "unit"))
    assert got["units_of_hr"] == (2.0, False, "ERROR") and got["units_of_t"][1]
    got = report(Q.check_nulls(events.withColumn("x", F.lit(None).cast("int")), ["hr", "x"], "silver"))
    assert got["hr_null_share"][0] == 0.5 and got["x_all_null"][1] is False and got["hr_all_null"][1]
    assert report(Q.check_nulls(events.where("hr > 999"), ["hr"], "silver"))["hr_all_null"][1]


def test_drift(spark):
    history = spark.createDataFrame([("r1", "m", 0.1), ("r2", "m", 0.15), ("r3", "m", 0.5)], "run_id string, metric string, value double")
    got = report(Q.check_drift(history, 0.1))
    assert got["m@r2"][1] and not got["m@r3"][1] and "m@r1" not in got


def test_counts_drift_by_their_relative_change(spark):
    rows = [("r1", "rows:gold", 1e6), ("r2", "rows:gold", 1e6 + 1), ("r3", "rows:gold", 1.2e6), ("r1", "share", 0.5), ("r2", "share", 0.7), ("r1", "rows:x", 0.0), ("r2", "rows:x", 0.0), ("r3", "rows:x", 1.0)]
    got = report(Q.check_drift(spark.createDataFrame(rows, "run_id string, metric string, value double"), 0.1, limits={"share": 0.3}))
    assert got["rows:gold@r2"][1] and not got["rows:gold@r3"][1] and got["share@r2"][1] and got["rows:x@r2"][1] and not got["rows:x@r3"][1]


def test_anchors_leakage_features_labels(spark, stays):
    anchors = spark.createDataFrame([("p", "a", T0)] * 2 + [("p", "a", T0 + 10 * H), ("p", "a", T0 + 30 * H), ("z", "z", T0)], "patient_id string, admission_id string, anchor_time timestamp_ntz")
    outcomes = spark.createDataFrame([("p", "a", T0 + 10 * H)], "patient_id string, admission_id string, deterioration_time timestamp_ntz")
    got = report(Q.check_anchors(anchors, stays, outcomes))
    assert (got["duplicate_anchors"][0], got["anchors_outside_stay"][0], got["anchors_after_outcome"][0]) == (1, 2, 2)
    assert {(r["n_anchors"], r["n_stays"]) for r in Q.anchor_distribution(anchors).collect()} == {(4, 1), (1, 1)}
    used = spark.createDataFrame([(T0, T0 + H), (T0, T0)], "anchor_time timestamp_ntz, max_event_time timestamp_ntz")
    got = report(Q.check_leakage(used, (6, 0)))
    assert got["features_after_anchor"][0] == 1 and got["non_positive_windows"] == (1.0, False, "ERROR")
    got = report(Q.check_features(spark.createDataFrame([(-1.0,), (7.0,), (3.0,)], "t double"), {"t": 6}))
    assert got["t_negative"][0] == 1 and got["t_beyond_window"][0] == 1
    labels = spark.createDataFrame([(1, T0, T0), (1, T0, None), (0, T0, None)], "label int, anchor_time timestamp_ntz, deterioration_time timestamp_ntz")
    got = report(Q.check_labels(labels, expected=0.02))
    assert got["outcome_not_after_anchor"][0] == 1 and got["positive_without_outcome"][0] == 1 and not got["prevalence_deviation"][1]


def test_splits_and_scores(spark):
    df = spark.createDataFrame([("p", "train"), ("p", "test"), ("q", "val")], "patient_id string, split string")
    assert report(Q.check_split_overlap(df))["entities_in_several_splits"] == (1.0, False, "ERROR")
    assert [r["patient_id"] for r in Q.shared_entities(df).collect()] == ["p"]
    scores = spark.createDataFrame([(0.5,), (0.5,)], "risk_score double")
    assert not report(Q.check_scores(scores))["collapsed_model"][1]
    bad = spark.createDataFrame([(0.5,), (1.5,), (float("nan"),)], "risk_score double")
    assert report(Q.check_scores(bad))["score_outside_0_1"][0] == 2


def test_run_checks_writes_and_raises(spark, tmp_path):
    good = Q.check_duplicates(spark.range(5), ["id"], "silver", True)
    sink = str(tmp_path / "dq")
    assert Q.run_checks([good], sink, "r1").count() == 3
    bad = Q.check_duplicates(spark.range(5).union(spark.range(2)), ["id"], "silver", True)
    for _ in range(2):  # a repeated run replaces its rows
        with pytest.raises(Q.QualityError, match="duplicate_rows=2.0"):
            Q.run_checks([good, bad], sink, "r2")
    assert spark.read.parquet(sink).where("run_id = 'r2'").count() == 6
    assert spark.read.parquet(sink).groupBy("run_id").count().count() == 2


def test_schema_counts_values_in_one_aggregation(spark, tmp_path):
    df = spark.createDataFrame([("p", 1.0, None), ("q", None, None)], "patient_id string, hr double, lab double")
    got = report(Q.check_schema(df, ["patient_id", "hr", "lab", "unit"]))
    assert got["rows"][0] == 2 and got["values_patient_id"][0] == 2 and got["values_hr"] == (1.0, True, "WARN")
    assert got["values_lab"] == (0.0, False, "WARN") and got["has_unit"] == (0.0, False, "ERROR") and got["values_unit"][0] == 0
    assert report(Q.check_schema(df.limit(0), ["hr"]))["values_hr"][1]


def test_audit_of_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("p", 1.0)] * 3, "k string, hr double").coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([("q",)] * 2, "k string").coalesce(1).write.mode("append").parquet(path)
    df = spark.read.schema("k string, hr double").parquet(path)
    got = sorted(tuple(r)[1:] for r in Q.audit_files(df, ["k", "hr", "unit"]).collect())
    assert got == [(2, 2, 0, 0), (3, 3, 3, 0)]
    assert Q.audit_files(df, ["k"])._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1


def test_checks_of_one_table_share_its_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.createDataFrame([("p", T0, 500.0), ("q", None, None), ("p", T0, 80.0)], "patient_id string, event_time timestamp_ntz, hr double").write.parquet(path)
    df, stays = spark.read.parquet(path), spark.createDataFrame([(T0, T0)], "admit_time timestamp_ntz, discharge_time timestamp_ntz")
    checks = [
        Q.schema_check(df, ["patient_id", "hr", "unit"]),
        Q.parse_check(df, "event_time"),
        Q.ranges_check(df, {"hr": (20.0, 250.0)}),
        Q.nulls_check(df, ["hr", "event_time"], "silver"),
        *Q.interval_checks(df, stays),
    ]
    together = Q.fused(checks)
    apart = [r for c in checks for r in c.report().collect()]
    assert sorted(map(str, together.collect())) == sorted(map(str, apart)) and len(apart) == 16
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(Q.fused(checks)).count("FileScan parquet") == 1
    mixed = Q.fused([*checks, Q.check_duplicates(df, ["patient_id"], "bronze")])
    assert plan(mixed).count("FileScan parquet") == 2, "one more by key"
    with pytest.raises(ValueError):
        Q.reports([checks[0], checks[-1]])


def test_names_in_lines_are_replaced_whole():
    assert Q._renamed("`hr` = 0 AND hr_x > n AND n > 0", {"hr": "c0", "n": "c1"}) == "c0 = 0 AND hr_x > c1 AND c1 > 0"
    assert Q._renamed("coalesce(n, 'n')", {"n": "c1"}) == "coalesce(c1, 'n')"
