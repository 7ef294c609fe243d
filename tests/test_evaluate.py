from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tidewatch.operators import evaluate, publish, ranking

T0 = dt.datetime(2024, 1, 1)
H = dt.timedelta(hours=1)


def rows_of(kind, n=800):
    rng = random.Random(3)
    out = []
    for i in range(n):
        label = int(rng.random() < 0.2)
        s = rng.random() * 0.7 + label * 0.3
        out.append((i, 0.4 if kind == "hot" and i % 3 == 0 else round(s, 2) if kind == "rounded" else s, label))
    return out


@pytest.mark.parametrize("kind", ["continuous", "rounded", "hot"])
def test_areas_equal_the_exact_evaluator(spark, kind, monkeypatch):
    df = spark.createDataFrame(rows_of(kind), "id int, prob double, label int")
    got = evaluate.curve_areas(df).first()
    for metric, value in (("areaUnderROC", got["auroc"]), ("areaUnderPR", got["auprc"])):
        exact = BinaryClassificationEvaluator(rawPredictionCol="prob", labelCol="label", metricName=metric, numBins=0)
        assert value == pytest.approx(exact.evaluate(df.withColumn("label", F.col("label").cast("double"))), abs=1e-12)
    assert got["n_pos"] + got["n_neg"] == 800


def test_areas_by_group_and_degenerate_labels(spark):
    rows = [("a", s, y) for _, s, y in rows_of("rounded", 200)] + [("b", 0.3, 0), ("b", 0.4, 0), (None, 0.1, 0), (None, 0.2, 1)]
    df = spark.createDataFrame(rows, "g string, prob double, label int")
    got = {r["g"]: r for r in evaluate.curve_areas(df, by=["g"]).collect()}
    alone = evaluate.curve_areas(df.where("g = 'a'")).first()
    assert got["a"]["auroc"] == pytest.approx(alone["auroc"]) and got["a"]["auprc"] == pytest.approx(alone["auprc"])
    assert got["b"]["auroc"] is None and got["b"]["auprc"] is None and got["b"]["n_neg"] == 2
    assert got[None]["auroc"] == 1.0
    all_positive = df.where("g = 'a'").withColumn("label", F.lit(1))
    assert evaluate.curve_areas(all_positive).first()["auroc"] is None
    assert evaluate.curve_areas(df.where("prob > 2")).first()["auroc"] is None


def test_calibration_bins(spark):
    df = spark.createDataFrame([(0.0, 0), (0.099, 1), (0.1, 0), (1.0, 1), (0.95, 0), (None, 1)], "prob double, label int")
    got = {r["bin"]: (r["n"], r["event_rate"]) for r in evaluate.calibration(df).collect()}
    assert got == {0: (2, 0.5), 1: (1, 0.0), 9: (2, 0.5)}


def test_lead_time(spark):
    def alert(p, h, flag=1):
        return (p, "a", T0 + h * H, flag)

    alerts = spark.createDataFrame(
        [alert("early", 4), alert("early", 8), alert("early", 0, 0), alert("late", 20), alert("at", 10)],
        "patient_id string, admission_id string, anchor_time timestamp_ntz, alert_flag int",
    )
    outcomes = spark.createDataFrame(
        [(p, "a", T0 + 10 * H) for p in ("early", "late", "at", "none")] + [("open", "a", None)],
        "patient_id string, admission_id string, deterioration_time timestamp_ntz",
    )
    leads = evaluate.lead_time(alerts, outcomes)
    assert {r["patient_id"]: r["lead_hours"] for r in leads.collect()} == {"early": 6.0, "late": None, "at": None, "none": None}
    summary = evaluate.lead_time_summary(leads).first()
    assert (summary["n_outcomes"], summary["n_caught"], summary["mean_lead_hours"]) == (4, 1, 6.0)


def test_metrics_table_and_selection(spark):
    rows = [(m, s, p if m == "x" else 1 - p, y) for s in ("val", "test") for m in ("x", "y") for _, p, y in rows_of("continuous", 150)]
    df = spark.createDataFrame(rows, "model string, split string, prob double, label int")
    metrics = evaluate.metrics_long(df, "r1")
    assert metrics.count() == 4 * 5
    best = evaluate.select_model(metrics).first()
    assert (best["run_id"], best["model"]) == ("r1", "x")
    long = evaluate.topk_long(df.where("model = 'x' and split = 'val'").withColumn("id", F.monotonically_increasing_id()), (0.1,), {"run_id": "r1"}, tie_keys=["id"])
    assert {r["metric"] for r in long.collect()} == {"precision_at_0.1", "recall_at_0.1", "lift_at_0.1", "base_rate"}


def test_bands_latest_and_volume(spark):
    rows = [("p", "a", T0 + i * 4 * H, T0.date(), s, int(s > 0.7)) for i, s in enumerate((0.2, 0.5, 0.8))]
    df = spark.createDataFrame(rows, "patient_id string, admission_id string, anchor_time timestamp_ntz, anchor_date date, risk_score double, alert_flag int")
    assert [r["risk_band"] for r in publish.risk_band(df).orderBy("anchor_time").collect()] == ["LOW", "MEDIUM", "HIGH"]
    null = df.withColumn("risk_score", F.lit(None).cast("double"))
    assert publish.risk_band(null).first()["risk_band"] is None
    latest = publish.latest_risk(df).first()
    assert latest["risk_score"] == 0.8 and latest["score_change"] == pytest.approx(0.3)
    assert publish.latest_risk(df.limit(1)).first()["previous_score"] is None
    day = publish.alert_volume_daily(df).first()
    assert (day["n_anchors"], day["n_alerts"]) == (3, 1)
