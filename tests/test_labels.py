from __future__ import annotations

import datetime as dt

from tidewatch.config import Horizon
from tidewatch.operators import labels

A = dt.datetime(2024, 1, 1)
H = dt.timedelta(hours=1)
US = dt.timedelta(microseconds=1)


def test_label_edges(spark):
    cases = {
        "at24": (1, 24 * H, 0), "after24": (1, 24 * H + US, 1), "at48": (1, 48 * H, 1), "after48": (1, 48 * H + US, 0),
        "before": (1, -H, 0), "unflagged": (0, 30 * H, 0), "timeless": (1, None, 0), "missing": None,
    }
    anchors = spark.createDataFrame([(k, k, A, A.date()) for k in cases], "patient_id string, admission_id string, anchor_time timestamp_ntz, anchor_date date")
    outcomes = spark.createDataFrame(
        [(k, k, c[0], None if c[1] is None else A + c[1]) for k, c in cases.items() if c],
        "patient_id string, admission_id string, deterioration int, deterioration_time timestamp_ntz",
    )
    got = {r["patient_id"]: r["label"] for r in labels.label_horizon(anchors, outcomes).collect()}
    assert got == {k: (c[2] if c else 0) for k, c in cases.items()}
    direct = {r["patient_id"]: r["label"] for r in labels.with_labels(anchors, outcomes).collect()}
    assert direct == got
    near = labels.label_horizon(anchors, outcomes, Horizon(0, 24)).where("label = 1").collect()
    assert [r["patient_id"] for r in near] == ["at24"]
