from __future__ import annotations

import bisect
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import drift


def exact_distance(a, b):
    a, b = sorted(a), sorted(b)
    return max(abs(bisect.bisect_right(a, x) / len(a) - bisect.bisect_right(b, x) / len(b)) for x in [*a, *b])


def table(spark, values):
    return spark.createDataFrame([(v, None) for v in values], "hr double, sbp double").repartition(6)


def test_distances_are_within_their_bounds_of_the_exact_ones(spark):
    rng = random.Random(3)
    runs = {
        "r1": [rng.gauss(80, 10) for _ in range(8000)],
        "r2": [rng.gauss(80, 10) for _ in range(5000)],
        "r3": [rng.gauss(95, 10) for _ in range(5000)],
        "r4": [rng.choice([60.0, 95.0, 95.0]) for _ in range(3000)],
    }
    kept = None
    for run, values in runs.items():
        part = drift.signal_sketches(table(spark, [*values, float("nan"), None]), ["hr", "sbp"], run)
        kept = part if kept is None else kept.unionByName(part)
    rows = {(r["signal"], r["run_id"]): (r["n"], r["sketch"]) for r in kept.collect()}
    assert rows["hr", "r1"][0] == 8000 and rows["sbp", "r1"] == (0, None)
    assert max(len(s) for _, s in rows.values() if s) < 20_000, "a sketch does not grow with its values"
    found = {r["run_id"]: r for r in drift.distribution_drift(kept, limit=0.2).collect()}
    assert set(found) == {"r2", "r3", "r4"}
    names = list(runs)
    for before, run in zip(names, names[1:]):
        r = found[run]
        assert r["before"] == before and r["signal"] == "hr"
        assert r["at_least"] <= exact_distance(runs[before], runs[run]) <= r["at_most"]
    assert [found[r]["passed"] for r in names[1:]] == [True, False, False]
    report = drift.check_distribution(kept, limit=0.2).collect()
    assert {r["metric"] for r in report if not r["passed"]} == {"hr@r3", "hr@r4"}


def test_merged_sketches_are_those_of_all_values(spark):
    rng = random.Random(5)
    parts = [[rng.uniform(k, k + 10) for _ in range(2000)] for k in range(4)]
    kept = None
    for k, values in enumerate(parts):
        part = drift.signal_sketches(table(spark, values), ["hr"], f"r{k}")
        kept = part if kept is None else kept.unionByName(part)
    one = drift.merged(kept).select("n", F.kll_sketch_get_quantile_double("sketch", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("q")).first()
    every = sorted(v for p in parts for v in p)
    assert one["n"] == 8000
    for q, value in zip((0.1, 0.5, 0.9), one["q"]):
        assert abs(bisect.bisect_right(every, value) / 8000 - q) <= 2 * drift.RANK_ERROR


def test_first_runs_and_empty_tables_have_no_drift(spark):
    one = drift.signal_sketches(table(spark, [1.0, 2.0]), ["hr"], "r1")
    assert drift.distribution_drift(one).collect() == []
    none = drift.signal_sketches(table(spark, [1.0]).limit(0), ["hr"], "r2")
    assert drift.distribution_drift(one.unionByName(none)).collect() == []
    same = drift.signal_sketches(table(spark, [1.0, 2.0]), ["hr"], "r2")
    (row,) = drift.distribution_drift(one.unionByName(same)).collect()
    assert row["distance"] == pytest.approx(0.0) and row["passed"]
