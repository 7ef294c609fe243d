"""The batch jobs on raw tables derived from the shared events."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.config import ANCHOR_KEYS, DashboardSpec, SplitFractions
from tidewatch.operators import clean, model
from tidewatch.plans import fixtures as fx, medallion
from tidewatch.sources import revoke_run
from tidewatch.sources.schemas import RAW_TABLES

# Few patients: parts of 40, 30 and 30 %, so that none is empty.
SETTINGS = medallion.Settings(gbt_iterations=3, dashboard=DashboardSpec(rows=400), splits=SplitFractions(0.4, 0.3))


def raw_tables(spark, small):
    ids = {"patient_id": F.concat(F.lit("P"), "patient_id"), "admission_id": F.concat(F.lit("A"), "admission_id")}
    stamp = lambda c: F.col(c).cast("timestamp")
    n = F.crc32("admission_id") % 100
    admissions = fx.stays(spark, small).withColumns(ids).withColumns(
        {
            "admit_time": stamp("admit_time"), "discharge_time": stamp("discharge_time"), "los_days": F.lit(5),
            "admit_acuity": (n / 100.0).cast("double"), "age": (20 + n % 70).cast("int"),
            "sex": F.when(n % 2 == 0, "m").otherwise("F "), "diabetes": (n % 3 == 0).cast("int"), "ckd": (n % 5 == 0).cast("int"),
            "copd": (n % 7 == 0).cast("int"), "chf": (n % 11 == 0).cast("int"), "comorbidity_count": (n % 4).cast("int"),
        }
    )
    vitals = fx.vitals(spark, small).withColumns(ids).withColumns({"event_time": stamp("event_time"), "dbp": F.lit(None).cast("double")})
    labs = fx.labs(spark, small).withColumns(ids).withColumns({"event_time": stamp("event_time"), "wbc": F.lit(None).cast("double")})
    # Some events arrive twice.
    vitals = vitals.unionByName(vitals.where("hr > 60"))
    outcomes = fx.outcomes(spark, small).withColumns(ids).withColumns(
        {"deterioration_time": stamp("deterioration_time"), "outcome_type": F.lit("deterioration")}
    )
    tables = {"admissions": admissions, "vitals": vitals, "labs": labs, "outcomes": outcomes}
    dated = {t: df.withColumn("event_date", F.to_date("event_time")) if t in ("vitals", "labs") else df for t, df in tables.items()}
    return {t: df.select(*RAW_TABLES[t].names) for t, df in dated.items()}


@pytest.fixture(scope="module")
def store(spark, small, tmp_path_factory):
    s = medallion.Store(spark, str(tmp_path_factory.mktemp("lake")))
    for name, df in raw_tables(spark, small).items():
        if name in ("vitals", "labs"):
            df.repartition(4, "event_date").write.partitionBy("event_date").parquet(s.path(f"raw/{name}"))
        else:
            df.write.parquet(s.path(f"raw/{name}"))
    return s


def test_jobs_end_to_end(spark, store):
    run_time = F.lit("2024-02-01 00:00:00").cast("timestamp")
    rows = medallion.run_all(store, "run_1", "shared_events", run_time, SETTINGS)
    assert rows["bronze/vitals"] > rows["silver/vitals"]
    assert rows["gold/anchors"] == rows["gold/features"] == rows["gold/labels"] == rows["gold/training_set"] == rows["marts/risk_scores"]
    assert rows["gold/anchors"] == 30 * rows["silver/admissions"]

    features = store.read("gold/features")
    assert len([c for c in features.columns if c.endswith("h")]) == 21
    table = store.read("gold/training_set")
    assert {f.dataType.simpleString() for f in table.schema if f.name.startswith("hr_")} == {"double"}
    assert model.feature_columns(table) == sorted([c for c in features.columns if c.endswith("h")] + ["age", "diabetes", "ckd", "copd", "chf", "comorbidity_count", "admit_acuity", "sex_m"])
    own = table.select("patient_id", "split", F.expr("pmod(abs(hash(patient_id)), 100)").alias("b"))
    assert own.where("(b < 40) <> (split = 'train') or (b >= 70) <> (split = 'test')").count() == 0

    metrics = store.read("marts/model_metrics")
    assert metrics.where("metric = 'auroc'").count() == 4
    scores = store.read("marts/risk_scores")
    assert scores.where("risk_score < 0 or risk_score > 1 or risk_band is null").count() == 0

    extract = spark.read.option("header", True).csv(store.path("reports/dashboard"))
    assert extract.count() <= 400 and {"risk_decile", "alert_flag", "risk_band", "anchor_datetime", "hr_mean_24h"} <= set(extract.columns)
    assert spark.read.option("header", True).csv(store.path("reports/risk_scores_sample")).count() == min(200, rows["marts/risk_scores"])
    history = {r["metric"]: r["value"] for r in store.read("marts/run_metrics").collect()}
    assert history["rows:in/vitals"] == rows["bronze/vitals"] and history["anchors_per_stay"] == 30
    checked = {r["check"] for r in store.read("marts/data_quality").collect()}
    assert {"anchors", "leakage", "null_profile", "dedupe", "temporal", "scores"} <= checked
    assert history["rows:gold/anchors"] == rows["gold/anchors"] and "gold:labels:prevalence" in history
    assert any(m.endswith(":val:auprc") for m in history) and medallion.drift(store).count() == 0
    assert store.read("marts/data_quality").where("severity = 'ERROR' and not passed").count() == 0
    bronze = store.read("bronze/vitals")
    assert history["clipped:silver/vitals:hr"] == bronze.where("hr < 30 or hr > 220").count() > 0 and "clipped:silver/labs:lactate" in history
    raw = {(r["layer"], r["metric"]): r["value"] for r in store.read("marts/raw_quality").collect()}
    assert raw["raw/vitals", "has_event_time"] == 1 and raw["raw/admissions.admit_time", "parse_success_rate"] == 1
    kept = {r["signal"]: r["n"] for r in store.read("marts/signal_sketches").collect()}
    assert kept["hr"] == store.read("silver/vitals").where("hr is not null").count() and kept["wbc"] == 0
    medallion.sketch_signals(store, "run_1b", SETTINGS)
    assert store.read("marts/signal_sketches").count() == 2 * len(kept) and medallion.distribution_drift(store).count() == 0


def test_a_second_run_is_added_and_becomes_the_latest(spark, store):
    run_time = F.lit("2024-02-02 00:00:00").cast("timestamp")
    before = store.read("marts/risk_scores").count()
    medallion.train(store, "run_2", SETTINGS)
    run_id, name = medallion.evaluate_best(store, SETTINGS)
    assert run_id == "run_2"
    medallion.score(store, run_id, name, run_time, SETTINGS)
    runs = store.read("marts/risk_scores").groupBy("run_id").count().collect()
    assert {r["run_id"]: r["count"] for r in runs} == {"run_1": before, "run_2": before}
    one = store.read("marts/risk_scores").where("run_id = 'run_1'").select(*ANCHOR_KEYS, "risk_score", F.col("model_version"))
    two = store.read("marts/risk_scores").where("run_id = 'run_2'").select(*ANCHOR_KEYS, F.col("risk_score").alias("again"), F.col("model_version").alias("v2"))
    same = one.join(two, list(ANCHOR_KEYS)).where(F.substring("model_version", 1, 3) == F.substring("v2", 1, 3))
    assert same.where("abs(risk_score - again) > 1e-9").count() == 0


def test_a_repeated_run_replaces_its_rows(spark, store):
    tables = ("marts/model_metrics", "marts/data_quality", "marts/run_metrics")
    before = [store.read(t).where("metric not like '%rows%'").count() for t in tables]
    medallion.train(store, "run_2", SETTINGS)
    medallion.check_quality(store, "run_1", F.lit("2024-02-01 00:00:00").cast("timestamp"), SETTINGS)
    medallion.record_run(store, "run_1")
    assert before == [store.read(t).where("metric not like '%rows%'").count() for t in tables]


def test_drivers_follow_the_coefficients(spark, store):
    table = store.read("gold/training_set").withColumn("weight", F.lit(1.0))
    features = ["age", "admit_acuity", "hr_mean_24h"]
    fitted = model.logreg_pipeline(features, max_iter=5).fit(table)
    drivers = model.top_drivers(table, fitted, features, n=2)
    assert drivers.count() == table.count() and {len(r["top_drivers"]) for r in drivers.limit(20).collect()} == {2}
    weights = {r["feature"]: r["weight"] for r in model.model_weights(fitted, features).collect()}
    assert set(weights) == set(features)


def test_the_chosen_model_has_a_record_on_the_test_split(spark, store):
    record = store.latest("marts/model_metrics").where("split = 'test'")
    (best,) = {r["model"] for r in store.read("marts/evaluation").where("run_id = 'run_2'").collect()}
    want = {r["metric"]: r["value"] for r in record.where(F.col("model") == best).collect()}
    got = {r["metric"]: r["value"] for r in store.read("marts/evaluation").where("run_id = 'run_2'").collect()}
    assert got.keys() == want.keys() and {"auroc", "auprc", "brier", "recall_at_0.1", "lift_at_0.1"} <= got.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want if want[k] is not None)


def test_only_new_anchors_are_scored_and_without_an_outcome(spark, store):
    inputs = store.read("gold/score_dataset")
    assert not {"label", "split", "deterioration_time"} & set(inputs.columns)
    live = store.read("marts/live_scores")
    n, version = inputs.count(), live.first()["model_version"]
    name, run_id = version.rsplit("_run_", 1)[0], "run_" + version.rsplit("_run_", 1)[1]
    assert live.count() == live.select(*ANCHOR_KEYS).distinct().count() == n
    full = store.read("marts/risk_scores").where(F.col("model_version") == version).select(*ANCHOR_KEYS, F.col("risk_score").alias("full"))
    assert live.join(full, list(ANCHOR_KEYS)).where("abs(risk_score - full) < 1e-12").count() == n
    # Anchors that came later: the same stays, a year on, with no row in any outcome table.
    later = inputs.where("anchor_time < timestamp'2024-01-03'").withColumn("anchor_time", F.expr("anchor_time + interval 366 days"))
    n_later = later.count()
    inputs.unionByName(later).write.parquet(store.path("gold/grown"))
    store.spark.read.parquet(store.path("gold/grown")).write.mode("overwrite").parquet(store.path("gold/score_dataset"))
    at = F.lit("2024-03-01 00:00:00").cast("timestamp")
    medallion.score_new(store, run_id, name, at, SETTINGS)
    assert store.rows()["marts/live_scores"] == n_later > 0
    medallion.score_new(store, run_id, name, at, SETTINGS)
    assert store.rows()["marts/live_scores"] == 0
    assert store.read("marts/live_scores").select(*ANCHOR_KEYS).distinct().count() == n + n_later


def test_a_run_that_stopped_is_not_the_latest(spark, store):
    latest = {r["run_id"] for r in store.latest("marts/model_metrics").collect()}
    half = store.read("marts/model_metrics").where(F.col("run_id") == latest.pop()).withColumn("run_id", F.lit("run_9")).limit(3)
    store.write_run(half, "marts/model_metrics")
    assert {r["run_id"] for r in store.latest("marts/model_metrics").collect()} == {"run_2"}
    assert store.read("marts/model_metrics").where("run_id = 'run_9'").count() == 3, "marks are no rows of the table"
    store.commit("marts/model_metrics", "run_9")
    store.commit("marts/model_metrics", "run_9")
    assert {r["run_id"] for r in store.latest("marts/model_metrics").collect()} == {"run_9"}
    revoke_run(spark, store.path("marts/model_metrics"), "run_9")
    assert {r["run_id"] for r in store.latest("marts/model_metrics").collect()} == {"run_2"}


def test_local_times_become_utc(spark):
    rows = [("a", dt.datetime(2024, 1, 1, 23, 30), dt.date(2024, 1, 1)), ("b", None, None)]
    df = spark.createDataFrame(rows, "k string, event_time timestamp, event_date date")
    assert clean.to_utc(df, ["event_time"], None) is df
    got = {r["k"]: (r["event_time"], r["event_date"]) for r in clean.to_utc(df, ["event_time"], "-05:00").selectExpr("k", "cast(event_time as timestamp_ntz) event_time", "event_date").collect()}
    base = df.selectExpr("cast(event_time as timestamp_ntz) t").first()["t"]
    assert got["a"][0] - base == dt.timedelta(hours=5) and got["a"][1] == (base + dt.timedelta(hours=5)).date() and got["b"] == (None, None)


def test_raw_tables_are_reported_before_they_are_refused(spark, store, tmp_path_factory):
    other = medallion.Store(spark, str(tmp_path_factory.mktemp("broken")))
    for name in RAW_TABLES:
        raw = store.read(f"raw/{name}")
        if name == "vitals":
            raw = raw.drop("hr").withColumn("event_time", F.when(F.col("sbp") > 80, "never").otherwise(F.col("event_time").cast("string")))
        raw.write.parquet(other.path(f"raw/{name}"))
    medallion.check_raw(other, "run_1")
    with pytest.raises(Exception):
        medallion.to_bronze(other, "feed")
    got = {(r["layer"], r["metric"]): (r["value"], r["passed"]) for r in other.read("marts/raw_quality").collect()}
    assert got["raw/vitals", "has_hr"] == (0.0, False) and got["raw/vitals", "has_sbp"] == (1.0, True)
    n = other.read("raw/vitals").where("event_time = 'never'").count()
    assert got["raw/vitals.event_time", "unparseable"] == (float(n), False) and n > 0
