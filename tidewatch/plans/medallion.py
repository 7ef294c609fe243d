"""The batch jobs end to end: raw, bronze, silver, gold, model, scores, dashboard extract.

Each job reads the tables of the job before and writes its own, one action per table; row counts
are observed during the write. Tables live below one root, which on a cluster is shared storage.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tidewatch.config import (
    ANCHOR_KEYS,
    CLIP_RANGES,
    OUTCOME_TYPES,
    DEFAULT_LAB_STATS,
    DEFAULT_VITAL_STATS,
    KEYS,
    AlertPolicy,
    DashboardSpec,
    Horizon,
    SignalStats,
    SplitFractions,
    TimeGrid,
)
from tidewatch.functions import null_if_nan
from tidewatch.operators import clean, compiled, dataset, evaluate, ingest, labels, model, publish, quality, windows
from tidewatch.operators import drift as sketches
from tidewatch.operators.anchors import anchor_grid
from tidewatch.sources import (
    assert_schema,
    commit_run,
    committed_runs,
    export_csv,
    latest_run,
    path_exists,
    read_table,
    revoke_run,
    row_audit,
    stage,
    unstage,
    write_table,
)
from tidewatch.sources.schemas import RAW_TABLES, struct_of

EVENTS = ("vitals", "labs")
# Tables of a few rows per run, one partition each: a run that is repeated replaces its own rows.
# The schemas keep run ids of digits as text.
MARTS = {
    "marts/model_metrics": struct_of("model string,split string,metric string,value double,run_id string"),
    "marts/evaluation": struct_of("model string,split string,metric string,value double,run_id string"),
    "marts/run_metrics": struct_of("metric string,value double,run_id string"),
    "marts/signal_sketches": struct_of("signal string,n bigint,sketch binary,run_id string"),
    "marts/data_quality": struct_of("check string,layer string,severity string,metric string,value double,passed boolean,run_id string"),
    "marts/raw_quality": struct_of("check string,layer string,severity string,metric string,value double,passed boolean,run_id string"),
}
ATTRIBUTES = ("age", "sex", "diabetes", "ckd", "copd", "chf", "comorbidity_count", "admit_acuity")


@dataclass(frozen=True)
class Settings:
    grid: TimeGrid = field(default_factory=TimeGrid)
    horizon: Horizon = field(default_factory=Horizon)
    splits: SplitFractions = field(default_factory=SplitFractions)
    alerts: AlertPolicy = field(default_factory=AlertPolicy)
    dashboard: DashboardSpec = field(default_factory=DashboardSpec)
    clip_ranges: Mapping[str, tuple[float, float]] = field(default_factory=lambda: dict(CLIP_RANGES))
    vital_stats: tuple[SignalStats, ...] = DEFAULT_VITAL_STATS
    lab_stats: tuple[SignalStats, ...] = DEFAULT_LAB_STATS
    split_method: str = "murmur3"
    select_on: str = "val"
    calibration_bins: int = 10
    gbt_iterations: int = 60
    seed: int = 42
    # Zone of the raw times; none if they are UTC.
    zone: str | None = None


@dataclass(frozen=True)
class Store:
    """Names tables below a root folder and counts the rows written to them."""

    spark: SparkSession
    root: str
    counts: dict[str, Observation] = field(default_factory=dict)
    # Values outside of their range, by table, counted while they are clipped.
    clipped: dict[str, Observation] = field(default_factory=dict)

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(self, table: str) -> DataFrame:
        return read_table(self.spark, self.path(table), MARTS.get(table))

    def latest(self, table: str) -> DataFrame:
        """The newest run whose rows are all written."""
        return latest_run(self.read(table), committed=committed_runs(self.spark, self.path(table)))

    def commit(self, table: str, run_id: str) -> None:
        commit_run(self.spark, self.path(table), run_id)

    def write_run(self, df: DataFrame, table: str) -> None:
        """A few rows of one run, in place of any it had."""
        small = df.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        small.partitionBy("run_id").parquet(self.path(table))

    def write(self, df: DataFrame, table: str, **options) -> None:
        audited, self.counts[table] = row_audit(df, table.replace("/", "_"))
        write_table(audited, self.path(table), **options)

    def rows(self) -> dict[str, int]:
        return {t: seen.get["rows"] for t, seen in self.counts.items()}


def check_raw(store: Store, run_id: str) -> None:
    """Report required columns and how many times can be read, ahead of anything that would refuse them."""
    checks: list[DataFrame | quality.Check] = []
    for name, schema in RAW_TABLES.items():
        raw = store.read(f"raw/{name}")
        checks.append(quality.schema_check(raw, schema.names, f"raw/{name}"))
        times = [f.name for f in schema if f.dataType.simpleString() == "timestamp" and f.name in raw.columns]
        checks += [quality.parse_check(raw, c, f"raw/{name}.{c}") for c in times]
    store.write_run(quality.fused(checks).withColumn("run_id", F.lit(run_id)), "marts/raw_quality")


def to_bronze(store: Store, source: str, ingest_ts: Column | None = None) -> None:
    for name, schema in RAW_TABLES.items():
        bronze = ingest.bronze_ingest(store.read(f"raw/{name}"), source, ingest_ts)
        by = ["event_date"] if name in EVENTS else []
        store.write(assert_schema(bronze, schema), f"bronze/{name}", partition_by=by)


def to_silver(store: Store, settings: Settings = Settings()) -> None:
    stays = clean.dedupe_latest(store.read("bronze/admissions"), KEYS, ["_ingest_ts"])
    stays = clean.to_utc(stays, ["admit_time", "discharge_time"], settings.zone)
    stays = clean.standardize_enum(clean.valid_intervals(stays), "sex")
    store.write(stays, "silver/admissions")
    for name in EVENTS:
        bronze = clean.to_utc(store.read(f"bronze/{name}"), ["event_time"], settings.zone)
        outside = {
            c: F.count_if((null_if_nan(c) < lo) | (null_if_nan(c) > hi)) for c, (lo, hi) in settings.clip_ranges.items() if c in bronze.columns
        }
        bronze, store.clipped[f"silver/{name}"] = row_audit(bronze, f"clipped_{name}", **outside)
        events = clean.silver_events(bronze, settings.clip_ranges)
        store.write(events, f"silver/{name}", partition_by=["event_date"])
    outcomes = clean.dedupe_latest(store.read("bronze/outcomes"), KEYS, ["_ingest_ts"])
    outcomes = clean.to_utc(outcomes, ["deterioration_time"], settings.zone)
    outcomes = clean.standardize_enum(outcomes, "outcome_type", OUTCOME_TYPES, None)
    store.write(clean.valid_outcomes(outcomes, store.read("silver/admissions")), "silver/outcomes")


def sketch_signals(store: Store, run_id: str, settings: Settings = Settings()) -> None:
    """Keep a quantile sketch of every signal of this run, to compare distributions across runs by."""
    kept = None
    for name in EVENTS:
        events = store.read(f"silver/{name}")
        part = sketches.signal_sketches(events, [c for c in settings.clip_ranges if c in events.columns], run_id)
        kept = part if kept is None else kept.unionByName(part)
    store.write_run(kept, "marts/signal_sketches")


def to_gold(store: Store, settings: Settings = Settings()) -> None:
    stays = store.read("silver/admissions")
    store.write(anchor_grid(stays, settings.grid), "gold/anchors")
    families = [
        windows.vitals_family(store.read("silver/vitals"), settings.vital_stats),
        windows.labs_family(store.read("silver/labs"), settings.lab_stats),
    ]
    store.write(windows.gold_features(stays, families, settings.grid, audit=True), "gold/features")
    outcomes = store.read("silver/outcomes")
    store.write(labels.label_horizon(store.read("gold/anchors"), outcomes, settings.horizon), "gold/labels")


ENCODED = {"sex": ("M", "sex_m")}


def to_training_set(store: Store, settings: Settings = Settings()) -> None:
    labelled = labels.with_labels(store.read("gold/features"), store.read("silver/outcomes"), settings.horizon)
    table = dataset.model_table(
        labelled.drop("deterioration_time", "max_event_time"),
        store.read("silver/admissions").select(*KEYS, *ATTRIBUTES),
        settings.splits,
        encode=ENCODED,
        method=settings.split_method,
    )
    store.write(table, "gold/training_set")


def to_score_set(store: Store) -> None:
    """What there is to score: features and attributes of all anchors, with or without an outcome."""
    features = store.read("gold/features").drop("max_event_time")
    inputs = dataset.model_inputs(features, store.read("silver/admissions").select(*KEYS, *ATTRIBUTES), encode=ENCODED)
    store.write(inputs, "gold/score_dataset")


def train(store: Store, run_id: str, settings: Settings = Settings()) -> None:
    """Fit both models on the train split, save them, write their metrics on val and test."""
    table = store.read("gold/training_set")
    weighted = dataset.class_weights(table, table.where(F.col("split") == "train"))
    features = model.feature_columns(weighted)
    pipelines = {
        "log_reg": model.logreg_pipeline(features),
        "gbt": model.gbt_pipeline(features, max_iter=settings.gbt_iterations, seed=settings.seed),
    }
    fitting = weighted.where(F.col("split") == "train")
    held_out = weighted.where(F.col("split") != "train")
    scored = None
    for name, pipeline in pipelines.items():
        fitted = model.fit_and_save(pipeline, fitting, store.path(f"models/{run_id}/{name}"))
        part = model.score(held_out, fitted, [*ANCHOR_KEYS, "split", "label"], "prob").withColumn("model", F.lit(name))
        scored = part if scored is None else scored.unionByName(part)
    # Every metric below reads the scores again, so they are written once.
    scored = stage(scored, "held-out-scores")
    metrics = evaluate.metrics_long(scored, run_id)
    # One search for the cut-offs of all models and splits.
    metrics = metrics.unionByName(evaluate.topk_long(scored, settings.alerts.rates, {"run_id": run_id}, by=("model", "split")))
    store.write_run(metrics, "marts/model_metrics")
    store.commit("marts/model_metrics", run_id)
    unstage(scored)


def evaluate_best(store: Store, settings: Settings = Settings()) -> tuple[str, str]:
    """Choose the best model of the latest run; write its record on the test split and its calibration.

    The record is computed anew from the saved model: areas, errors, and the rates of all alert policies.
    """
    metrics = store.latest("marts/model_metrics")
    best = evaluate.select_model(metrics, "auprc", settings.select_on).first()
    if best is None:
        raise ValueError(f"no model has a value on the split '{settings.select_on}'")
    run_id, name = best["run_id"], best["model"]
    test = store.read("gold/training_set").where(F.col("split") == "test")
    fitted = compiled.load_compiled(store.spark, store.path(f"models/{run_id}/{name}"))
    scored = compiled.score_with(test, fitted, [*ANCHOR_KEYS, "split", "label"], "prob").withColumn("model", F.lit(name))
    scored = stage(scored, "test-scores")
    record = evaluate.metrics_long(scored, run_id)
    record = record.unionByName(evaluate.topk_long(scored, settings.alerts.rates, {"run_id": run_id}, by=("model", "split")))
    store.write_run(record, "marts/evaluation")
    # As many rows as bins.
    export_csv(evaluate.calibration(scored, settings.calibration_bins), store.path("reports/calibration_test"), single_file=True)
    unstage(scored)
    return run_id, name


def score(store: Store, run_id: str, name: str, scored_at: Column, settings: Settings = Settings()) -> None:
    """Score all rows, one partition per run, with a preview of the highest scores."""
    fitted = compiled.load_compiled(store.spark, store.path(f"models/{run_id}/{name}"))
    keep = [*ANCHOR_KEYS, "anchor_date", "label", "split"]
    scores = compiled.score_with(store.read("gold/training_set"), fitted, keep)
    # A run that is repeated is not read until its rows are complete again.
    revoke_run(store.spark, store.path("marts/risk_scores"), run_id)
    out = publish.score_output(scores, f"{name}_{run_id}", scored_at, settings.dashboard.bands)
    table = out.withColumn("run_id", F.lit(run_id))
    audited, store.counts["marts/risk_scores"] = row_audit(table, "risk_scores")
    # One run is one partition value: rows are written where they are instead of being clustered.
    audited.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(
        store.path("marts/risk_scores")
    )
    store.commit("marts/risk_scores", run_id)
    newest = store.latest("marts/risk_scores")
    export_csv(publish.top_risk_preview(newest), store.path("reports/risk_scores_sample"), single_file=True)


def score_new(store: Store, run_id: str, name: str, scored_at: Column, settings: Settings = Settings()) -> None:
    """Score the anchors of the score set that this model version has not scored yet; no outcome is needed.

    One partition per model version. What is there already is left out by an anti-join of the keys, and
    new rows are added; a call that finds nothing new adds none.
    """
    version = f"{name}_{run_id}"
    path = store.path("marts/live_scores")
    inputs = store.read("gold/score_dataset")
    if path_exists(store.spark, path):
        schema = struct_of("patient_id string,admission_id string,anchor_time timestamp,model_version string")
        done = read_table(store.spark, path, schema).where(F.col("model_version") == version)
        inputs = dataset.unscored(inputs, done)
    fitted = compiled.load_compiled(store.spark, store.path(f"models/{run_id}/{name}"))
    scores = compiled.score_with(inputs, fitted, [*ANCHOR_KEYS, "anchor_date"])
    out = publish.score_output(scores, version, scored_at, settings.dashboard.bands)
    audited, store.counts["marts/live_scores"] = row_audit(out, "live_scores")
    audited.write.mode("append").partitionBy("model_version").parquet(path)


def export_dashboard(store: Store, settings: Settings = Settings()) -> None:
    newest = store.latest("marts/risk_scores")
    scored = newest.select(*ANCHOR_KEYS, "anchor_date", "risk_score", "label", "split")
    extract = publish.dashboard_extract(scored, store.read("gold/training_set"), settings.dashboard)
    # At most settings.dashboard.rows rows.
    export_csv(extract, store.path("reports/dashboard"), single_file=True)


def check_quality(store: Store, run_id: str, run_time: Column, settings: Settings = Settings()) -> DataFrame:
    """The checks of all layers, written to the quality table; failed errors raise.

    The grid runs on after an outcome by default, so anchors after an outcome are a warning here.
    """
    event_keys = [*KEYS, "event_time"]
    stays = store.read("silver/admissions")
    checks = []
    for name in EVENTS:
        bronze, silver = store.read(f"bronze/{name}"), store.read(f"silver/{name}")
        checks += [
            quality.schema_check(bronze, event_keys, f"bronze/{name}"),
            quality.parse_check(bronze, "event_time", f"bronze/{name}"),
            quality.check_duplicates(bronze, event_keys, f"bronze/{name}"),
            quality.ranges_check(bronze, layer=f"bronze/{name}"),
            quality.check_temporal(silver, stays, run_time, f"silver/{name}"),
            quality.check_duplicates(silver, event_keys, f"silver/{name}", remaining_is_error=True),
            *quality.interval_checks(silver, stays, f"silver/{name}"),
            quality.check_dedupe_removed(bronze, silver, f"silver/{name}"),
            quality.nulls_check(silver, [c for c in settings.clip_ranges if c in silver.columns], f"silver/{name}"),
        ]
    table, features, anchors = (store.read(f"gold/{t}") for t in ("training_set", "features", "anchors"))
    hours = {f"{s.signal}_tslm_{w}h": w for s in (*settings.vital_stats, *settings.lab_stats) for w in settings.grid.windows_h}
    present = {c: w for c, w in hours.items() if c in features.columns}
    checks += [
        quality.check_anchors(anchors, stays, store.read("silver/outcomes"), "gold/anchors", after_outcome=quality.WARN),
        quality.leakage_check(features, settings.grid.windows_h, "gold/features"),
        *([quality.features_check(features, present, "gold/features")] if present else []),
        quality.check_duplicates(store.read("gold/anchors"), ANCHOR_KEYS, "gold/anchors", remaining_is_error=True),
        quality.check_labels(store.read("gold/labels")),
        quality.check_split_overlap(table),
        quality.check_scores(store.latest("marts/risk_scores")),
    ]
    return quality.run_checks(checks, store.path("marts/data_quality"), run_id)


def record_run(store: Store, run_id: str) -> None:
    """Append the monitoring metrics of a run ``(run_id, metric, value)``.

    Row counts and clipped values were observed while the tables were written; the metrics of the checks and of the
    models are already tables of a few rows.
    """
    counted = store.spark.createDataFrame(
        [(run_id, f"rows:{table}", float(n)) for table, n in store.rows().items()],
        "run_id string, metric string, value double",
    )
    rows = store.rows()
    # Bronze holds every row that came in.
    came = [(run_id, f"rows:in/{t}", float(rows[f"bronze/{t}"])) for t in RAW_TABLES if f"bronze/{t}" in rows]
    if rows.get("silver/admissions"):
        came.append((run_id, "anchors_per_stay", rows.get("gold/anchors", 0) / rows["silver/admissions"]))
    for table, seen in store.clipped.items():
        came += [(run_id, f"clipped:{table}:{c}", float(n)) for c, n in seen.get.items() if c != "rows"]
    counted = counted.unionByName(store.spark.createDataFrame(came, counted.schema))
    here = F.col("run_id") == run_id
    checks = store.read("marts/data_quality").where(here)
    checked = checks.select("run_id", F.concat_ws(":", "layer", "check", "metric").alias("metric"), "value")
    models = store.read("marts/model_metrics").where(here)
    trained = models.select("run_id", F.concat_ws(":", "model", "split", "metric").alias("metric"), "value")
    history = counted.unionByName(checked).unionByName(trained)
    store.write_run(history, "marts/run_metrics")


def drift(store: Store, limit: float = 0.10) -> DataFrame:
    """Metrics that moved by more than ``limit`` against the run before."""
    return quality.check_drift(store.read("marts/run_metrics"), limit).where(~F.col("passed"))


def distribution_drift(store: Store, limit: float = 0.10) -> DataFrame:
    """Signals whose distribution surely moved by more than ``limit`` in rank against the run before."""
    return sketches.distribution_drift(store.read("marts/signal_sketches"), limit).where(~F.col("passed"))


def run_all(
    store: Store,
    run_id: str,
    source: str,
    run_time: Column,
    settings: Settings = Settings(),
) -> dict[str, int]:
    """All jobs in order. Returns the rows written per table."""
    check_raw(store, run_id)
    to_bronze(store, source, run_time)
    to_silver(store, settings)
    sketch_signals(store, run_id, settings)
    to_gold(store, settings)
    to_training_set(store, settings)
    to_score_set(store)
    train(store, run_id, settings)
    chosen, name = evaluate_best(store, settings)
    score(store, chosen, name, run_time, settings)
    score_new(store, chosen, name, run_time, settings)
    export_dashboard(store, settings)
    check_quality(store, run_id, run_time, settings)
    record_run(store, run_id)
    return store.rows()
