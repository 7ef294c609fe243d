from __future__ import annotations

import contextlib
import datetime as dt
import io
import os
import re

import pytest
from pyspark.sql import functions as F, types as T

from tidewatch.functions import hash_bucket, murmur3_bucket
from tidewatch.operators import clean, dataset, ingest, joins
from tidewatch.sources import (
    assert_schema,
    commit_run,
    committed_runs,
    enforce_schema,
    export_csv,
    latest_run,
    numeric_columns,
    read_bucketed,
    read_table,
    revoke_run,
    row_audit,
    stage,
    tables,
    write_bucketed,
    write_table,
)
from tidewatch.sources.tables import shared_folder

D = dt.datetime(2024, 1, 1)


def test_clip_keeps_null_and_drops_nan(spark):
    df = spark.createDataFrame([(0, None), (1, float("nan")), (2, 29.9), (3, 30.0), (4, 220.0), (5, 221.0)], "i int, hr double")
    got = [r["hr"] for r in clean.clip_signals(df).orderBy("i").collect()]
    assert got == [None, None, 30.0, 30.0, 220.0, 220.0]


def test_range_flags_leave_values(spark):
    df = spark.createDataFrame([(19.0,), (20.0,), (220.5,), (None,), (float("nan"),)], "hr double")
    got = clean.range_flags(df).collect()
    assert [r["hr_oor"] for r in got] == [1, 0, 1, 0, 0] and got[0]["hr"] == 19.0


def test_dedupe_keeps_the_latest_and_breaks_ties_by_value(spark):
    rows = [("a", 1, 5.0), ("a", 2, 1.0), ("a", 2, 3.0), ("b", 1, None), ("b", None, 9.0)]
    df = spark.createDataFrame(rows, "k string, o int, v double")
    for n in (1, 7):
        got = {r["k"]: r["v"] for r in clean.dedupe_latest(df.repartition(n), ["k"], ["o"]).collect()}
        assert got == {"a": 3.0, "b": None}


def test_dedupe_reduces_keys_ahead_of_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = clean.dedupe_latest(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_enum_time_and_intervals(spark):
    df = spark.createDataFrame([(" m ",), ("F",), ("x",), (None,)], "sex string")
    assert [r["sex"] for r in clean.standardize_enum(df, "sex").collect()] == ["M", "F", "U", "U"]
    times = spark.createDataFrame([("2024-01-01 05:00:00",), ("soon",)], "t string")
    got = [r["t"] for r in clean.normalize_time(times, "t", "+05:00").select(F.col("t").cast("timestamp_ntz").alias("t")).collect()]
    assert got == [D, None]
    spans = spark.createDataFrame([(D, D), (D, D + dt.timedelta(1)), (D, None), (None, D)], "admit_time timestamp_ntz, discharge_time timestamp_ntz")
    assert clean.valid_intervals(spans).count() == 2


def test_silver_events_drop_rows_without_keys(spark):
    df = spark.createDataFrame(
        [("p", "a", D, 500.0, 1), ("p", "a", D, 80.0, 2), ("p", None, D, 80.0, 1)],
        "patient_id string, admission_id string, event_time timestamp_ntz, hr double, _ingest_ts int",
    )
    assert [r["hr"] for r in clean.silver_events(df).collect()] == [80.0]


def test_bronze_lower_cases_and_refuses_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "Aa int, B int")
    out = ingest.bronze_ingest(df, "src", D)
    assert out.columns == ["aa", "b", "_ingest_ts", "_source"]
    with pytest.raises(ValueError, match="case"):
        ingest.lower_case_columns(df.toDF("x", "X"))


def test_orphans(spark):
    events = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k int")
    stays = spark.createDataFrame([(2,)], "k int")
    assert {tuple(r) for r in joins.orphan_keys(events, stays, ["k"]).collect()} == {(1, 2), (3, 1)}
    assert joins.orphan_rows(events, stays, ["k"]).count() == 3


def test_schema_checks(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    wanted = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    with pytest.raises(ValueError, match="wrong types"):
        assert_schema(df, wanted)
    with pytest.raises(ValueError, match="missing"):
        enforce_schema(df.drop("b"), wanted)
    assert enforce_schema(df, wanted, lenient=True).first() == (1, None)
    typed = spark.createDataFrame([], "a int, b bigint, c double, d string, e decimal(5,2), label int")
    assert numeric_columns(typed, ["label"]) == ["a", "b", "c", "e"]


def test_partitioned_write_prunes_and_overwrites_dynamically(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).select((F.col("id") % 4).cast("int").alias("d"), "id")
    write_table(df, path, partition_by=["d"], files_per_partition=3, cluster_on=[F.col("id")])
    back = read_table(spark, path)
    assert back.count() == 100
    assert "PartitionFilters: [isnotnull(d" in back.where("d = 2")._jdf.queryExecution().executedPlan().toString()
    write_table(df.where("d = 1").limit(3), path, partition_by=["d"], dynamic=True)
    assert {r["d"]: r["count"] for r in read_table(spark, path).groupBy("d").count().collect()} == {0: 25, 1: 3, 2: 25, 3: 25}
    with pytest.raises(ValueError):
        write_table(df, path, partition_by=["d"], files_per_partition=2)


def test_latest_run_csv_audit_and_stage(spark, tmp_path):
    runs = spark.createDataFrame([("r1", 1), ("r2", 2), ("r2", 3)], "run_id string, v int")
    assert sorted(r["v"] for r in latest_run(runs).collect()) == [2, 3]
    export_csv(runs, str(tmp_path / "csv"), single_file=True)
    assert read_table(spark, str(tmp_path / "csv"), runs.schema, "csv", {"header": "true"}).count() == 3
    audited, seen = row_audit(runs, "runs", twos=F.count_if(F.col("v") == 2))
    write_table(audited, str(tmp_path / "audited"))
    assert seen.get == {"rows": 3, "twos": 1}
    kept = stage(runs, "runs")
    assert kept.schema == runs.schema and kept.count() == 3
    assert spark.conf.get("spark.checkpoint.dir") in kept.inputFiles()[0]


def test_fill_encode_and_split(spark):
    df = spark.createDataFrame([("p1", None, 3, "M", None), ("p2", 1.5, None, None, 1)], "patient_id string, x double, n bigint, sex string, label int")
    filled = dataset.fill_nulls(df)
    assert [(r["x"], r["n"], r["label"]) for r in filled.orderBy("patient_id").collect()] == [(0.0, 3.0, None), (1.5, 0.0, 1)]
    assert [r["sex_m"] for r in dataset.encode_binary(df, "sex", "M", "sex_m").orderBy("patient_id").collect()] == [1, 0]
    assert spark.createDataFrame([("P1",)], "k string").select(hash_bucket("k").alias("b")).first()["b"] == 35
    many = spark.range(2000).select(F.concat(F.lit("P"), (F.col("id") % 500).cast("string")).alias("patient_id"))
    for method in ("md5", "murmur3"):
        split = dataset.split_assign(many, method=method)
        assert split.groupBy("patient_id").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
        shares = {r["split"]: r["count"] / 2000 for r in split.groupBy("split").count().collect()}
        assert abs(shares["train"] - 0.7) < 0.08 and abs(shares["val"] - 0.15) < 0.06
    own = many.select("patient_id", murmur3_bucket("patient_id").alias("a"), F.expr("pmod(abs(hash(patient_id)), 100)").alias("b"))
    assert own.where("a <> b").count() == 0
    null_key = spark.createDataFrame([(None,)], "patient_id string")
    assert dataset.split_assign(null_key).first()["split"] is not None


def test_class_weights(spark):
    df = spark.createDataFrame([(1, "train"), (0, "train"), (0, "train"), (0, "train"), (1, "test")], "label int, split string")
    got = dataset.class_weights(df, df.where("split = 'train'"))
    assert {(r["label"], r["weight"]) for r in got.collect()} == {(1, 3.0), (0, 1.0)}
    none = dataset.class_weights(df, df.where("label = 0"))
    assert {r["weight"] for r in none.collect()} == {1.0}
    assert "CartesianProduct" not in got._jdf.queryExecution().executedPlan().toString()


def test_temporal_split_keeps_equal_times_together(spark):
    rows = [("p", f"a{i}", D + dt.timedelta(days=i // 10)) for i in range(100)]
    df = spark.createDataFrame(rows, "patient_id string, admission_id string, admit_time timestamp_ntz")
    split = dataset.split_temporal(df)
    per_day = split.groupBy("admit_time").agg(F.count_distinct("split").alias("n"), F.first("split").alias("s")).orderBy("admit_time").collect()
    assert all(r["n"] == 1 for r in per_day)
    assert [r["s"] for r in per_day] == ["train"] * 7 + ["val"] * 2 + ["test"]


class _Unset:
    """A session without a shared folder."""

    def __init__(self, master, app):
        self.conf, self.sparkContext = self, self
        self.master, self.applicationId = master, app

    def get(self, key, default):
        return default


def test_shared_folder_without_the_setting():
    first = shared_folder(_Unset("local[2]", "a"))
    assert shared_folder(_Unset("local[2]", "a")) == first != shared_folder(_Unset("local[2]", "b"))
    with pytest.raises(ValueError, match="shared folder"):
        shared_folder(_Unset("spark://host:7077", "c"))


def test_split_stats(spark):
    rows = [("p", "train", 1), ("p", "train", 0), ("q", "test", 0), ("r", None, 0)]
    df = spark.createDataFrame(rows, "patient_id string, split string, label int")
    got = {r["split"]: (r["n_rows"], r["n_pos"], r["n_entities"]) for r in dataset.split_stats(df).collect()}
    assert got == {"train": (2, 1, 1), "test": (1, 0, 1), None: (1, 0, 1), "all": (4, 1, 3)}


def test_fixed_number_of_files(spark, tmp_path):
    write_table(spark.range(100), str(tmp_path / "t"), files=3)
    assert len(read_table(spark, str(tmp_path / "t")).inputFiles()) == 3
    assert spark.range(100).exceptAll(read_table(spark, str(tmp_path / "t"))).count() == 0


def test_bucketed_features_are_joined_where_they_lie(spark, tmp_path):
    keys = ["patient_id", "admission_id", "anchor_time"]
    ids = [F.concat(F.lit("P"), F.col("id") % 50).alias("patient_id"), F.concat(F.lit("A"), F.col("id") % 50).alias("admission_id")]
    time = F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("anchor_time")
    plain = spark.range(2000).select(*ids, time, (F.col("id") % 7 / 7.0).alias("hr_mean_24h"))
    labels = plain.select(*keys, (F.col("hr_mean_24h") > 0.8).cast("int").alias("label"))
    attributes = plain.select("patient_id", "admission_id").distinct().withColumn("age", F.length("patient_id"))
    path = str(tmp_path / "gold")
    write_bucketed(plain, path, keys, 6)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 6
    spark.sql(f"DROP TABLE {tables._bucketed_name(path)}")
    lying = read_bucketed(spark, path, plain.schema, keys, 6)
    assert read_bucketed(spark, path, plain.schema, keys, 6).count() == 2000

    def shuffled(features):
        made = dataset.training_set(features, labels, attributes)
        with contextlib.redirect_stdout(io.StringIO()) as text:
            made.explain("formatted")
        nodes = re.split(r"\n\(\d+\) ", text.getvalue())
        return made, [n for n in nodes if n.startswith("Exchange") and "hr_mean" in n]

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    one, exchanged = shuffled(plain)
    two, none = shuffled(lying)
    assert len(exchanged) == 1 and none == []
    assert one.exceptAll(two).count() == two.exceptAll(one).count() == 0 and two.count() == 2000
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_runs_are_read_once_they_are_committed(spark, tmp_path):
    path = str(tmp_path / "scores")
    for run in ("r1", "r2", "r3"):
        spark.createDataFrame([(1, run)], "v int, run_id string").write.mode("append").partitionBy("run_id").parquet(path)
        if run != "r3":
            commit_run(spark, path, run)
    df = spark.read.schema("v int, run_id string").parquet(path)
    newest = lambda: [r["run_id"] for r in latest_run(df, committed=committed_runs(spark, path)).collect()]
    assert df.count() == 3 and newest() == ["r2"]
    revoke_run(spark, path, "r2")
    assert newest() == ["r1"] and committed_runs(spark, str(tmp_path / "none")).count() == 0
