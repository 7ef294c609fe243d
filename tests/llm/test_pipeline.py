from __future__ import annotations

from collections import defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tests.twin_check import connect, differences
from tidewatch.llm import neardup, queries
from tidewatch.sources.tables import shared_folder, staged_tables


def test_stages_agree_with_plain_versions(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, small).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen.append({r["doc_id"]: r["text"] for r in docs.collect()})
        assert docs.count() == len(seen[-1])
        assert docs.columns == columns or name == "mixing"
    raw = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    scored = {r["doc_id"] for r in queries.q_quality(spark, small).where("predicted = 1").collect()}
    assert set(seen[0]) == scored
    equal = defaultdict(list)
    for d, t in seen[0].items():
        equal[t].append(d)
    assert set(seen[1]) == {max(g) for g in equal.values()}
    assert set(seen[2]) == {d for d, x in brute.near_duplicates(list(seen[1].items()), 5, 80).items() if x[2]}
    leaks = {r["doc_id"] for r in queries.q_benchmark_leaks(spark, small).collect()}
    assert set(seen[3]) == set(seen[2]) - leaks
    assert seen[4] == {d: raw[d] for d in seen[3]}


def test_mixing_stage_equals_sql(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    mixed = corpus_pipeline.mix(spark, docs, small).select("doc_id", "source", "block", "slot", "on_target")
    assert differences(mixed, connect(small), queries.oracle_sql()["op9_mix_sources"]) == []


def test_stages_take_empty_and_odd_tables(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    odd = docs.limit(3).unionByName(docs.limit(3)).withColumn("text", F.when(F.col("doc_id") > 1, F.col("text")))
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, docs.limit(0), small).count() == 0
        assert step(spark, odd, small).count() <= 6


def test_rows_that_repeat_an_id_are_told_apart(spark, small):
    words = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(4)]
    near = [w + " end" for w in words]
    rows = [(1, words[0]), (5, near[0]), (5, words[1]), (None, words[2]), (None, near[2]), (None, words[3]), (7, words[3]), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("x"))
    got = corpus_pipeline.near_dedup(spark, docs, small)
    assert got.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert sorted((str(d), str(t)[:3]) for d, t in kept) == [("1", "w0x"), ("5", "w1x"), ("7", "w3x"), ("8", "Non"), ("None", "w2x")]
    twice = docs.unionByName(docs)
    once = corpus_pipeline.exact_dedup(spark, twice, small)
    assert once.columns == docs.columns
    want = [r for r in rows if r != (None, words[3])]
    assert sorted(map(str, [(r["doc_id"], r["text"]) for r in once.collect()])) == sorted(map(str, want))
    assert corpus_pipeline.near_dedup(spark, twice, small).count() == 6, "null texts are linked with nothing"


def test_near_duplicates_without_ids_are_linked(spark):
    words = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(None, words), (None, words + " end"), (3, "other words")], "doc_id long, text string")
    got = neardup.near_duplicates(docs, k=4, percent=80).where("doc_id is null").collect()
    assert len(got) == 2 and {r["component_id"] for r in got} == {None} and all(r["kept"] for r in got)
    docs = docs.unionByName(spark.createDataFrame([(9, words + " end")], docs.schema))
    assert {r["component_id"] for r in neardup.near_duplicates(docs, k=4, percent=80).where("doc_id is null").collect()} == {9}


def test_staged_tables_go_once_a_stage_is_written(spark, small):
    import os

    folder = f"{shared_folder(spark)}/tidewatch"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    out = corpus_pipeline.run(spark, small)
    left = {name.rpartition("-")[0] for name in set(os.listdir(folder)) - before}
    assert left == {"decontamination"}, "the input of the last stage"
    assert out.count() > 0


def test_a_row_is_named_by_its_place_in_files(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    docs.unionByName(docs).repartition(5).write.parquet(str(tmp_path / "twice"))
    twice = spark.read.parquet(str(tmp_path / "twice"))
    with staged_tables() as made:
        once = corpus_pipeline.exact_dedup(spark, twice, small)
        near = corpus_pipeline.near_dedup(spark, twice, small)
    assert not any("numbered" in f for t in made for f in t.inputFiles()), "no copy of the texts is written for it"
    assert once.count() == docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert near.count() == near.select("doc_id").distinct().count()


def test_columns_named_like_those_of_the_mix(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumn("slot", F.lit("mine")).withColumn("Block", F.lit(3))
    got = corpus_pipeline.mix(spark, docs, small)
    assert {"row_slot", "row_Block", "slot", "block"} <= set(got.columns) and len({c.lower() for c in got.columns}) == len(got.columns)
    assert {tuple(r) for r in got.select("row_slot", "row_Block").collect()} == {("mine", 3)}
