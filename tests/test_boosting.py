from __future__ import annotations

import math

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidewatch.operators import boosting, compiled, dataset, model
from tidewatch.plans import catalog

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(autouse=True)
def blocks_for_few_rows(monkeypatch):
    monkeypatch.setattr(boosting, "_FEW_ROWS", 0)


def _rows(spark, n, parts):
    """Rows with a dense, a sparse, a coarse and a constant feature."""
    part = lambda k: (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(10_000)) / 10_000.0)
    df = spark.range(0, n, 1, parts).withColumn("a", part(1) * 8 - 3).withColumn("b", F.when(part(2) < 0.2, part(3) * 5).otherwise(0.0))
    df = df.withColumn("c", F.floor(part(4) * 3).cast("double")).withColumn("d", F.lit(0.0))
    return df.withColumn("label", (F.col("a") + F.col("b") * F.col("c") + part(5) * 4 > 5).cast("int")).withColumn("weight", 1.0 + F.col("c"))


def _both(df, **params):
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)
    params = {"labelCol": "label", "maxIter": 2, "maxDepth": 3, "minInstancesPerNode": 20, "stepSize": 0.1, "subsamplingRate": 0.8, "seed": 42} | params
    return GBTClassifier(**params).fit(vectors), boosting.BoostedTrees(**params).fit(vectors), vectors


def _alike(own, theirs):
    """The same trees but for the last digits of sums, which Spark adds up in no fixed order over parts."""
    for a, b in zip(compiled._forest_in_memory(own, FEATURES).trees, compiled._forest_in_memory(theirs, FEATURES).trees, strict=True):
        shape = [[(k, n.left, n.right, n.feature, n.threshold) for k, n in sorted(t.items())] for t in (a, b)]
        if shape[0] != shape[1] or any(n.prediction != pytest.approx(b[k].prediction, abs=1e-9) for k, n in a.items()):
            return False
    return own.treeWeights == theirs.treeWeights


@pytest.mark.parametrize("n, parts, trees", [(2_000, 3, 10), (15_000, 1, 2), (30_000, 2, 2)])
def test_trees_are_those_of_spark(spark, n, parts, trees):
    """Also where thresholds come from a sample, of either kind, and margins are added up anew."""
    theirs, own, _ = _both(_rows(spark, n, parts), maxIter=trees)
    assert _alike(own, theirs)
    assert own.numFeatures == theirs.numFeatures and own.totalNumNodes == theirs.totalNumNodes
    assert own.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray())


@pytest.mark.parametrize("params", [{"minInstancesPerNode": 60}, {"minInfoGain": 0.02}, {"maxDepth": 0}, {"maxBins": 5}, {"subsamplingRate": 1.0}])
def test_parameters_are_heeded(spark, params):
    theirs, own, _ = _both(_rows(spark, 900, 1), **params, maxIter=2)
    assert _alike(own, theirs)


def test_many_rows_and_parts_add_up_to_the_same_trees(spark, monkeypatch):
    monkeypatch.setattr(boosting, "_FEW", 1)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 150)
    theirs, own, vectors = _both(_rows(spark, 3_000, 2))
    p = {k: {r["id"]: r["probability"][1] for r in m.transform(vectors).collect()} for k, m in (("theirs", theirs), ("own", own))}
    assert all(p["own"][k] == pytest.approx(v, abs=1e-9) for k, v in p["theirs"].items())


def test_the_pipeline_of_trees_packs_its_rows(spark, monkeypatch):
    """Fits of the pipeline go over blocks, those of few rows or with weights are Spark's own."""
    made = []
    packing = boosting._blocks
    monkeypatch.setattr(boosting, "_blocks", lambda *a: made.append(1) or packing(*a))
    df = _rows(spark, 300, 2)
    assert len(model.gbt_pipeline(FEATURES, max_iter=2).fit(df).stages[-1].trees) == 2 and made == [1]
    monkeypatch.setattr(boosting, "_FEW_ROWS", 300)
    assert len(model.gbt_pipeline(FEATURES, max_iter=2).fit(df).stages[-1].trees) == 2 and made == [1]
    monkeypatch.setattr(boosting, "_FEW_ROWS", 0)
    assert len(model.gbt_pipeline(FEATURES, max_iter=2, weight="weight").fit(df).stages[-1].trees) == 2 and made == [1]


def test_wrong_labels_are_refused(spark):
    df = _rows(spark, 50, 1)
    for bad in (df.withColumn("label", F.lit(2)), df.withColumn("label", F.lit(None).cast("int")), df.limit(0)):
        with pytest.raises(Exception):
            model.gbt_pipeline(FEATURES, max_iter=1).fit(bad)


def test_repeated_fits_read_rows_ordered_in_counted_parts(spark, small, monkeypatch):
    parts, staging = [], catalog.stage
    n = catalog.training_table(spark, small).where("split = 'train'").count()
    monkeypatch.setattr(dataset, "ROWS_PER_PART", n // 6)
    monkeypatch.setattr(catalog, "stage", lambda df, name: parts.append(df.rdd.getNumPartitions()) or staging(df, name))
    assert catalog.q_ml_gbt_repeat(spark, small).first()["n_off"] == 0
    assert parts == [math.ceil(n / (n // 6))], "ordered once, for both fits"
