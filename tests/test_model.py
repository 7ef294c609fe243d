from __future__ import annotations

import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidewatch.config import SplitFractions
from tidewatch.operators import compiled, dataset, model

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        a, b = rng.gauss(0, 1), rng.gauss(50, 20)
        rows.append((i, a, b, int(a + b / 40 + rng.gauss(0, 1) > 1.5), rng.choice([1.0, 2.0])))
    return spark.createDataFrame(rows, "id int, a double, b double, label int, weight double")


def test_fitted_coefficients_leave_no_slope(spark, table):
    fitted = model.logreg_pipeline(FEATURES, max_iter=300).fit(table)
    slopes = {r["feature"]: r["slope"] for r in model.logreg_slopes(table, fitted, FEATURES).collect()}
    assert set(slopes) == {*FEATURES, "(intercept)"} and max(map(abs, slopes.values())) < 1e-3
    early = model.logreg_pipeline(FEATURES, max_iter=1).fit(table)
    assert model.logreg_slopes(table, early, FEATURES).agg(F.max(F.abs("slope"))).first()[0] > 1e-3


def test_trees_of_one_seed_are_equal(spark, table):
    scores = []
    for _ in range(2):
        fitted = model.gbt_pipeline(FEATURES, max_iter=3).fit(table.coalesce(1).sortWithinPartitions("id"))
        scores.append({r["id"]: r["risk_score"] for r in model.score(table, fitted, ["id"]).collect()})
    assert scores[0] == scores[1] and len(set(scores[0].values())) > 2
    other = model.gbt_pipeline(FEATURES, max_iter=3, seed=7).fit(table.coalesce(1).sortWithinPartitions("id"))
    assert {r["id"]: r["risk_score"] for r in model.score(table, other, ["id"]).collect()} != scores[0]


def test_saved_models_score_as_before(spark, table, tmp_path):
    fitted = model.fit_and_save(model.logreg_pipeline(FEATURES), table, str(tmp_path / "m"))
    again = model.load_model(str(tmp_path / "m"))
    one, two = (model.score(table, m, ["id"]).orderBy("id").collect() for m in (fitted, again))
    assert one == two


def test_class_weights_balance(spark, table):
    weighted = dataset.class_weights(table.drop("weight"), table)
    sums = {r["label"]: r["w"] for r in weighted.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    assert sums[0] == pytest.approx(sums[1])


def test_split_fractions():
    assert SplitFractions().cuts == (70, 85) and SplitFractions(0.29, 0.28).cuts == (29, 57)
    with pytest.raises(ValueError):
        SplitFractions(0.9, 0.2).cuts


@pytest.mark.parametrize("make", [model.logreg_pipeline, model.gbt_pipeline])
def test_compiled_models_score_as_spark_does(spark, table, tmp_path, make):
    fitted = make(FEATURES, max_iter=6).fit(table)
    model.save_model(fitted, str(tmp_path / "m"))
    loaded = model.load_model(str(tmp_path / "m"))
    want = {r["id"]: r["p"] for r in loaded.transform(table).select("id", vector_to_array("probability")[1].alias("p")).collect()}
    for form in (compiled.compiled(fitted), compiled.compiled(loaded), compiled.load_compiled(spark, str(tmp_path / "m"))):
        scored = compiled.score_with(table, form, ["id"])
        got = {r["id"]: r["risk_score"] for r in scored.collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
        text = scored._jdf.queryExecution().executedPlan().toString()
        assert "UDF" not in text and "Exchange" not in text


@pytest.mark.parametrize("make", [model.logreg_pipeline, model.gbt_pipeline])
def test_contributions_add_up_to_the_margin(spark, table, make):
    fitted = make(FEATURES, max_iter=6).fit(table)
    form = compiled.compiled(fitted)
    rows = compiled.attributed(table, form, ["id", *FEATURES]).collect()
    assert len(rows) == 300
    for r in rows:
        assert r["bias"] + sum(c["contribution"] for c in r["contributions"]) == pytest.approx(r["margin"], abs=1e-9)
    drivers = {r["id"]: r["top_drivers"] for r in model.top_drivers(table, fitted, keep=["id"], n=1).collect()}
    for r in rows:
        best = max(r["contributions"], key=lambda c: (c["contribution"], c["feature"]))["feature"]
        assert drivers[r["id"]] == [best]


def test_contributions_of_a_small_forest_by_hand(spark):
    tree = {0: compiled.Node(1.0, 1, 2, 0, 5.0), 1: compiled.Node(0.5), 2: compiled.Node(2.0, 3, 4, 1, 0.0), 3: compiled.Node(1.5), 4: compiled.Node(4.0)}
    stump = {0: compiled.Node(-1.0)}
    form = compiled.Forest(("x y", "z"), (tree, stump), (1.0, 0.5))
    df = spark.createDataFrame([(1, 5.0, 9.0), (2, 6.0, 0.0), (3, 6.0, 0.1), (4, None, 1.0), (5, float("nan"), None)], "id int, `x y` double, z double")
    got = {r["id"]: (r["margin"], r["bias"], [c["contribution"] for c in r["contributions"]]) for r in compiled.attributed(df, form, ["id"]).collect()}
    assert got[1] == (0.0, 0.5, [-0.5, 0.0]) and got[2] == (1.0, 0.5, [1.0, -0.5]) and got[3] == (3.5, 0.5, [1.0, 2.0])
    assert got[4][0] is None and got[5][0] is None and got[4][2] == [None, None]


def test_forest_of_many_deep_trees_is_generated(spark):
    """More conditions than one method may hold."""
    rng = random.Random(4)

    def grow(nodes, depth):
        at = len(nodes)
        nodes[at] = None
        if depth == 0:
            nodes[at] = compiled.Node(rng.uniform(-1, 1))
        else:
            left, right = grow(nodes, depth - 1), grow(nodes, depth - 1)
            nodes[at] = compiled.Node(rng.uniform(-1, 1), left, right, rng.randrange(8), rng.uniform(0, 1))
        return at

    trees = []
    for _ in range(60):
        nodes = {}
        grow(nodes, 5)
        trees.append(nodes)
    form = compiled.Forest(tuple(f"f{i}" for i in range(8)), tuple(trees), (0.1,) * 60)
    rows = [[rng.random() for _ in range(8)] for _ in range(50)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, " + ", ".join(f"f{i} double" for i in range(8)))

    def value(nodes, x):
        n = nodes[0]
        while not n.is_leaf:
            n = nodes[n.left if x[n.feature] <= n.threshold else n.right]
        return n.prediction

    for r in compiled.attributed(df, form, ["id"]).collect():
        want = sum(0.1 * value(t, rows[r["id"]]) for t in trees)
        assert r["margin"] == pytest.approx(want, abs=1e-9)
        assert r["bias"] + sum(c["contribution"] for c in r["contributions"]) == pytest.approx(want, abs=1e-9)


def test_margin_of_trees_is_neither_interpreted_nor_one_method(spark, table):
    form = compiled.compiled(model.gbt_pipeline(FEATURES, max_iter=3).fit(table))
    df = spark.createDataFrame([(1, 0.5, 40.0), (2, None, 40.0)], "id int, a double, b double")
    scored = compiled.score_with(df, form, ["id"])
    got = {r["id"]: r["risk_score"] for r in scored.collect()}
    assert 0 < got[1] < 1 and got[2] is None
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "aggregate(" not in plan and "exists(" in plan


def test_other_models_and_splits_are_refused(spark):
    split = {"featureIndex": 0, "leftCategoriesOrThreshold": [1.0], "numCategories": 3}
    leaf = {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}
    rows = [(0, {"id": 0, "prediction": 0.0, "leftChild": 1, "rightChild": 2, "split": split})]
    rows += [(0, {"id": i, "prediction": 0.0, "leftChild": -1, "rightChild": -1, "split": leaf}) for i in (1, 2)]
    with pytest.raises(ValueError):
        compiled.forest_of(rows, [1.0], ["x"])
    with pytest.raises(ValueError):
        compiled.forest_of(rows[1:2], [1.0, 1.0], ["x"])
