from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.functions import tie_hash
from tidewatch.operators import publish, ranking as R

KEYS = ["id"]


def digest(i, seed=None):
    return hashlib.md5("|".join([str(i)] + ([str(seed)] if seed is not None else [])).encode()).hexdigest()


def scores_of(kind, n):
    rng = random.Random(n)
    return {
        "continuous": lambda: [rng.random() for _ in range(n)],
        "hot": lambda: [0.5 if i % 3 == 0 else round(rng.random(), 2) for i in range(n)],
        "equal": lambda: [0.25] * n,
        "two": lambda: [float(i % 2) for i in range(n)],
        "nulls": lambda: [None if i % 4 == 0 else float("nan") if i % 4 == 1 else rng.random() for i in range(n)],
    }[kind]()


def frame(spark, scores):
    return spark.createDataFrame(list(enumerate(scores)), "id bigint, risk_score double").repartition(5)


def ordered(scores):
    """Ids in ascending (score, tie) order."""
    valid = [(s, digest(i), i) for i, s in enumerate(scores) if s is not None and s == s]
    return [i for _, _, i in sorted(valid)]


@pytest.fixture(params=[False, True], ids=["plain", "narrowed"])
def narrowing(request, monkeypatch):
    """Also run with a limit that sends small tables and groups of equal scores through narrowing."""
    if request.param:
        monkeypatch.setattr(R, "_ORDER_AT_ONCE", 5)


@pytest.mark.parametrize("kind", ["continuous", "hot", "equal", "two", "nulls"])
def test_deciles_equal_ntile(spark, kind, narrowing):
    scores = scores_of(kind, 997)
    got = {r["id"]: r["risk_decile"] for r in R.risk_decile(frame(spark, scores), tie_keys=KEYS).collect()}
    order = ordered(scores)
    size, extra = divmod(len(order), 10)
    expected = {}
    for rank, i in enumerate(order):
        big = extra * (size + 1)
        expected[i] = rank // (size + 1) + 1 if rank < big else (rank - big) // size + extra + 1
    assert got == {i: expected.get(i) for i in range(len(scores))}


@pytest.mark.parametrize("n", [1, 3, 9, 10, 11])
def test_fewer_rows_than_tiles(spark, n):
    df = frame(spark, [i / 20 for i in range(n)])
    native = Window.partitionBy(F.lit(0)).orderBy("risk_score")
    expected = {r["id"]: r["t"] for r in df.withColumn("t", F.ntile(10).over(native)).collect()}
    assert {r["id"]: r["risk_decile"] for r in R.risk_decile(df, tie_keys=KEYS).collect()} == expected


def test_empty_and_all_null_tables(spark):
    for rows in ([], [None, None]):
        df = frame(spark, rows) if rows else frame(spark, [0.5]).where("id < 0")
        assert R.risk_decile(df, tie_keys=KEYS).where("risk_decile is not null").count() == 0
        assert R.alert_flags(df, 0.1, tie_keys=KEYS).where("alert_flag = 1").count() == 0
        assert R.alert_flags(df, 0.1, tie_keys=KEYS, mode="threshold").where("alert_flag = 1").count() == 0
        assert R.distributed_rank(df, tie_keys=KEYS).count() == len(rows)
        assert R.hash_sample(df, 5, 1, KEYS).count() == len(rows)


@pytest.mark.parametrize("kind", ["continuous", "hot", "equal", "nulls"])
@pytest.mark.parametrize("descending", [False, True])
def test_distributed_rank(spark, kind, descending):
    scores = scores_of(kind, 1003)
    got = {r["id"]: r["rank"] for r in R.distributed_rank(frame(spark, scores), tie_keys=KEYS, descending=descending).collect()}
    order = ordered(scores)
    expected = {i: rank for rank, i in enumerate(reversed(order) if descending else order, 1)}
    assert got == {i: expected.get(i) for i in range(len(scores))}


def test_a_common_score_is_cut_into_even_ranges(spark):
    # Ranges of a few kilobytes would be joined again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = frame(spark, scores_of("equal", 2000)).withColumn("t", tie_hash(KEYS))
    sizes = [r["count"] for r in R.staged_ranges(df, ["risk_score", "t"], "ranges").groupBy("__range").count().collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 2000 and len(sizes) == 4 and max(sizes) < 1000


@pytest.mark.parametrize("n", [2_000, 40_000])
@pytest.mark.parametrize("kind", ["continuous", "hot", "equal"])
def test_no_part_holds_more_rows_than_the_limit(spark, monkeypatch, n, kind):
    monkeypatch.setattr(R, "_ORDER_AT_ONCE", 500)
    seen = []
    real = R._ordered
    monkeypatch.setattr(R, "_ordered", lambda scored, rows, parts: seen.extend(scored.where(p.where).count() for p in parts) or real(scored, rows, parts))
    df = frame(spark, scores_of(kind, n))
    marked = R.deciles_and_alerts(df, 0.1, 10, tie_keys=KEYS)
    assert marked.where("alert_flag = 1").count() == n // 10 and seen and max(seen) <= 500
    assert {r["count"] for r in marked.groupBy("risk_decile").count().collect()} == {n // 10}


def test_repeated_keys_are_divided(spark, narrowing):
    same = spark.createDataFrame([(7, 0.5, i) for i in range(100)], "id bigint, risk_score double, other int")
    some = spark.createDataFrame([(i % 3, 0.5, i) for i in range(100)], "id bigint, risk_score double, other int")
    for df in (same, some):
        assert R.hash_sample(df, 10, 1, KEYS).count() == 10
        assert R.alert_flags(df, 0.1, tie_keys=KEYS).where("alert_flag = 1").count() == 10
        tiles = R.risk_decile(df, tie_keys=KEYS).groupBy("risk_decile").count().collect()
        assert {r["risk_decile"]: r["count"] for r in tiles} == {i: 10 for i in range(1, 11)}
        top = R.topk_metrics(df.withColumn("label", F.lit(1)), (0.25,), score="risk_score", tie_keys=KEYS).first()
        assert (top["k"], top["precision_at_k"]) == (25, 1.0)


def test_a_table_that_changes_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(R, "_ordered", lambda *a: {})
    with pytest.raises(RuntimeError, match="positions"):
        R.alert_flags(frame(spark, scores_of("continuous", 50)), 0.1, tie_keys=KEYS)


@pytest.mark.parametrize("kind", ["continuous", "hot", "equal"])
@pytest.mark.parametrize("rate", [0.0005, 0.1, 0.37, 1.0])
def test_exact_alerts_keep_the_budget(spark, kind, rate, narrowing):
    scores = scores_of(kind, 500)
    flagged = {r["id"] for r in R.alert_flags(frame(spark, scores), rate, tie_keys=KEYS).where("alert_flag = 1").collect()}
    k = int(500 * rate)
    assert flagged == (set(ordered(scores)[-k:]) if k else set())


def test_threshold_alerts_take_all_ties(spark):
    df = frame(spark, [0.1] * 80 + [0.9] * 20)
    flags = R.alert_flags(df, 0.1, tie_keys=KEYS, mode="threshold")
    assert flags.where("alert_flag = 1").count() == 20
    assert flags.first()["alert_rate_config"] == 0.1
    assert R.alert_flags(df, 0.1, tie_keys=KEYS, mode="approx").where("alert_flag = 1").count() == 20
    with pytest.raises(ValueError):
        R.alert_flags(df, mode="other")


def test_exact_quantile(spark):
    df = frame(spark, [i / 100 for i in range(100)])
    assert [R.exact_quantile(df, "risk_score", q) for q in (0.0, 0.005, 0.5, 0.901, 1.0)] == [0.0, 0.0, 0.49, 0.9, 0.99]


def test_a_missed_bracket_is_searched_beside_it(spark, monkeypatch):
    real, calls = R._brackets, []
    monkeypatch.setattr(R, "_ORDER_AT_ONCE", 5)
    monkeypatch.setattr(R, "_brackets", lambda *a: calls.append(a) or ([(5.0, 6.0)] if len(calls) == 1 else real(*a)))
    scores = scores_of("hot", 300)
    flagged = {r["id"] for r in R.alert_flags(frame(spark, scores), 0.1, tie_keys=KEYS).where("alert_flag = 1").collect()}
    assert flagged == set(ordered(scores)[-30:])


@pytest.mark.parametrize("kind", ["continuous", "hot", "equal"])
def test_topk_metrics(spark, kind):
    scores = scores_of(kind, 400)
    df = frame(spark, scores).withColumn("label", (F.col("id") % 7 == 0).cast("int"))
    got = {r["k_rate"]: r for r in R.topk_metrics(df, (0.001, 0.05, 0.2), score="risk_score", tie_keys=KEYS).collect()}
    assert got[0.001]["k"] == 0 and got[0.001]["precision_at_k"] is None
    pos = {i for i in range(400) if i % 7 == 0}
    for rate in (0.05, 0.2):
        k = int(400 * rate)
        hits = len(pos & set(ordered(scores)[-k:]))
        r = got[rate]
        assert r["k"] == k and r["precision_at_k"] == pytest.approx(hits / k) and r["recall_at_k"] == pytest.approx(hits / len(pos))
        assert r["lift_at_k"] == pytest.approx(hits / k / (len(pos) / 400)) and r["base_rate"] == pytest.approx(len(pos) / 400)


def test_topk_without_positives(spark):
    df = frame(spark, [0.1, 0.2, 0.3, 0.4]).withColumn("label", F.lit(0))
    row = R.topk_metrics(df, (0.5,), score="risk_score", tie_keys=KEYS).first()
    assert (row["k"], row["precision_at_k"], row["recall_at_k"], row["lift_at_k"]) == (2, 0.0, 0.0, None)


@pytest.mark.parametrize("n", [0, 1, 10, 999, 1000, 5000])
def test_hash_sample_is_stable(spark, n):
    df = frame(spark, [0.0] * 1000)
    expected = set(sorted(range(1000), key=lambda i: digest(i, 42))[:n])
    for parts in (1, 9):
        assert {r["id"] for r in R.hash_sample(df.repartition(parts), n, 42, KEYS).collect()} == expected


def test_hash_sample_widens_a_missed_interval(spark, monkeypatch):
    monkeypatch.setattr(R, "_ORDER_AT_ONCE", 5)
    real, calls = R._digest_at, []

    def off(fraction):
        calls.append(fraction)
        return "0" if len(calls) <= 2 else real(fraction)

    monkeypatch.setattr(R, "_digest_at", off)
    assert R.hash_sample(frame(spark, [0.0] * 300), 20, 1, KEYS).count() == 20 and len(calls) >= 4


def test_stratified_sample_takes_what_there_is(spark):
    df = frame(spark, [0.0] * 100).withColumn("alert_flag", (F.col("id") < 10).cast("int"))
    out = R.stratified_sample(df, 60, 0.5, keys=KEYS)
    assert {r["alert_flag"]: r["count"] for r in out.groupBy("alert_flag").count().collect()} == {1: 10, 0: 30}


def test_combined_search_equals_the_single_ones(spark):
    df = frame(spark, scores_of("hot", 777))
    both = R.deciles_and_alerts(df, 0.1, 10, tie_keys=KEYS)
    apart = R.alert_flags(R.risk_decile(df, tie_keys=KEYS), 0.1, tie_keys=KEYS)
    assert both.exceptAll(apart).count() == 0 and both.count() == 777


def test_marking_rows_needs_no_shuffle(spark):
    df = frame(spark, scores_of("hot", 500)).drop("x")
    from tidewatch.sources import stage

    marked = R.deciles_and_alerts(stage(df, "scores"), 0.1, 10, tie_keys=KEYS)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_top_risk_preview_is_not_a_full_sort(spark):
    df = frame(spark, scores_of("continuous", 300))
    top = publish.top_risk_preview(df, 20, keys=KEYS)
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert [r["id"] for r in top.collect()] == ordered(scores_of("continuous", 300))[::-1][:20]


class _Actions:
    """Counts the collects of a block."""

    def __init__(self, monkeypatch):
        self.n = 0
        real = DataFrame.collect

        def collect(df):
            self.n += 1
            return real(df)

        monkeypatch.setattr(DataFrame, "collect", collect)


@pytest.mark.parametrize("limit", [1_000_000, 40])
def test_cutoffs_of_all_groups_agree_with_one_search_each(spark, monkeypatch, limit):
    monkeypatch.setattr(R, "_ORDER_AT_ONCE", limit)
    monkeypatch.setattr(R, "_QUANTILES", 20)
    rng = random.Random(limit)
    pick = {"m1": lambda: rng.random(), "m2": lambda: rng.choice([0.1, 0.5, 0.5, 0.9]), None: lambda: rng.choice([None, float("nan"), rng.random()])}
    rows = [(m, f"k{i}", pick[m](), rng.randrange(2)) for m in pick for i in range(700)] + [("m3", "one", 0.5, 1), ("m2", "k1", 0.5, 0)]
    df = spark.createDataFrame(rows, "model string, key string, prob double, label int").repartition(5)
    whole = R.topk_metrics(df, (0.05, 0.3), tie_keys=["key"], by=["model"]).collect()
    got = {(r["model"], r["k_rate"]): tuple(r)[2:] for r in whole}
    assert len(whole) == len(got) == 8
    for m in (*pick, "m3"):
        alone = R.topk_metrics(df.where(F.col("model").eqNullSafe(F.lit(m))), (0.05, 0.3), tie_keys=["key"]).collect()
        assert {r["k_rate"]: tuple(r)[1:] for r in alone} == {rate: v for (x, rate), v in got.items() if x == m}, m


def test_groups_share_the_passes_of_a_search(spark, monkeypatch):
    monkeypatch.setattr(R, "_ORDER_AT_ONCE", 50)
    df = spark.range(6000).select(
        (F.col("id") % 6).cast("string").alias("model"), F.col("id").cast("string").alias("key"), (F.col("id") * 37 % 5999 / 5999.0).alias("prob"), F.lit(1).alias("label")
    )
    counted = _Actions(monkeypatch)
    R.topk_metrics(df.where("model = '0'"), (0.1, 0.5), tie_keys=["key"])
    one = counted.n
    R.topk_metrics(df, (0.1, 0.5), tie_keys=["key"], by=["model"])
    # One more looks for the groups; brackets of one group may need a step more than those of another.
    assert counted.n - one <= one + 2
    assert R.topk_metrics(df.limit(0), (0.1,), tie_keys=["key"], by=["model"]).count() == 0
