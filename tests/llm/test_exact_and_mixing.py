from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import exact, mixing

DOC = "doc_id long, text string"


def deduped(docs, **kw):
    found = exact.exact_dedup(docs, **kw)
    return {r["row"]["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in found.collect()}


def test_groups_of_equal_texts(spark):
    long = "x" * 5000
    texts = ["a", "a", "a ", "", None, "é" * 40, "é" * 40, long, long, long + "y", long[:-1] + "z", "A", "b" * 64, "b" * 64, "b" * 63 + "c"]
    got = deduped(spark.createDataFrame(list(enumerate(texts)), DOC))
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[t or ""].append(i)
    assert got == {i: (max(g), len(g), i == max(g)) for g in groups.values() for i in g}


def test_digits_of_any_width_give_the_same_groups(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 9))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), DOC)
    assert deduped(docs, digit=1, growth=2) == deduped(docs)


def test_repeated_rows_null_ids_and_other_columns(spark):
    rows = [(1, "t", 5), (1, "t", 5), (0, "t", 6), (None, "n", 7), (None, "n", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, grp int").withColumn("kept", F.lit("mine")).withColumn("n", F.lit(1))
    got = [(r["row"]["doc_id"], r["row"]["grp"], r["keep_id"], r["group_size"], r["kept"]) for r in exact.exact_dedup(docs).collect()]
    assert sorted(got, key=str) == sorted([(1, 5, 1, 3, True), (1, 5, 1, 3, True), (0, 6, 1, 3, False), (None, 7, None, 2, True), (None, 8, None, 2, True)], key=str)
    assert exact.exact_dedup(docs.limit(0)).count() == 0


def mixed(docs, **kw):
    return mixing.mix_sources(docs, **kw).select("row.*", "block", "slot", "on_target").collect()


def off_target(slots: dict[int, str], weights: dict[str, Fraction], end: int) -> list:
    """Slots up to ``end`` after which a source is a block or more off its exact share."""
    seen, found = Counter(), []
    for t in range(end + 1):
        if t in slots:
            seen[slots[t]] += 1
        found += [(t, s) for s, w in weights.items() if abs(seen[s] - w * (t + 1)) >= 1]
    return found


def test_every_prefix_of_the_mix_is_within_a_block_of_its_target(spark):
    rng = random.Random(2)
    rows = [(i, "x" * 10, rng.choice("aaaab")) for i in range(300)] + [(1000 + i, "x" * 10, "c") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = {"a": 0.5, "b": 0.2, "c": 0.3}
    table = spark.createDataFrame([*weights.items(), ("unseen", 0.0)], "source string, weight double")
    got = mixed(docs, weights=table, block_chars=10)
    assert sorted(map(str, got)) == sorted(map(str, mixed(docs, weights=weights, block_chars=10)))
    assert len(got) == 700 and Counter(r["source"] for r in got) == Counter(s for _, _, s in rows)
    slots = {r["slot"]: r["source"] for r in got}
    assert len(slots) == 700, "one block of one document in each slot"
    end = max(r["slot"] for r in got if r["on_target"])
    assert end > 100 and off_target(slots, {s: Fraction(str(w)) for s, w in weights.items()}, end) == []


def _random_weights(n: int) -> dict[str, int]:
    rng = random.Random(n)
    return {f"s{i:04d}": rng.choice([1, 1, 1, 2] if n > 500 else [1, 3, 40, 70]) for i in range(n)}


@pytest.mark.parametrize(
    "parts",
    [
        {"a": 1, "b": 1, "c": 1},
        {"a": 3333, "b": 1, "c": 6666},
        {"big": 5000, "tiny": 1, "small": 2, "rest": 4997},
        {"half": 500} | {f"s{i:03d}": 1 for i in range(500)},
        {f"s{i:04d}": 1 for i in range(2000)},
        _random_weights(100),
        _random_weights(2000),
    ],
    ids=["thirds", "one small", "ten-thousandth", "half and 500", "2000 equal", "100 unequal", "2000 unequal"],
)
def test_schedule_is_within_a_block_of_exact_weights(spark, parts):
    """All slots of a cycle, or its first 2500, for any number of sources."""
    total = sum(parts.values())
    blocks = min(2500, total)
    quota = spark.createDataFrame([(s, max(blocks * q // total, 1), q, total) for s, q in parts.items()], "src string, vol long, q long, cycle long")
    plan = mixing.schedule(quota, block_chars=1).collect()
    slots = {r["slot"]: r["src"] for r in plan}
    assert sorted(slots) == list(range(len(plan))) and len(plan) >= min(blocks, total)
    counts = Counter()
    worst = 0
    for t in range(min(len(plan), 2500)):
        counts[slots[t]] += 1
        if t % 7 == 0 or t < 50:
            worst = max(worst, max(abs(counts[s] * total - q * (t + 1)) for s, q in parts.items()))
    assert worst < total
    for r in plan:
        q = parts[r["src"]]
        assert r["nth"] * total // q <= r["slot"] < -(-(r["nth"] + 1) * total // q)


def test_quotas_are_the_smallest_exact_ones(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1), ("c", 40), ("d", 9)], "src string, vol long")
    weights = spark.createDataFrame([("a", 0.5), ("b", 0.0001), ("c", 0.4999), ("c", 0.1), ("e", 1.0)], "src string, weight double")
    got = {r["src"]: (r["q"], r["cycle"]) for r in mixing.quotas(sizes, weights).collect()}
    assert got == {"a": (5000, 10_000), "b": (1, 10_000), "c": (4999, 10_000), "d": (0, 10_000)}
    thirds = spark.createDataFrame([(s, 1 / 3) for s in "abc"], "src string, weight double")
    assert {tuple(r)[2:] for r in mixing.quotas(sizes.where("src != 'd'"), thirds).collect()} == {(1, 3)}
    roots = {r["src"]: r["q"] / r["cycle"] for r in mixing.quotas(sizes, None).collect()}
    assert all(abs(roots[s] - x / 20) < 1e-5 for s, x in (("a", 10), ("b", 1), ("c", 6), ("d", 3)))


def test_sources_without_a_weight_come_last(spark):
    rows = [(i, "x" * 10, "abc"[i % 3]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixed(docs, weights={"a": 1.0, "b": 0.0}, block_chars=10)
    slots = sorted((r["slot"], r["source"], r["on_target"]) for r in got)
    assert [s for s, _, _ in slots] == list(range(60)) and [x for _, x, _ in slots] == ["a"] * 20 + ["b"] * 20 + ["c"] * 20
    assert [t for *_, t in slots] == [True] * 20 + [False] * 40
    assert sorted(r["slot"] for r in mixed(docs, weights={"z": 1.0}, block_chars=10)) == list(range(60))


def test_odd_tables_mix(spark):
    rows = [(1, None, None), (1, None, None), (2, "", "s"), (None, "y" * 1000, ""), (3, "z", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("src", F.lit(1)).withColumn("slotx", F.lit(2))
    got = mixed(docs, block_chars=100)
    assert len(got) == 5 and len({r["slot"] for r in got if r["doc_id"] == 1}) == 1
    assert mixed(docs.limit(0)) == [] and mixed(docs.limit(0), weights={"s": 1.0}) == []
    many = spark.range(60).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.col("id").cast("string").alias("source"))
    assert sorted(r["slot"] for r in mixed(many)) == list(range(60)), "each source has one block"
    with pytest.raises(ValueError):
        mixed(docs, weights={"s": -1.0})
    long = spark.createDataFrame([(1, "x" * 3000, "a"), (2, "y", "a"), (3, "z", "b")], "doc_id long, text string, source string")
    assert {r["doc_id"]: r["block"] for r in mixed(long, block_chars=100)}[3] == 0


def test_no_python_worker_takes_part(spark):
    docs = spark.createDataFrame([(1, "x", "a")], "doc_id long, text string, source string")
    plan = mixing.mix_sources(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_tables_of_sources_are_not_worked_out_again_by_every_reader(spark):
    docs = spark.createDataFrame([(i, "x" * i, "abc"[i % 3]) for i in range(30)], "doc_id long, text string, source string")
    for weights in (None, {"a": 0.5, "b": 0.2}):
        plan = mixing.mix_sources(docs, weights=weights)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") - plan.count("BroadcastExchange") < 30 and plan.count("Aggregate(") < 20


def test_running_volumes_over_several_levels(spark):
    docs = spark.range(500).select(
        F.lit("s").alias("src"), F.col("id").cast("string").alias("id"), F.md5(F.col("id").cast("string")).alias("h"), (F.col("id") % 7 + 1).alias("vol")
    )
    rows = sorted((hashlib.md5(str(i).encode()).hexdigest(), i % 7 + 1) for i in range(500))
    expected, total = {}, 0
    for h, v in rows:
        expected[h] = total
        total += v
    for parts in (1, 2):
        assert {r["h"]: r["before"] for r in mixing._running(docs, parts).collect()} == expected
