from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from tidewatch.llm import components, neardup, substring, words

DOC = "doc_id long, text string"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é\t\n\x0b-", max_size=12)), max_size=8))
def test_words_and_shingles_agree_with_the_pattern(texts):
    seen, sets = [], []
    for w in words.words(pa.array(texts, pa.string()), lower=True):
        for a, b in zip(w.rows[:-1], w.rows[1:]):
            seen.append([w.data[s:e].tobytes().decode() for s, e in zip(w.starts[a:b], w.ends[a:b])])
        sets += list(words.shingle_sets(w, 2))
    assert seen == [brute.WORD.findall(t or "") for t in texts]
    assert [len(s) for s in sets] == [len(brute.shingle_set(t, 2)) for t in texts]
    for a, x in zip(texts, sets):
        for b, y in zip(texts, sets):
            assert len(np.intersect1d(x, y)) == len(brute.shingle_set(a, 2) & brute.shingle_set(b, 2))


def test_runs_do_not_depend_on_where_they_stand():
    h = words.mix(np.arange(40, dtype=np.uint64))
    assert (words.runs(np.r_[h[5:], h], 8)[35 : 35 + 33] == words.runs(h, 8)[:33]).all()


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 30_000).astype(np.uint64)
    for common, own in ((800, 100), (500, 500), (9000, 1000)):
        a, b = pool[: common + own], np.r_[pool[:common], pool[-own:]]
        ra, rb = neardup.registers(a)[None], neardup.registers(b)[None]
        got = neardup.likely_similarity(ra, rb, np.array([float(len(a))]), np.array([float(len(b))]))[0]
        assert abs(got - common / (common + 2 * own)) < 0.15
        assert (neardup.registers(np.r_[a, b]) == np.maximum(ra, rb)[0]).all(), "a union's registers are the maxima"


def near(docs, **kw):
    return {r[0]: (r[1], r[2], r[3]) for r in neardup.near_duplicates(docs, **kw).collect()}


def test_near_duplicates_of_a_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    assert near(docs) == brute.near_duplicates([tuple(r) for r in docs.collect()], 4, 80)


def test_near_duplicates_of_a_chain_and_a_crowd(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows, chain = [(0, " ".join(base))], list(base)
    for i in range(1, 25):  # each a step away from the one before
        for _ in range(2):
            chain[rng.randrange(120)] = f"c{rng.randrange(10**6)}"
        rows.append((i, " ".join(chain)))
    for i in range(100, 160):  # all near the base, most not near each other
        copy = list(base)
        for _ in range(3):
            copy[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy).upper() if i % 2 else " ".join(copy)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "one two"), (204, "One  TWO"), (205, "one"), (206, rows[3][1])]
    assert near(spark.createDataFrame(rows, DOC)) == brute.near_duplicates(rows, 4, 80)


def test_near_duplicates_of_odd_tables(spark):
    rows = [(7, "a b c d e"), (7, "a b c d e"), (7, "p q r s t"), (None, "a b c d e"), (None, None)]
    docs = spark.createDataFrame(rows, DOC).withColumn("node", F.lit("n")).withColumn("n", F.lit(1))
    got = sorted(map(tuple, neardup.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(7, 2, 7, True), (7, 2, 7, True), (7, 2, 7, True), (None, 2, 7, False), (None, 0, None, True)], key=str)
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_a_long_path_and_no_links(spark):
    links = spark.range(60).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v")).unionByName(spark.createDataFrame([(100, 99)], "u long, v long"))
    got = {r["node"]: r["root"] for r in components.components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {99: 99, 100: 99}
    assert components.components(links.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [27, 9])
def test_repeats_of_a_table(spark, small, bits):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    extra = [
        (-1, None), (-2, ""), (-3, " \n"), (-4, " ".join(f"w{i % 11}" for i in range(46))), (-5, " ".join(f"v{i % 11}" for i in range(45))),
        (-6, "ab cd ef " * 50), (-7, "x " * 200), (-8, "y " * 36), (-9, "z " * 35), (-10, " ".join(f"é{i}" for i in range(80))),
        (-11, "q " + "\t".join(f"é{i}" for i in range(80))),
    ]
    docs = docs.unionByName(spark.createDataFrame(extra, DOC))
    rows = [tuple(r) for r in docs.collect()]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"], r["kept_text"]) for r in substring.remove_repeats(docs, bits=bits, with_text=True).collect()}
    assert got == {d: (n, k, hashlib.sha256(t.encode()).hexdigest(), t) for d, (n, k, t) in brute.repeated_words(rows, 35).items()}


def test_repeats_of_odd_tables(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text), (1, text), (None, "a"), (2, text + "x")], DOC).withColumn("place", F.lit(3))
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in substring.remove_repeats(docs).collect())
    assert got == [(0, 1, 0), (1, 40, 40), (1, 40, 40), (2, 40, 39)]
    assert substring.remove_repeats(docs.limit(0)).count() == 0


def test_the_sketch_never_counts_too_few():
    rng = random.Random(3)
    for _ in range(300):
        w = [str(rng.randrange(3)) for _ in range(rng.randint(30, 90))]
        for chunk in words.words(pa.array([" ".join(w), " ".join(w[5:])], pa.string())):
            counted = dict(zip(*np.unique(substring._anchor_places(chunk, 35, 8), return_counts=True)))
            starts, anchors = substring._anchors(chunk, 35, 8)
            kinds = {}
            for s, a in zip(starts, anchors):
                kinds.setdefault(int(words.runs(chunk.hashes, 35)[s]), []).append(a)
            assert all(counted[a[0]] >= len(a) for a in kinds.values())
