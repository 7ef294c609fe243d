from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import phrases

DOC = "lang string, text string, rank long, phrase string"
_ASCII = {c: c + 32 for c in range(65, 91)}


def brute(rows, least, longest=5, top=2000):
    """lang -> [(rank, phrase, a, l, r, n, score)] by plain counting."""
    counts, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_ASCII)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = {}
    for lang, f in counts.items():
        frequent = {p: c for p, c in f.items() if c >= least}
        scored = []
        for p, a in frequent.items():
            inside = [c for q, c in frequent.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if len(p) == 1 or any(c >= a for c in inside):
                continue
            score, _, l, r = min((1000 * a * words[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        out[lang] = [(n, p.decode(), -a, l, r, words[lang], -s) for n, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1)]
    return {k: v for k, v in out.items() if v}


def mined(docs, **kw):
    out = defaultdict(list)
    for r in phrases.collocations(docs, **kw).orderBy("lang", "rank").collect():
        out[r["lang"]].append(tuple(r)[1:])
    return dict(out)


def test_table_of_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("lang", "text")
    found = mined(docs, least=12)
    assert found == brute([tuple(r) for r in docs.collect()], 12)
    assert len(found) == 4 and max(map(len, found.values())) > 20


@pytest.mark.parametrize("bits", [8, 27])
def test_random_texts_and_a_filter_that_tells_nothing(spark, bits):
    rng = random.Random(bits)
    words = ["a", "B", "cc", "d-d", "é", "Ü", "ee"]
    text = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n"]) for _ in range(rng.randrange(80)))
    rows = [(rng.choice(["x", "y", None, "und"]), text(), 1, "p") for _ in range(120)]
    assert mined(spark.createDataFrame(rows, DOC), least=9, bits=bits) == brute([r[:2] for r in rows], 9)


def test_equal_hashes_do_not_mix_counts(spark, monkeypatch):
    """With all hashes equal, everything passes, and words alone tell phrases apart."""
    real = phrases._hashes
    relation = spark.createDataFrame([("x", "a b\nb c d\n" * 3), ("y", "a b a\n")], "lang string, text string")
    column = pa.array(["a b\nb c d\n" * 3])
    (part,) = phrases._parts(column, False)
    at = part.phrases(2)
    assert [t.decode() for t in phrases._texts_of(part, at, 2)] == ["a b", "b c", "c d"] * 3
    monkeypatch.setattr(phrases, "_hashes", lambda s, langs, k, at: real(s, langs, k, at) * np.uint64(0))

    found = phrases.count_phrases(relation, 2, 1)
    assert {tuple(r) for r in found.collect()} == {("x", "a b", 3), ("x", "b c", 3), ("x", "c d", 3), ("y", "a b", 1), ("y", "b a", 1)}


def test_relation_keeps_adjacent_occurrences_side_by_side():
    (s,) = phrases._parts(pa.array(["A b, c D  e\tf. g", None, "h i j"]), True)
    at = np.array([0, 1, 2, 4, 5, 8, 9])  # all but d, g and h
    assert phrases._written(s, at, 1).to_pylist() == ["a b\nc\ne f\n", "", "i j\n"]
    at = s.phrases(2)
    assert phrases._written(s, at, 2).to_pylist() == ["a b\nc d e f\n", "", "h i j\n"]
    assert phrases._written(s, np.array([2, 4]), 2).to_pylist() == ["c d\ne f\n", "", ""]


def test_contained_phrases_go_and_ranks_break_ties(spark):
    rows = [("x", "p q r. p q r. q r z", 0, ""), ("x", "m n. m n", 0, "")]
    docs = spark.createDataFrame(rows, DOC)
    found = mined(docs, least=2)
    assert found == brute([r[:2] for r in rows], 2)
    # "p q" lies in "p q r" each time it occurs, "q r" does not.
    assert {p for _, p, *_ in found["x"]} == {"p q r", "q r", "m n"}
    assert mined(docs, least=2, top=1)["x"] == found["x"][:1]


def test_products_past_64_bits(spark, monkeypatch):
    big = 3_000_000_000_000
    every = spark.createDataFrame([("x", "a", 1, big), ("x", "b", 1, big + 1), ("x", "a b", 2, big - 7)], "lang string, phrase string, size int, n long")
    monkeypatch.setattr(phrases, "mine", lambda *a: (every, spark.createDataFrame([("x", 50 * big)], "lang string, n long")))
    (row,) = phrases.collocations(spark.createDataFrame([], DOC)).collect()
    assert row["score"] == 1000 * (big - 7) * 50 * big // (big * (big + 1))


def test_odd_tables(spark):
    docs = spark.createDataFrame([(None, "a b. a b", 1, ""), ("und", "A B", 1, ""), ("x", None, 1, ""), ("x", "", 1, ""), (None, " \t.,", 1, "")], DOC)
    assert mined(docs, least=3) == {"und": [(1, "a b", 3, 3, 3, 6, 2000)]}
    assert mined(docs, least=100) == {}
    assert mined(docs.where("false")) == {}
    long = spark.createDataFrame([("x", "w" * 200_000 + " v " + "w" * 200_000 + " v", 1, ""), ("x", "u v " * 60_000, 1, "")], DOC)
    found = mined(long, least=2)
    assert found["x"] == brute([tuple(r)[:2] for r in long.collect()], 2)["x"]


def test_result_does_not_depend_on_partitions(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("lang", "text")
    total = lambda d: phrases.collocations(d, least=20).agg(F.sum(F.xxhash64("*").cast("decimal(20,0)"))).first()
    assert total(docs) == total(docs.repartition(9))
