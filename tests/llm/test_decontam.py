from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import decontam, queries

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def prose(rng, words):
    return " ".join("".join(rng.choice(LETTERS) for _ in range(rng.randint(2, 9))) for _ in range(words))


def edited(rng, text, edits):
    out = list(text)
    for at in rng.sample(range(len(out)), edits):
        out[at] = rng.choice(["", rng.choice(LETTERS), out[at] + rng.choice(LETTERS)])
    return "".join(out)


def least_edits(pattern, text):
    """Edit distance of the whole pattern to the best part of the text."""
    cost = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, cost[0] = cost[0], i
        for j, t in enumerate(text, 1):
            last, cost[j] = cost[j], min(last + (p != t), cost[j] + 1, cost[j - 1] + 1)
    return min(cost)


def found(items, texts):
    return {(r, i): (e, a, b) for r, i, e, a, b in decontam.Finder(items).find(pa.array(texts, pa.string()))}


@pytest.mark.parametrize("edits", [0, 1, 3, 5])
def test_edited_passages_are_found_within_the_budget(edits):
    rng = random.Random(edits)
    items = [(k, prose(rng, 12)[:80].strip()) for k in range(20)]
    texts = [f"{prose(rng, 30)} {edited(rng, t, edits)} {prose(rng, 30)}" for _, t in items] + [prose(rng, 200)]
    got = found(items, texts)
    form = lambda t: decontam.normal_form(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0].tobytes().decode()
    for r, text in enumerate(texts):
        for k, item in items:
            d = least_edits(form(item), form(text)) if r == k else 99
            if d <= decontam.budget(len(form(item)))[1]:
                assert got[r, k][0] == d
            else:
                assert (r, k) not in got


def test_any_stretch_counts_and_short_overlaps_do_not():
    rng = random.Random(9)
    item = prose(rng, 60)
    part, short = item[100:190], item[100:150]
    got = found([(7, item)], [f"{prose(rng, 9)} {part.upper()}!  {prose(rng, 9)}", f"{prose(rng, 9)} {short} {prose(rng, 9)}", None, ""])
    assert set(got) == {(0, 7)}
    edits, start, end = got[0, 7]
    assert edits == 0 and end - start >= 80


def test_places_are_code_points():
    rng = random.Random(5)
    item = prose(rng, 20)
    text = "é" * 50 + "  " + item
    (edits, start, end), = found([(1, item)], [text]).values()
    assert edits == 0 and text[start:end].strip() == item


def test_case_space_and_punctuation_make_no_difference():
    rng = random.Random(6)
    item = prose(rng, 20)
    assert found([(1, item)], [item.upper().replace(" ", ",\n\n- ")])[0, 1][0] == 0


def test_query_finds_planted_items(spark, small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()}
    whole = {(d, i) for d, t in docs.items() for i, x in items.items() if x in (t or "")}
    got = {(r["doc_id"], r["item_id"]) for r in queries.q_benchmark_leaks(spark, small).collect()}
    assert whole <= got


def test_odd_tables_and_blocks_of_items(spark, monkeypatch):
    rng = random.Random(3)
    texts = [prose(rng, 30) for _ in range(3)]
    docs = spark.createDataFrame([(1, texts[0]), (1, texts[0]), (None, texts[1]), (2, None), (3, "")], "doc_id long, text string").withColumn("item_id", F.lit("x"))
    bench = spark.createDataFrame([(0, texts[0]), (1, texts[1]), (2, None), (3, "too short"), (4, texts[2])], "item_id long, text string")
    for limit in (4_000_000, 10):
        monkeypatch.setattr(decontam, "ITEM_CHARS", limit)
        got = [(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(docs, bench).collect()]
        assert sorted(got, key=str) == sorted([(1, 0), (1, 0), (None, 1)], key=str)
        clean = decontam.without_leaks(docs, bench)
        assert clean.columns == docs.columns and sorted(r["doc_id"] for r in clean.collect()) == [2, 3]
    assert decontam.find_leaks(docs, bench.limit(0)).count() == 0 and decontam.without_leaks(docs.limit(0), bench).count() == 0


def letters(rng, n):
    return "".join(rng.choice(LETTERS) for _ in range(n))


@pytest.mark.parametrize("length", [*range(24, 40), 47, 48, 50, 63, 64, 70, 79, 80, 85, 90])
def test_every_match_within_the_budget_is_found(length):
    """Items of any length, all numbers of edits, against the plain edit distance of their stretches."""
    rng = random.Random(length)
    item = letters(rng, length)
    span, budget, need = decontam.budget(length)
    assert need >= 1
    stretches = [item[k : k + span] for k in range(length - span + 1)]
    texts = []
    for edits in range(budget + 2):
        for _ in range(4):
            # Substitutions spread evenly leave the fewest q-grams whole.
            out = list(item)
            for k in range(edits):
                at = (k + 1) * length // (edits + 1)
                out[min(at, length - 1)] = rng.choice("0123456789")
            texts.append(letters(rng, 30) + "".join(out) + letters(rng, 30))
            texts.append(letters(rng, 30) + edited(rng, item, edits) + letters(rng, 30))
    got = found([(1, item)], texts)
    for r, text in enumerate(texts):
        d = min(least_edits(s, text) for s in stretches)
        assert ((r, 1) in got) == (d <= budget), (length, r, d)
        if d <= budget:
            assert got[r, 1][0] == d


def test_short_items_are_found_as_whole_words_only():
    items = [(1, "twelve chars"), (2, "a phrase of twenty"), (3, "eleven char")]
    texts = ["Twelve  chars.", "x twelve chars y", "xtwelve chars", "twelve charsx", "not a phrase of Twenty!", "a phrase off twenty", "eleven char", "pre" * 30 + " twelve chars"]
    assert set(found(items, texts)) == {(0, 1), (1, 1), (4, 2), (7, 1)}


@pytest.mark.parametrize("unit", ["ha ", "ab", "x"])
def test_text_that_repeats_itself_takes_bounded_memory(unit):
    item = (unit * 900)[:900].strip()
    finder = decontam.Finder([(1, item), (2, "ho " * 300)])
    assert sum(map(len, finder.pieces)) < 400, "only distinct stretches are held"
    text = pa.array([unit * (1_000_000 // len(unit)), "some words " + unit * 60], pa.string())
    tracemalloc.start()
    got = {(r, i): e for r, i, e, *_ in finder.find(text)}
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == {(0, 1): 0} | ({(1, 1): 0} if len(unit * 60) >= 80 else {}) and peak < 300e6


def test_pieces_hold_every_distinct_stretch(monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(decontam, "PIECE", 200)
    for text in (letters(rng, 700), "ab " * 200 + letters(rng, 150) + "ab " * 200, letters(rng, 90) * 4, letters(rng, 60)):
        z = np.frombuffer(text.encode(), np.uint8)
        parts = [p.tobytes() for p in decontam.pieces(z, 80)]
        assert max(map(len, parts)) <= 200
        want = {z[k : k + 80].tobytes() for k in range(max(len(z) - 79, 1))}
        assert {p[k : k + 80] for p in parts for k in range(max(len(p) - 79, 1))} == want


def test_windows_of_hits_lose_no_band(monkeypatch):
    """With very few places listed at once, the result is the same."""
    rng = random.Random(12)
    items = [(k, prose(rng, 30)) for k in range(10)]
    texts = [" ".join([prose(rng, 20), edited(rng, items[k][1], 3), prose(rng, 50), items[(k + 3) % 10][1]]) for k in range(10)]
    whole = found(items, texts)
    assert len(whole) >= 15
    monkeypatch.setattr(decontam, "LISTED", 1)
    assert found(items, texts) == whole
