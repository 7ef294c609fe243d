from __future__ import annotations

import hashlib
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidewatch.llm import pii, queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    return found + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab.@-_ 124+()é%", max_size=40))
def test_base_spans_agree_with_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_cards_and_borders():
    text = "4111 1111 1111 1111, 4111-1111-1111-1112 x@y x@y.z@w.v 999.1.1.1 01.002.3.255 +1 (966) 555-0400"
    assert pii.base_spans(text) == brute(text) and [s[0] for s in brute(text)] == ["email", "ip", "card", "phone"]


def test_query_returns_the_base_spans_of_every_document(spark, small):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = queries.q_pii(spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(s[0] == k for s in base) for k in pii.KINDS[:4]]
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r["spans"].split(","))


def test_expectation_maximisation_finds_who_is_reliable():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    votes = np.full((4000, 8), pii.SILENT)
    for k, right in enumerate((0.95, 0.9, 0.6, 0.85)):
        votes[:, k] = np.where(rng.random(4000) < right, truth, ~truth)
    post, table = pii.estimate(votes, np.ones(4000))
    assert ((post > 0.5) == truth).mean() > 0.96
    assert table[0, 1, 1] > table[1, 1, 1] > table[3, 1, 1] > table[2, 1, 1]


def test_supervision_adds_spans_and_leaves_plain_numbers(spark):
    good = [f"please call tel (030) {i:03d}-4567 or mail ann{i} [at] mail [dot] com, key = {hashlib.md5(str(i).encode()).hexdigest()} end" for i in range(60)]
    plain = [f"version 2.0.{i} of page {i} on 2024-01-{i % 28 + 1:02d} sold 1,{i:03d} units under license 3.{i}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(good + plain)), "doc_id long, text string")
    model = pii.fit(docs)
    found = {r["doc_id"]: r["spans"] for r in pii.find_pii(docs, model).collect()}
    for i, text in enumerate(good):
        kinds = [s.split(":")[0] for s in found[i].split(",")]
        assert kinds == ["email", "phone", "secret"], (text, found[i])
    assert all(found[60 + i] == "" for i in range(60))


def test_odd_tables(spark):
    long = "a" * 200_000 + "@" + "b" * 1000 + ".c " + "1" * 50_000
    docs = spark.createDataFrame([(1, None), (1, ""), (None, "x@y.zz"), (2, long)], "doc_id long, text string").withColumn("spans", F.lit(1))
    got = {(r["doc_id"], r["n_email"], r["spans"]) for r in pii.find_pii(docs, pii.fit(docs)).collect()}
    assert got == {(1, 0, ""), (None, 1, "email:0:6"), (2, 1, "email:0:201003")}
    assert pii.find_pii(docs.limit(0), pii.fit(docs.limit(0))).count() == 0


def test_candidates_of_any_length_and_case():
    key = "sk_" + "aB3" * 46
    text = f"key = {'x' * 60 + '7' * 80} and {key}; john (AT) example.com, ann[At]mail [Dot] org, bob at home dot net"
    got = {(k, text[a:b]) for k, a, b, *_ in pii.candidates(text, pii.base_spans(text))}
    assert got == {
        ("secret", "x" * 60 + "7" * 80), ("secret", key), ("email", "john (AT) example.com"),
        ("email", "ann[At]mail [Dot] org"), ("email", "bob at home dot net"),
    }


def _seconds(text):
    best = 1e9
    for _ in range(3):
        began = time.perf_counter()
        list(pii.candidates(text, pii.base_spans(text)))
        best = min(best, time.perf_counter() - began)
    return best


@pytest.mark.parametrize(
    "part",
    [
        "0171 5550{0:04d} or ann{0}@mail.example.com, ",
        "( ",
        "1 2 3 4 5 6 7 8 9 ",
        "12345678x ",
        "a.b at c.d. ",
        "x[at]",
        "abcdefgh1jklm_",
        "+1 ((( ",
    ],
)
def test_time_grows_with_the_text(part):
    n = 400_000 // len(part)
    small, large = ("".join(part.format(i) for i in range(k)) for k in (n // 4, n))
    assert _seconds(large) < 8 * _seconds(small) + 0.05


def test_places_that_base_spans_cover():
    taken = pii.Taken([("email", 10, 20), ("phone", 15, 30), ("ip", 40, 41)])
    for a in range(50):
        for b in range(a + 1, 50):
            assert taken.meets(a, b) == any(x < b and a < y for x, y in ((10, 20), (15, 30), (40, 41)))
    assert not pii.Taken([]).meets(0, 9)
