from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidewatch.llm import langid, quality, queries

WORDS = {"aa": "the of and that with from".split(), "bb": "über ist nicht eine schön".split()}


def texts_of(lang, n, seed):
    rng = np.random.default_rng(seed)
    return [" ".join(rng.choice(WORDS[lang], rng.integers(3, 60))) for _ in range(n)]


def test_network_learns_and_reads_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(langid, "_EPOCHS", 4)
    rows = [(i, t, lang) for lang in WORDS for i, t in enumerate(texts_of(lang, 60, len(lang + "x") + ord(lang[0])))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = langid.fit(docs, F.lit(True))
    # The first window alone says otherwise.
    mixed = " ".join(WORDS["aa"] * 8) + " " + " ".join(WORDS["bb"] * 60)
    odd = [(1, None), (2, ""), (3, "12 34 !?"), (4, mixed), (5, texts_of("aa", 1, 5)[0]), (5, texts_of("bb", 1, 6)[0]), (None, "the of")]
    got = sorted((r["doc_id"] or 0, r["lang_pred"]) for r in langid.predict(spark.createDataFrame(odd, "doc_id long, text string"), net).collect())
    assert got == [(0, "aa"), (1, "und"), (2, "und"), (3, "und"), (4, "bb"), (5, "aa"), (5, "bb")]
    assert langid.predict(docs.limit(0), net).count() == 0
    unknown = langid.predict(docs.limit(2), langid.fit(docs, F.lit(False))).collect()
    assert [(r["lang_pred"], r["score"]) for r in unknown] == [("und", 0.0)] * 2


def test_pair_tables_give_the_same_sums():
    rng = np.random.default_rng(2)
    w = rng.integers(0, 256, (3, langid.WINDOW)).astype(np.uint8)
    net = langid.train(w, np.array([0, 1, 0]), ["a", "b"]).pairs()
    top = []
    for table, bias, width in zip(net.tables, net.bias, langid.WIDTHS):
        z = sum(table[k][w[:, k : langid.WINDOW - width + 1 + k]] for k in range(width))
        top.append(z.max(1) + bias)
    z = np.maximum(np.concatenate(top, 1), 0) @ net.out + net.out_bias
    p = np.exp(z - z.max(1, keepdims=True))
    assert np.allclose(net.probabilities(w), p / p.sum(1, keepdims=True), atol=1e-4)


def test_windows_cover_every_byte():
    data = np.frombuffer(b"abcdefghij" + b"xyz", np.uint8)
    w, row, held = langid.windows(data, np.array([0, 10, 10, 13]), 4)
    assert b"".join(x.tobytes()[:h] for x, h in zip(w, held)) == data.tobytes() and list(row) == [0, 0, 0, 2]


def test_languages_held_out(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang", "text")
    rows = queries.q_language(spark, small).join(docs, "doc_id").where("held_out and length(text) > 100").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.9


def test_quality_held_out(spark, small):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    rows = queries.q_quality(spark, small).join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) if bad else 1
    assert auc > 0.9 and np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.85


def test_quality_of_odd_tables(spark):
    rows = [(1, "Good words, in a row."), (2, "BAD!! BAD!! BAD!!"), (3, None), (3, ""), (None, "x " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("s"))
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (9, 1), (3, None)], "doc_id long, quality int")
    model = quality.fit(docs, labels, F.lit(True))
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert len(got) == 4 and got[1] > 0.5 > got[2] and got[3] == model.prior and 0 <= got[None] <= 1
    kept = quality.select_rows(docs, model)
    assert kept.columns == docs.columns and 2 not in {r["doc_id"] for r in kept.collect()}
    assert quality.score(docs.limit(0), model).count() == 0
    nothing = quality.fit(docs, labels.limit(0), F.lit(True))
    assert nothing is None and {r["score"] for r in quality.score(docs, nothing).collect()} == {0.5} and quality.select_rows(docs, nothing).count() == 5


def test_neighbour_votes_equal_the_plain_sum():
    rng = np.random.default_rng(3)
    v = rng.normal(size=(40, 8))
    model = quality.Neighbours(np.ones(quality.TERMS), np.eye(quality.TERMS, 8), v / np.linalg.norm(v, axis=1, keepdims=True), rng.integers(0, 2, 40).astype(float), 0.5)
    counts = rng.integers(0, 5, (6, quality.TERMS)).astype(float)
    z = model.latent(counts)
    for got, x in zip(model.scores(counts), z):
        near = sorted(zip(model.vectors @ x, model.labels), key=lambda p: -p[0])[: quality.NEIGHBOURS]
        weight = [max(s, 0) ** quality.SHARPNESS for s, _ in near]
        assert abs(got - (1e-6 * 0.5 + sum(w * y for w, (_, y) in zip(weight, near))) / (1e-6 + sum(weight))) < 1e-9


def trained(monkeypatch):
    """What train() is given: windows and labels."""
    seen = []
    monkeypatch.setattr(langid, "train", lambda w, y, labels: seen.append((w, [labels[k] for k in y])))
    return seen


def test_copies_of_few_texts_are_learned(spark, monkeypatch):
    seen = trained(monkeypatch)
    one = spark.range(10_000).select(F.lit("the same text").alias("text"), F.lit("aa").alias("lang"))
    langid.fit(one, F.lit(True), sample=20)
    assert seen[-1][1] == ["aa"] * langid._WINDOWS_EACH
    other = spark.range(10_000).select(F.concat(F.lit("text "), F.col("id") % 300).alias("text"), F.lit("bb").alias("lang"))
    langid.fit(one.unionByName(other), F.lit(True), sample=20)
    assert sorted(seen[-1][1]) == ["aa"] * langid._WINDOWS_EACH + ["bb"] * 10 * langid._WINDOWS_EACH
    assert len({bytes(w) for w, lang in zip(*seen[-1]) if lang == "bb"}) >= 10, "distinct texts"


def test_all_languages_and_all_of_a_text_are_learned(spark, monkeypatch):
    seen = trained(monkeypatch)
    many = spark.range(200).select(F.concat(F.lit("text "), F.col("id")).alias("text"), (F.col("id") % 100).cast("string").alias("lang"))
    langid.fit(many, F.lit(True), sample=50)
    assert sorted(seen[-1][1]) == sorted(str(k) for k in range(100) for _ in range(langid._WINDOWS_EACH))
    long = spark.range(40).select(F.concat(F.repeat(F.lit("menu "), 1000), F.repeat(F.concat(F.lit("ü"), F.col("id")), 20_000)).alias("text"), F.lit("aa").alias("lang"))
    langid.fit(long, F.lit(True))
    menu = np.mean([b"menu" in bytes(w) for w in seen[-1][0]])
    assert len(seen[-1][0]) == 40 * langid._WINDOWS_EACH and menu < 0.25, "windows lie over the whole text"
    langid.fit(spark.createDataFrame([("ab", "x"), ("ab", "x")], "text string, lang string"), F.lit(True))
    assert [bytes(w[:3]) for w in seen[-1][0]] == [b"ab\0"] * langid._WINDOWS_EACH


def test_references_are_bounded_whatever_ids_repeat(spark):
    rows = [(7, f"text {i} of one id") for i in range(3000)] + [(8, "a text of label one, two times")] * 500 + [(9, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(7, 0), (8, 1), (9, 1), *[(100 + i, 1) for i in range(400)]], "doc_id long, quality int")
    model = quality.fit(docs, labels, F.lit(True), references=40)
    # Rows of label 0 fill their half; ids without a row take no place in the other.
    assert (model.labels == 0).sum() == 20 and (model.labels == 1).sum() == 2
    again = quality.fit(docs.repartition(7), labels, F.lit(True), references=40)
    assert np.allclose(model.labels, again.labels) and np.allclose(np.abs(model.vectors), np.abs(again.vectors), atol=1e-3)
    assert quality.fit(docs, labels.where("doc_id > 50"), F.lit(True)) is None
