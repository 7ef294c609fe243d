from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import bpe

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOC = "doc_id long, text string, n_tokens string, ids long"
PIECES = (
    " |  |\t|\n|\r\n|\x0b|\x1c|\x1f|\x85|\xa0| | |　|​| | | | |'|'s|'re|'ll|a|b|Z|é|ß|1|23|²|中|日本"
    "|\U0001f389|é|.|!|?|--|==|<|endoftext|>|the| the|don't|ing|_|##|\x00|\x7f|กำ|\U0010ffff"
).split("|") + ["<|endoftext|>", "<|endof", "text|>", "|"]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Encoder(f.read())


def own(encoder, texts):
    return [
        np.frombuffer(p, "<u4").tolist() for *_, data, offsets in bpe._parts(pa.array(texts, pa.string())) for p in encoder.encode(data, offsets)
    ]


def test_fragments_give_the_ids_of_whole_texts(encoder, library):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(25))) for _ in range(20_000)]
    assert own(encoder, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_no_character_moves_a_boundary(encoder, library):
    points = [c for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b 1{c} {c}{c}x" for c in map(chr, random.Random(5).sample(points, 30_000))]
    assert own(encoder, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_long_words_and_forced_boundaries(encoder, library):
    texts = ["a" * 30_000, " " * 30_000, "ab" * 20_000, "Ａｂ" * 9_000, "x'" * 9_000, "", "word " * 50_000]
    assert own(encoder, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    raw = np.frombuffer(b"some words, and more words", np.uint8)
    cuts = encoder.boundaries(raw, np.array([0, len(raw)]))
    assert len(cuts) > 5, "text is cut into fragments"
    assert all(not encoder.inside[int(raw[c - 1]) * 256 + int(raw[c])] for c in cuts[1:-1])


def test_what_is_remembered_is_bounded(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "_REMEMBERED", 7)
    texts = [f"word{i} and {i * 7919}" for i in range(200)] + ["x" * 100]
    assert own(encoder, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert max(map(len, encoder.known)) <= bpe._SHORT
    for _ in range(3):
        own(encoder, ["a few words"])
    assert len(encoder.known) <= 7
    encoder.known.clear()


def test_merges_of_long_words_agree_with_those_of_short_ones(encoder, monkeypatch):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdeinst ") for _ in range(rng.randrange(0, 40))).encode() for _ in range(2000)]
    short = [ids.tolist() for ids in encoder.merge_all(words)]
    monkeypatch.setattr(bpe, "_SHORT", 0)
    assert [ids.tolist() for ids in encoder.merge_all(words)] == short


def test_table_of_documents(spark, small, library):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    found = {r["doc_id"]: r for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()}
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        got = found[r["doc_id"]]
        assert np.frombuffer(got["ids"], "<u4").tolist() == ids and got["n_tokens"] == len(ids)
        assert got["text"] == library.decode(ids, skip_special_tokens=False) == (r["text"] or "")


def test_odd_rows(spark):
    rows = [(1, None, "x", 1), (1, "", "x", 2), (None, "tie", None, 3), (None, "tie", None, 3), (2, "<|endoftext|>  a", "", 4)]
    docs = spark.createDataFrame(rows, DOC)
    found = sorted(((r[0], r[1], r[3]) for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()), key=repr)
    assert [(d, t) for d, _, t in found] == [(1, ""), (1, ""), (2, "<|endoftext|>  a"), (None, "tie"), (None, "tie")]
    assert [n for _, n, _ in found] == [0, 0, 3, 1, 1] or [n for _, n, _ in found][:3] == [0, 0, 3]
    assert bpe.decode(bpe.encode(docs.where("false"), PATH), PATH).collect() == []


def test_ids_cut_within_a_character_or_unknown(spark, library):
    ids = library.encode("日本 \U0001f389", add_special_tokens=False).ids
    for some in (ids[:1], ids[1:], [*ids[:2], 999_999, *ids[2:]], []):
        row = spark.createDataFrame([(1, len(some), bytearray(np.array(some, "<u4").tobytes()))], "doc_id long, n_tokens long, ids binary")
        assert bpe.decode(row, PATH).first()["text"] == library.decode(some, skip_special_tokens=False)
    null = spark.createDataFrame([(1, 0, None)], "doc_id long, n_tokens long, ids binary")
    assert bpe.decode(null, PATH).first()["text"] == ""


def test_other_models_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        bpe.Encoder(f.read())


def test_ids_do_not_depend_on_batches(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    once = bpe.encode(docs, PATH).agg(F.sum(F.xxhash64("doc_id", "ids").cast("decimal(20,0)")))
    dealt = bpe.encode(docs.repartition(7), PATH).agg(F.sum(F.xxhash64("doc_id", "ids").cast("decimal(20,0)")))
    assert once.first() == dealt.first()
