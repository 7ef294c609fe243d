"""Byte-level BPE: encoding in fragments cut at forced boundaries, and decoding.

A merge only ever builds tokens of the vocabulary. So where two neighbouring bytes are found side by
side inside no token at all, no token can reach across: the place between them is a token boundary
of every text. A table of 256 x 256 pairs tells these places for a whole column at once; the
fragments between them are encoded independently and their ids are put after one another. Fragments
are short and recur, so a task encodes each of them about once and looks the others up.

Words are split off by a pattern before merging, which also must not see the cut. It looks back
nowhere and ahead in two places only: behind white space, and from an apostrophe. No place behind
white space or ahead of an apostrophe is therefore cut. Special tokens stand alone: the places
around one are cut, those inside are not.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from tidewatch.llm.words import CHUNK_BYTES, text_bytes

# Fragments whose ids a task remembers, and the bytes up to which one is short.
_REMEMBERED, _SHORT = 200_000, 64

# What the word pattern takes as one word at sight; all else is split by the library's pattern.
_ONE_WORD = re.compile(rb" ?[A-Za-z]+")

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True


def _byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies write each byte as.

    Printable bytes of Latin-1 stand for themselves, the others for the characters from 256 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


_LETTER = _byte_letters()
_BYTE = {c: b for b, c in enumerate(_LETTER)}


def token_bytes(token: str) -> bytes:
    """The bytes a token stands for; a token with a character of no byte stands for its own text."""
    return bytes(_BYTE[c] for c in token) if all(c in _BYTE for c in token) else token.encode()


def after_white(data: np.ndarray) -> np.ndarray:
    """Marks the last byte of each white-space character (``\\s`` of the word pattern)."""
    out = _WHITE[data]
    one, two = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    one[1:], two[2:] = data[:-1], data[:-2]
    out |= (one == 0xC2) & ((data == 0x85) | (data == 0xA0))
    out |= (two == 0xE1) & (one == 0x9A) & (data == 0x80)
    out |= (two == 0xE2) & (one == 0x80) & ((data <= 0x8A) | (data == 0xA8) | (data == 0xA9) | (data == 0xAF))
    out |= (two == 0xE2) & (one == 0x81) & (data == 0x9F)
    return out | ((two == 0xE3) & (one == 0x80) & (data == 0x80))


class Encoder:
    """Ids of fragments, as packed little-endian unsigned 32-bit integers, remembered up to a bound."""

    def __init__(self, vocabulary: str):
        read = json.loads(vocabulary)
        model, split, added = read["model"], read["pre_tokenizer"], read["added_tokens"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or read["normalizer"] is not None:
            raise ValueError("not a plain byte-level BPE")
        if split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
            raise ValueError("words must be split by the byte-level pattern, without a space put first")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("special tokens must not take text around them")
        ids: dict[str, int] = model["vocab"]
        missing = [c for c in _LETTER if c not in ids]
        if missing:
            raise ValueError(f"{len(missing)} bytes have no token")
        self.split = Tokenizer.from_str(vocabulary).pre_tokenizer
        self.special = {t["content"].encode(): t["id"] for t in added if t["content"]}
        found = sorted(self.special, key=len, reverse=True)
        self.find_special = re.compile(b"|".join(map(re.escape, found))) if found else None
        self.tokens = {i: token_bytes(t) for t, i in ids.items()} | {i: c for c, i in self.special.items()}
        self.inside = np.zeros(1 << 16, bool)
        for t in ids:
            raw = np.frombuffer(token_bytes(t), np.uint8).astype(np.int64)
            self.inside[raw[:-1] * 256 + raw[1:]] = True
        # Merges by their pair of ids: rank, and the id they make.
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.base = max(ids.values()) + 1
        keys = np.array([ids[a] * self.base + ids[b] for a, b in pairs], np.int64)
        self.rank = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank]
        self.ranks = {int(k): n for n, k in enumerate(keys)}
        self.of_byte = np.array([ids[c] for c in _LETTER], np.int64)
        self.known: dict[bytes, bytes] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], len(self.keys))

    def merge_all(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word: the merge of least rank first, of equal ones the leftmost.

        All words at once, one merge of each a round; what is done leaves. A long word would take as
        many rounds as it has merges, so it goes its own way.
        """
        out: list[np.ndarray] = [self.of_byte[:0]] * len(words)
        some = [k for k, w in enumerate(words) if 0 < len(w) <= _SHORT]
        for k, w in enumerate(words):
            if len(w) > _SHORT:
                out[k] = np.array(self._merge_long(self.of_byte[np.frombuffer(w, np.uint8)].tolist()), np.int64)
        if not some:
            return out
        none = len(self.keys)
        symbol = self.of_byte[np.frombuffer(b"".join([words[k] for k in some]), np.uint8)]
        owner = np.repeat(np.array(some), [len(words[k]) for k in some])
        rank = np.full(len(symbol), none)
        same = np.flatnonzero(owner[1:] == owner[:-1])
        rank[same] = self._ranks(symbol[same], symbol[same + 1])
        while len(symbol):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            size = np.diff(np.r_[first, len(owner)])
            least = np.minimum.reduceat(rank, first)
            over = least == none
            if over.any():
                for k, a, n in zip(owner[first[over]].tolist(), first[over].tolist(), size[over].tolist()):
                    out[k] = symbol[a : a + n]
                on = ~np.repeat(over, size)
                symbol, owner, rank = symbol[on], owner[on], rank[on]
                least, size = least[~over], size[~over]
                if not len(symbol):
                    break
            hit = np.flatnonzero(rank == np.repeat(least, size))
            hit = hit[np.r_[True, owner[hit[1:]] != owner[hit[:-1]]]]
            symbol[hit] = self.made[rank[hit]]
            keep = np.ones(len(symbol), bool)
            keep[hit + 1] = False
            hit = hit - np.arange(len(hit))  # places after one symbol of each word before is gone
            symbol, owner, rank = symbol[keep], owner[keep], rank[keep]
            for at in (hit, hit - 1):
                at = at[at >= 0]
                inner = (at + 1 < len(owner)) & (owner[at] == owner[np.minimum(at + 1, len(owner) - 1)])
                rank[at[~inner]] = none
                at = at[inner]
                rank[at] = self._ranks(symbol[at], symbol[at + 1])
        return out

    def _merge_long(self, symbol: list[int | None]) -> list[int]:
        """The same for one word: a heap over a linked list of symbols takes n log n steps."""
        n, ranks, base = len(symbol), self.ranks, self.base
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p], i) for i, p in enumerate(a * base + b for a, b in zip(symbol, symbol[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if symbol[i] is None or j >= n or ranks.get(symbol[i] * base + symbol[j]) != rank:
                continue
            symbol[i] = int(self.made[rank])
            symbol[j] = None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get(symbol[i] * base + symbol[k])) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := ranks.get(symbol[h] * base + symbol[i])) is not None:
                heapq.heappush(heap, (r, h))
        return [s for s in symbol if s is not None]

    def _learn(self, fragments: list[bytes]) -> None:
        """Encode fragments, each on its own, into ``known``."""
        words, owner = [], []
        for k, f in enumerate(fragments):
            if f in self.special:
                continue
            found = [f] if _ONE_WORD.fullmatch(f) else [token_bytes(w) for w, _ in self.split.pre_tokenize_str(f.decode())]
            words += found
            owner += [k] * len(found)
        packed: list[list[bytes]] = [[] for _ in fragments]
        for k, ids in zip(owner, self.merge_all(words)):
            packed[k].append(ids.astype("<u4").tobytes())
        for f, parts in zip(fragments, packed):
            self.known[f] = self.special[f].to_bytes(4, "little") if f in self.special else b"".join(parts)

    def boundaries(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Places of ``data`` (from 0, its length included) at which a fragment begins or ends."""
        cut = np.zeros(len(data) + 1, bool)
        pair = data[:-1].astype(np.int64) * 256 + data[1:]
        starts_letter = (data[1:] & 0xC0) != 0x80
        cut[1:-1] = ~self.inside[pair] & starts_letter & ~after_white(data)[:-1] & (data[1:] != 0x27)
        raw = data.tobytes()
        if self.find_special and self.find_special.search(raw):
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                for m in self.find_special.finditer(raw, a, b):
                    cut[m.start() : m.end()] = False
                    cut[[m.start(), m.end()]] = True
        cut[offsets] = True
        return np.flatnonzero(cut)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Packed ids of each row. What the rows need is remembered with what fits into the bound."""
        if len(data) == 0:
            return [b""] * (len(offsets) - 1)
        places = self.boundaries(data, offsets)
        rows = np.searchsorted(places, offsets).tolist()
        raw, at = data.tobytes(), places.tolist()
        fragments = [raw[i:j] for i, j in zip(at, at[1:])]
        known = self.known
        if len(known) > _REMEMBERED:
            known.clear()
        new = list({f for f in fragments if f not in known})
        self._learn(new)
        packed = list(map(known.__getitem__, fragments))
        for f in new:
            if len(f) > _SHORT:
                del known[f]
        return [b"".join(packed[a:b]) for a, b in zip(rows[:-1], rows[1:])]


def _parts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Some whole rows of a text column at a time: first row, end row, bytes and offsets."""
    data, offsets = text_bytes(column)
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def _read(df: DataFrame, path: str):
    """The vocabulary, read once by the driver; its size is that of the file."""
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids) of each row of ``docs``; ids are packed as unsigned 32-bit integers.

    ``path`` names a byte-level BPE of the tokenizers library; ids are those of its ``encode`` without
    added special tokens, truncation and padding. A special token's text counts as that token. Null
    and empty texts have no ids. A text is encoded as a whole, whatever its length, and memory grows
    with the longest text only. Rows that repeat an id give a row each, an empty table an empty one;
    other columns, of whatever name, are not read.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    vocabulary = _read(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(vocabulary.value)
            for a, b, data, offsets in _parts(batch.column("text")):
                packed = encoder.encode(data, offsets)
                n = pa.array([len(p) // 4 for p in packed], pa.int64())
                yield pa.record_batch([batch.column("doc_id").slice(a, b - a), n, pa.array(packed, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, n_tokens, ids) with ``text``, special tokens included.

    Bytes that are no UTF-8 become U+FFFD, as in any sequence of ids cut within a character; ids that
    are not in the vocabulary are left out; null ids give an empty text.
    """
    vocabulary = _read(encoded, path)
    rows = encoded.select("doc_id", "n_tokens", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = None
        for batch in batches:
            tokens = tokens or Encoder(vocabulary.value).tokens
            texts = []
            for packed in batch.column("ids"):
                ids = np.frombuffer(packed.as_py() or b"", "<u4").tolist()
                texts.append(b"".join([tokens.get(i, b"") for i in ids]).decode(errors="replace"))
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=["doc_id", "n_tokens", "ids", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary, text string")
