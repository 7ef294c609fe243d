"""Personal data: fixed patterns, and spans found by weak supervision.

Four patterns give the base spans. Looser candidates (numbers, disguised addresses, keys) are judged
by labelers that vote yes, no or not at all: regular expressions on the shape, word lists on the
words before, and the context. Counts of vote patterns over the whole corpus, at most a few thousand
different ones, let expectation-maximisation estimate how reliable each labeler is without any
labels; its posteriors train a logistic classifier of spans, which sees shapes and contexts as
features and also decides where all labelers are silent.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Order of kinds in joined spans; the last comes from candidates only.
KINDS = ("email", "ip", "card", "phone", "secret")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits is tried from its start only: what fails there fails further on as well.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four patterns in the order of KINDS, leftmost and non-overlapping per kind."""
    found = []
    end = at = 0
    while (at := text.find("@", at)) >= 0:
        if m := _DOMAIN.match(text, at):
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                end = m.end()
                found.append(("email", start, end))
        at += 1
        if at < end:
            at = end
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", *m.span()))
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", *m.span()))
    return found


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


# Candidates: what each looser pattern would be if it is personal. Runs are taken whole, and what must
# hold of them is asked afterwards, so that no run is scanned from more than one start.
_NUMBER = re.compile(r"(?<![\w.+])\(?[0-9]++(?:[ ().-]{1,3}[0-9]++)*+")
_KEYLIKE = re.compile(r"(?<!\w)[A-Za-z0-9_]{12,}+(?!\w)")
_AT = re.compile(r" ?(?:\[at\]|\(at\)|\{at\}) ?| at ", re.I)
_HOST = re.compile(r"[A-Za-z0-9-]++(?:(?: ?(?:\[dot\]|\(dot\)|\{dot\}|\.) ?| dot )[A-Za-z0-9-]++)++", re.I)
_MARK = re.compile(r"[\[({](?:at|dot)[\])}]| dot ", re.I)
# Fixed word lists: words ahead of personal data, and ahead of other numbers and names.
_CUES = frozenset(
    "tel telefon telephone phone mobile cell call fax handy numéro teléfono móvil contact kontakt ssn social passport "
    "iban konto account card karte password passwd passwort pwd token secret key apikey email mail e-mail correo".split()
)
_OTHER_CUES = frozenset(
    "version v isbn issn doi page seite página chapter kapitel figure fig section year jahr eur usd euro dollars "
    "table no nr commit build release license licence".split()
)
_TOPS = frozenset("com org net edu gov de fr es io uk eu info".split())
_WORDS = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")
_DATE = re.compile(r"[0-9]{1,4}[ .-][0-9]{1,2}[ .-][0-9]{1,4}")
_GROUPED = re.compile(r"\(?[0-9]{2,5}\)?(?:[ .-]{1,2}[0-9]{2,5}){1,4}")
_HEX = re.compile(r"[0-9a-f]{16,}|[0-9A-F]{16,}")
_KEY = re.compile(r"[A-Z]{3,4}[A-Z0-9]{16}")
YES, NO, SILENT = 1, 0, 2
LABELERS = 8


class Taken:
    """Places that base spans cover, as disjoint stretches in order."""

    def __init__(self, base: list[tuple[str, int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, a, b in sorted(base, key=lambda s: s[1:]):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, start: int, end: int) -> bool:
        """Does any place from ``start`` to before ``end`` lie in a stretch?"""
        k = bisect_left(self.starts, end) - 1
        return k >= 0 and self.ends[k] > start


def _signals(kind: str, text: str, start: int, end: int, taken: Taken) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Votes of the labelers, and features of the classifier (small integers)."""
    span, before, after = text[start:end], text[max(0, start - 32) : start], text[end : end + 1]
    digits = sum(c.isdigit() for c in span)
    words = [w.lower() for w in _WORDS.findall(before)][-3:]
    near = taken.meets(start - 65, end + 65)
    opened = before[-1:] in ("=", ":", '"', "'") or before[-2:] in ("= ", ": ")
    cue, other = any(w in _CUES for w in words), any(w in _OTHER_CUES for w in words)
    spread = len(set(span)) / max(1, min(len(span), 16))
    if kind == "phone":
        shape = YES if 9 <= digits <= 13 and _GROUPED.fullmatch(span) else NO if digits < 7 or digits > 15 else SILENT
        pattern = NO if _DATE.fullmatch(span) else SILENT
    elif kind == "secret":
        shape = YES if _HEX.fullmatch(span) or _KEY.fullmatch(span) else SILENT
        pattern = NO if re.fullmatch(r"[A-Za-z]+[0-9]{1,4}", span) else SILENT
    else:
        shape = YES if span.rpartition(".")[2].rpartition(" ")[2].lower().strip("])}") in _TOPS else NO
        pattern = YES if re.search(r"[\[({]at[\])}]", span, re.I) else SILENT
    votes = (
        shape,
        pattern,
        YES if cue else SILENT,
        NO if other else SILENT,
        YES if opened else SILENT,
        YES if near else SILENT,
        NO if spread < 0.3 else YES if kind == "secret" and spread > 0.6 else SILENT,
        NO if after in ("%", "€", "$") or before[-1:] in ("$", "€", "#") else SILENT,
    )
    features = (
        int(shape == YES), int(pattern == NO), int(cue), int(other), int(opened), int(near), int(spread < 0.3),
        min(digits, 20) // 4, min(len(span), 64) // 8, int(any(c.isupper() for c in span)), int(any(c in "()-. " for c in span)),
    )
    return votes, features


def _loose(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of everything that has the form of a number, a key or a disguised address."""
    if _DIGIT.search(text):
        for m in _NUMBER.finditer(text):
            attached = text[m.end() : m.end() + 1]
            if sum(c.isdigit() for c in m[0]) >= 7 and not (attached.isalnum() or attached == "_"):
                yield "phone", *m.span()
        for m in _KEYLIKE.finditer(text):
            if any(c.isdigit() for c in m[0]) and any(not c.isdigit() for c in m[0]):
                yield "secret", *m.span()
    end = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start() and (host := _HOST.match(text, m.end())):
            if _MARK.search(m[0]) or _MARK.search(host[0]):
                yield "email", start, host.end()
            end = host.end()


def candidates(text: str, base: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, tuple[int, ...], tuple[int, ...]]]:
    """(kind, start, end, votes, features) of looser spans that touch no base span, in linear time."""
    taken = Taken(base)
    for kind, start, end in _loose(text):
        if not taken.meets(start, end):
            yield kind, start, end, *_signals(kind, text, start, end, taken)


@dataclass
class SpanModel:
    """Reliabilities (kind -> labeler x truth x vote) and weights of the classifier per kind."""

    reliability: dict[str, np.ndarray]
    weights: dict[str, np.ndarray]

    def accepts(self, kind: str, features: tuple[int, ...]) -> bool:
        w = self.weights.get(kind)
        return w is not None and float(_expand(np.array([features])) @ w) >= 0


def _expand(features: np.ndarray) -> np.ndarray:
    """Flags as they are; sizes as one column per grade; a constant."""
    flags = features[:, [0, 1, 2, 3, 4, 5, 6, 9, 10]]
    grades = [(features[:, [c]] == np.arange(9)) for c in (7, 8)]
    return np.hstack([flags, *grades, np.ones((len(features), 1))]).astype(float)


def estimate(votes: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each vote pattern and (labeler x truth x vote) reliabilities, by EM.

    Starts from the majority of votes; a labeler's table is smoothed towards its being right more
    often than not, which also fixes which of the two classes is which.
    """
    yes, no = (votes == YES).sum(1), (votes == NO).sum(1)
    post = np.clip(0.5 + 0.2 * (yes - no), 0.05, 0.95)
    onehot = (votes[:, :, None] == np.arange(3)).astype(float)
    belief = np.zeros((votes.shape[1], 2, 3))
    belief[:, 0, NO], belief[:, 1, YES], belief[:, :, SILENT] = 4, 4, 4
    belief[:, 0, YES] = belief[:, 1, NO] = 1
    table = belief
    for _ in range(rounds):
        both = np.stack([1 - post, post])
        table = np.einsum("tp,plv->ltv", both * weight, onehot) + belief
        table /= table.sum(2, keepdims=True)
        prior = (both * weight).sum(1) + 1
        score = np.einsum("plv,ltv->pt", onehot, np.log(table)) + np.log(prior / prior.sum())
        post = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -50, 50)))
    return post, table


def fit(docs: DataFrame, text_col: str = "text") -> SpanModel:
    """Labelers' reliabilities and the classifier, from candidates of all rows of ``docs``.

    Tasks count their candidates by (kind, votes, features); what reaches the driver is one row per
    combination that occurs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text:
                    seen.update((kind, votes, features) for kind, _, _, votes, features in candidates(text, base_spans(text)))
        if seen:
            keys = list(seen)
            yield pa.record_batch(
                [pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys], pa.list_(pa.int32())),
                 pa.array([k[2] for k in keys], pa.list_(pa.int32())), pa.array([seen[k] for k in keys], pa.int64())],
                names=["kind", "votes", "features", "n"],
            )

    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    counted = texts.mapInArrow(run, "kind string, votes array<int>, features array<int>, n long")
    rows = counted.groupBy("kind", "votes", "features").agg(F.sum("n").alias("n")).collect()
    rows.sort(key=lambda r: (r["kind"], r["votes"], r["features"]))
    model = SpanModel({}, {})
    for kind in sorted({r["kind"] for r in rows}):
        mine = [r for r in rows if r["kind"] == kind]
        votes, weight = np.array([r["votes"] for r in mine]), np.array([r["n"] for r in mine], float)
        post, model.reliability[kind] = estimate(votes, weight)
        x = _expand(np.array([r["features"] for r in mine]))
        w = np.zeros(x.shape[1])
        for _ in range(25):  # Newton's method with a small ridge
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (weight * (p - post)) + 0.5 * w
            curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 0.5 * np.eye(len(w))
            w -= np.linalg.solve(curve, slope)
        model.weights[kind] = w
    return model


def find_pii(docs: DataFrame, model: SpanModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans), one row per row of ``docs``.

    Counts and digest are of base spans; ``spans`` also has those that the model adds. A null text
    is empty and has no spans. Rows that repeat an id are separate; an empty table gives an empty
    table; other columns are ignored. Places are code points, ends are exclusive.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["n_email", "n_ip", "n_card", "n_phone"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            counts, digests, spans = [[] for _ in names], [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                for k, column in zip(KINDS, counts):
                    column.append(sum(s[0] == k for s in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                more = [c[:3] for c in candidates(text or "", base) if model.accepts(c[0], c[4])]
                spans.append(joined(base + more))
            yield pa.record_batch(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", *names, "base_sha256", "spans"],
            )

    schema = ", ".join([f"doc_id {kind}", *(f"{n} long" for n in names), "base_sha256 string", "spans string"])
    return texts.mapInArrow(run, schema)
