"""Chat formatting: a finite-state machine over roles and a declarative template.

Conversations are brought together by key and sorted by turn within a partition; a task then
streams over them turn by turn, so that a conversation of any length needs no more memory than
one batch. Every turn becomes three segments: the head that marks it, its text with control strings
escaped, and the tail. Each segment says whether a training loss counts it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Strings that chat templates in common use treat as control tokens.
CONTROL_STRINGS = (
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|begin_of_text|>", "<|end_of_text|>",
    "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>", "<|system|>", "<|user|>", "<|assistant|>",
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<start_of_turn>", "<end_of_turn>",
)
_MARK = "\\"


@dataclass(frozen=True)
class Template:
    """Head and tail of a turn, the roles that are trained on, and the legal order of roles.

    ``order`` maps a state to the roles that may follow; a role is the next state. ``start`` is
    the first state. ``ends`` are the states a conversation may end in.
    """

    head: str = "<|im_start|>{role}\n"
    tail: str = "<|im_end|>\n"
    loss_roles: frozenset[str] = frozenset({"assistant"})
    order: Mapping[str, frozenset[str]] = field(
        default_factory=lambda: {
            "start": frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user"}),
        }
    )
    ends: frozenset[str] = frozenset({"assistant", "user"})
    controls: tuple[str, ...] = CONTROL_STRINGS

    def __post_init__(self) -> None:
        before, _, after = self.head.partition("{role}")
        if before not in self.controls or not after or not any(self.tail.startswith(c) for c in self.controls):
            raise ValueError("head must be a control string, {role} and an end; tail must start with a control string")

    @property
    def _controls(self) -> re.Pattern[str]:
        # A lookahead finds controls that overlap as well.
        return re.compile("(?=" + "|".join(map(re.escape, self.controls)) + ")(.)", re.S)

    def escape(self, text: str) -> str:
        """No control string is left in the result: each gets a mark behind its first character."""
        return self._controls.sub(r"\1" + _MARK * 2, text.replace(_MARK, _MARK * 2))

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        # Roles are names; whatever else stands there must not end the head early.
        return [
            (self.head.replace("{role}", quote(role, safe="")), False),
            (self.escape(text), role in self.loss_roles),
            (self.tail, False),
        ]

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of every turn: the inverse of joining the segments."""
        before, _, after = self.head.partition("{role}")
        turn = re.compile(f"{re.escape(before)}(.*?){re.escape(after)}(.*?){re.escape(self.tail)}", re.S)
        found, at = [], 0
        while at < len(formatted):
            m = turn.match(formatted, at)
            if m is None:
                raise ValueError(f"no turn at {at}")
            found.append((unquote(m[1]), self.unescape(m[2])))
            at = m.end()
        return found


def format_chat(
    turns: DataFrame,
    template: Template = Template(),
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Segments (conv_id, seq, text, loss, problem), three per turn, in order within a partition.

    The segments of a conversation by ``seq``, joined, are its training text. ``problem`` is set
    at the head of a turn whose role may not follow the one before (``role``) and of one whose
    number repeats the one before (``turn``); such turns are formatted all the same, and the
    machine goes on from the role found. Null texts and roles are empty; a null conversation id
    is a conversation of its own; null turn numbers come first. Rows with equal turn numbers are
    ordered by role and text. Columns of any other name are ignored.
    """
    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, last, seq, fresh = None, "start", None, 0, True
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for c, t, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text"))):
                if fresh or c != conv:
                    conv, state, last, seq, fresh = c, "start", None, 0, False
                problem = "role" if role not in template.order.get(state, ()) else None
                if seq and t == last:
                    problem = "turn"
                for k, (piece, loss) in enumerate(template.segments(role, text)):
                    for column, value in zip(out, (c, seq, piece, loss, problem if k == 0 else None)):
                        column.append(value)
                    seq += 1
                state, last = role, t
            if out[0]:
                yield pa.record_batch(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()),
                     pa.array(out[3], pa.bool_()), pa.array(out[4], pa.string())],
                    names=["conv_id", "seq", "text", "loss", "problem"],
                )

    return ordered.mapInArrow(run, "conv_id long, seq long, text string, loss boolean, problem string")


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation, from the output of ``format_chat`` as it lies in its partitions.

    Every turn is parsed from its formatted text; digests are fed as the segments come.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        done: list[tuple] = []
        conv, open_ = None, False

        def close() -> None:
            done.append((conv, n, said.hexdigest(), lost, heard.hexdigest(), chars, valid and state in template.ends))

        for batch in batches:
            columns = (batch.column(k).to_pylist() for k in ("conv_id", "seq", "text", "loss", "problem"))
            for c, seq, text, loss, problem in zip(*columns):
                if seq == 0:
                    if open_:
                        close()
                    conv, open_, n, lost, chars, valid, state = c, True, 0, 0, 0, True, "start"
                    said, heard, parts = hashlib.sha256(), hashlib.sha256(), []
                parts.append(text)
                chars += len(text)
                valid &= problem is None
                if loss:
                    plain = template.unescape(text)
                    lost += len(plain)
                    heard.update(plain.encode())
                if len(parts) == 3:
                    for role, body in template.parse("".join(parts)):
                        n, state = n + 1, role
                        said.update(f"{role}\n{body}\n".encode())
                    parts = []
            if done:
                yield pa.record_batch([pa.array(v, k) for v, k in zip(zip(*done), kinds)], names=names)
                done.clear()
        if open_:
            close()
            yield pa.record_batch([pa.array(v, k) for v, k in zip(zip(*done), kinds)], names=names)

    return segments.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, valid boolean",
    )
