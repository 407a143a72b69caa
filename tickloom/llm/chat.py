"""Chat formatting with loss masks aligned by offsets.

A conversation is rendered whole, encoded once with offsets, and the sorted spans of the assistant's turns are
intersected with the token spans by binary search: a token counts for the loss where it overlaps such a span, and the
overlap says with which characters.

    <s>[INST]role\\ntext[/INST]\\n      any role but assistant
    <s>assistant\\ntext</s>\\n

Control strings inside roles and texts get a backslash after their first character, a backslash is doubled, and a
new line in a role gets a backslash before it; ``unescape`` takes them back.

Rows stream through a task in the order of conversation and turn (then role and text, where turns are equal), so a
conversation of any length needs the memory of a piece: rendering is cut before a turn once a piece is
full. Turns end in a new line before a ``<``, where the vocabulary's pattern always ends a word, so the pieces' tokens
are those of the whole. A NULL text or role is empty; rows without conversation id form one conversation; repeated rows
are repeated turns. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

PIECE = 1 << 20
LOSS_ROLE = "assistant"

_ESCAPE = re.compile(r"\\|<(?=/?s>)|\[(?=/?INST\])")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_PLAIN = r"(?:[^\\]|\\.)*?"
_TURN = re.compile(rf"<s>(?:\[INST\](?P<role>{_PLAIN})\n(?P<text>{_PLAIN})\[/INST\]|(?P<own>{_PLAIN})\n(?P<said>{_PLAIN})</s>)\n", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """One turn, and where its text starts and ends."""
    name, body = escape(role).replace("\n", "\\\n"), escape(text)
    lead, tail = (f"<s>{name}\n", "</s>\n") if role == LOSS_ROLE else (f"<s>[INST]{name}\n", "[/INST]\n")
    return lead + body + tail, len(lead), len(lead) + len(body)


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """Role and text of every turn of a rendered piece."""
    at = 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if not turn:
            raise ValueError(f"not a rendered conversation from character {at}")
        own = turn["own"] is not None
        yield unescape(turn["own"] if own else turn["role"]), unescape(turn["said"] if own else turn["text"])
        at = turn.end()


def overlaps(tokens: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens overlap any span, and the overlaps (start, end) in order. Both arrays hold sorted (start, end) rows."""
    if not len(tokens) or not len(spans):
        return np.zeros(len(tokens), bool), np.empty((0, 2), np.int64)
    first = np.searchsorted(spans[:, 1], tokens[:, 0], side="right")
    last = np.searchsorted(spans[:, 0], tokens[:, 1], side="left")
    counts = np.maximum(last - first, 0)
    token = np.repeat(np.arange(len(tokens)), counts)
    span = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + first[token]
    both = np.stack([np.maximum(tokens[token, 0], spans[span, 0]), np.minimum(tokens[token, 1], spans[span, 1])], axis=1)
    held = both[:, 1] > both[:, 0]
    mask = np.zeros(len(tokens), bool)
    mask[token[held]] = True
    return mask, both[held]


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


_PIECES = pa.schema(
    [("conv_id", pa.int64()), ("piece", pa.int32()), ("formatted", pa.string()), ("ids", pa.list_(pa.int32())), ("mask", pa.list_(pa.bool_())), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))]
)
PIECES = "conv_id bigint, piece int, formatted string, ids array<int>, mask array<boolean>, starts array<bigint>, ends array<bigint>"
READ = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def _piece(conv_id: int | None, number: int, turns: list[tuple[str, int, int, bool]], path: str) -> pa.RecordBatch:
    formatted = "".join(t[0] for t in turns)
    begins = np.cumsum([0, *[len(t[0]) for t in turns]])
    spans = np.array([(at + t[1], at + t[2]) for at, t in zip(begins, turns) if t[3]], np.int64).reshape(-1, 2)
    found = _tokenizer(path).encode(formatted, add_special_tokens=False)
    mask, both = overlaps(np.array(found.offsets, np.int64).reshape(-1, 2), spans)
    columns = [conv_id], [number], [formatted], [found.ids], [mask.tolist()], [both[:, 0].tolist()], [both[:, 1].tolist()]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECES)], schema=_PIECES)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, str, str]]:
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "text")])


def _format(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    current, number, held, size, any_row = None, 0, [], 0, False
    for conv_id, role, text in _rows(batches):
        if any_row and (conv_id != current or size >= PIECE):
            yield _piece(current, number, held, path)
            number, held, size = (number + 1 if conv_id == current else 0), [], 0
        turn, start, end = render(role, text)
        held.append((turn, start, end, role == LOSS_ROLE))
        current, size, any_row = conv_id, size + len(turn), True
    if any_row:
        yield _piece(current, number, held, path)


@dataclass
class _Reading:
    conv_id: int | None
    n_turns: int = 0
    loss_chars: int = 0
    formatted_chars: int = 0
    turns: object = field(default_factory=hashlib.sha256)
    loss: object = field(default_factory=hashlib.sha256)

    def add(self, formatted: str, starts: list[int], ends: list[int]) -> None:
        for role, text in parse(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        # Neighbouring tokens may share a character, so the characters are marked before they are read.
        marked = np.zeros(len(formatted) + 1, np.int32)
        np.add.at(marked, starts, 1)
        np.add.at(marked, ends, -1)
        edges = np.flatnonzero(np.diff((np.cumsum(marked) > 0).astype(np.int8), prepend=0))
        loss = unescape("".join(formatted[a:b] for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())))
        self.loss.update(loss.encode())
        self.loss_chars += len(loss)
        self.formatted_chars += len(formatted)

    def row(self) -> pa.RecordBatch:
        values = [self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=[c.split()[0] for c in READ.split(", ")])


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reading = None
    for batch in batches:
        for conv_id, formatted, starts, ends in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "formatted", "starts", "ends")]):
            if reading is None or reading.conv_id != conv_id:
                if reading:
                    yield reading.row()
                reading = _Reading(conv_id)
            reading.add(formatted, starts, ends)
    if reading:
        yield reading.row()


def _ordered(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")


def format_conversations(conversations: DataFrame, path: str) -> DataFrame:
    """Pieces of rendered conversations: text, token ids, the loss mask by token, and its characters as spans.

    ``path``: the vocabulary, at the same place on every executor.
    """
    return _ordered(conversations).mapInArrow(partial(_format, path=path), PIECES)


def read_back(pieces: DataFrame) -> DataFrame:
    """Turns and loss text of every conversation, read from its pieces: counts and digests."""
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(_read, READ)


def round_trip(conversations: DataFrame, path: str) -> DataFrame:
    """``read_back(format_conversations(...))`` in one pass through one Python worker."""

    def both(batches):
        return _read(_format(batches, path))

    return _ordered(conversations).mapInArrow(both, READ)
