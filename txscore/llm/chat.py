"""Chat formatting on tokens: segments encoded apart, reserved ids spliced, masks by prefix sums.

A turn is the start id, its role and a line feed, its text, the end id and a line feed. Role and
text are encoded apart from everything around them, so no text can make a start or end id. The
two reserved ids are the first beyond the vocabulary. In decoded form they read `<|im_start|>`
and `<|im_end|>`; for that form, inside texts every `<|` gets a backslash in between and every
`<\\...|` one more, which is taken out again on reading back. The loss mask is the span of the texts
of the assistant, as token offsets in the conversation: prefix sums of the segments' lengths.

Turns of a conversation stand in the order of turn, then role, then token ids. They are encoded
where they are read, moved once by conversation, and then streamed, so memory does not depend on
how long a conversation is.

Cases: a null text is empty and so is a null role; a null turn comes first; rows with a null
conversation id are one conversation. Repeated rows are turns of their own. An empty table gives
an empty result; other columns are ignored. Long texts are encoded in parts of bounded size.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txscore.llm.token_ids import token_ids

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
_OPENING = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _OPENING.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role is one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Template:
    """Ids of turns, and turns of ids."""

    def __init__(self, tokenizer_path: str) -> None:
        self._encode = token_ids(tokenizer_path, plain_specials=True)
        self._tokenizer = self._encode.tokenizer
        self.start = self._tokenizer.get_vocab_size(with_added_tokens=True)
        self.end = self.start + 1
        (self._line,) = self.encode(["\n"])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [np.frombuffer(ids, np.uint32).tolist() for ids in self._encode.many(texts)]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; reserved ids as their names."""
        ids = np.asarray(ids)
        out, at = [], 0
        for i in np.flatnonzero(ids >= self.start).tolist():
            out += [self._plain(ids[at:i]), START if ids[i] == self.start else END]
            at = i + 1
        return "".join([*out, self._plain(ids[at:])])

    def _plain(self, ids: np.ndarray) -> str:
        return self._tokenizer.decode(ids.tolist(), skip_special_tokens=False) if len(ids) else ""

    def turns(self, said: list[tuple[str, str]]) -> list[tuple[list[int], int, int]]:
        """Of each role and text the ids of the turn, and where its text starts and ends in them."""
        roles = self.encode([escape_role(role) for role, _ in said])
        bodies = self.encode([escape(text) for _, text in said])
        found = []
        for role, body in zip(roles, bodies, strict=True):
            head = [self.start, *role, *self._line]
            found.append(([*head, *body, self.end, *self._line], len(head), len(head) + len(body)))
        return found

    def read_turn(self, formatted: str) -> tuple[str, str]:
        """Role and text of a decoded turn."""
        if not (formatted.startswith(START) and formatted.endswith(END + "\n")):
            raise ValueError("not a turn of this template")
        role, _, text = formatted[len(START) : -len(END) - 1].partition("\n")
        if START in text or END in text:
            raise ValueError("a control string inside a text")
        return unescape_role(role), unescape(text)


def format_turns(
    turns: DataFrame,
    tokenizer_path: str,
    *,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    loss_role: str = ASSISTANT,
) -> DataFrame:
    """One row per turn, conversations together and in order within a partition.

    Columns id, position (from 0), ids, start (tokens of the conversation before the turn) and
    loss_start, loss_end: the part of the conversation's tokens under the mask, empty for others.
    """
    rows = turns.select(
        F.col(id_column),
        F.col(turn_column).alias("turn"),
        F.col(role_column).alias("role"),
        F.col(text_column).alias("text"),
    )
    key = rows.schema[id_column]
    encoded = T.StructType([
        key,
        rows.schema["turn"],
        T.StructField("role", T.StringType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("body", T.IntegerType()),
        T.StructField("body_end", T.IntegerType()),
    ])
    placed = T.StructType([
        key,
        *[T.StructField(name, T.LongType()) for name in ("position", "start", "loss_start", "loss_end")],
        encoded["ids"],
    ])

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        template = Template(tokenizer_path)
        for batch in batches:
            said = zip(batch["role"], batch["text"], strict=True)
            made = template.turns([(role or "", text or "") for role, text in said])
            yield pd.DataFrame({
                id_column: batch[id_column],
                "turn": batch["turn"],
                "role": batch["role"],
                "ids": [ids for ids, _, _ in made],
                "body": [a for _, a, _ in made],
                "body_end": [b for _, _, b in made],
            })

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        present, position, start = object(), 0, 0
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                conv = _key(row[0])
                if conv != present:
                    present, position, start = conv, 0, 0
                masked = row.role == loss_role
                out.append((
                    row[0], position, start,
                    start + (row.body if masked else 0), start + (row.body_end if masked else 0), row.ids,
                ))
                position, start = position + 1, start + len(row.ids)
            yield pd.DataFrame(out, columns=placed.names)

    return (
        rows.mapInPandas(encode, encoded)
        .repartition(F.col(id_column))
        .sortWithinPartitions(id_column, "turn", "role", "ids")
        .mapInPandas(place, placed)
    )


def _key(value: object) -> object:
    """A null id arrives as None or as a number that differs from itself."""
    return None if value is None or value != value else value


def read_back(formatted: DataFrame, tokenizer_path: str, *, id_column: str = "conv_id") -> DataFrame:
    """Digests of what the formatted turns say, one row per conversation.

    Columns id, n_turns, turns_sha256 (of role, line feed, text, line feed per turn), loss_chars,
    loss_sha256 (of all text under the mask) and formatted_chars, all from decoding the ids.
    """
    layout = T.StructType([
        formatted.schema[id_column],
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
    ])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        template = Template(tokenizer_path)
        conv = None
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if conv is None or conv.key != _key(row[0]):
                    if conv is not None:
                        out.append(conv.row())
                    conv = _Conversation(row[0])
                conv.add(template, row)
            yield pd.DataFrame(out, columns=layout.names)
        if conv is not None:
            yield pd.DataFrame([conv.row()], columns=layout.names)

    return (
        formatted.select(id_column, "position", "start", "loss_start", "loss_end", "ids")
        .repartition(F.col(id_column))
        .sortWithinPartitions(id_column, "position")
        .mapInPandas(read, layout)
    )


class _Conversation:
    def __init__(self, conv_id: object) -> None:
        self.conv_id, self.key = conv_id, _key(conv_id)
        self.turns = self.loss_chars = self.chars = 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, template: Template, row) -> None:
        ids = np.asarray(row.ids)
        text = template.decode(ids)
        role, said = template.read_turn(text)
        self.turns += 1
        self.chars += len(text)
        self.said.update(f"{role}\n{said}\n".encode())
        under = unescape(template.decode(ids[row.loss_start - row.start : row.loss_end - row.start]))
        self.loss_chars += len(under)
        self.loss.update(under.encode())

    def row(self) -> tuple:
        return (
            self.conv_id, self.turns, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
        )
