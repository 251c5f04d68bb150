"""Vector best-fit packing of documents into token sequences.

A document is its token ids and an end id. Longer ones than a sequence takes are cut into full pieces,
only the first of which may be shorter. Every piece then has three demands: tokens, one document,
and attention cost (the square of its length). A sequence has a capacity for each, and takes a
piece only if all three hold. Pieces are placed from large to small; of the sequences that have
room, the rule picks one: the least weighted norm of what would be left (`norm`), or the least
weighted dot-product of the demand with what is left now (`dot`).

Pieces are dealt evenly into groups of a fixed size and every group is packed for itself, so work
and memory of a task do not depend on the table; a group leaves about one sequence part-filled.

Cases: a null or empty text is the end id alone. A null doc_id is kept. Repeated rows are each
packed. An empty table gives an empty result. Other columns are ignored. Texts of any length are
encoded whole, in parts of bounded size.
"""

from __future__ import annotations

import math
import sys
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txscore.llm.token_ids import token_ids
from txscore.session import shared_folder

GROUP_PIECES = 8192
NORM, DOT = "norm", "dot"


@dataclass(frozen=True)
class Capacity:
    """Of one sequence. By default only the tokens can bind."""

    tokens: int = 1024
    documents: int | None = None
    attention: int | None = None

    def piece(self) -> int:
        """The longest piece that an empty sequence takes."""
        return self.tokens if self.attention is None else min(self.tokens, math.isqrt(self.attention))

    def limits(self) -> np.ndarray:
        documents = self.tokens if self.documents is None else self.documents
        attention = self.tokens**2 if self.attention is None else self.attention
        if documents < 1 or self.tokens < 1 or attention < self.tokens:
            raise ValueError("a sequence must hold a piece")
        return np.array([self.tokens, documents, attention], float)


def piece_starts(n: int, size: int) -> list[int]:
    """Where the pieces of n ids start; the first takes what is over."""
    over = n % size
    return [0, *range(over, n, size)] if over else list(range(0, n, size))


def cut_documents(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    size: int = 1024,
    end_id: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Columns id, piece, start, length, ids_crc32: one row per piece."""
    rows = docs.select(F.col(id_column), F.col(text_column).alias("text"))
    layout = T.StructType([
        rows.schema[id_column],
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ])
    end = array("I", [end_id]).tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = token_ids(tokenizer_path)
        for batch in batches:
            out = []
            found = encode.many([text or "" for text in batch["text"]])
            for doc_id, ids in zip(batch[id_column], found, strict=True):
                data = little_endian(ids + end)
                starts = piece_starts(len(data) // 4, size)
                ends = [*starts[1:], len(data) // 4]
                for i, (a, b) in enumerate(zip(starts, ends, strict=True)):
                    out.append((doc_id, i, a, b - a, zlib.crc32(data[4 * a : 4 * b])))
            yield pd.DataFrame(out, columns=layout.names)

    return rows.mapInPandas(cut, layout)


def little_endian(data: bytes) -> bytes:
    if sys.byteorder == "little":
        return data
    swapped = array("I", data)
    swapped.byteswap()
    return swapped.tobytes()


def best_fit(lengths: np.ndarray, capacity: Capacity, rule: str = NORM) -> np.ndarray:
    """The sequence of each piece. The pieces come in order, largest first."""
    if rule not in (NORM, DOT):
        raise ValueError(f"unknown rule: {rule}")
    limits = capacity.limits()
    demands = np.stack([lengths, np.ones(len(lengths)), lengths.astype(float) ** 2], axis=1) / limits
    # a dimension counts by the share of it that all pieces ask for; one that the tokens alone keep
    # decides between sequences that are alike in the others, by less than one token's difference
    able = np.array([True, limits[1] < limits[0], limits[2] < limits[0] ** 2])
    weights = demands.sum(axis=0) * able
    weights /= max(weights.sum(), 1e-300)
    weights[~able] = 0.1 * weights[0] / limits[0] ** 2
    smallest = demands.min(axis=0, initial=1.0)
    room = np.ones((max(1, len(lengths)), 3))  # by open sequence; `number` says which
    number = np.zeros(len(room), np.int64)
    chosen = np.zeros(len(lengths), np.int64)
    n_open = n_all = 0
    slack = 1e-9  # below any whole unit of any capacity in use
    for i, demand in enumerate(demands):
        left = room[:n_open] - demand
        fits = np.flatnonzero((left >= -slack).all(axis=1))
        if len(fits):
            if rule == NORM:
                cost = (left[fits] ** 2) @ weights
            else:
                cost = room[fits] @ (weights * demand)
            at = fits[cost.argmin()]
        else:
            at, n_open = n_open, n_open + 1
            room[at], number[at] = 1.0, n_all
            n_all += 1
        chosen[i] = number[at]
        room[at] -= demand
        if (room[at] < smallest - slack).any():  # nothing fits any more
            n_open -= 1
            room[at], number[at] = room[n_open], number[n_open]
    return chosen


def pack_pieces(
    pieces: DataFrame,
    capacity: Capacity,
    *,
    rule: str = NORM,
    group_pieces: int = GROUP_PIECES,
    length_column: str = "length",
) -> DataFrame:
    """All columns of `pieces` with sequence_id and offset.

    `pieces` must come out alike each time, as a checkpointed or stored table does: its rows are
    dealt into groups by their place.
    """
    count = max(1, math.ceil(pieces.count() / group_pieces))
    clashing = [c for c in ("sequence_id", "offset", "pack_group") if c in pieces.columns]
    rows = pieces.drop(*clashing)
    layout = T.StructType([
        *rows.schema.fields,
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ])

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop(columns="pack_group")
        order = group.sort_values(
            [length_column, *[c for c in group.columns if c != length_column]],
            ascending=[False, *[True] * (len(group.columns) - 1)],
            kind="stable",
        )
        chosen = best_fit(order[length_column].to_numpy(np.int64), capacity, rule)
        order = order.assign(sequence_id=chosen + (int(key[0]) << 32))
        before = order.groupby("sequence_id")[length_column].cumsum() - order[length_column]
        return order.assign(offset=before)

    place = F.pmod(F.monotonically_increasing_id(), F.lit(count))
    dealt = rows.withColumn("pack_group", place)
    return dealt.groupBy("pack_group").applyInPandas(pack, layout)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    capacity: Capacity | None = None,
    end_id: int = 2,
    rule: str = NORM,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Columns id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    capacity = capacity or Capacity()
    shared_folder(docs.sparkSession)  # sets the checkpoint folder where the cluster has not
    pieces = cut_documents(
        docs,
        tokenizer_path,
        size=capacity.piece(),
        end_id=end_id,
        id_column=id_column,
        text_column=text_column,
    ).checkpoint()
    return pack_pieces(pieces, capacity, rule=rule)
