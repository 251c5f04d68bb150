"""Encoding by the merges of a piece vocabulary, and decoding, in Arrow batches.

A text starts as its characters, spaces written as the mark `▁` and one mark put in front. Of all
adjacent symbols that together are a piece of the vocabulary, the pair whose piece has the highest
score is merged, the leftmost of equals first, until none is left. Symbols that are no
piece become the pieces of their UTF-8 bytes. Texts are cut where no piece can reach across, and
every new stretch is compared with what the sentencepiece library gives for it: a
difference ends the job, as the vocabulary is then not of the kind meant here.

Vocabularies of merge type with byte pieces and without rewriting of the text are taken; another
one is refused with a ValueError.

Cases: a null or empty text has no ids and decodes to the empty text. A null id is kept, repeated
rows come repeatedly, an empty table gives an empty result, and other columns are ignored.
Texts of any length are encoded whole, in parts of bounded size.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txscore.llm.chunks import Lookup

MARK = "▁"
# stretches up to this length are merged side by side, longer ones one at a time
SIDE_BY_SIDE = 48
_CODES = 0x110000


class Agenda:
    """The merges of a vocabulary: which two symbols make which piece, at which score."""

    def __init__(self, processor) -> None:
        self.scores: dict[str, float] = {}
        ids: dict[str, int] = {}
        for i in range(processor.get_piece_size()):
            if processor.is_unused(i):
                raise ValueError("pieces out of use are not supported")
            if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i)):
                piece = processor.id_to_piece(i)
                ids[piece], self.scores[piece] = i, processor.get_score(i)
        self.ids = ids
        self.size = processor.get_piece_size()
        self.byte_ids = [processor.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(processor.is_byte(i) for i in self.byte_ids):
            raise ValueError("the vocabulary has no byte pieces")
        if processor.normalize("  a  b\t\n ") != f"{MARK * 3}a{MARK * 2}b\t\n{MARK}":
            raise ValueError("the vocabulary rewrites its texts")
        if any(MARK in piece.lstrip(MARK) or "\n" in piece for piece in ids):
            raise ValueError("a piece reaches across the cuts")
        #: characters that stand side by side in some piece
        self.neighbours = {pair for piece in ids for pair in zip(piece, piece[1:], strict=False)}
        # a character that is no piece is the symbol behind the last id, by its code
        self.symbol_of = np.arange(self.size, self.size + _CODES, dtype=np.int64)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.symbol_of[ord(piece)] = i
        self._tabulate()

    def _symbol(self, piece: str) -> int | None:
        if len(piece) == 1:
            return int(self.symbol_of[ord(piece)])
        return self.ids.get(piece)

    def _tabulate(self) -> None:
        base = self.size + _CODES
        rows = []
        for piece, i in self.ids.items():
            for at in range(1, len(piece)):
                left, right = self._symbol(piece[:at]), self._symbol(piece[at:])
                if left is not None and right is not None:
                    rows.append((left * base + right, i, self.scores[piece]))
        rows.sort()
        self.base = base
        self.keys = np.array([r[0] for r in rows], np.int64)
        self.merged = np.array([r[1] for r in rows], np.int64)
        self.score = np.array([r[2] for r in rows])

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged id and score of pairs; the score is -inf where they make no piece."""
        keys = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = (self.keys[at] == keys) & (left >= 0) & (right >= 0)
        return self.merged[at], np.where(known, self.score[at], -np.inf)

    def one(self, stretch: str) -> list[int]:
        """A stretch of any length, by a heap of its pairs."""
        n = len(stretch)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        end = list(range(1, n + 1))
        alive = bytearray(b"\1" * n)
        heap: list[tuple[float, int, int]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right < n:
                score = self.scores.get(stretch[left : end[right]])
                if score is not None:
                    heapq.heappush(heap, (-score, left, end[right]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, left, stop = heapq.heappop(heap)
            right = after[left] if alive[left] else n
            if right >= n or end[right] != stop:
                continue
            alive[right] = 0
            end[left], after[left] = stop, after[right]
            if after[left] < n:
                before[after[left]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        found: list[int] = []
        at = 0
        while at < n:
            piece = stretch[at : end[at]]
            found += [self.ids[piece]] if piece in self.ids else self._bytes(piece)
            at = after[at]
        return found

    def _bytes(self, piece: str) -> list[int]:
        return [self.byte_ids[b] for b in piece.encode()]

    def many(self, stretches: list[str]) -> list[list[int]]:
        """Many stretches; those of similar length are merged side by side."""
        found: list = [None] * len(stretches)
        order = sorted(range(len(stretches)), key=lambda i: len(stretches[i]))
        group: list[int] = []
        for i in order:
            if not 0 < len(stretches[i]) <= SIDE_BY_SIDE:
                found[i] = self.one(stretches[i])
                continue
            if group and (len(group) >= 8192 or len(stretches[i]) > len(stretches[group[0]]) + 2):
                self._merge(stretches, group, found)
                group = []
            group.append(i)
        if group:
            self._merge(stretches, group, found)
        return found

    def _merge(self, stretches: list[str], group: list[int], found: list) -> None:
        width = max(len(stretches[i]) for i in group)
        codes = np.frombuffer(
            "".join(stretches[i].ljust(width, "\0") for i in group).encode("utf-32-le"), np.uint32
        ).reshape(len(group), width)
        lengths = np.array([len(stretches[i]) for i in group])
        columns = np.arange(width)
        symbols = np.where(columns < lengths[:, None], self.symbol_of[codes], -1)
        if width > 1:
            merged, scores = self._look_up(symbols[:, :-1], symbols[:, 1:])
        else:
            merged, scores = np.zeros((len(group), 0), np.int64), np.zeros((len(group), 0))
        rows = np.arange(len(group))
        done = np.full((len(group), width), -1)
        while scores.shape[1]:
            best = scores.argmax(axis=1)  # the first of equals, so the leftmost
            at = np.arange(len(rows))
            going = scores[at, best] > -np.inf
            if not going.all():
                done[rows[~going]] = symbols[~going]
                rows, symbols, merged, scores, best = (
                    x[going] for x in (rows, symbols, merged, scores, best)
                )
                if not len(rows):
                    break
                at = np.arange(len(rows))
            symbols[at, best] = merged[at, best]
            # what stands right of the merged pair moves one place to the left
            take = columns + (columns > best[:, None])
            symbols = np.where(
                take < width, np.take_along_axis(symbols, np.minimum(take, width - 1), axis=1), -1
            )
            pairs = width - 1
            take = columns[:-1] + (columns[:-1] > best[:, None])
            short = np.minimum(take, pairs - 1)
            merged = np.take_along_axis(merged, short, axis=1)
            scores = np.where(take < pairs, np.take_along_axis(scores, short, axis=1), -np.inf)
            for place in (best - 1, best):
                mine = at[(place >= 0) & (place < pairs)]
                there = place[mine]
                merged[mine, there], scores[mine, there] = self._look_up(
                    symbols[mine, there], symbols[mine, there + 1]
                )
        else:
            done[rows] = symbols
        for row, i in zip(done.tolist(), group, strict=True):
            ids: list[int] = []
            for symbol in row:
                if symbol < 0:
                    break
                ids += [symbol] if symbol < self.size else self._bytes(chr(symbol - self.size))
            found[i] = ids


class PieceIds:
    """Ids of whole texts, as packed 32-bit numbers; new stretches are checked by the library."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        self.agenda = Agenda(self.processor)
        self._lookup = Lookup(self._encode, self._cut_end)

    def _cut_end(self, piece: str) -> int:
        """Before a last character that never follows the one before it in a piece."""
        return 0 if tuple(piece[-2:]) in self.agenda.neighbours else len(piece) - 1

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.agenda.many([text.replace(" ", MARK) for text in texts])
        # the library puts a mark in front of every text, and nothing merges with a line feed
        asked = [text[1:] if text.startswith(" ") else "\n" + text for text in texts]
        given = self.processor.encode(asked, num_threads=1)
        for text, mine, theirs in zip(texts, found, given, strict=True):
            if mine != (theirs if text.startswith(" ") else theirs[2:]) and text != " ":
                raise RuntimeError(f"the library encodes {text[:80]!r} otherwise")
        return [np.array(ids, np.int32).tobytes() for ids in found]

    def many(self, texts: list[str]) -> list[bytes]:
        marked = [" " + text.replace(MARK, " ") if text else "" for text in texts]
        return self._lookup.many(marked)


@lru_cache(maxsize=4)
def piece_ids(path: str) -> PieceIds:
    return PieceIds(path)


def encode_decode(
    docs: DataFrame,
    model_path: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Columns id, ids (array of int) and decoded (the library's text of the ids)."""
    rows = docs.select(F.col(id_column), F.col(text_column).alias("text"))
    layout = T.StructType([
        rows.schema[id_column],
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.StringType()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = piece_ids(model_path)
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            encoded = encode.many(texts)
            # small slices, as the decoded texts of a slice are held together
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                found = encoded[at : at + 256]
                ids = [np.frombuffer(one, np.int32) for one in found]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(found), np.int32))
                decoded = [encode.processor.decode(one.tolist()) if len(one) else "" for one in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(id_column),
                        pa.ListArray.from_arrays(pa.array(ends), flat),
                        pa.array(decoded, pa.string()),
                    ],
                    names=layout.names,
                )

    return rows.mapInArrow(work, layout)
