"""Texts cut where no token can reach across, so that a piece is encoded once and looked up.

A text is cut before each single space or line feed that stands between two characters that are
not white space. A tokenizer for which such places are always token boundaries gives for the
pieces, one after the other, what it gives for the text. A text that has other white space there
is cut at the safe places only. The table of known pieces is bounded: when it is full, it becomes
the old one, from which pieces come back as they are met again, and the one before is dropped.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# pieces in the present table of a process, and at most as many in the old one
KNOWN = 200_000
# characters of texts that are looked up together, so that what is new is encoded in one go
TOGETHER = 4 << 20
# longer pieces are rare and are not remembered
LONG = 64
# characters of a very long text that are cut at once
PART = 1 << 20

_SAFE = re.compile(r"(?<=\S)(?=[ \n]\S)")
# what may be the last character of a piece behind which is no safe place; none at all is one, too
_WHITE = pa.array(["", *(chr(i) for i in range(0x3001) if chr(i).isspace())], pa.large_string())


def parts(text: str, size: int = PART) -> Iterator[str]:
    """The text in order, in parts of about `size` characters that begin at safe places."""
    start = 0
    while len(text) - start > size:
        found = _SAFE.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


class Lookup:
    """Packed 32-bit ids of texts. `encode` maps many pieces at once; `cut_end` may say where a new
    piece can be cut again. `encode_run` may do better for pieces that could follow one another in a
    text: each begins with its space or line feed and ends with what is not white space.

    The pieces of many texts are cut and told apart by Arrow, so only distinct ones are looked up one
    by one; numpy gathers their ids in the order of the texts.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], list[bytes]],
        cut_end: Callable[[str], int] | None = None,
        known: int = KNOWN,
        encode_run: Callable[[list[str]], list[bytes]] | None = None,
    ) -> None:
        self._encode, self._cut_end, self._limit = encode, cut_end, known
        self._encode_run = encode_run or encode
        self._known: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        found: list[list[bytes]] = [[] for _ in texts]
        owners: list[int] = []
        group: list[str] = []
        size = 0
        for i, text in enumerate(texts):
            for part in parts(text):
                if size > TOGETHER:
                    self._add(group, owners, found)
                    owners, group, size = [], [], 0
                if part:
                    owners.append(i)
                    group.append(part)
                    size += len(part)
        if group:
            self._add(group, owners, found)
        return [values[0] if len(values) == 1 else b"".join(values) for values in found]

    def _add(self, group: list[str], owners: list[int], found: list[list[bytes]]) -> None:
        # a piece stands in the table without its space; one after a line feed keeps that
        cut = pc.split_pattern(pc.replace_substring(pa.array(group, pa.large_string()), "\n", " \n"), " ")
        begin, end = cut.offsets.to_numpy()[:-1], cut.offsets.to_numpy()[1:]
        told_apart = cut.values.dictionary_encode()
        codes, pieces = told_apart.indices.to_numpy().astype(np.int64), told_apart.dictionary
        last = pc.utf8_slice_codeunits(pieces, -1)
        white = pc.is_in(last, value_set=_WHITE).to_numpy(zero_copy_only=False)
        # a part that begins with its space or line feed has an empty head, which is safe there; any
        # other head has no space before it, and a value of its own
        lone = (pc.binary_length(pieces).to_numpy() == 0)[codes[begin]] & (end - begin > 1)
        heads, head_of = np.unique(codes[begin[~lone]], return_inverse=True)
        # the place behind a piece is safe if the piece ends with what is not white space
        unsafe = white[codes]
        unsafe[end - 1] = False
        unsafe[begin[lone]] = False
        slow = np.add.reduceat(unsafe, begin) > 0
        inner = np.ones(len(codes), bool)
        inner[begin] = False
        used = np.zeros(len(pieces), bool)
        used[codes[inner]] = True
        if len(self._known) > self._limit:
            self._old, self._known = self._known, {}
        known = self._known
        wanted = _strings(pieces.filter(pa.array(used)))
        odd = set(_strings(pieces.filter(pa.array(used & white))))
        new = set(wanted).difference(known)
        self._learn(new.difference(odd))
        known.update((p, value) for p, value in zip(odd, self._encode([_spaced(p) for p in odd]), strict=True))
        values = list(map(known.__getitem__, wanted))
        for piece in odd | {p for p in new if len(p) > LONG}:
            del known[piece]
        values += self._encode(_strings(pieces.take(pa.array(heads))))
        values.append(b"")
        codes = (np.cumsum(used) - 1)[codes]
        codes[begin[~lone]] = len(wanted) + head_of
        codes[begin[lone]] = len(values) - 1
        ids = np.frombuffer(b"".join(values), np.uint32)
        lengths = np.fromiter(map(len, values), np.int64, len(values)) // 4
        starts = np.cumsum(lengths) - lengths
        n = lengths[codes]
        ahead = np.cumsum(n) - n
        flat = ids[np.repeat(starts[codes] - ahead, n) + np.arange(n.sum())]
        bounds = np.append(ahead[begin], len(flat)).tolist()
        for i, part, low, high, again in zip(owners, group, bounds, bounds[1:], slow.tolist(), strict=False):
            if again:
                found[i] += self._encode(_SAFE.split(part))
            else:
                found[i].append(flat[low:high].tobytes())

    def _learn(self, new: set[str]) -> None:
        """Pieces that end with what is not white space."""
        known, old = self._known, self._old
        met = new.intersection(old)
        known.update((piece, old[piece]) for piece in met)
        new = new.difference(met)
        ends = {}
        if self._cut_end is not None:
            ends = {p: at for p in new if 0 < (at := self._cut_end(p)) < len(p)}
        heads = {piece[:at] for piece, at in ends.items()}
        whole = list(new.difference(ends) | heads.difference(known))
        known.update(zip(whole, self._encode_run([_spaced(piece) for piece in whole]), strict=True))
        if ends:
            tails = list({piece[at:] for piece, at in ends.items()})
            tail_values = dict(zip(tails, self._encode(tails), strict=True))
            for piece, at in ends.items():
                known[piece] = known[piece[:at]] + tail_values[piece[at:]]


def _strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()  # many times as fast as to_pylist


def _spaced(piece: str) -> str:
    return piece if piece[:1] == "\n" else " " + piece
