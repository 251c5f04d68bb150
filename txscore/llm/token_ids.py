"""Token ids of whole texts by a byte-level vocabulary of the tokenizers library, as packed bytes."""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

import numpy as np

from txscore.llm.chunks import Lookup

RUN = 500  # pieces that are encoded as one text


def _cut_end(piece: str) -> int:
    """Before a last full stop or comma that follows a letter: letters never share its token."""
    return len(piece) - 1 if piece[-1:] in (".", ",") and piece[-2:-1].isalpha() else 0


class TokenIds:
    def __init__(self, path: str, *, plain_specials: bool = False) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # with it, the strings of special tokens are ordinary text
        self.tokenizer.encode_special_tokens = plain_specials
        self._lookup = Lookup(self._encode, _cut_end, encode_run=self._encode_run)
        vocabulary = self.tokenizer.get_vocab()
        # a character of a byte-level token stands for one byte
        self._bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self._bytes[list(vocabulary.values())] = list(map(len, vocabulary))

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [array("I", one.ids).tobytes() for one in found]

    def _encode_run(self, pieces: list[str]) -> list[bytes]:
        """Many pieces as one text, and its ids dealt out to them by their bytes."""
        texts = ["".join(pieces[i : i + RUN]) for i in range(0, len(pieces), RUN)]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(one.ids, np.uint32) for one in found] or [np.zeros(0, np.uint32)])
        reached = np.append(0, np.cumsum(self._bytes[ids]))
        sizes = np.fromiter((len(piece.encode()) for piece in pieces), np.int64, len(pieces))
        wanted = np.append(0, np.cumsum(sizes))
        at = np.searchsorted(reached, wanted)
        if reached[-1] != wanted[-1] or not np.array_equal(reached[at], wanted):
            raise RuntimeError("a token reaches across two pieces")
        data = ids.tobytes()
        bounds = (4 * at).tolist()
        return [data[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as unsigned 32-bit numbers in the machine's order."""
        return self._lookup.many(texts)


@lru_cache(maxsize=4)
def token_ids(path: str, *, plain_specials: bool = False) -> TokenIds:
    """One per Python process, as a table of known pieces pays over many batches."""
    return TokenIds(path, plain_specials=plain_specials)
