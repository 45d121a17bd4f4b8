"""Exact token ids of whole Arrow columns with the ``tokenizers`` library.

Both supplied vocabularies split a text before they merge, and no token crosses a lone blank or
line feed, or the border from an ASCII letter to a full stop or comma. So a text is cut there,
each piece that a worker hasn't met before is encoded once by the library, and the ids are put
together again: the result is that of encoding the whole text, at the cost of the distinct
pieces. Known pieces are looked up by a 64-bit hash; ``CACHED_PIECES`` of them take about 80 MB,
after which a worker starts anew.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa

from gapweave.llm.words import IS_SPACE, span_hashes, text_bytes

CACHED_PIECES = 2_000_000
ONE_WORD = re.compile("( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+)")

IS_LETTER = np.zeros(256, bool)
IS_LETTER[[*range(65, 91), *range(97, 123)]] = True


def cut_places(data: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Where pieces begin."""
    n = len(data)
    begins = np.zeros(n + 1, bool)
    if n > 2:
        blank = IS_SPACE[data] | ((data >= 0x1C) & (data <= 0x1F))
        lone = np.zeros(n, bool)
        lone[1:-1] = blank[1:-1] & ~blank[:-2] & ~blank[2:]
        inner = where[(where > 0) & (where < n)]
        lone[inner] = False
        lone[inner - 1] = False
        feed = lone & (data == 0x0A)
        begins[:-1] = feed | (lone & (data == 0x20))
        begins[1:] |= feed
        begins[1:-1] |= IS_LETTER[data[:-1]] & ((data[1:] == 0x2E) | (data[1:] == 0x2C))
    begins[where[:-1]] = True
    return np.flatnonzero(begins[:n])


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Encoder:
    """Encodes columns; ``lower_words`` for the vocabulary that lower-cases and drops white space."""

    def __init__(self, path: str, lower_words: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.tokenize = self.library.model.tokenize
        self.lower_words = lower_words
        self.letter = byte_letters()
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.flat: list[np.ndarray] = [np.zeros(0, np.uint32)]
        self.ids = 0

    def word(self, text: str) -> list[int] | None:
        """Ids of a single word of Latin letters, which the vocabularies don't split beforehand."""
        found = ONE_WORD.fullmatch(text)
        if not found:
            return None
        if self.lower_words:
            text = found[2].lower()
        letter = self.letter
        return [t.id for t in self.tokenize("".join([letter[b] for b in text.encode()]))]

    def learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        """Encode new pieces; ``hashes`` ascend."""
        if len(self.hashes) + len(hashes) > CACHED_PIECES:
            self.forget()
        found = [self.word(t) for t in texts]
        rest = [i for i, x in enumerate(found) if x is None]
        if rest:
            encoded = self.library.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)
            for i, e in zip(rest, encoded, strict=True):
                found[i] = e.ids
        size = np.fromiter(map(len, found), np.int64, len(found))
        self.flat = [*self.flat, np.fromiter((i for x in found for i in x), np.uint32, int(size.sum()))]
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.begin = np.insert(self.begin, at, self.ids + np.cumsum(size) - size)
        self.size = np.insert(self.size, at, size)
        self.ids += int(size.sum())
        if len(self.flat) > 8:
            self.flat = [np.concatenate(self.flat)]

    def missing(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.arange(len(hashes))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.flatnonzero(self.hashes[at] != hashes)

    def encode(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text followed by ``end_id``, and where each text begins (n + 1 places)."""
        data, where = text_bytes(column)
        starts = cut_places(data, where)
        ends = np.append(starts[1:], len(data))
        rows = np.searchsorted(where, starts, "right") - 1
        ids, lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(starts):
            if self.lower_words:
                starts = starts + ((data[starts] == 0x20) & (ends - starts > 1))
            hashes, first, which = np.unique(
                span_hashes(data, starts, ends), return_index=True, return_inverse=True
            )
            new = self.missing(hashes)
            if len(self.hashes) + len(new) > CACHED_PIECES:
                self.forget()
                new = np.arange(len(hashes))
            if len(new):
                raw = data.tobytes()
                self.learn(
                    hashes[new],
                    [raw[s:e].decode() for s, e in zip(starts[first[new]], ends[first[new]], strict=True)],
                )
            known = np.searchsorted(self.hashes, hashes)[which]
            lengths = self.size[known]
            at = np.cumsum(lengths) - lengths
            flat = self.flat[0] if len(self.flat) == 1 else np.concatenate(self.flat)
            self.flat = [flat]
            ids = flat[np.arange(int(lengths.sum())) + np.repeat(self.begin[known] - at, lengths)]
        ends_at = np.cumsum(np.bincount(rows, lengths, len(where) - 1).astype(np.int64))
        return np.insert(ids, ends_at, np.uint32(end_id)), np.append(0, ends_at + np.arange(1, len(where)))


@lru_cache(maxsize=2)
def encoder(path: str, lower_words: bool) -> Encoder:
    """One encoder for each vocabulary and worker process."""
    return Encoder(path, lower_words)
