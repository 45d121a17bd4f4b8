"""A minimal perfect hash table over 64-bit keys, built and read with numpy.

Keys are placed level by level: at each level a key goes to one bit of an array about twice as
long as the keys left; a bit that only one key wants is that key's, the others go on. The slot of
a key is the rank of its bit. Keys that even the last level can't part (equal 64-bit hashes) are
kept in a list beside the table. A stored fingerprint tells foreign keys.
"""

from __future__ import annotations

import io

import numpy as np

from gapweave.llm.words import mix

LEVELS = 40
BLOCK = 64


def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys + np.uint64((level * 0x9E3779B97F4A7C15) % (1 << 64))) % np.uint64(size)).astype(np.int64)


def build(keys: np.ndarray, prints: np.ndarray, values: np.ndarray) -> bytes:
    """The table as bytes; ``values`` is (n, columns) of int64."""
    sizes, words, slots = [], [], np.full(len(keys), -1, np.int64)
    left, placed = np.arange(len(keys)), 0
    for level in range(LEVELS):
        if not len(left):
            break
        size = -(-2 * len(left) // BLOCK) * BLOCK
        at = place(keys[left], level, size)
        bits = np.bincount(at, minlength=size) == 1
        alone = bits[at]
        slots[left[alone]] = placed + (np.cumsum(bits) - 1)[at[alone]]
        placed += int(bits.sum())
        sizes.append(size)
        words.append(np.packbits(bits, bitorder="little").view(np.uint64))
        left = left[~alone]
    bitmap = np.concatenate(words) if words else np.zeros(0, np.uint64)
    ranks = np.cumsum(np.bitwise_count(bitmap), dtype=np.int64) - np.bitwise_count(bitmap)
    order = np.empty(placed, np.int64)
    inside = slots >= 0
    order[slots[inside]] = np.flatnonzero(inside)
    out = io.BytesIO()
    np.savez(
        out,
        sizes=np.array(sizes, np.int64),
        bitmap=bitmap,
        ranks=ranks,
        prints=prints[order],
        values=values[order],
        odd_keys=keys[left],
        odd_prints=prints[left],
        odd_values=values[left],
    )
    return out.getvalue()


class Table:
    """A built table; looking up a key takes the same few steps whatever the table's size."""

    def __init__(self, raw: bytes):
        self.__dict__.update(np.load(io.BytesIO(raw)))

    def find(self, keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the keys, and which of the keys are in the table."""
        out = np.zeros((len(keys), self.values.shape[1]), np.int64)
        found = np.zeros(len(keys), bool)
        left, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = place(keys[left], level, int(size)) + base
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.bitmap[word] >> bit) & np.uint64(1) == 1
            below = self.bitmap[word] & ((np.uint64(1) << bit) - np.uint64(1))
            slot = (self.ranks[word] + np.bitwise_count(below))[hit]
            same = self.prints[slot] == prints[left[hit]]
            out[left[hit][same]] = self.values[slot[same]]
            found[left[hit][same]] = True
            left, base = left[~hit], base + int(size)
        for key, fingerprint, value in zip(self.odd_keys, self.odd_prints, self.odd_values, strict=True):
            same = (keys == key) & (prints == fingerprint)
            out[same], found[same] = value, True
        return out, found
