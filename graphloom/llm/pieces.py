"""Splitting texts into the pieces that byte-level BPE encodes one by one.

The published pattern of the vocabulary is applied to all rows of a chunk at
once: every boundary depends on the classes of neighbouring characters only.
"""

from __future__ import annotations

import struct
import unicodedata
from collections.abc import Callable

import numpy as np

from graphloom.llm.texts import Hasher

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: The characters with the Unicode property White_Space.
WHITE_SPACE = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: What the pattern splits off after an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

_CLASSES: list[np.ndarray] = []


def classes() -> np.ndarray:
    if not _CLASSES:
        kind = {"L": LETTER, "N": NUMBER}
        table = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
        table[list(WHITE_SPACE)] = SPACE
        _CLASSES.append(table)
    return _CLASSES[0]


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts of all pieces, and the index of each row's first piece."""
    n_bytes = len(data)
    if not n_bytes:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    char = np.flatnonzero((data & 0xC0) != 0x80)
    if len(char) == n_bytes:
        code = data.astype(np.uint32)
    else:
        code = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    kind = classes()[code]
    n = len(code)
    row_start = np.zeros(n + 1, bool)
    row_start[np.searchsorted(char, offsets)] = True
    row_start[n] = True
    start = row_start[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # the last of a run of spaces stands alone, or joins what follows it if it is a blank
    after = np.flatnonzero(start[1:] & (kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~row_start[1:n]) + 1
    start[after - 1] = True
    start[after[code[after - 1] == 32]] = False
    quote = np.flatnonzero((code == 39) & start)
    if len(quote):
        padded = np.concatenate([code, np.zeros(3, np.uint32)])
        edge = np.concatenate([row_start, np.ones(2, bool)])
        for ending in ENDINGS:
            hit = quote[~edge[quote + 1]]
            for k, letter in enumerate(ending):
                hit = hit[padded[hit + 1 + k] == ord(letter)]
            if len(ending) == 2:
                hit = hit[~edge[hit + 2]]
            start[hit + 1] = False
            follow = hit + 1 + len(ending)
            start[follow[follow < n]] = True
    starts = char[start]
    return starts, np.searchsorted(starts, offsets)


class PieceEncoder:
    """Encodes chunks of rows; each distinct piece goes through ``encode`` once
    while the bounded memo holds it.  The memo has two generations: pieces that
    are met again move to the younger, and the older is dropped as a whole."""

    def __init__(self, encode: Callable[[bytes], list[int]], most: int = 200_000):
        self.encode, self.most, self.memo, self.old = encode, most, {}, {}

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows (uint32) and the offsets of the rows in them."""
        starts, first = split(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        ends = np.append(starts[1:], len(data))
        keys, at, back = np.unique(Hasher(data)(starts, ends), return_index=True, return_inverse=True)
        if len(self.memo) > self.most:
            self.memo, self.old = {}, self.memo
        memo, old = self.memo, self.old
        packed = list(map(memo.get, keys.tolist()))
        raw = data.tobytes()
        missing = [i for i, x in enumerate(packed) if x is None]
        if missing:
            where = at[missing]
            for i, key, a, b in zip(missing, keys[missing].tolist(), starts[where].tolist(), ends[where].tolist()):
                known = old.get(key)
                if known is None:
                    ids = self.encode(raw[a:b])
                    known = struct.pack(f"<{len(ids)}I", *ids)
                packed[i] = memo[key] = known
        flat = np.frombuffer(b"".join(packed), "<u4")
        size = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        base = np.cumsum(size) - size
        back = back.reshape(-1)
        count = size[back]
        until = np.cumsum(count)
        ids = flat[np.arange(until[-1]) + np.repeat(base[back] - until + count, count)]
        return ids, np.concatenate([[0], until])[first]
