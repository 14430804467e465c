"""Words of many texts at once: runs of ASCII letters and digits and of all non-ASCII characters.

Texts are bytes of an Arrow column. A table folds A-Z to a-z and everything that is no part of a
word to zero, so that words are found, hashed and compared in numpy without a loop over texts.
Byte offsets are as good as characters here: a byte of 0x80 or more always belongs to a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from nextpick.llm.common import utf8

PIECE = 4 << 20  # bytes of text that are looked at together; a longer text is a piece of its own
BLOCK = 1 << 18
_BASE, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # any odd numbers will do

_FOLD = np.zeros(256, np.uint8)
for _low, _high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    _FOLD[_low:_high + 1] = np.arange(_low, _high + 1)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


@dataclass
class Words:
    """Words of `rows` texts: `folded` bytes, each word's start, end and text number, texts' starts."""

    folded: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    rows: int
    origin: np.ndarray

    def per_row(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows).astype(np.int64)

    def join(self, first: int, last: int) -> bytes:
        """Words `first` to `last`, without it, of one text, joined by single spaces."""
        piece = self.folded[self.start[first]:self.end[last - 1]].tobytes()
        return b" ".join(w for w in piece.split(b"\0") if w)


def words_of(column: pa.Array) -> Words:
    """Words of an Arrow string column; null is empty text."""
    raw, starts, ends = utf8(column)
    low, high = (int(starts[0]), int(ends.max())) if len(starts) else (0, 0)
    folded, starts, ends = _FOLD[raw[low:high]], starts - low, ends - low
    for i in np.flatnonzero(ends[:-1] < starts[1:]):  # bytes under a null belong to no text
        folded[ends[i]:starts[i + 1]] = 0
    inside = folded != 0
    edge = starts[starts < len(folded)]
    before = np.zeros(len(folded), bool)
    before[1:] = inside[:-1]
    before[edge] = False
    after = np.zeros(len(folded), bool)
    after[:-1] = inside[1:]
    after[edge[edge > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(starts, start, side="right") - 1
    return Words(folded, start, end, row, len(column), starts)


def pieces(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about PIECE bytes of text together, a single row at least."""
    sizes = batch.column(text).cast(pa.large_binary())
    at = np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset:sizes.offset + len(sizes) + 1]
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + PIECE, side="right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def _powers(base: int, count: int) -> np.ndarray:
    made = np.full(count, base, np.uint64)
    made[:1] = 1
    return np.cumprod(made, dtype=np.uint64)


def _range_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial of ``values[start:end]`` modulo 2**64 for each range, by prefix sums in blocks.

    Starts and ends ascend. A range may span blocks: only the sums at its two ends are kept.
    """
    up, down = _powers(_BASE, BLOCK), _powers(pow(_BASE, -1, 1 << 64), BLOCK)
    at_start, at_end, back = (np.zeros(len(start), np.uint64) for _ in range(3))
    carry, mask = 0, (1 << 64) - 1
    for low in range(0, len(values) + 1, BLOCK):
        block = values[low:low + BLOCK].astype(np.uint64)
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(block * up[:len(block)], dtype=np.uint64, out=sums[1:])
        lift, lower = pow(_BASE, low, 1 << 64), pow(_BASE, -low, 1 << 64)
        sums = sums * np.uint64(lift) + np.uint64(carry)
        a, b = np.searchsorted(start, [low, low + BLOCK])
        at_start[a:b] = sums[start[a:b] - low]
        back[a:b] = down[start[a:b] - low] * np.uint64(lower)
        a, b = np.searchsorted(end, [low, low + BLOCK])
        at_end[a:b] = sums[end[a:b] - low]
        carry = int(sums[-1]) & mask
    return (at_end - at_start) * back


def word_hashes(words: Words) -> np.ndarray:
    """64-bit hash of each word; equal words have equal hashes, different ones nearly always others."""
    made = _range_hashes(words.folded, words.start, words.end)
    made ^= made >> np.uint64(29)
    made *= np.uint64(_MIX)
    return made ^ (made >> np.uint64(32))


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` words from each word on, as far as the words go."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    start = np.arange(count)
    made = _range_hashes(hashes, start, start + length)
    return made ^ (made >> np.uint64(31))


def same_words(words: Words, which: np.ndarray, text: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether each word of `which` equals ``text[start:start + length]`` of its own row, byte for byte."""
    same = words.end[which] - words.start[which] == length
    left = np.flatnonzero(same)
    if len(left):
        size = length[left]
        ends = np.cumsum(size)
        step = np.arange(ends[-1]) - np.repeat(ends - size, size)
        differs = (words.folded[np.repeat(words.start[which[left]], size) + step]
                   != text[np.repeat(start[left], size) + step])
        same[left[np.unique(np.repeat(np.arange(len(left)), size)[differs])]] = False
    return same
