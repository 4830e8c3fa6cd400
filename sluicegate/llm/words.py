"""Words of whole texts as numpy arrays: where they stand and a 64-bit name for each.

A word is a maximal run of bytes other than space and 0x09-0x0D. All functions work on one
Arrow batch of texts at a time, on its UTF-8 buffer, without making a Python string per word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: The same words for the SQL side.
WORD = "[^\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\x0c\r"

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPAN = 256
_PLACE = _random.integers(1, 2**63, _SPAN, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLOCK = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit number over all bits (one-to-one)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of a batch of texts; word j of text i is at bounds[i] + j."""

    data: np.ndarray  # bytes of all texts of the batch
    start: np.ndarray  # first byte of each word in data
    end: np.ndarray  # byte after each word
    name: np.ndarray  # 64-bit name of each word
    bounds: np.ndarray  # words before text i; one more entry than texts
    offsets: np.ndarray  # bytes before text i

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.bounds))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow text column; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return flat, offsets - offsets[0]


def find_words(texts: pa.Array, lower: bool = False) -> Words:
    """All words of a batch of texts; with ``lower``, A-Z count as a-z."""
    data, offsets = text_bytes(texts)
    if lower:
        data = _LOWER[data]
    inside = ~_IS_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] = inside[begins]  # a word ends where its text ends
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] = inside[ends]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(data, start, end, names(data, start, end), np.searchsorted(start, offsets), offsets)


def names(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit name of each byte range [start, end), the same wherever the same bytes stand.

    The ranges are in order and do not overlap. Each byte is mapped to a random number, times
    a random factor of its place, summed and mixed: a multilinear hash.
    """
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    total = np.zeros(len(start), np.uint64)
    step = 1 << 22  # bytes at once
    cut = 0
    while cut < len(start):
        stop = max(cut + 1, int(np.searchsorted(end, start[cut] + step)))
        n = length[cut:stop]
        where = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(where, n)
        value = _BYTE[data[place + np.repeat(start[cut:stop], n)]]
        if place.size and int(n.max()) > _SPAN:
            value = value * (_PLACE[place % _SPAN] + _BLOCK * (place // _SPAN * 2).astype(np.uint64))
        else:
            value = value * _PLACE[place]
        total[cut:stop] = np.add.reduceat(value, where)
        cut = stop
    return mix(total + length.astype(np.uint64) * _BLOCK)


def window_names(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of all runs of ``size`` words inside one text: (first word of each run, name)."""
    count = len(words.name) - size + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = run_names(words.name, np.arange(count), size)
    room = np.diff(words.bounds)
    left = np.repeat(words.bounds[1:], room) - np.arange(len(words.name))  # words from here to the text's end
    inside = np.flatnonzero(left[:count] >= size)
    return inside, total[inside]


def run_names(name: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Names of the runs of ``size`` names that begin at ``first``."""
    total = np.zeros(len(first), np.uint64)
    for k in range(size):
        total += mix(name[first + k] + _PLACE[k % _SPAN]) * _PLACE[(k * 7 + 3) % _SPAN]
    return mix(total + np.uint64(size))
