"""Words of whole text columns as hashed arrays, without a Python loop over words.

A word is a maximal run of bytes other than space and ``\\x09``-``\\x0d``; A-Z are lower-cased first
where asked.  Its hash is the sum of random byte values times random odd numbers of their places, taken
as a difference of running sums, then mixed by a bijection.  The places' numbers are no powers of a base:
long words in the order of Thue and Morse would collide under any base modulo 2**64.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
CHUNK = 1 << 18
_SHIFT = np.uint64(31)
_PLACES = _RNG.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MARKS = _SPACE.copy()  # white space, ASCII punctuation and control characters
_MARKS[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
_VISIBLE = np.arange(256) > 0x20
_VISIBLE[[0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_KIND = np.zeros(256, np.uint8)  # 1 letters, 2 digits, 3 other visible characters of ASCII, 0 the rest
_KIND[0x21:0x7F] = 3
_KIND[0x30:0x3A] = 2
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_ODD = [np.empty(0, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, kept between calls."""
    if len(_POWERS[0]) < n:
        n += n >> 2
        for i, base in enumerate((_BASE, _INVERSE)):
            grown = np.full(n, base, np.uint64)
            grown[0] = 1
            _POWERS[i] = np.multiply.accumulate(grown)
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> _SHIFT)
        x = x * np.uint64(0x7FB5D329728EA185)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x81DADEF4BC2DD44D)
        return x ^ (x >> np.uint64(33))


@dataclass
class Words:
    """The words of some texts: ``hashes`` of all words in order, text i has first[i]:first[i+1]."""

    hashes: np.ndarray
    first: np.ndarray
    data: np.ndarray  # bytes of the texts, one after the other
    start: np.ndarray  # of each word in data
    end: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the bounds of each text; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    low, high = int(bounds[0]), int(bounds[-1])
    raw = np.frombuffer(data, np.uint8, high - low, low) if high > low else np.empty(0, np.uint8)
    return raw, bounds - low


def _odd_numbers(n: int) -> np.ndarray:
    """At least n fixed random odd numbers, kept between calls; the i-th is the same however many are asked for."""
    if len(_ODD[0]) < n:
        with np.errstate(over="ignore"):
            _ODD[0] = mix(np.arange(1, n + (n >> 2) + 64, dtype=np.uint64) * _BASE) | np.uint64(1)
    return _ODD[0]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of each run of bytes data[start:end]; the runs ascend and don't overlap.

    Made for about ``CHUNK`` bytes at a time, so it takes little memory.
    """
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        upto = max(at + 1, int(np.searchsorted(start, start[at] + CHUNK)))
        low, high = int(start[at]), int(end[upto - 1])
        size = end[at:upto] - start[at:upto]
        # Where each byte stands in its run; bytes between runs count on from the run before.
        gaps = np.append(start[at + 1 : upto], high) - start[at:upto]
        longest = int(size.max())
        place = np.minimum(np.arange(high - low) - np.repeat(start[at:upto] - low, gaps), longest)
        odd = _odd_numbers(longest + 1)
        total = np.zeros(high - low + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(_BYTE[data[low:high]] * odd[place], out=total[1:])
            out[at:upto] = mix(total[end[at:upto] - low] - total[start[at:upto] - low] + size.astype(np.uint64))
        at = upto
    return out


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of each short run of bytes data[start:end], such as the n-grams of a word, which may overlap.

    Starts and ends ascend.  A polynomial over random byte values modulo 2**64 as a difference of running
    sums, made for about ``CHUNK`` bytes at a time.
    """
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        upto = max(at + 1, int(np.searchsorted(start, start[at] + CHUNK)))
        low, high = int(start[at]), int(end[upto - 1])
        up, down = _powers(high - low + 1)
        total = np.zeros(high - low + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(_BYTE[data[low:high]] * up[: high - low], out=total[1:])
            found = (total[end[at:upto] - low] - total[start[at:upto] - low]) * down[start[at:upto] - low]
        out[at:upto] = mix(found)
        at = upto
    return out


def runs(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[k], start[k] + 1, ... (count[k] numbers) for each k, one after the other."""
    total = np.concatenate([[0], np.cumsum(count)])
    return np.repeat(start - total[:-1], count) + np.arange(total[-1])


def spaced_pieces(column: pa.Array | pa.ChunkedArray, spaces_together: bool = False) -> Words:
    """Every text cut before each space or line end that a visible character follows.

    Nothing is dropped.  No cut is made before the first bytes of characters that may be white space
    beyond ASCII, nor, with ``spaces_together``, after a space.
    """
    raw, bounds = text_bytes(column)
    n = len(raw)
    if not n:
        none = np.empty(0, np.int64)
        return Words(np.empty(0, np.uint64), np.zeros(len(bounds), np.int64), raw, none, none)
    begins = np.zeros(n, bool)
    begins[:-1] = ((raw[:-1] == 0x20) | (raw[:-1] == 0x0A)) & _VISIBLE[raw[1:]]
    if spaces_together:
        begins[1:] &= raw[:-1] != 0x20
    filled = bounds[:-1] < bounds[1:]
    begins[bounds[1:][filled] - 1] = False  # what follows is another text
    begins[bounds[:-1][filled]] = True
    start = np.flatnonzero(begins)
    end = np.append(start[1:], n)
    return Words(word_hashes(raw, start, end), np.searchsorted(start, bounds), raw, start, end)


def words_of(column: pa.Array | pa.ChunkedArray, lower: bool = True, marks: bool = True) -> Words:
    """The hashed words of every text of a column; without ``marks``, punctuation parts words too."""
    raw, bounds = text_bytes(column)
    n = len(raw)
    if not n:
        none = np.empty(0, np.int64)
        return Words(np.empty(0, np.uint64), np.zeros(len(bounds), np.int64), raw, none, none)
    data = _LOWER[raw] if lower else raw
    word = ~(_SPACE if marks else _MARKS)[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    cuts = bounds[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    begins[cuts] = word[cuts]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    ends[cuts - 1] = word[cuts - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    hashes = word_hashes(data, start, end)
    first = np.searchsorted(start, bounds)
    return Words(hashes, first, data, start, end)


def parted_words(column: pa.Array | pa.ChunkedArray) -> Words:
    """The words of every text, cut further between letters, digits and visible ASCII marks that stand side by side.

    Letters are those of ASCII and Latin-1.  No cut is made beside another character, nor between an
    apostrophe and a letter.  A-Z before ASCII are lower-cased in ``data``; a mark beyond ASCII may
    join the letter before it, and not every pair has both cases.
    """
    raw, bounds = text_bytes(column)
    n = len(raw)
    if not n:
        none = np.empty(0, np.int64)
        return Words(np.empty(0, np.uint64), np.zeros(len(bounds), np.int64), raw, none, none)
    kind = _KIND[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]  # signs of times and division
    kind[lead] = kind[lead + 1] = 1
    word = ~_SPACE[raw]
    cut = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0) & ~((raw[:-1] == 0x27) & (kind[1:] == 1))
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1] | cut
    ends[:-1] &= ~word[1:] | cut
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    begins[inner], ends[inner - 1] = word[inner], word[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    data = _LOWER[raw]
    if len(odd := np.flatnonzero(raw[1:] >= 0x80)):
        data[odd] = raw[odd]
    return Words(word_hashes(data, start, end), np.searchsorted(start, bounds), data, start, end)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of every run of ``size`` words, or of all words as one if there are fewer."""
    n = len(words)
    if not n:
        return words
    width = min(size, n)
    with np.errstate(over="ignore"):
        total = words[: n - width + 1] * _PLACES[0]
        for i in range(1, width):
            total = total + words[i : n - width + 1 + i] * _PLACES[i]
        return mix(total + np.uint64(width))


def give_back() -> None:
    """Give this process's free memory back to the system, where its C library can.

    A Python worker lives on after its task, beside all that its executor does next.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim is not None:
        trim(0)


def in_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text, so that memory stays bounded; then free memory goes back."""
    for batch in batches:
        at, sizes = 0, None
        col = batch.column(column)
        if col.nbytes <= limit:
            if batch.num_rows:
                yield batch
            continue
        sizes = np.diff(text_bytes(col)[1])
        total = np.cumsum(sizes)
        while at < batch.num_rows:
            base = total[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(total, base + limit, "right")))
            yield batch.slice(at, upto - at)
            at = upto
    batch = col = sizes = total = None
    give_back()
