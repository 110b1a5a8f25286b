"""Words of whole texts, found and hashed column-wise on Arrow buffers.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D of the UTF-8 text, which is the pattern
``[^\\x20\\x09-\\x0D]+``. Everything here works on slices of a batch, so memory follows the slice, not the partition.

Hashes are polynomials over bytes or over word hashes, by prefix sums. ``FAST`` ones are modulo 2**64: cheap, but there
are texts (Thue-Morse words) that collide whatever the base, so they only filter. Where a hash decides that texts are equal,
it is a ``SOUND`` one, modulo the prime 2**61 - 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
FAST, SOUND = 0, 1

_U = np.uint64
_BASE = 0x9E3779B97F4A7C17


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = mix(np.arange(256, dtype=_U) + _U(_BASE)) | _U(1)

_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept up to the longest slice seen, 16 MB at most."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        have = np.full(size, _U(base))
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 1 << 21:
            _POWERS[base] = have
    return have[:n]


def rolling(values: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int) -> np.ndarray:
    """64-bit hashes of values[start:end] for many ranges at once."""
    return prime_rolling(values, start, end) if lane == SOUND else fast_rolling(values, start, end)


def fast_rolling(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    n = len(values)
    prefix = np.zeros(n + 1, dtype=_U)
    np.cumsum(values * powers(_BASE, n), out=prefix[1:])
    return mix((prefix[end] - prefix[start]) * powers(_INVERSE, n + 1)[start] + (end - start).astype(_U))


PRIME = (1 << 61) - 1
_P, _LOW30, _LOW31 = _U(PRIME), _U((1 << 30) - 1), _U((1 << 31) - 1)
_BASE61 = 0x1B2E5C4F39A7D613 % PRIME
_STEP = 1 << 15


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2**61 - 1, of numbers below it, by halves of 31 bits."""
    a1, a0, b1, b0 = a >> _U(31), a & _LOW31, b >> _U(31), b & _LOW31
    mid = a1 * b0 + a0 * b1
    r = (a1 * b1 << _U(1)) + (mid >> _U(30)) + ((mid & _LOW30) << _U(31)) + a0 * b0
    return reduced(r)


def reduced(r: np.ndarray) -> np.ndarray:
    r = (r & _P) + (r >> _U(61))
    return np.where(r >= _P, r - _P, r)


_PRIME_POWERS: dict[int, np.ndarray] = {}


def prime_powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo the prime, by doubling; kept like ``powers``."""
    have = _PRIME_POWERS.get(base)
    if have is None or len(have) < n:
        have = np.ones(1, dtype=_U)
        while len(have) < max(n, 4096):
            have = np.concatenate([have, times(have, _U(pow(base, len(have), PRIME)))])
        if len(have) <= 1 << 21:
            _PRIME_POWERS[base] = have
    return have[:n]


def prime_rolling(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """As ``fast_rolling`` modulo the prime; products are made in steps that stay in the processor's cache."""
    n = len(values)
    p = prime_powers(_BASE61, n)
    low, high = np.zeros(n + 1, dtype=_U), np.zeros(n + 1, dtype=_U)
    for at in range(0, n, _STEP):
        x = times(reduced(values[at : at + _STEP].astype(_U)), p[at : at + _STEP])
        low[at + 1 : at + 1 + len(x)], high[at + 1 : at + 1 + len(x)] = x & _LOW31, x >> _U(31)
    # sums of halves of 31 bits: no overflow below 2**33 values
    np.cumsum(low, out=low)
    np.cumsum(high, out=high)
    out = np.empty(len(start), dtype=_U)
    inverse = prime_powers(pow(_BASE61, -1, PRIME), n + 1)
    for at in range(0, len(start), _STEP):
        s, e = start[at : at + _STEP], end[at : at + _STEP]
        total = reduced(times(reduced(high[e] - high[s]), _U(1 << 31)) + reduced(low[e] - low[s]))
        out[at : at + _STEP] = mix(times(total, inverse[s]) + ((e - s).astype(_U) << _U(61)))
    return out


class Words:
    """Words of a slice of texts: byte ranges, the text each belongs to, and hashes.

    ``first[i]:first[i+1]`` are the words of text i.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        offsets, self.data = buffers(texts)
        data = self.data
        if lower:
            data = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
            self.data = data
        self.offsets = offsets
        space = (data == 32) | ((data >= 9) & (data <= 13))
        self.space = space
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        word = ~space
        opens = word.copy()
        opens[1:] &= space[:-1] | edge[1:-1]
        closes = word.copy()
        closes[:-1] &= space[1:] | edge[1:-1]
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def hashes(self, lane: int = SOUND) -> np.ndarray:
        """Hashes of all words; under one lane, unlike words of a corpus differ but for a chance of about 2**-61."""
        return rolling(_BYTES[self.data], self.start, self.end, lane)

    def windows(self, size: int) -> np.ndarray:
        """First words of all runs of ``size`` words inside one text."""
        left = np.repeat(self.first[1:], self.count) - np.arange(len(self.start))
        return np.flatnonzero(left >= size)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (from 0) and bytes of a string array; nulls count as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    _, raw, data = texts.buffers()
    offsets = np.frombuffer(raw, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return offsets - offsets[0], whole[offsets[0] : offsets[-1]]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch where its texts pass ``limit`` bytes; a longer text is a slice of its own, never cut."""
    offsets, _ = buffers(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(n, max(at + 1, to))
        yield batch.slice(at, to - at)
        at = to


def runs_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values[offsets[i]:offsets[i+1]] for every i."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
