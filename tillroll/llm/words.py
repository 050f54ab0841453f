"""64-bit hashes of the words of many texts at once, with numpy.

Two different words get the same hash with a chance of about 2**-64, so
sequences and sets of words can be compared by their hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tillroll.llm.tokens import unsliced

#: Bytes hashed at once; about 40 bytes of memory each.
AT_ONCE = 1 << 20
_POSITIONS = 1 << 12

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(0, 1 << 64, 256, dtype="u8")
_BYTE[65:91] = _BYTE[97:123]                      # A-Z count as a-z
_PLACE = _rng.integers(0, 1 << 64, _POSITIONS, dtype="u8") | np.uint64(1)
_ODD = _rng.integers(0, 1 << 64, 64, dtype="u8") | np.uint64(1)

#: Separators: the six ASCII white space characters.
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
#: Separators: every ASCII character but letters and digits.
MARKS = np.ones(256, bool)
MARKS[48:58] = MARKS[65:91] = MARKS[97:123] = MARKS[128:] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words data[begin:end]; begin is ascending."""
    size = end - begin
    where = np.arange(size.sum(), dtype="i4")
    place = where - np.repeat(np.cumsum(size) - size, size).astype("i4")
    byte = data[where + np.repeat(begin - (np.cumsum(size) - size), size)]
    weight = _PLACE[place & (_POSITIONS - 1)]
    if len(size) and size.max() > _POSITIONS:
        weight = weight + (place // _POSITIONS).astype("u8") * _ODD[0]
    total = np.add.reduceat(_BYTE[byte] * weight, np.cumsum(size) - size)
    return mix(total + size.astype("u8") * _ODD[1])


def word_hashes(texts: pa.Array, separators: np.ndarray = SPACES):
    """(hashes, starts, begins): text i has words starts[i]:starts[i + 1]; their
    hashes and the byte at which each begins, counted from the text's start.
    NULL texts have no words."""
    texts = unsliced(texts.cast(pa.large_string()).fill_null(""))
    n = len(texts)
    if n == 0:
        return np.empty(0, "u8"), np.zeros(1, "i8"), np.empty(0, "i8")
    _, offsets, buffer = texts.buffers()
    at = np.frombuffer(offsets, "i8")[:n + 1]
    data = np.frombuffer(buffer, "u1")[:at[-1]] if at[-1] else np.empty(0, "u1")
    inside = ~separators[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = at[:-1][at[:-1] < len(data)]
    first[cuts] = inside[cuts]                    # a word ends with its text
    begin = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = at[1:][at[1:] > 0] - 1
    last[ends] |= inside[ends]
    end = np.flatnonzero(last) + 1
    out = np.empty(len(begin), "u8")
    lo = 0
    while lo < len(begin):
        hi = max(lo + 1, int(np.searchsorted(end, begin[lo] + AT_ONCE, "right")))
        out[lo:hi] = _hash(data, begin[lo:hi], end[lo:hi])
        lo = hi
    starts = np.searchsorted(begin, at)
    return out, starts, begin - np.repeat(at[:-1], np.diff(starts))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every run of ``k`` words of one text; of the whole sequence if
    it is shorter; none if there are no words."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(k, n)
    out = np.full(n - size + 1, size, "u8") * _ODD[2]
    for i in range(size):
        out += hashes[i:n - size + 1 + i] * _ODD[3 + i % 60]
    return mix(out)
