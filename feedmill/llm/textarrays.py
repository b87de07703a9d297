"""Vectorised views of Arrow text columns: words, word hashes and word n-gram hashes.

Everything works on the raw UTF-8 bytes of a column. The hash of a word takes eight bytes at a time; those
of words of up to seven bytes are one-to-one. The hash of a run of words is a polynomial over the word
hashes modulo 2^64, for runs of far fewer than the thousand words at which such polynomials have known
collisions. Hashes depend on content alone and are equal in every task.

A step holds rows of about half a megabyte together; a longer text is a step of its own and needs some
60 bytes of memory for each of its bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes of text that one vectorised step holds; a longer text is a step of its own.
PIECE_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD1342543DE82EF95

#: The white space bytes 09-0D and 20.
SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True

#: Every byte but ASCII letters and digits and the bytes of non-ASCII characters.
NOT_ALNUM = np.array([not (chr(b).isalnum() if b < 128 else True) for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U64(32))
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(29)
    x *= U64(0xA0761D6478BD642F)
    x ^= x >> U64(32)
    return x


#: Low bytes of a 64-bit number, by how many of them a word fills.
_FILLED = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=U64)
_LONG = U64(1 << 63)
#: A longer word is hashed by BLAKE2b.
_LONGEST = 4096


@lru_cache(maxsize=4)
def _grown(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    up = np.full(n, base, dtype=U64)
    up[0] = 1
    down = np.full(n, pow(base, -1, 1 << 64), dtype=U64)
    down[0] = 1
    return np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of base and of its inverse modulo 2^64, n of each at least."""
    return _grown(base, max(20, int(n).bit_length()))


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into steps of rows: first row, end row, bytes, offsets. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.string()) if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)) else column
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(off, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def word_bounds(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each text's offsets among them."""
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    np.logical_not(separators[data], out=inside[1 : n + 1])
    begins = inside[1 : n + 1] & ~inside[:n]
    ends = inside[1 : n + 1] & ~inside[2:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    begins[cuts] = inside[cuts + 1]
    ends[cuts - 1] = inside[cuts]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hashes of byte ranges; those of up to seven bytes are one-to-one. Another seed gives independent ones for longer ranges."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    size = ends - starts
    out = (eight[starts] & _FILLED[np.minimum(size, 8)]) | (size.astype(U64) << U64(56))
    long = np.flatnonzero(size > 7)
    if len(long):
        begin, size = starts[long], size[long]
        state = mix((eight[begin] + U64(seed)) ^ (size.astype(U64) * U64(_BASE)))
        active, at = np.flatnonzero((size > 8) & (size <= _LONGEST)), 8
        while len(active):
            chunk = eight[begin[active] + at] & _FILLED[np.minimum(size[active] - at, 8)]
            state[active] = mix(state[active] * U64(0xC6A4A7935BD1E995) + chunk)
            at += 8
            active = active[size[active] > at]
        for k in np.flatnonzero(size > _LONGEST):
            state[k] = int.from_bytes(hashlib.blake2b(data[begin[k] : begin[k] + size[k]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little")
        out[long] = state | _LONG
    return mix(out ^ U64(seed))


def word_hashes(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word, and each text's offsets among them."""
    starts, ends, at = word_bounds(data, offsets, separators)
    return hash_ranges(data, starts, ends), at


def gram_prefix(words: np.ndarray) -> np.ndarray:
    total = np.zeros(len(words) + 1, dtype=U64)
    np.cumsum(words * _powers(_WORD_BASE, len(words))[0][: len(words)], out=total[1:])
    return total


def gram_hashes(prefix: np.ndarray, starts: np.ndarray, lengths) -> np.ndarray:
    """Hashes of runs of words, from gram_prefix; runs of other lengths differ."""
    raw = (prefix[starts + lengths] - prefix[starts]) * _powers(_WORD_BASE, len(prefix))[1][starts]
    return mix(raw + np.asarray(lengths, dtype=U64) * U64(0x94D049BB133111EB))


def ramp(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... count - 1 for each count, one after another."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of size words, and each text's offsets among them.

    A text of fewer words has one shingle, all its words; a text without words has none.
    """
    words, at = word_hashes(data, offsets)
    n = np.diff(at)
    counts = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    starts = np.repeat(at[:-1], counts) + ramp(counts)
    hashes = gram_hashes(gram_prefix(words), starts, np.repeat(np.minimum(n, size), counts))
    return hashes, np.concatenate(([0], np.cumsum(counts)))


def permutations(k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and addends of k universal hash permutations of the 32-bit numbers."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 31, k, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, k, dtype=np.uint32)


def minhashes(hashes: np.ndarray, offsets: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """MinHash values, a row of k for each text; a text without shingles has the largest value throughout."""
    n = len(offsets) - 1
    out = np.full((k, n), np.uint32(0xFFFFFFFF))
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full):
        low = (hashes >> U64(32)).astype(np.uint32)
        at, moved = offsets[full], np.empty_like(low)
        for j, (a, b) in enumerate(zip(*permutations(k, seed), strict=True)):
            np.multiply(low, a, out=moved)
            np.add(moved, b, out=moved)
            out[j, full] = np.minimum.reduceat(moved, at)
    return np.ascontiguousarray(out.T)


def int64(values: np.ndarray) -> pa.Array:
    """The bits of 64-bit hashes as Arrow longs."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))
