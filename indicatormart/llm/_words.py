"""Words of many texts at once: positions and 64-bit hashes by numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` over UTF-8 bytes, lower-cased in A-Z only.
A word's hash is a sum of random byte values times powers of an odd number
(modulo 2^64) put through a finaliser: equal words have equal hashes, and two
different words share one with a probability of about 2^-63.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from indicatormart.llm._tables import _mix

#: Bytes that are looked at together; bounds the memory of a task however long a text is.
PIECE = 1 << 18

_BLANKS = [9, 10, 11, 12, 13, 32]
_SPACE = np.zeros(256, bool)
_SPACE[_BLANKS] = True
_BYTE = np.random.default_rng(20240607).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]    # A-Z count as a-z
_BYTE[_BLANKS] = 0
_STEP = 0xD1342543DE82EF95


class Words(NamedTuple):
    start: np.ndarray   # byte positions in the buffer
    end: np.ndarray
    hash: np.ndarray    # uint64


class Texts(NamedTuple):
    buf: np.ndarray     # the bytes of all texts, one after another
    offset: np.ndarray  # where each text starts, and the end


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, where, data = column.buffers()
    offset = np.frombuffer(where, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(buf[offset[0]:offset[-1]], offset - offset[0])


def groups(texts: Texts, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes (a longer text is alone)."""
    first, n = 0, len(texts.offset) - 1
    while first < n:
        last = int(np.searchsorted(texts.offset, texts.offset[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def part(texts: Texts, first: int, last: int) -> Texts:
    a, b = texts.offset[first], texts.offset[last]
    return Texts(texts.buf[a:b], texts.offset[first:last + 1] - a)


def _cuts(texts: Texts, piece: int) -> list[int]:
    """Where to cut the bytes so that no word is cut."""
    n, cuts = len(texts.buf), [0]
    while n - cuts[-1] > piece:
        at = cuts[-1] + piece
        edge = int(np.searchsorted(texts.offset, at))
        near = int(texts.offset[edge]) if edge < len(texts.offset) else n
        step = 4096
        while at < min(near, n):
            found = np.flatnonzero(_SPACE[texts.buf[at:at + step]])
            if len(found):
                near = min(near, at + int(found[0]))
                break
            at += step
        if near <= cuts[-1] or near >= n:
            break
        cuts.append(near)
    return cuts + [n]


def words_of(texts: Texts) -> Words:
    found = []
    cuts = _cuts(texts, PIECE)
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b <= a:
            continue
        low, high = np.searchsorted(texts.offset, a), np.searchsorted(texts.offset, b)
        found.append(_piece(texts.buf[a:b], texts.offset[low:high] - a, a))
    if not found:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, np.uint64))
    return Words(*(np.concatenate(x) for x in zip(*found, strict=True)))


def _piece(raw: np.ndarray, edges: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    solid = (raw > 13) & (raw != 32) | (raw < 9)
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = edges[(edges >= 0) & (edges < len(raw))]
    first[inner] = solid[inner]             # a text's first byte starts a word even if the last text ended in one
    last = solid
    last[:-1] &= ~solid[1:] | first[1:]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(start):
        return start, end, np.zeros(0, np.uint64)
    size = end - start
    powers = np.full(int(size.max()), _STEP, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    low = int(start[0])
    inside = np.arange(low, len(raw)) - np.repeat(start, np.diff(np.append(start, len(raw))))
    code = np.take(_BYTE, raw[low:])        # blanks after a word count zero
    code *= np.take(powers, inside, mode="clip")
    total = np.add.reduceat(code, start - low) + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return start + base, end + base, _mix(total)


def owner(offset: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The text each position lies in."""
    return np.searchsorted(offset, start, side="right") - 1


def per_text(index: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(index, minlength=n).astype(np.int64)
