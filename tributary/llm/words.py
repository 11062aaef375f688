"""Words of many texts at once: positions and 64-bit hashes from the bytes of an Arrow column.

A word is a run of bytes other than 0x20 and 0x09-0x0D, which on UTF-8 text equals the pattern
`[^\\x20\\x09-\\x0D]+`. Words never span two texts. All work is on slices of bounded size, so a very
long text costs eight bytes per word and a few bytes per byte of one slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18

_SPACES = (0x20, *range(0x09, 0x0E))
_INSIDE = bytes(b not in _SPACES for b in range(256))
# For `plain`: ASCII letters, digits and all other bytes of UTF-8 letters; marks part words as well.
_PLAIN = bytes(chr(b).isalnum() if b < 0x80 else 1 for b in range(256))
# One more than the byte, so that no byte counts as zero (0xFF does not occur in UTF-8).
_SAME = bytes(min(b + 1, 255) for b in range(256))
_LOWER = bytes(min(b + 1 + 0x20 * (0x41 <= b <= 0x5A), 255) for b in range(256))

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_NOTHING = np.empty(0, dtype=np.int64), np.empty(0, dtype=_U), np.empty(0, dtype=np.uint16)
_powers: dict[int, np.ndarray] = {}


class Chunk(NamedTuple):
    """Words of the rows first..first+len(offsets)-2 of a batch; offsets bounds each row's words.
    endings holds the last two bytes of each word (A-Z as a-z if the words are), the last one in the low bits."""

    first: int
    words: np.ndarray
    offsets: np.ndarray
    endings: np.ndarray


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers (a one-to-one map)."""
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


def _table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + 1), base, dtype=_U)
        have[0] = 1
        have = np.cumprod(have, dtype=_U)
        _powers[base] = have
    return have[:n]


def _hash_slice(data: np.ndarray, breaks: np.ndarray, lower: bool, plain: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start positions, hashes and endings of the words of one slice; breaks holds positions where a text starts."""
    n = len(data)
    raw = data.tobytes()
    inside = np.frombuffer(raw.translate(_PLAIN if plain else _INSIDE), dtype=bool)
    edge = np.empty(n + 1, dtype=bool)
    edge[0] = edge[n] = True
    edge[1:n] = inside[1:] != inside[:-1]
    edge[breaks[breaks < n]] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    keep = inside[starts]
    starts, ends = starts[keep], ends[keep]
    sums = np.zeros(n + 1, dtype=_U)
    values = np.frombuffer(raw.translate(_LOWER if lower else _SAME), dtype=np.uint8)
    np.cumsum(values * _table(_BASE, n), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _table(_INVERSE, n)[starts]
    # Like the hashes from the mapped bytes: equal words have one ending, however they are written.
    endings = values[ends - 1].astype(np.uint16) - np.uint16(1)
    long = ends - starts > 1
    endings[long] |= (values[ends[long] - 2].astype(np.uint16) - np.uint16(1)) << np.uint16(8)
    return starts, mix(h + (ends - starts).astype(_U)), endings


def _plain(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", dtype=np.uint8), bounds


def _long(data: np.ndarray, lower: bool, plain: bool) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and endings of one text beyond a slice, cut at white space."""
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + SLICE_BYTES)
        while end < len(data) and data[end] not in _SPACES:
            inside = np.frombuffer(data[end : end + SLICE_BYTES].tobytes().translate(_INSIDE), dtype=bool)
            more = np.flatnonzero(~inside)
            end = end + int(more[0]) if len(more) else min(len(data), end + SLICE_BYTES)
        parts.append(_hash_slice(data[at:end], np.empty(0, dtype=np.int64), lower, plain)[1:])
        at = end
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def chunks(column: pa.Array, lower: bool, plain: bool = False) -> Iterator[Chunk]:
    """Word hashes of a text column, some rows at a time; lower maps A-Z to a-z first, plain takes
    ASCII marks for white space."""
    data, bounds = _plain(column)
    row, rows = 0, len(column)
    while row < rows:
        end = int(np.searchsorted(bounds, bounds[row] + SLICE_BYTES, side="right")) - 1
        if end <= row:
            words, endings = _long(data[bounds[row] : bounds[row + 1]], lower, plain)
            yield Chunk(row, words, np.array([0, len(words)]), endings)
            row += 1
            continue
        own = bounds[row : end + 1] - bounds[row]
        part = data[bounds[row] : bounds[end]]
        starts, words, endings = _hash_slice(part, own, lower, plain) if len(part) else _NOTHING
        yield Chunk(row, words, np.searchsorted(starts, own), endings)
        row = end


def join_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n neighbouring words, at the position of its first word."""
    size = max(0, len(words) - n + 1)
    total = np.zeros(size, dtype=_U)
    factor = 1
    for k in range(n):
        factor = factor * 0xA24BAED4963EE407 % (1 << 64)
        total += words[k : k + size] * _U(factor)
    return mix(total + _U(n))
