"""Words and fingerprints of whole Arrow batches of texts, with numpy.

A text is its UTF-8 bytes.  All word classes here are complements of ASCII
sets, so a byte of 0x80 or more is always part of a word and no code point is
cut.  Fingerprints are 64-bit polynomial sums over randomly mapped symbols,
scrambled at the end; equal sequences have equal fingerprints wherever they
stand.  Such sums agree for some long, highly regular strings (Thue-Morse), so
byte ranges of more than PLAIN bytes are digested with BLAKE2b instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: `[^\x20\x09-\x0D]+`
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, on texts whose A-Z are lower-cased
ALPHANUMERIC = np.ones(256, bool)
ALPHANUMERIC[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SYMBOLS = np.random.default_rng(0x5EED).integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_STEP), -1, 2**64))
#: Bytes up to which a range's polynomial sum is its fingerprint.
PLAIN = 64


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of length n + 1); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def portions(offsets: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about `size` bytes each; a longer text stands alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of member bytes; no run crosses two texts."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = member[data]
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    first[edge] = inside[edge + 1]
    last[edge - 1] = inside[edge]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def owner(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The index of the text each start lies in."""
    return np.searchsorted(offsets, starts, "right") - 1


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    both = []
    for base in (_STEP, _BACK):
        row = np.full(n, base, np.uint64)
        row[0] = 1
        both.append(np.multiply.accumulate(row))
    return both[0], both[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    forth, back = _powers(1 << max(16, int(n).bit_length()))
    return forth[:n], back[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _prefix(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of symbol times power, and the powers that undo a place."""
    forth, back = powers(len(symbols) + 1)
    total = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * forth[:-1], out=total[1:])
    return total, back


def fingerprints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One value for each byte range."""
    total, back = _prefix(_SYMBOLS[data])
    out = mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    long = np.flatnonzero(ends - starts > PLAIN)
    if len(long):
        held = memoryview(np.ascontiguousarray(data))
        out[long] = np.frombuffer(b"".join(
            blake2b(held[s:e], digest_size=8).digest()
            for s, e in zip(starts[long].tolist(), ends[long].tolist(), strict=True)), np.uint64)
    return out


def grams(values: np.ndarray, k: int) -> np.ndarray:
    """One value for each k consecutive values; the caller skips those that cross two texts."""
    if len(values) < k:
        return np.zeros(0, np.uint64)
    total, back = _prefix(values)
    at = len(values) - k + 1
    return mix((total[k:] - total[:-k]) * back[:at] + np.uint64(k))


def windows(data: np.ndarray, positions: np.ndarray, length: int, step: int = 1 << 19) -> np.ndarray:
    """The fingerprint of the `length` bytes from each of the sorted positions, chunk by chunk."""
    out = np.empty(len(positions), np.uint64)
    for at in range(0, len(data), step):
        a, b = np.searchsorted(positions, (at, at + step))
        if a < b:
            total, back = _prefix(_SYMBOLS[data[at: at + step + length]])
            place = positions[a:b] - at
            out[a:b] = mix((total[place + length] - total[place]) * back[place])
    return out


def sums(values: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    """Sum of integer values by owner, as int64."""
    return np.bincount(owners, values, minlength=n).astype(np.int64) if len(values) else np.zeros(n, np.int64)


def ramp(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count, concatenated."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def pack_texts(data: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Texts laid end to end as an Arrow column."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    large = pa.Array.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    return large.cast(kind)
