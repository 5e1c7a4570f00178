"""Array work on the UTF-8 bytes of many texts at once, inside Spark tasks.

Fingerprints are polynomials modulo 2**64 over prefix sums, so the fingerprint of any byte range costs two look-ups.
Memory follows `CHUNK`, not the text length: ranges longer than a chunk are summed piece by piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 18
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and the n + 1 row offsets in them. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks or [pa.array([], column.type)])
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
        column = pc.fill_null(column, b"" if binary else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, size: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about `size` bytes each, at least one row."""
    row, last = 0, len(offsets) - 1
    while row < last:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, min(end, last)
        row = min(end, last)


def powers(n: int, which: int = 0, inverse: bool = False) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64, or those of the inverse of the base."""
    key = (which, inverse)
    if len(_POWERS.get(key, ())) < n:
        base = pow(_BASES[which], -1, 1 << 64) if inverse else _BASES[which]
        table = np.full(max(n, CHUNK + 1), base, np.uint64)
        table[0] = 1
        _POWERS[key] = np.cumprod(table, dtype=np.uint64)
    return _POWERS[key][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(values: np.ndarray, which: int = 0) -> np.ndarray:
    """Prefix sums of value * base**position: `range_hash` reads any range from them."""
    sums = np.empty(len(values) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(len(values), which), out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """Fingerprints of [start, end), equal for equal content wherever it stands."""
    return (sums[end] - sums[start]) * powers(len(sums), which, True)[start]


def _long_hash(values: np.ndarray) -> int:
    total, base = 0, _BASES[0]
    for at in range(0, len(values), CHUNK):
        piece = values[at : at + CHUNK].astype(np.uint64) + np.uint64(1)
        total += int((piece * powers(len(piece))).sum(dtype=np.uint64)) * pow(base, at, 1 << 64)
    return total % (1 << 64)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes; a run ends with its row."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(inside) + 1, bool)
    cut[offsets] = True
    change = inside[1:] != inside[:-1]
    starts, ends = inside.copy(), np.empty(len(inside), bool)
    starts[1:] &= change | cut[1:-1]
    ends[:-1] = inside[:-1] & (change | cut[1:-1])
    ends[-1] = inside[-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def hash_ranges(folded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed 64-bit fingerprints of byte ranges that do not overlap and stand in order."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        stop = int(np.searchsorted(ends, low + CHUNK, "right"))
        if stop <= at:
            out[at] = _long_hash(folded[low : ends[at]])
            at += 1
            continue
        sums = prefix_sums(folded[low : ends[stop - 1]])
        out[at:stop] = range_hash(sums, starts[at:stop] - low, ends[at:stop] - low)
        at = stop
    return mix(out ^ (ends - starts).astype(np.uint64))


def fold_table(separators: bytes, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Byte tables: folded value (A-Z lower-cased), and whether the byte belongs to a word."""
    fold = np.arange(256, dtype=np.uint8)
    if lower:
        fold[65:91] += 32
    word = np.ones(256, bool)
    word[np.frombuffer(separators, np.uint8)] = False
    return fold, word


WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
WHITE_FOLD, WHITE_WORD = fold_table(WHITE)


def white_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words between ASCII white space, A-Z lower-cased: starts, ends, fingerprints."""
    starts, ends = runs(WHITE_WORD[data], offsets)
    return starts, ends, hash_ranges(WHITE_FOLD[data], starts, ends)


def group_starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Positions at which a group of equal keys begins, for keys sorted together."""
    new = np.ones(len(sorted_keys[0]), bool)
    if len(new):
        same = np.ones(len(new) - 1, bool)
        for key in sorted_keys:
            same &= key[1:] == key[:-1]
        new[1:] = ~same
    return np.flatnonzero(new)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
