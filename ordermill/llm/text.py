"""Byte-level text work on whole Arrow columns, for operators that run numpy inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes worked on at once; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}
#: Longer spans are hashed one by one.
_LANES = 64
_FIRST_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (in place where possible)."""
    shifted = x >> np.uint64(30)
    x = x ^ shifted
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, np.uint64(27), out=shifted)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= np.right_shift(x, np.uint64(31), out=shifted)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, PIECE_BYTES + 1)
        for name, factor in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one number; places beyond the end count as zero."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), np.uint64, padded.data, 0, (1,))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end) of ``data``; equal bytes give equal hashes.

    Eight bytes at a time go through ``mix``, which is no polynomial: texts of repeating structure do not collide.
    """
    starts, left = np.asarray(starts, np.int64), np.asarray(ends, np.int64) - starts
    found = mix(left.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(_BASE))
    eight, live, at = lanes(data), np.flatnonzero((left > 0) & (left <= 8 * _LANES)), starts
    for step in range(_LANES):
        if not len(live):
            break
        rest = left[live] - 8 * step
        word = eight[at[live] + 8 * step] & _FIRST_BYTES[np.minimum(rest, 8)]
        found[live] = mix((found[live] ^ word) * np.uint64(_BASE))
        live = live[rest > 8]
    for i in np.flatnonzero(left > 8 * _LANES):
        found[i] = xxhash.xxh3_64_intdigest(data[starts[i]: starts[i] + left[i]])
    return found


def equal_spans(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether ``lengths[i]`` bytes of ``a`` from ``a_starts[i]`` are those of ``b`` from ``b_starts[i]``."""
    same, live = np.ones(len(lengths), bool), np.flatnonzero(lengths > 0)
    left, right, step = lanes(a), lanes(b), 0
    while len(live):
        rest = lengths[live] - 8 * step
        unlike = ((left[a_starts[live] + 8 * step] ^ right[b_starts[live] + 8 * step]) & _FIRST_BYTES[np.minimum(rest, 8)]) != 0
        same[live[unlike]] = False
        live, step = live[(rest > 8) & ~unlike], step + 1
    return same


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, PIECE_BYTES + 1)
        for name, factor in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums that the polynomial hashes below are differences of."""
    up, _ = _power_tables(len(data) + 1)
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    terms = data.astype(np.uint64)
    terms += np.uint64(1)
    terms *= up[: len(data)]
    np.cumsum(terms, out=sums[1:])
    return sums


def rolling_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """As ``span_hashes``, for spans that overlap and for numbers beyond a byte: one pass over the data; polynomial modulo 2**64."""
    _, down = _power_tables(len(data) + 1)
    sums = prefix_sums(data) if sums is None else sums
    found = (sums[ends] - sums[starts]) * down[starts]
    found += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(found)


def same_spans(sums: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether ``length`` numbers from ``a`` and from ``b`` have equal ``rolling_hashes``, from the sums of their data."""
    _, down = _power_tables(len(sums))
    return (sums[a + length] - sums[a]) * down[a] == (sums[b + length] - sums[b]) * down[b]


def gram_hashes(data: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``rolling_hashes`` of all ranges of ``width`` bytes, by start, and the sums for more hashes of the same data."""
    _, down = _power_tables(len(data) + 1)
    sums = prefix_sums(data)
    found = sums[width:] - sums[:-width]
    found *= down[: len(found)]
    found += np.uint64(width * 0xD6E8FEB86659FD93 % 2**64)
    return mix(found), sums


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of a string column as (first row, end row, bytes, offsets); null counts as empty.

    ``offsets`` has one more entry than there are rows and starts at 0. A piece holds at most
    ``limit`` bytes, or one row.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, bounds, values = column.buffers()
    offsets = np.frombuffer(bounds, dtype=np.int64)[column.offset: column.offset + n + 1]
    raw = np.frombuffer(values, dtype=np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(n, max(end, first + 1))
        yield first, end, raw[offsets[first]: offsets[end]], offsets[first: end + 1] - offsets[first]
        first = end


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return _LOWER[data]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true bytes that do not cross rows: (starts, ends, first run of each row and their number)."""
    n = len(inside)
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    cuts = offsets[:-1][offsets[:-1] < n]
    before[cuts] = False
    after[cuts[cuts > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes other than space and 0x09-0x0D, as in ``runs``."""
    return runs(~_BLANK[data], offsets)
