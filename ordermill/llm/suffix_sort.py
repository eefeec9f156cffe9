"""Suffix arrays by induced sorting, and permuted common prefixes.

Suffixes are classified as smaller or larger than the next one. Leftmost smaller suffixes (LMS) are put into
their buckets, everything else is induced from them in one sweep up and one down. The first such run sorts the
LMS substrings; if some are equal, their names form a shorter string, whose suffixes are sorted by doubling;
then the final run induces the whole array. A sweep handles a bucket's entries as a block:
those that put new entries into the bucket itself make the next block. Symbols are kept in two bytes, which numpy sorts by counting.
"""

from __future__ import annotations

import numpy as np

from ordermill.llm.text import prefix_sums, rolling_hashes, same_spans

#: Strings of more names than this are sorted by doubling alone.
_SYMBOLS = 4096


def _smaller(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one behind it; the last (the unique smallest end mark) is."""
    n = len(s)
    out = np.ones(n, bool)
    if n > 1:
        up = s[1:] > s[:-1]
        at = np.where(s[1:] != s[:-1], np.arange(n - 1), n)
        at = np.minimum.accumulate(at[::-1])[::-1]  # the next place where neighbours differ
        out[:-1] = (at < n) & up[np.minimum(at, n - 2)]
    return out


def _placed(values: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries grouped by value in stable order: (entries, values, rank inside the value)."""
    by = np.argsort(values, kind="stable")
    sorted_values = values[by]
    first = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]])) if len(by) else np.zeros(0, np.int64)
    rank = np.arange(len(by)) - np.repeat(first, np.diff(np.append(first, len(by))))
    return order[by], sorted_values, rank


def _induced(s: np.ndarray, smaller: np.ndarray, ends: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The array induced from LMS positions in the given order."""
    n, size = len(s), len(ends) - 1
    array = np.full(n, -1, np.int64)
    entries, values, rank = _placed(s[lms], lms)
    count = np.bincount(values, minlength=size)
    array[ends[values + 1] - count[values] + rank] = entries
    lms_begin = ends[1:] - count

    head = ends[:-1].copy()
    used = np.flatnonzero(np.diff(ends)).tolist()
    for c in used:
        at = ends[c]
        while at < head[c]:
            stop = head[c]
            _push_up(array, array[at:stop], s, smaller, head)
            at = stop
        _push_up(array, array[lms_begin[c]: ends[c + 1]], s, smaller, head)
    for c in used:
        array[lms_begin[c]: ends[c + 1]] = -1

    tail = ends[1:].copy()
    array[0] = n - 1  # the end mark
    tail[0] = 0
    for c in reversed(used):
        at = ends[c + 1]
        while at > tail[c]:
            stop = tail[c]
            _push_down(array, array[stop:at][::-1], s, smaller, tail)
            at = stop
        _push_down(array, array[ends[c]: head[c]][::-1], s, smaller, tail)
    return array


def _push_up(array: np.ndarray, block: np.ndarray, s: np.ndarray, smaller: np.ndarray, head: np.ndarray) -> None:
    if not len(block):
        return
    before = block[block > 0] - 1
    before = before[~smaller[before]]
    if len(before):
        entries, values, rank = _placed(s[before], before)
        array[head[values] + rank] = entries
        head += np.bincount(values, minlength=len(head))


def _push_down(array: np.ndarray, block: np.ndarray, s: np.ndarray, smaller: np.ndarray, tail: np.ndarray) -> None:
    if not len(block):
        return
    before = block[block > 0] - 1
    before = before[smaller[before]]
    if len(before):
        entries, values, rank = _placed(s[before], before)
        array[tail[values] - 1 - rank] = entries
        tail -= np.bincount(values, minlength=len(tail))


def _doubled(s: np.ndarray, size: int) -> np.ndarray:
    """The same array for a string of many names: order by the first names, then by twice as many in every round.

    Only suffixes that are equal so far are sorted again. Equal ones cannot hold the end mark, so what lies behind them is there.
    """
    n, bits = len(s), max(1, int(size - 1).bit_length())
    width = max(1, 63 // bits)
    padded = np.zeros(n + width, np.uint64)
    padded[:n] = s
    key = padded[:n].copy()
    for k in range(1, width):
        key = (key << np.uint64(bits)) | padded[k: k + n]
    order = np.argsort(key)
    rank, slots, key = np.empty(n, np.int64), np.arange(n), key[order]
    while len(slots):
        fresh = np.ones(len(slots), bool)
        fresh[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(fresh)
        count = np.diff(np.append(first, len(slots)))
        rank[order[slots]] = np.repeat(slots[first], count)
        slots = slots[np.repeat(count > 1, count)]
        entries = order[slots]
        key = (rank[entries] << 32) | rank[np.minimum(entries + width, n - 1)]
        by = np.argsort(key)
        order[slots], key = entries[by], key[by]
        width *= 2
    return order


def suffix_array(s: np.ndarray, size: int) -> np.ndarray:
    """Start positions of the suffixes of ``s`` in order; ``s`` holds numbers below ``size`` and ends with its only 0."""
    n = len(s)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    if size > _SYMBOLS:
        return _doubled(s, size)
    s = s.astype(np.uint16)
    smaller = _smaller(s)
    ends = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=size))])
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    array = _induced(s, smaller, ends, lms)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = array[is_lms[array]]

    # Names: an LMS substring reaches to the next LMS position, included; the end mark is one of its own.
    number = np.zeros(n, np.int64)
    number[lms] = np.arange(len(lms))
    after = np.minimum(np.append(lms[1:], n - 1) + 1, n)
    marks = rolling_hashes(s, lms, after)[number[order]]
    length = (after - lms)[number[order]]
    fresh = np.ones(len(order), np.int64)
    fresh[1:] = (marks[1:] != marks[:-1]) | (length[1:] != length[:-1])
    names = np.cumsum(fresh) - 1
    if names[-1] + 1 < len(order):
        short = np.empty(len(lms), np.int64)
        short[number[order]] = names
        order = lms[_doubled(short, int(names[-1]) + 1)]
    return _induced(s, smaller, ends, order)


def common_prefixes(s: np.ndarray, array: np.ndarray, most: int) -> np.ndarray:
    """By position: how many numbers (at most ``most``) a suffix shares with the one before it in the array.

    Where the number in front of both is the same, the suffix that begins there shares one more with its own neighbour.
    So only the last place of such a run is compared; in copies runs are long.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    goes_on = np.zeros(n + 1, bool)
    goes_on[1:n] = (before[1:] > 0) & (s[:-1] == s[np.maximum(before[1:], 1) - 1])
    here = np.flatnonzero((before >= 0) & ~goes_on[1:])
    there = before[here]
    behind, sums = np.maximum(here, there), prefix_sums(s)
    # Repeats share all that counts: these are found at once, the others by halving.
    shared = np.zeros(len(here), np.int64)
    whole = np.flatnonzero(behind + most <= n)
    whole = whole[same_spans(sums, here[whole], there[whole], most)]
    shared[whole] = most
    rest = np.flatnonzero(shared < most)
    step = 1 << max(0, most.bit_length() - 1)
    while step:
        fits = rest[(behind[rest] + shared[rest] + step <= n) & (shared[rest] + step <= most)]
        a, b = here[fits] + shared[fits], there[fits] + shared[fits]
        shared[fits[same_spans(sums, a, b, step)]] += step
        step >>= 1
    out = np.zeros(n, np.int64)
    if len(here):
        run = np.diff(here, prepend=-1)
        out[: here[-1] + 1] = np.minimum(np.repeat(shared + here, run) - np.arange(here[-1] + 1), most)
        out[array[0]] = 0
    return out
