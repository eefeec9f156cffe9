"""Repeated passages across documents, cut out byte by byte; ties between them settled by suffix arrays.

A 50-byte string gets an anchor: the smallest hash among its GRAM-byte pieces. Equal strings have equal anchors
at equal places, so they meet wherever rows are routed by anchor. Neighbouring strings with the same anchor
form one segment of text.

1. Documents are dealt to groups of bounded size by one shuffle that all steps reuse. A group names its
   anchors to buckets; a bucket answers which of them another document has too.
2. For these, the group sends the hash of the whole segment and its smallest doc_id. If all segments at an anchor are
   equal, the smallest doc_id settles it. Otherwise the segment's text is asked for, once per distinct segment.
3. A bucket sorts the suffixes of these texts by induced sorting. Positions whose common prefixes chain up to 50
   bytes or more are the same string; the smallest doc_id among them is the first to have it.
4. Groups mark the bytes of all strings that a smaller doc_id has and cut them out.

An anchor found in very many groups (HOT_GROUPS) has no bounded place to meet. Its strings are routed one by one
by their own hash, which spreads them, and need no sorting. Packed numbers travel instead of one row per anchor.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.suffix_sort import common_prefixes, suffix_array
from ordermill.llm.text import gram_hashes, mix, pieces, rolling_hashes

WIDTH, GRAM = 50, 24
#: Bytes of text in a group, anchors in a bucket, and the number of groups from which an anchor is hot.
GROUP_BYTES, BUCKET_ANCHORS, HOT_GROUPS = 4 << 20, 1 << 20, 64
#: Bytes of text whose suffixes are sorted at once; an anchor's texts stay together.
SORT_BYTES = 1 << 19
_CHUNK = 1 << 23
#: Bytes hashed at once: arrays of eight bytes per byte of text stay in cache.
_PIECE = 1 << 16
_NONE = np.iinfo(np.int64).max


class Anchors:
    """Segments of one group: row, first and last string, 40-bit anchor key, 64-bit hash of the segment, place of the anchor in it.

    With ``wanted``, sorted keys, only the segments at these anchors; only then are segments hashed.
    """

    def __init__(self, table: pa.Table, width: int, wanted: np.ndarray | None = None):
        self.width = width
        self.texts = []  # (first row, bytes, offsets)
        parts = []
        among = None if wanted is None else _Among(wanted)
        for first, end, data, offsets in pieces(table.column("text"), _PIECE):
            self.texts.append((first, data, offsets))
            parts += [(first, len(self.texts) - 1, *found) for found in _anchors(data, offsets, width, among)]
        get = lambda k, kind: np.concatenate([p[k] for p in parts]).astype(kind) if parts else np.zeros(0, kind)
        self.piece = np.concatenate([np.full(len(p[2]), p[1], np.int32) for p in parts]) if parts else np.zeros(0, np.int32)
        self.row = np.concatenate([p[2] + p[0] for p in parts]) if parts else np.zeros(0, np.int64)
        self.low, self.high, self.place = get(3, np.int64), get(4, np.int64), get(5, np.int64)
        self.key, self.mark = get(6, np.uint64), get(7, np.uint64)
        self.docs = table.column("doc_id").to_numpy(zero_copy_only=False)

    def chosen(self, at: np.ndarray) -> None:
        for name in ("piece", "row", "low", "high", "place", "key", "mark"):
            setattr(self, name, getattr(self, name)[at])

    def split(self, at: np.ndarray) -> None:
        """The segments ``at`` become one segment per string, routed by its own hash."""
        if not at.any():
            return
        count = np.where(at, self.high - self.low + 1, 1)
        old = np.repeat(np.arange(len(at)), count)
        step = np.arange(len(old)) - np.repeat(np.cumsum(count) - count, count)
        alone = at[old]
        low = self.low[old] + step
        high = np.where(alone, low, self.high[old])
        self.chosen(old)
        self.low, self.high = low, high
        for k, (_, data, _) in enumerate(self.texts):
            these = np.flatnonzero(alone & (self.piece == k))
            if len(these):
                marks = mix(rolling_hashes(data, low[these], low[these] + self.width) ^ np.uint64(0x5851F42D4C957F2D))
                self.mark[these], self.key[these], self.place[these] = marks, marks >> np.uint64(24), -1


class _Among:
    """Whether numbers are among sorted ones; most that are not are told by a table of their low bits."""

    def __init__(self, wanted: np.ndarray):
        self.wanted, self.low = wanted, np.zeros(1 << 21, bool)
        self.low[(wanted & np.uint64((1 << 21) - 1)).astype(np.int64)] = True

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Positions of the keys that are."""
        if not len(self.wanted):
            return np.zeros(0, np.int64)
        at = np.flatnonzero(self.low[(keys & np.uint64((1 << 21) - 1)).astype(np.int64)])
        spot = np.minimum(np.searchsorted(self.wanted, keys[at]), len(self.wanted) - 1)
        return at[self.wanted[spot] == keys[at]]


def _anchors(data: np.ndarray, offsets: np.ndarray, width: int, among: _Among | None):
    """(row, first string, last string, place of the anchor, key, mark) per chunk of consecutive rows; see ``Anchors`` for ``among``."""
    n = len(data)
    window = width - GRAM + 1
    lengths = np.diff(offsets)
    row_of = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    # Strings that reach beyond their row, and those with which a row begins.
    fits, begins = np.ones(n, bool), np.zeros(n, bool)
    tails = offsets[1:, None] - np.arange(1, width)
    fits[tails[tails >= offsets[:-1, None]]] = False
    begins[offsets[:-1][lengths > 0]] = True
    for begin in range(0, max(0, n - width + 1), _CHUNK):
        part = data[begin: begin + _CHUNK + width - 1]
        if len(part) < width:
            break
        grams, sums = gram_hashes(part, GRAM)
        low = (grams & ~np.uint64(0xFFFFFF)) | np.arange(len(grams), dtype=np.uint64)  # ties go to the first
        reach = 1
        while reach * 2 <= window:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        strings = len(part) - width + 1
        low = np.minimum(low[:strings], low[window - reach: window - reach + strings])
        inside = fits[begin: begin + strings]
        fresh = begins[begin: begin + strings].copy()
        fresh[0] = True
        fresh[1:] |= (low[1:] != low[:-1]) | ~inside[:-1]
        fresh &= inside
        ends = inside.copy()
        ends[:-1] &= fresh[1:] | ~inside[1:]
        first, last = np.flatnonzero(fresh), np.flatnonzero(ends)
        if not len(first):
            continue
        anchor = (low[first] & np.uint64(0xFFFFFF)).astype(np.int64)
        key, mark = grams[anchor] >> np.uint64(24), np.zeros(0, np.uint64)
        if among is not None:
            at = among(key)
            first, last, anchor, key = first[at], last[at], anchor[at], key[at]
            mark = mix(rolling_hashes(part, first, last + width, sums) + (anchor - first).astype(np.uint64))
        yield row_of[begin + first].astype(np.int64), first + begin, last + begin, anchor - first, key, mark


def _packed(keys: np.ndarray) -> bytes:
    """40-bit numbers in five bytes each."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


_SENT = "bucket long, grp long, body array<binary>"
_NAMES = ["bucket", "grp", "body"]


def _table(rows: list[tuple[int, int, list[bytes]]]) -> pa.Table:
    return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.binary()))], names=_NAMES)


def _dealt(keys: np.ndarray, buckets: int):
    """(bucket, positions) of keys by bucket."""
    bucket = (keys % np.uint64(buckets)).astype(np.int64 if buckets > 1 << 16 else np.uint16)  # two bytes are sorted by counting
    order = np.argsort(bucket, kind="stable")
    for a, b in _ranges(bucket[order]):
        yield int(bucket[order[a]]), order[a:b]


def _numbered(lists: list[np.ndarray]) -> np.ndarray:
    """The number of its list beside each entry of all, in two bytes where they do."""
    return np.repeat(np.arange(len(lists), dtype=np.uint16 if len(lists) <= 1 << 16 else np.int64), [len(x) for x in lists])


def _firsts(*sorted_columns: np.ndarray) -> np.ndarray:
    """Places where any of the sorted columns changes."""
    if not len(sorted_columns[0]):
        return np.zeros(0, np.int64)
    changed = np.zeros(len(sorted_columns[0]), bool)
    changed[0] = True
    for c in sorted_columns:
        changed[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(changed)


def _ranges(*sorted_columns: np.ndarray):
    """(begin, end) of the runs of equal values."""
    first = _firsts(*sorted_columns)
    return zip(first, [*first[1:], len(sorted_columns[0])], strict=False)


def _spans(first: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(first, n))


def _bodies(table: pa.Table, *parts: int) -> list[np.ndarray]:
    """Concatenated parts of all bodies as raw bytes objects, by part."""
    bodies = table.column("body").to_pylist()
    return [b"".join(b[p] for b in bodies) for p in parts]


def _by_kind(told: pa.Table) -> list[pa.Table]:
    """What buckets told a group: shared anchors, settled segments, sorted strings."""
    kinds = told.column("kind").to_numpy(zero_copy_only=False)
    return [told.filter(pa.array(kinds == k)) for k in range(3)]


class Steps:
    """The work of groups and buckets; ``width`` is the string length, ``buckets`` their number."""

    def __init__(self, width: int, buckets: int, hot: int):
        self.width, self.buckets, self.hot = width, buckets, hot

    def name_anchors(self, key, table):
        found = Anchors(table, self.width)
        order = np.argsort(found.key)
        keys, docs = found.key[order], found.docs[found.row][order]
        first = _firsts(keys)
        if not len(first):
            return _table([])
        single = keys[first]
        several = single[np.minimum.reduceat(docs, first) != np.maximum.reduceat(docs, first)]
        group = key[0].as_py()
        own = dict(_dealt(several, self.buckets))
        return _table([(b, group, [_packed(single[at]), _packed(several[own[b]]) if b in own else b""]) for b, at in _dealt(single, self.buckets)])

    def find_shared(self, key, table):
        """Body for a group: anchors that another document has too, and those of them that are hot."""
        bodies, groups = table.column("body").to_pylist(), table.column("grp").to_numpy()
        lists = [_unpacked(b[0]) for b in bodies]
        keys, of = np.concatenate(lists), _numbered(lists)
        several = np.unique(_unpacked(b"".join(b[1] for b in bodies)))
        order = np.argsort(keys)
        keys, of = keys[order], of[order]
        first = _firsts(keys)
        count = _spans(first, len(keys))
        shared = (count > 1) | np.isin(keys[first], several, assume_unique=True)
        hot = np.repeat(count >= self.hot, count)
        shared = np.repeat(shared, count)
        keys, of, hot = keys[shared], of[shared], hot[shared]
        by = np.argsort(of, kind="stable")
        rows = []
        for a, b in _ranges(of[by]):
            at = by[a:b]
            rows.append((key[0].as_py(), int(groups[of[at[0]]]), [_packed(keys[at]), _packed(keys[at[hot[at]]])]))
        return _table(rows)

    def _shared(self, table: pa.Table, shared: pa.Table) -> Anchors:
        keys, hot = (np.sort(_unpacked(x)) for x in _bodies(shared, 0, 1))
        found = Anchors(table, self.width, keys)
        if len(hot):
            found.split(np.isin(found.key, hot))
        return found

    def send_segments(self, key, table, told):
        """Body for a bucket: key, mark and smallest doc_id of each distinct shared segment."""
        shared, _, _ = _by_kind(told)
        if not table.num_rows:
            return _table([])
        found = self._shared(table, shared)
        docs = found.docs[found.row].astype(np.int64)
        order = np.argsort(found.mark)
        first = _firsts(found.mark[order], found.key[order])
        if not len(first):
            return _table([])
        docs, order = np.minimum.reduceat(docs[order], first), order[first]
        keys, marks = found.key[order], found.mark[order]
        group = key[0].as_py()
        return _table([(b, group, [_packed(keys[at]), marks[at].tobytes(), docs[at].tobytes()]) for b, at in _dealt(keys, self.buckets)])

    def _compared(self, table: pa.Table):
        """All segments sent to a bucket, sorted by (key, mark), with first of each mark and whether its key has several marks."""
        bodies, groups = table.column("body").to_pylist(), table.column("grp").to_numpy()
        lists = [_unpacked(b[0]) for b in bodies]
        keys, of = np.concatenate(lists), _numbered(lists)
        marks = np.frombuffer(b"".join(b[1] for b in bodies), np.uint64)
        docs = np.frombuffer(b"".join(b[2] for b in bodies), np.int64)
        # A key and what of a mark fits beside it are one number; only where that does not tell marks apart are both sorted.
        word = (keys << np.uint64(24)) | (marks >> np.uint64(40))
        order = np.argsort(word)
        if len(_firsts(word[order], marks[order])) > len(_firsts(word[order])):
            order = np.lexsort((marks, keys))
        keys, marks, docs, of = keys[order], marks[order], docs[order], of[order]
        first = _firsts(keys, marks)
        count = _spans(first, len(keys))
        key_first = _firsts(keys[first])
        open_ = np.repeat(_spans(key_first, len(first)) > 1, _spans(key_first, len(first)))
        return groups, marks, docs, of, first, count, open_

    def settle(self, key, table):
        """Bodies for groups: [marks, smallest doc_ids, marks whose text is asked for]. Only what a group cannot know itself."""
        groups, marks, docs, of, first, count, open_ = self._compared(table)
        least = np.repeat(np.minimum.reduceat(docs, first), count) if len(first) else docs
        told = (docs > least) & ~np.repeat(open_, count)
        asked, holders = np.zeros(len(marks), bool), np.flatnonzero(docs == least)
        asked[holders[_firsts(np.repeat(np.arange(len(first)), count)[holders])][open_]] = True  # one that has the smallest
        some = np.flatnonzero(told | asked)
        some = some[np.argsort(of[some], kind="stable")]
        rows = []
        for a, b in _ranges(of[some]):
            at = some[a:b]
            t, q = at[told[at]], at[asked[at]]
            rows.append((key[0].as_py(), int(groups[of[at[0]]]), [marks[t].tobytes(), least[t].tobytes(), marks[q].tobytes()]))
        return _table(rows)

    def send_texts(self, key, table, told):
        """Body for a bucket: mark, doc_id, length and text of the segments it asked for."""
        shared, settled, _ = _by_kind(told)
        marks = np.frombuffer(b"".join(b[2] for b in settled.column("body").to_pylist()), np.uint64) if settled.num_rows else np.zeros(0, np.uint64)
        if not table.num_rows or not len(marks):
            return _table([])
        found = self._shared(table, shared)
        docs = found.docs[found.row].astype(np.int64)
        found_at = np.flatnonzero(np.isin(found.mark, marks))
        order = found_at[np.lexsort((docs[found_at], found.mark[found_at]))]
        order = order[_firsts(found.mark[order])]
        rows = []
        for b, at in _dealt(found.key[order], self.buckets):
            at = order[at]
            texts = [self.texts_of(found, i) for i in at]
            rows.append((b, key[0].as_py(), [found.mark[at].tobytes(), docs[at].tobytes(), np.array([len(t) for t in texts], np.int64).tobytes(), b"".join(texts), _packed(found.key[at])]))
        return _table(rows)

    def texts_of(self, found: Anchors, i: int) -> bytes:
        return found.texts[found.piece[i]][1][found.low[i]: found.high[i] + self.width].tobytes()

    def sort_suffixes(self, key, texts, segments):
        """Bodies for groups: [marks, numbers of strings, smallest doc_id of each string] of segments whose text was asked for."""
        if not texts.num_rows:
            return _table([])
        raw_marks, raw_docs, raw_lengths, body, raw_keys = _bodies(texts, 0, 1, 2, 3, 4)
        marks, docs, lengths = np.frombuffer(raw_marks, np.uint64), np.frombuffer(raw_docs, np.int64), np.frombuffer(raw_lengths, np.int64)
        keys, data = _unpacked(raw_keys), np.frombuffer(body, np.uint8)
        starts = np.cumsum(lengths) - lengths
        order = np.lexsort((marks, keys))  # the same arrays whatever order texts came in
        found, part, held = [], [], 0
        for a, b in _ranges(keys[order]):
            part.append(order[a:b])
            held += int(lengths[order[a:b]].sum())
            if held >= SORT_BYTES or b == len(order):
                at = np.concatenate(part)
                found.append((at, _earliest_holders(data, starts[at], lengths[at], docs[at], self.width)))
                part, held = [], 0
        at, least = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
        strings = lengths[at] - self.width + 1
        marks, ends = marks[at], np.cumsum(strings)
        by_mark = np.argsort(marks, kind="stable")

        groups, sent, sent_docs, by_group, _, _, _ = self._compared(segments)
        spot = by_mark[np.minimum(np.searchsorted(marks[by_mark], sent), len(marks) - 1)]
        # A group's own smallest doc_id settles a segment whose strings no smaller document has.
        earliest = np.minimum.reduceat(least, ends - strings)
        some = np.flatnonzero((marks[spot] == sent) & (earliest[spot] < sent_docs))
        some = some[np.argsort(by_group[some], kind="stable")]
        rows = []
        for a, b in _ranges(by_group[some]):
            mine = some[a:b]
            k = spot[mine]
            values = np.concatenate([least[ends[i] - strings[i]: ends[i]] for i in k])
            rows.append((key[0].as_py(), int(groups[by_group[mine[0]]]), [sent[mine].tobytes(), strings[k].tobytes(), values.tobytes()]))
        return _table(rows)

    def cut(self, key, table, told):
        """The result of each document of a group."""
        shared, settled, sorted_ = _by_kind(told)
        found = self._shared(table, shared)
        docs = found.docs[found.row].astype(np.int64)
        # What the group knows itself, what buckets settled, and what sorting found.
        least = np.full(len(docs), _NONE, np.int64)
        order = np.argsort(found.mark)
        first = _firsts(found.mark[order])
        if len(first):
            least[order] = np.repeat(np.minimum.reduceat(docs[order], first), _spans(first, len(order)))
        if settled.num_rows:
            raw_marks, raw_least = _bodies(settled, 0, 1)
            _lower(least, found.mark, np.frombuffer(raw_marks, np.uint64), np.frombuffer(raw_least, np.int64))
        change = [np.zeros(len(data) + 1, np.int64) for _, data, _ in found.texts]
        self._mark(change, found.piece, found.low, found.high, least < docs)
        if sorted_.num_rows:
            raw_marks, raw_counts, raw_least = _bodies(sorted_, 0, 1, 2)
            marks, counts, values = np.frombuffer(raw_marks, np.uint64), np.frombuffer(raw_counts, np.int64), np.frombuffer(raw_least, np.int64)
            by = np.argsort(marks, kind="stable")
            spot = by[np.minimum(np.searchsorted(marks[by], found.mark), len(by) - 1)]
            hit = np.flatnonzero(marks[spot] == found.mark)
            count = counts[spot[hit]]
            old = np.repeat(hit, count)
            step = np.arange(len(old)) - np.repeat(np.cumsum(count) - count, count)
            value = values[np.repeat((np.cumsum(counts) - counts)[spot[hit]], count) + step]
            low = found.low[old] + step
            self._mark(change, found.piece[old], low, low, value < docs[old])
        out: list[tuple] = []
        ids = table.column("doc_id").to_pylist()
        for (first_row, data, offsets), delta in zip(found.texts, change, strict=True):
            gone = np.cumsum(delta[:-1]) > 0
            for k in range(len(offsets) - 1):
                a, b = offsets[k], offsets[k + 1]
                mask = gone[a:b]
                spans = int(mask[0]) + int(np.count_nonzero(mask[1:] & ~mask[:-1])) if b > a else 0
                rest = data[a:b][~mask].tobytes()
                out.append((ids[first_row + k], int(b - a), int(mask.sum()), spans, hashlib.sha256(rest).hexdigest()))
        names, kinds = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], [pa.int64()] * 4 + [pa.string()]
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=names)

    def _mark(self, change: list[np.ndarray], piece: np.ndarray, low: np.ndarray, high: np.ndarray, gone: np.ndarray) -> None:
        for k, delta in enumerate(change):
            at = np.flatnonzero(gone & (piece == k)) if len(change) > 1 else np.flatnonzero(gone)
            np.add.at(delta, low[at], 1)
            np.add.at(delta, high[at] + self.width, -1)


def _earliest_holders(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, docs: np.ndarray, width: int) -> np.ndarray:
    """The smallest doc_id that has each string of the texts, text by text in their order."""
    # Texts one behind the other, each closed by a 1; bytes count from 2, the end mark is 0.
    inner = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    place = np.cumsum(lengths + 1) - lengths - 1
    s = np.ones(int(lengths.sum()) + len(lengths) + 1, np.int64)
    s[-1] = 0
    s[np.repeat(place, lengths) + inner] = data[np.repeat(starts, lengths) + inner].astype(np.int64) + 2
    array = suffix_array(s, 258)
    shared = common_prefixes(s, array, width)
    strings = lengths - width + 1
    of = np.repeat(np.arange(len(lengths)), strings)
    at = np.repeat(place, strings) + np.arange(len(of)) - np.repeat(np.cumsum(strings) - strings, strings)
    family = np.empty(len(s), np.int64)
    family[array] = np.cumsum(shared[array] < width)
    least = np.full(len(s) + 1, _NONE, np.int64)
    np.minimum.at(least, family[at], docs[of])
    return least[family[at]]


def _lower(least: np.ndarray, marks: np.ndarray, told: np.ndarray, values: np.ndarray) -> None:
    order = np.argsort(told, kind="stable")
    if len(order):
        spot = order[np.minimum(np.searchsorted(told[order], marks), len(order) - 1)]
        hit = told[spot] == marks
        least[hit] = np.minimum(least[hit], values[spot[hit]])


def without_repeats(docs: DataFrame, width: int = WIDTH, group_bytes: int = GROUP_BYTES, bucket_anchors: int = BUCKET_ANCHORS, hot_groups: int = HOT_GROUPS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row of ``docs``.

    Removed is each byte of a ``width``-byte string that also starts in a document with a smaller
    doc_id. Null text is empty. Rows with the same doc_id are one document: they cost each other
    nothing. Rows without doc_id take no part and lose nothing.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    groups = max(24, -(-size // group_bytes))
    steps = Steps(width, max(24, -(-size // (13 * bucket_anchors))), hot_groups)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = rows.where("doc_id IS NOT NULL").withColumn("grp", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(groups)))
    texts = dealt.groupBy("grp")

    def told(*messages: DataFrame):
        found = [m.select("grp", F.lit(kind).alias("kind"), "body") for kind, m in enumerate(messages)]
        whole = found[0]
        for m in found[1:]:
            whole = whole.unionByName(m)
        return whole.groupBy("grp")

    named = texts.applyInArrow(lambda k, t: steps.name_anchors(k, t), _SENT)
    shared = named.groupBy("bucket").applyInArrow(lambda k, t: steps.find_shared(k, t), _SENT)
    segments = texts.cogroup(told(shared)).applyInArrow(lambda k, t, m: steps.send_segments(k, t, m), _SENT)
    settled = segments.groupBy("bucket").applyInArrow(lambda k, t: steps.settle(k, t), _SENT)
    asked = texts.cogroup(told(shared, settled)).applyInArrow(lambda k, t, m: steps.send_texts(k, t, m), _SENT)
    sorted_ = asked.groupBy("bucket").cogroup(segments.groupBy("bucket")).applyInArrow(lambda k, t, m: steps.sort_suffixes(k, t, m), _SENT)
    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    cut = texts.cogroup(told(shared, settled, sorted_)).applyInArrow(lambda k, t, m: steps.cut(k, t, m), result)
    apart = rows.where("doc_id IS NULL").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )
    return cut.unionByName(apart)
