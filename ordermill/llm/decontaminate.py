"""Benchmark decontamination on templates: re-parameterised questions match too.

A text becomes template tokens: numbers, units and names turn into typed placeholders (a run of the same
type is one), other words are lower-cased. Windows of template tokens are hashed and joined with those of
the benchmark. A matching window also carries its slots (what stood at each placeholder). For one document
and item at one alignment, slot values must be consistent: one benchmark value always goes to the same document value.
An item is found when matching windows cover enough of its tokens.

Windows of lower-cased words, without placeholders, are joined beside them: they find every verbatim copy, also where
numbers or names are dense, where an item is shorter than a window, and where a document has another case.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.storage import kept
from ordermill.llm.text import lowered, mix, pieces, runs, span_hashes

#: Tokens in a window (a shorter item is one window of its own length), and how many tokens of a template must be plain words (not placeholders).
WINDOW, PLAIN = 8, 5
#: Tokens of an item that have to be covered: all, or this many for longer items.
COVERED = 13
#: Bits of the filter of benchmark windows that goes to every task (2 MB).
FILTER_BITS = 1 << 24

#: Units that become placeholders (fixed values).
UNITS = (
    "mm cm dm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "mg g kg t lb lbs oz gram grams kilogram kilograms ton tons pound pounds ounce ounces ml cl l liter liters litre litres gallon gallons "
    "ms s sec secs min mins h hr hrs second seconds minute minutes hour hours day days week weeks month months year years "
    "usd eur gbp dollar dollars euro euros cent cents percent kmh mph hz khz mhz ghz w kw v j kj n pa kpa"
).split()

_PLAIN, _NUMBER, _UNIT, _NAME = 0, 1, 2, 3
#: Ways to read an item: its template, its template with the first word as a name, its words.
_TEMPLATE, _NAMED, _WORDS = 0, 1, 2
_MARKS = mix(np.arange(1, 5, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
_STEP = np.uint64(0x9E3779B97F4A7C15)

_TOKEN = np.zeros(256, bool)
_TOKEN[128:] = True
for _a, _b in ("09", "AZ", "az"):
    _TOKEN[ord(_a): ord(_b) + 1] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0"): ord("9") + 1] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A"): ord("Z") + 1] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:\n"]] = True

_unit_hashes: list[np.ndarray] = []


def _units() -> np.ndarray:
    if not _unit_hashes:
        data = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
        starts, ends, _ = runs(_TOKEN[data], np.array([0, len(data)]))
        _unit_hashes.append(np.unique(span_hashes(data, starts, ends)))
    return _unit_hashes[0]


def _sorted_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    place = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[place] == values


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of letters and digits that do not cross rows, as in ``runs``. Spaces and punctuation outside ASCII divide like those inside."""
    inside = _TOKEN[data]
    lead = np.flatnonzero(data >= 0xC2)
    lead = lead[lead + 1 < len(data)]
    one, two = data[lead + 1], data[np.minimum(lead + 2, len(data) - 1)]
    # U+0080..U+00BF but for its letters, U+00D7, U+00F7; U+2000..U+206F; U+3000..U+303F but for U+3005..U+3007; full-width marks.
    short = lead[((data[lead] == 0xC2) & ~np.isin(one, (0xAA, 0xB5, 0xBA))) | ((data[lead] == 0xC3) & np.isin(one, (0x97, 0xB7)))]
    general = (data[lead] == 0xE2) & ((one == 0x80) | ((one == 0x81) & (two < 0xB0)))
    eastern = (data[lead] == 0xE3) & (one == 0x80) & ~np.isin(two, (0x85, 0x86, 0x87))
    wide = (data[lead] == 0xEF) & (one == 0xBC) & ((two < 0x90) | ((two >= 0x9A) & (two < 0xA1)))
    long = lead[(general | eastern | wide) & (lead + 2 < len(data))]
    for k in range(2):
        inside[short + k] = False
    for k in range(3):
        inside[long + k] = False
    return runs(inside, offsets)


def _lower_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each token's own lower case, which may have another length in bytes."""
    value = span_hashes(lowered(data), starts, ends)
    foreign = np.concatenate([[0], np.cumsum(data >= 128)])
    chosen = np.flatnonzero(foreign[ends] > foreign[starts])
    if len(chosen):
        inside = np.zeros(len(data) + 1, np.int8)
        inside[starts[chosen]] += 1
        inside[ends[chosen]] -= 1
        held = data[np.cumsum(inside[:-1], dtype=np.int8) == 1]
        bounds = np.concatenate([[0], np.cumsum(ends[chosen] - starts[chosen])]).astype(np.int64)
        small = pc.utf8_lower(pa.LargeStringArray.from_buffers(len(chosen), pa.py_buffer(bounds), pa.py_buffer(held)))
        found = [span_hashes(low, at[:-1], at[1:]) for _, _, low, at in pieces(small)]
        value[chosen] = np.concatenate(found)
    return value


def template(
    data: np.ndarray, value: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, first_named: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Template tokens of consecutive rows, given as tokens and their hashes: (token hash, type, slot value hash, first token of each row and their number, may be a name).

    A number is a token with a digit in front; a unit is a known unit word behind a number; a name
    is a word with a capital first and a small letter next that does not begin a sentence. Such a word that does
    may be a name; with ``first_named`` it is one where it begins a row. Runs of
    numbers (also across points) or of names are one token.
    """
    if not len(starts):
        empty = np.zeros(0, np.uint64)
        return empty, np.zeros(0, np.int8), empty, rows, np.zeros(0, bool)
    kind = np.zeros(len(starts), np.int8)
    number = _DIGIT[data[starts]]
    kind[number] = _NUMBER
    first = np.zeros(len(starts), bool)
    first[rows[:-1][rows[:-1] < len(starts)]] = True
    after_number = np.zeros(len(starts), bool)
    after_number[1:] = number[:-1] & ~first[1:]
    unit = np.flatnonzero(after_number & ~number)
    kind[unit[_sorted_in(value[unit], _units())]] = _UNIT
    capital = np.flatnonzero(_UPPER[data[starts]] & (ends - starts > 1) & (kind == _PLAIN))
    capital = capital[~_UPPER[data[starts[capital] + 1]] & ~_DIGIT[data[starts[capital] + 1]]]
    # A stop between the token before and this one begins a sentence.
    stops = np.concatenate([[0], np.cumsum(_STOP[data])])
    begins = first[capital] | (stops[starts[capital]] != stops[ends[capital - 1]])
    named = ~begins | first[capital] if first_named else ~begins
    kind[capital[named]] = _NAME
    either = np.zeros(len(starts), bool)
    either[capital[~named]] = True
    follows = np.zeros(len(starts), bool)
    follows[1:] = (kind[1:] == kind[:-1]) & (kind[1:] != _PLAIN) & ~first[1:]
    begin = np.flatnonzero(~follows)
    group = np.cumsum(~follows) - 1
    place = (np.arange(len(starts)) - begin[group]).astype(np.uint64)
    slot = np.add.reduceat(mix(value + place * _STEP), begin)
    kind = kind[begin]
    token = np.where(kind == _PLAIN, value[begin], _MARKS[kind])
    return token, kind, slot, np.searchsorted(begin, rows), either[begin]


def _windows(token: np.ndarray, kind: np.ndarray, rows: np.ndarray, widths: list[int], plain: int, salt: int = 0, either: np.ndarray | None = None):
    """(width, first token, row, hash, its first word is read as a name) of all windows inside one row that hold enough plain words."""
    total = len(token)
    owner = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    left = rows[owner + 1] - np.arange(total)
    words = np.concatenate([[0], np.cumsum(kind == _PLAIN)])
    rolled = np.full(total, salt, np.uint64)
    turned_at = np.flatnonzero(either) if either is not None else np.zeros(0, np.int64)
    turned = np.full(len(turned_at), salt, np.uint64)
    for width in range(1, max(widths, default=0) + 1):
        n = total - width + 1
        if n <= 0:
            return
        rolled = mix((rolled[:n] + np.uint64(width)) * _STEP + token[width - 1:])
        fits = left[turned_at] >= width
        turned_at, turned = turned_at[fits], turned[fits]
        turned = mix((turned + np.uint64(width)) * _STEP + (token[turned_at + width - 1] if width > 1 else _MARKS[_NAME]))
        if width in widths:
            held = words[width:] - words[:n]
            at = np.flatnonzero((held >= plain) & (left[:n] >= width))
            yield width, at, owner[at], rolled[at], False
            fine = held[turned_at] > plain
            yield width, turned_at[fine], owner[turned_at[fine]], turned[fine], True


_SCHEMA = "id long, way int, width int, tokens int, at int, window long, slots array<long>"


def _all_windows(width: int, plain: int, asked: dict[bool, list[int]] | None = None, shared=None):
    """Rows (id, way of reading, width, tokens of the text, first token, window hash, slot values).

    Of items, all windows, in all ways; a text shorter than ``width`` is one window. Of documents, windows of the widths in
    ``asked`` (by whether they are of words alone) that the filter knows.
    """
    every = list(range(1, width + 1))

    def read(data, offsets):
        """(way, windows, slots, types, first token of each row)"""
        starts, ends, rows = _tokens(data, offsets)
        value = _lower_hashes(data, starts, ends)
        for way in (_TEMPLATE, _NAMED) if asked is None else (_TEMPLATE,):
            token, kind, slot, at, either = template(data, value, starts, ends, rows, way == _NAMED)
            yield way, _windows(token, kind, at, every if asked is None else asked[False], plain, 0, either if asked is not None else None), slot, kind, at
        kind = np.zeros(len(starts), np.int8)
        yield _WORDS, _windows(value, kind, rows, every if asked is None else asked[True], 0, 1), value, kind, rows

    def run(batches):
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            for first, _, data, offsets in pieces(batch.column("text")):
                for way, windows, slot, kind, rows in read(data, offsets):
                    for wide, at, owner, hashed, named in windows:
                        if asked is None:
                            size = rows[owner + 1] - rows[owner]
                            fine = (size == wide) | (wide == width)
                            if way == _NAMED:
                                fine &= kind[rows[owner]] == _NAME
                        else:
                            fine = _filter_has(np.frombuffer(shared.value, np.uint8), hashed)
                        at, owner, hashed = at[fine], owner[fine], hashed[fine]
                        for k in range(0, len(at), 50_000):
                            a, o, h = at[k: k + 50_000], owner[k: k + 50_000], hashed[k: k + 50_000]
                            held = kind != _PLAIN
                            slots = []
                            for i in a:
                                open_ = held[i: i + wide]
                                if named:
                                    open_ = open_.copy()
                                    open_[0] = True
                                slots.append(slot[i: i + wide][open_].view(np.int64))
                            yield pa.RecordBatch.from_arrays([
                                pa.array(ids[first + o], pa.int64()), pa.array(np.full(len(a), way), pa.int32()), pa.array(np.full(len(a), wide), pa.int32()),
                                pa.array(rows[o + 1] - rows[o], pa.int32()), pa.array(a - rows[o], pa.int32()), pa.array(h.view(np.int64)), pa.array(slots, pa.list_(pa.int64())),
                            ], names=["id", "way", "width", "tokens", "at", "window", "slots"])

    return run


def _bit(hashed: np.ndarray) -> np.ndarray:
    return hashed % np.uint64(FILTER_BITS)


def _filter_has(bits: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    b = _bit(hashed)
    return (bits[(b >> np.uint64(3)).astype(np.int64)] >> (b & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _filter(windows: DataFrame) -> bytes:
    """The filter of benchmark windows: of fixed size whatever the benchmark's; set bits travel, not windows."""
    def bits(batches):
        held = np.zeros(FILTER_BITS // 8, np.uint8)
        for batch in batches:
            b = _bit(batch.column("window").to_numpy().view(np.uint64))
            np.bitwise_or.at(held, (b >> np.uint64(3)).astype(np.int64), np.left_shift(1, (b & np.uint64(7)).astype(np.uint8)).astype(np.uint8))
        part = FILTER_BITS // 8 // 32
        yield pa.RecordBatch.from_arrays([pa.array(range(32), pa.int32()), pa.array([held[i * part: (i + 1) * part].tobytes() for i in range(32)], pa.binary())], names=["part", "bits"])

    def merged(key, table):
        held = np.bitwise_or.reduce([np.frombuffer(b.as_py(), np.uint8) for b in table.column("bits")])
        return pa.table({"part": [key[0].as_py()], "bits": [held.tobytes()]}, pa.schema([("part", pa.int32()), ("bits", pa.binary())]))

    rows = windows.select("window").mapInArrow(bits, "part int, bits binary").groupBy("part").applyInArrow(merged, "part int, bits binary").collect()
    held = {r.part: bytes(r.bits) for r in rows}
    return b"".join(held.get(i, bytes(FILTER_BITS // 8 // 32)) for i in range(32))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, plain: int = PLAIN, covered: int = COVERED) -> DataFrame:
    """(doc_id, item_id, n_windows, n_tokens, n_changed) for each document and benchmark item found in it.

    ``n_tokens`` counts the item's template tokens covered by matching windows at one alignment,
    ``n_changed`` the benchmark slot values that differ in the document. A pair that templates do not find and
    windows of words do has words in place of template tokens. An item without letters and digits is
    left out. Null texts and ids match nothing; rows with the same doc_id are one document.
    """
    spark = docs.sparkSession
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("id"), "text").distinct()
    asked = kept(items.mapInArrow(_all_windows(window, plain), _SCHEMA), "benchmark-windows")
    shared = spark.sparkContext.broadcast(_filter(asked))
    widths: dict[bool, list[int]] = {False: [], True: []}
    for r in asked.select((F.col("way") == _WORDS).alias("words"), "width").distinct().collect():
        widths[r.words].append(r.width)
    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"), "text")
    given = texts.mapInArrow(_all_windows(window, plain, widths, shared), _SCHEMA).select(F.col("id").alias("doc_id"), F.col("at").alias("doc_at"), "window", F.col("slots").alias("doc_slots"))
    matched = given.join(asked.select(F.col("id").alias("item_id"), "way", "width", "tokens", F.col("at").alias("item_at"), "window", "slots"), "window")
    # Asked for twice below; texts are read once.
    matched = kept(matched.where(F.size("slots") == F.size("doc_slots")).withColumn("shift", F.col("doc_at") - F.col("item_at")), "matched-windows")
    aligned = ["doc_id", "item_id", "way", "tokens", "shift"]

    # Values a slot takes at this alignment; the consistent one is the most frequent. Windows that say otherwise do not count.
    values = matched.select(*aligned, F.explode(F.arrays_zip("slots", "doc_slots")).alias("s")).groupBy(*aligned, "s.slots", "s.doc_slots").agg(F.count("*").alias("n"))
    best = values.groupBy(*aligned, "slots").agg(F.max(F.struct("n", "doc_slots"))["doc_slots"].alias("value"))
    mapping = best.groupBy(*aligned).agg(F.map_from_entries(F.collect_list(F.struct("slots", "value"))).alias("mapping"))
    checked = matched.join(mapping, aligned, "left").where(
        F.forall(F.arrays_zip("slots", "doc_slots"), lambda s: F.element_at("mapping", s["slots"]) == s["doc_slots"])
    )
    # A window covers what it adds to the one before it at the same alignment.
    before = F.lag("item_at").over(Window.partitionBy(*aligned).orderBy("item_at"))
    fresh = F.least("width", F.col("item_at") - F.coalesce(before, -F.col("width")))
    changed = F.size(F.filter(F.map_entries("mapping"), lambda e: e["key"] != e["value"]))
    runs_ = checked.withColumn("fresh", fresh).groupBy(*aligned).agg(
        F.count("*").alias("n_windows"), F.sum("fresh").alias("n_tokens"), F.coalesce(F.max(changed), F.lit(0)).alias("n_changed")
    )
    found = runs_.where(F.col("n_tokens") >= F.least(F.lit(covered), F.col("tokens")))
    top = F.max(F.struct((F.col("way") != _WORDS).alias("template"), "n_tokens", "n_windows", (-F.col("n_changed")).alias("same"), -F.col("shift")))
    return found.groupBy("doc_id", "item_id").agg(top.alias("t")).select(
        "doc_id", "item_id", F.col("t.n_windows").alias("n_windows"), F.col("t.n_tokens").cast("long").alias("n_tokens"), (-F.col("t.same")).cast("long").alias("n_changed")
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows and columns of ``docs`` in which no benchmark item is found; rows without doc_id stay."""
    found = contaminated(docs, benchmark, **options).select(F.col("doc_id").alias("_found_doc_id")).distinct()
    return docs.join(found, docs["doc_id"] == F.col("_found_doc_id"), "left_anti")
