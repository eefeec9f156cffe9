"""Lines that many documents repeat, found with two Bloom filters.

1. Every document's line keys are hashed. Per segment of the hash space, one pass over the hashes
   sets bits in a *once-seen* filter; a hash whose bits are all set there already goes into the
   *twice-seen* filter. Hashes travel as packed 8-byte numbers, distinct per chunk of documents.
2. The twice-seen filter (of bounded size) goes to all tasks. Only lines it knows are shuffled: they
   are grouped by the key itself, which settles the number of documents and the one that keeps
   the line. A filter that is too full for the data lets more lines through, it loses none.
3. Lost line numbers return to their rows by ``doc_id`` and a digest of the text.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.storage import kept

MIN_POINTS = 40
MIN_DOCUMENTS = 5
#: Bits of the twice-seen filter: so many per document, within these bounds (at most 128 MB to broadcast).
BITS_PER_DOCUMENT, LEAST_BITS, MOST_BITS = 256, 1 << 20, 1 << 30
#: Hashes that one segment is meant to hold, and hashes gathered by a task before they are handed on.
SEGMENT_HASHES, CHUNK_HASHES = 1 << 20, 1 << 18
_PROBES = 4
_BLANK = b" \t\n\r\x0b\x0c"


def line_keys(text: str | None, min_points: int) -> dict[bytes, list[int]]:
    """Long enough keys of a text with the numbers of their lines."""
    found: dict[bytes, list[int]] = {}
    for number, line in enumerate((text or "").encode().split(b"\n")):
        if len(line) >= min_points:
            key = line.strip(_BLANK).lower()
            if len(key) >= min_points and (key.isascii() or len(key.decode()) >= min_points):
                found.setdefault(key, []).append(number)
    return found


def _bit_numbers(hashes: np.ndarray, bits: int) -> np.ndarray:
    """One row of bit positions per probe (double hashing)."""
    one, two = hashes, (hashes >> np.uint64(32)) | np.uint64(1)
    return np.stack([(one + np.uint64(k) * two) % np.uint64(bits) for k in range(_PROBES)])


def _hashes_by_segment(min_points: int, segments: int):
    def packed(counts: Counter) -> pa.RecordBatch:
        hashes = np.fromiter(counts.keys(), np.uint64, len(counts))
        more = np.fromiter(counts.values(), np.int64, len(counts)) > 1
        segment = hashes % np.uint64(segments)
        order = np.argsort(segment, kind="stable")
        cuts = np.searchsorted(segment[order], np.arange(segments + 1))
        rows = [(s, order[a:b]) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
        return pa.RecordBatch.from_arrays([
            pa.array([s for s, _ in rows], pa.int64()),
            pa.array([hashes[i].tobytes() for _, i in rows], pa.binary()),
            pa.array([hashes[i[more[i]]].tobytes() for _, i in rows], pa.binary()),
        ], names=["segment", "hashes", "repeated"])

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                counts.update(xxhash.xxh64_intdigest(k) for k in line_keys(text.as_py(), min_points))
                if len(counts) >= CHUNK_HASHES:
                    yield packed(counts)
                    counts.clear()
        if counts:
            yield packed(counts)

    return run


def _twice_seen(segments: int, bits: int):
    def run(key, table):
        once, twice = np.zeros(bits, dtype=bool), np.zeros(bits, dtype=bool)
        for hashes, repeated in zip(table.column("hashes"), table.column("repeated"), strict=True):
            probes = _bit_numbers(np.frombuffer(hashes.as_py(), np.uint64) // np.uint64(segments), bits)
            again = once[probes].all(axis=0)
            twice[probes[:, again]] = True
            once[probes] = True
            twice[_bit_numbers(np.frombuffer(repeated.as_py(), np.uint64) // np.uint64(segments), bits)] = True
        return pa.table({"segment": [key[0].as_py()], "bits": [np.packbits(twice).tobytes()]}, pa.schema([("segment", pa.int64()), ("bits", pa.binary())]))

    return run


def _suspects(min_points: int, segments: int, bits: int, shared):
    def run(batches):
        held = np.zeros((segments, bits // 8), np.uint8)
        for s, packed in shared.value.items():
            held[s] = np.frombuffer(packed, np.uint8)
        for batch in batches:
            keys, docs, digests, lines, hashes = [], [], [], [], []
            for doc, digest, text in zip(batch.column("doc_id").to_pylist(), batch.column("digest").to_pylist(), batch.column("text"), strict=True):
                for key, numbers in line_keys(text.as_py(), min_points).items():
                    keys.append(key)
                    docs.append(doc)
                    digests.append(digest)
                    lines.append(numbers)
                    hashes.append(xxhash.xxh64_intdigest(key))
            if not keys:
                continue
            hashed = np.array(hashes, np.uint64)
            probes = _bit_numbers(hashed // np.uint64(segments), bits)
            rows = (hashed % np.uint64(segments)).astype(np.int64)
            known = ((held[rows, probes >> np.uint64(3)] >> (7 - (probes & np.uint64(7)).astype(np.uint8))) & 1).all(axis=0)
            chosen = np.flatnonzero(known)
            for at in range(0, len(chosen), 20_000):
                part = chosen[at: at + 20_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([keys[i].decode() for i in part], pa.string()),
                    pa.array([docs[i] for i in part], pa.int64()),
                    pa.array([digests[i] for i in part], pa.binary()),
                    pa.array([lines[i] for i in part], pa.list_(pa.int32())),
                ], names=["key", "doc_id", "digest", "lines"])

    return run


def text_digest() -> Column:
    return F.unhex(F.md5(F.col("text").cast("binary")))


def lost_lines(docs: DataFrame, min_points: int = MIN_POINTS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(doc_id, digest, lost array<int>): numbers of the lines each text of a document loses; texts that lose none are left out.

    A key found in ``min_documents`` documents or more stays in the largest doc_id alone. Rows
    with the same doc_id are one document, which counts once for a key that several of them hold; each row has
    its own lines, told apart by ``text_digest``. Rows without doc_id are not looked at.
    """
    spark = docs.sparkSession
    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long"), text_digest().alias("digest"), "text")
    n = docs.count()
    segments = max(24, -(-n * 24 // SEGMENT_HASHES))
    bits = min(MOST_BITS, max(LEAST_BITS, n * BITS_PER_DOCUMENT)) // segments // 8 * 8
    # One byte range of text gives few hashes: each document's distinct lines, 8 bytes a line.
    hashes = texts.select("text").mapInArrow(_hashes_by_segment(min_points, segments), "segment long, hashes binary, repeated binary")
    found = hashes.groupBy("segment").applyInArrow(_twice_seen(segments, bits), "segment long, bits binary")
    shared = spark.sparkContext.broadcast({r.segment: bytes(r.bits) for r in found.toLocalIterator()})
    suspects = kept(texts.mapInArrow(_suspects(min_points, segments, bits, shared), "key string, doc_id long, digest binary, lines array<int>"), "suspect-lines")
    # As a table of its own, so that a join partition of one very common line can be split.
    verdicts = kept(
        suspects.select("key", "doc_id").distinct().groupBy("key")
        .agg(F.count("*").alias("documents"), F.max("doc_id").alias("keeper"))
        .where(F.col("documents") >= min_documents).select("key", "keeper"),
        "shared-lines",
    )
    lost = suspects.join(verdicts, "key").where("doc_id <> keeper")
    return lost.groupBy("doc_id", "digest").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("lost"))


def without_repeated_lines(docs: DataFrame, min_points: int = MIN_POINTS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """All rows and columns of ``docs``, ``text`` without the lost lines, plus ``line_count`` and ``lines_lost``.

    Null text stays null (one empty line); a document that loses every line becomes an empty
    text. Rows without doc_id keep all their lines.
    """
    names = docs.columns
    line_count, lines_lost = (next(c for c in (f"{name}{'_' * k}" for k in range(99)) if c not in names) for name in ("line_count", "lines_lost"))
    lost = lost_lines(docs, min_points, min_documents).select(F.col("doc_id").alias("_lost_doc_id"), F.col("digest").alias("_lost_digest"), F.col("lost").alias("_lost_lines"))
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    numbers = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_lost_lines"))
    shorter = F.array_join(F.transform(numbers, lambda i: F.get(lines, i)), "\n")
    joined = docs.join(lost, (docs["doc_id"] == F.col("_lost_doc_id")) & (text_digest() == F.col("_lost_digest")), "left")
    return joined.select(
        *[F.when(F.col("_lost_lines").isNotNull(), shorter).otherwise(F.col("text")).alias("text") if c == "text" else docs[c] for c in names],
        F.size(lines).cast("long").alias(line_count),
        F.coalesce(F.size("_lost_lines"), F.lit(0)).cast("long").alias(lines_lost),
    )
