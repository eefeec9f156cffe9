"""Near-duplicate documents: MinHash bands propose pairs, a sequential Bayesian test prunes them, full sets decide.

Sets are distinct five-word shingles as 64-bit hashes. Documents with the same set form a class and go on
as one representative. A pair of representatives in a common bucket is compared on its signatures in
batches of hashes: after n hashes with m matches it is dropped if the posterior probability (uniform
prior) of a similarity at the threshold or above is below the chosen miss probability. Survivors are
verified exactly on the full sets; only verified links join documents.

No bucket emits all its pairs. Representatives connected by common buckets are a candidate cluster, and all links
lie inside clusters. Members of a cluster meet block by block, inside tasks that emit nothing but verified links.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.components import components
from ordermill.llm.storage import kept
from ordermill.llm.text import lowered, mix, pieces, span_hashes, words

WORDS = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 85
BANDS, ROWS = 25, 5
HASHES = BANDS * ROWS
#: Hashes per batch of the sequential test and its miss probability.
BATCH, MISS = 25, 1e-6
BLOCK = 1024
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * _STEP) | np.uint64(1)
_SHIFTS = mix(np.arange(1001, HASHES + 1001, dtype=np.uint64) * _STEP)


def shingle_sets(column: pa.Array, width: int = WORDS):
    """For each row of a text column: its shingles as sorted distinct 64-bit hashes.

    Fewer than ``width`` words make one shingle of the whole sequence; no words, no shingle.
    """
    for _, _, data, offsets in pieces(column):
        data = lowered(data)
        starts, ends, rows = words(data, offsets)
        hashed = span_hashes(data, starts, ends)
        n = len(hashed)
        rolled = np.zeros(max(0, n - width + 1), np.uint64)
        for k in range(width):
            rolled = mix((rolled + np.uint64(k + 1)) * _STEP + hashed[k: n - width + 1 + k])
        for a, b in zip(rows[:-1], rows[1:], strict=True):
            if b - a >= width:
                yield np.unique(rolled[a: b - width + 1])
            elif b > a:
                short = np.array([b - a], np.uint64)
                for k in range(a, b):
                    short = mix((short ^ np.uint64(0xA5)) * _STEP + hashed[k: k + 1])
                yield short
            else:
                yield np.zeros(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Smallest value of each hash function over the set (32 bits each); the set is not empty."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 512):
        part = shingles[at: at + 512]
        np.minimum(low, (part[None, :] * _SEEDS[:, None] + _SHIFTS[:, None]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def fewest_matches(percent: int = PERCENT, miss: float = MISS, bits: int = 8) -> list[tuple[int, int]]:
    """(n, fewest matches among the first n hashes that keep a pair) per batch.

    With a uniform prior, P(similarity >= t | m of n) = P(Binomial(n + 1, t) <= m). Hashes are
    compared on ``bits`` bits, so unequal ones match with probability 2**-bits more; as that only adds
    matches, the bound stays safe.
    """
    t = percent / 100
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def _features(batches):
    for batch in batches:
        ids = batch.column("doc_id")
        rows: list[tuple] = []
        for at, shingles in enumerate(shingle_sets(batch.column("text"))):
            if len(shingles):
                low = signature(shingles)
                bands = np.zeros(BANDS, np.uint64)
                for k in range(ROWS):
                    bands = mix((bands + np.arange(BANDS, dtype=np.uint64)) * _STEP + low.reshape(BANDS, ROWS)[:, k])
                one, two = mix(shingles).sum(dtype=np.uint64), mix(shingles ^ _STEP).sum(dtype=np.uint64)
                rows.append((len(shingles), int(one.view(np.int64)), int(two.view(np.int64)), (low & np.uint32(255)).astype(np.uint8).tobytes(), bands.view(np.int64)))
            else:
                rows.append((0, 0, 0, b"", np.zeros(0, np.int64)))
            if len(rows) == 2000 or at + 1 == batch.num_rows:
                yield pa.RecordBatch.from_arrays([
                    ids.slice(at + 1 - len(rows), len(rows)),
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
                    pa.array([r[3] for r in rows], pa.binary()), pa.array([r[4] for r in rows], pa.list_(pa.int64())),
                ], names=["doc_id", "n_shingles", "mark_a", "mark_b", "sig", "bands"])
                rows = []


def _verified(percent: int, bounds: list[tuple[int, int]]):
    """Links found between the two blocks of a group (or inside its one block), fewest that join what they join."""
    def run(key, table):
        block_a, block_b = key[1].as_py(), key[2].as_py()
        block = table.column("block").to_numpy()
        ids = table.column("rep").to_numpy()
        order = np.lexsort((ids, -table.column("copies").to_numpy()))
        sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(-1, HASHES)
        sets = list(shingle_sets(table.column("text")))
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        root = np.arange(len(ids))
        links = []
        for place, i in enumerate(order):
            rest = order[place + 1:]
            if block_a != block_b:
                rest = rest[block[rest] != block[i]]
            rest = rest[root[rest] != root[i]]
            # Sizes alone bound the similarity; then batches of hashes.
            rest = rest[100 * np.minimum(sizes[rest], sizes[i]) >= percent * np.maximum(sizes[rest], sizes[i])]
            matches, seen = np.zeros(len(rest), np.int64), 0
            for n, fewest in bounds:
                matches += (sigs[rest, seen:n] == sigs[i, seen:n]).sum(axis=1)
                alive = matches >= fewest
                rest, matches, seen = rest[alive], matches[alive], n
                if not len(rest):
                    break
            for j in rest:
                if root[i] == root[j]:
                    continue
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * common >= percent * (sizes[i] + sizes[j] - common):
                    links.append((int(ids[i]), int(ids[j])))
                    root[root == root[j]] = root[i]
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return run


def clustered(docs: DataFrame, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links, ``kept`` is true for that
    document. A document without words is linked with nothing. Rows with the same doc_id are one
    document; rows without doc_id are linked with nothing and kept (component_id null).
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    features = kept(texts.mapInArrow(_features, "doc_id long, n_shingles long, mark_a long, mark_b long, sig binary, bands array<long>"), "shingle-features")
    marks = ["n_shingles", "mark_a", "mark_b"]
    known = features.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = kept(known.groupBy(*marks).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "shingle-classes")
    reps = known.join(classes, marks).where("doc_id = rep").dropDuplicates([*marks, "rep"]).select("rep", "copies", "sig", "bands")
    reps = kept(reps, "shingle-reps")

    # Candidate clusters: representatives connected by common buckets. All links lie inside them.
    buckets = reps.select("rep", F.explode("bands").alias("bucket"))
    leaders = kept(buckets.groupBy("bucket").agg(F.min("rep").alias("leader"), F.max("rep").alias("last")).where("leader <> last").select("bucket", "leader"), "bucket-leaders")
    stars = buckets.join(leaders, "bucket").where("rep <> leader").select(F.col("rep").alias("a"), F.col("leader").alias("b"))
    members = components(stars)
    sizes = kept(members.groupBy("component").agg(F.count("*").alias("size")), "cluster-sizes")
    width = F.greatest(F.lit(64), F.least(F.lit(BLOCK), F.ceil(F.col("size") / 32)))
    members = members.join(sizes, "component").select(
        F.col("node"), F.col("component").alias("cluster"), F.ceil(F.col("size") / width).cast("int").alias("blocks")
    ).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))

    # A member travels once per other block of its cluster; a cluster of one block is one small group.
    held = reps.join(members, F.col("rep") == F.col("node")).select("rep", "copies", "sig", "cluster", "blocks", "block")
    held = held.join(texts, F.col("rep") == F.col("doc_id")).select("rep", "copies", "sig", "cluster", "blocks", "block", "text")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = held.withColumn("other", other).select(
        "cluster", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "rep", "copies", "sig", "text"
    )
    links = kept(spread.groupBy("cluster", "one", "two").applyInArrow(_verified(percent, fewest_matches(percent, miss)), "a long, b long"), "verified-links")

    # Rows with the same doc_id link their classes, and a row without words goes where the others are.
    again = kept(features.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("again_id")), "repeated-ids")
    classed = features.select("doc_id", *marks).join(classes.select(*marks, "rep"), marks, "left")
    of_again = kept(classed.join(again, F.col("doc_id") == F.col("again_id")).select("again_id", "rep").where("rep IS NOT NULL").distinct(), "repeated-classes")
    first = of_again.groupBy("again_id").agg(F.min("rep").alias("first_rep"))
    links = links.unionByName(of_again.join(first, "again_id").select(F.col("rep").alias("a"), F.col("first_rep").alias("b")))
    joined = components(links).select(F.col("node").alias("rep"), "component")
    first = first.select(F.col("again_id").alias("doc_id"), "first_rep")

    placed = classed.join(first, "doc_id", "left").withColumn("rep", F.coalesce("rep", "first_rep")).join(joined, "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
