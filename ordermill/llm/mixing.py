"""Mixing sources to target weights with exact block quotas.

A source is one stream of words: its documents in a drawn order, cut into equal blocks. Its target
becomes a number of block draws. A splitting tree over the output shards halves the draws again and
again; each split is one multivariate hypergeometric draw over the sources, so shards get exact,
jointly drawn quotas that add up to the source's draws. A source's blocks are permuted once per pass
over it, and each shard takes the run of permuted blocks its quotas say: no two shards share a draw.
Inside a shard, pieces are put in a drawn order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.storage import kept
from ordermill.operators.ordering import running_total

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
#: Words in a block at most; a source is cut into at least FEWEST_BLOCKS where it has the words.
BLOCK_WORDS, FEWEST_BLOCKS = 1024, 256
#: Words an output shard is meant to hold.
SHARD_WORDS = 16_000_000
_RANGE = 1 << 31
#: Standard deviations around the mode that a draw from an urn looks at.
REACH = 12


def sized(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size (its words), and a number that stands for the source."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per source: source, weight, source_size, target, and the cut into blocks.

    Targets share all words by weight; a source never gets more than ``most`` times its words,
    and what it cannot take is shared again among the rest. With r = most * size / weight sorted
    upwards, the sources before the first whose r is above the remaining share per weight are full.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    listed = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    listed = listed.withColumn("place", F.row_number().over(order) - 1).withColumn(
        "weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("place", F.lit(len(weights))).cast("int"))
    )
    everything = Window.partitionBy(F.lit(0))
    upward = Window.partitionBy(F.lit(0)).orderBy(F.col("source_size") / F.col("weight"), "place")
    before = upward.rowsBetween(Window.unboundedPreceding, -1)
    limit = F.lit(float(most)) * F.col("source_size")
    shared = listed.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
    ).withColumn("open", F.col("level") * F.col("weight") <= limit)
    level = F.min(F.when(F.col("open"), F.struct(F.col("source_size") / F.col("weight"), "place", "level"))).over(everything)["level"]
    targeted = shared.withColumn("target", F.when(F.col("source_size") == 0, 0.0).otherwise(F.least(limit, level * F.col("weight"))))
    block = F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(F.col("source_size") / FEWEST_BLOCKS))).cast("long")
    blocks = F.ceil(F.col("source_size") / F.col("block"))
    return targeted.withColumn("block", block).withColumn("blocks", blocks.cast("long")).withColumn(
        "draws",
        F.when(F.col("source_size") == 0, 0).otherwise(
            F.least(F.round(F.col("target") / F.col("source_size") * F.col("blocks")), F.col("blocks") * most)
        ).cast("long"),
    ).select("source", "place", "weight", "source_size", "target", "block", "blocks", "draws")


def shard_quotas(targets: DataFrame, levels: int, seed: int) -> DataFrame:
    """(place, quotas array<bigint>): draws of each source in each of 2**levels shards.

    One group per tree node holds one row per source; a level splits all its nodes at once.
    """
    def split(key, rows):
        rows = rows.sort_values("place")
        left = _hypergeometric(rows["draws"].to_numpy(np.int64), np.random.default_rng([seed, 7, int(key[0])]))
        one = rows.assign(node=2 * int(key[0]), draws=left)
        two = rows.assign(node=2 * int(key[0]) + 1, draws=rows["draws"] - left)
        return pd.concat([one, two])[["node", "place", "draws"]]

    nodes = targets.select(F.lit(1).cast("long").alias("node"), F.col("place").cast("long").alias("place"), "draws")
    for _ in range(levels):
        nodes = nodes.groupBy("node").applyInPandas(split, "node long, place long, draws long")
    quotas = F.transform(F.array_sort(F.collect_list(F.struct("node", "draws"))), lambda x: x["draws"])
    return nodes.groupBy("place").agg(quotas.alias("quotas"))


def _hypergeometric(counts: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """How many of each kind fall into a random half of all draws."""
    left, rest = np.zeros_like(counts), int(counts.sum())
    wanted = rest // 2
    for k, count in enumerate(counts):
        rest -= int(count)
        left[k] = _urn(int(count), rest, wanted, rng.random())
        wanted -= int(left[k])
    return left


def _urn(good: int, bad: int, wanted: int, at: float) -> int:
    """The number of good ones among ``wanted`` drawn from an urn, by inversion at ``at`` in [0, 1).

    Probabilities are built outward from the mode by the ratio of neighbours, for REACH deviations to both sides; what lies
    beyond has less weight than a double can tell from 0. That takes about 200 bytes times the root of the draws.
    """
    low, high = max(0, wanted - bad), min(good, wanted)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (wanted + 1) * (good + 1) // (total + 2)))
    deviation = (wanted / total * good * (bad / total) * ((total - wanted) / max(1, total - 1))) ** 0.5
    reach = int(REACH * deviation) + 64
    first, last = max(low, mode - reach), min(high, mode + reach)
    x = np.arange(first, last, dtype=np.float64)  # p(x + 1) / p(x)
    ratio = np.log((good - x) / (x + 1)) + np.log((wanted - x) / (float(bad - wanted) + x + 1))
    logs = np.concatenate([[0.0], np.cumsum(ratio)])
    below = np.cumsum(np.exp(logs - logs[mode - first]))
    return first + int(np.searchsorted(below, at * below[-1], side="right"))


def permuted(numbers: np.ndarray, n: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Each number's place in a drawn permutation of 0..n-1 (one per key): a Feistel network walked until it lands inside."""
    half = np.ceil(np.log2(np.maximum(n, 2).astype(np.float64)) / 2).astype(np.uint64)
    half = np.maximum(half, np.uint64(1))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = numbers.astype(np.uint64), np.arange(len(numbers))
    while len(todo):
        x, h, m, k = out[todo], half[todo], mask[todo], keys[todo]
        high, low = x >> h, x & m
        for step in range(6):
            f = (low + k + np.uint64(step)) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            high, low = low, high ^ ((f >> np.uint64(32)) & m)
        out[todo] = (high << h) | low
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


_PIECES = "array<struct<pass:int,shard:int,turn:bigint,first_word:bigint,words:bigint>>"


def _draw(most: int, seed: int):
    def run(frames):
        for rows in frames:
            for at in range(0, len(rows), 2000):
                yield drawn(rows.iloc[at: at + 2000])

    def drawn(rows: pd.DataFrame) -> pd.DataFrame:
        start, size, block = (rows[c].to_numpy(np.int64) for c in ("start", "size", "block"))
        first, last = start // block, np.where(size > 0, (start + size - 1) // block, start // block - 1)
        owner = np.repeat(np.arange(len(rows)), last - first + 1)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1) + first[owner]
        blocks, draws, place = (rows[c].to_numpy(np.int64)[owner] for c in ("blocks", "draws", "place"))
        begin = np.maximum(number * block[owner], start[owner])
        end = np.minimum((number + 1) * block[owner], start[owner] + size[owner])
        found: list[list] = [[] for _ in range(len(rows))]
        ends = [np.cumsum(np.asarray(q, np.int64)) for q in rows["quotas"]]
        for turn in range(most):
            keys = (place.astype(np.uint64) * np.uint64(1_000_003) + np.uint64(turn)) ^ np.uint64(seed * 0x9E3779B9 % 2**63)
            rank = turn * blocks + permuted(number, blocks, keys)
            for i in np.flatnonzero(rank < draws):
                o = owner[i]
                shard = int(np.searchsorted(ends[o], rank[i], side="right"))
                found[o].append({"pass": turn, "shard": shard, "turn": int(rank[i]), "first_word": int(begin[i] - start[o]), "words": int(end[i] - begin[i])})
        return pd.DataFrame({
            "doc_id": rows["doc_id"].astype("Int64"), "source": rows["source"], "size": size, "source_size": rows["source_size"], "target": rows["target"], "pieces": found,
        })

    return run


def drawn_pieces(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: int = 17, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, pieces.

    ``pieces`` are the drawn runs of the document's words: pass over the source, output shard,
    turn in it, first word and number of words. Null text has size 0; null is a source of its own,
    sorted last; documents without words get no piece. Repeated rows are documents of their own.
    """
    sizes = kept(sized(docs), "mix-sizes")
    n, total = sizes.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    levels = max(1, int(np.ceil(np.log2(max(2, total / shard_words)))))
    targets = kept(source_targets(sizes, weights, most), "mix-targets")
    quotas = shard_quotas(targets, levels, seed)
    slices = max(1, min(1 << 16, n // 256))
    # The order inside a source is drawn by hash; its slices keep a large source out of one task.
    placed = running_total(
        sizes.withColumn("source_key", F.concat(F.lit("="), F.coalesce("source", F.lit("")), F.col("source").isNull().cast("string")))
        .withColumn("draw", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(_RANGE))),
        ["source_key"], ["draw", "doc_id", "size"], {"start": F.col("size")}, slice_width=-(-_RANGE // slices),
    )
    plan = targets.join(quotas, "place").select(F.col("source").alias("of"), "place", "source_size", "target", "block", "blocks", "draws", "quotas")
    joined = placed.join(plan, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "size", "start", "place", "source_size", "target", "block", "blocks", "draws", "quotas"
    )
    return joined.mapInPandas(_draw(most, seed), f"doc_id long, source string, size long, source_size long, target double, pieces {_PIECES}")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: (shard, place, doc_id, source, pass, first_word, words), each shard in a drawn order."""
    rows = drawn_pieces(docs, **options).select("doc_id", "source", F.explode("pieces").alias("piece")).select("doc_id", "source", "piece.*")
    order = F.xxhash64("doc_id", "pass", "first_word", F.lit(options.get("seed", 17)))
    return rows.withColumn("place", order).repartition("shard").sortWithinPartitions("shard", "place")


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): the words of each document the mix takes, repeats counted."""
    return drawn_pieces(docs, **options).select(
        "doc_id", "source", "size", "source_size", "target",
        F.aggregate("pieces", F.lit(0).cast("long"), lambda s, p: s + p["words"]).alias("taken"),
    )
