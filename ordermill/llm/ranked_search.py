"""Ranked lexical search: the best documents of every item, by the Best Position Algorithm.

1. One pass over the texts turns each document into its number of terms and the frequencies of the terms that
   items ask for; that table is written once. Document frequencies and lengths are summed from it.
2. Documents are dealt into shards of bounded size as they lie in that table. A shard has one impact list per
   term: its documents by falling share of the score. For every item the lists are read from the top, some
   positions of each at a time. A document met in one list is looked up in the others (direct access), which also
   marks its positions there as seen. A list's *best position* is the end of its unbroken run of seen positions;
   no unseen document can add more than the impact at that position. The search of a shard stops once these
   impacts together are strictly below its kth best score, so that documents of equal score are all met.
3. The best of all shards are ranked per item; every task hands on at most k rows an item.

Scores are whole numbers, with statistics of the whole table, so shards do not change them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.storage import kept
from ordermill.llm.text import equal_spans, lowered, pieces, runs, span_hashes

BEST = 20
#: Documents and term frequencies that one shard holds at most (a single document may have more).
SHARD_DOCUMENTS, SHARD_POSTINGS = 16_384, 4_000_000
#: Positions read from every list before the first look at the stopping rule; doubled from look to look.
FIRST_POSITIONS = 64
#: Bytes of item texts whose terms are sent to the tasks at once; more items are searched in several passes.
ITEM_BYTES = 64 << 20

_TERM = np.ones(256, dtype=bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _TERM[_low: _high + 1] = False


def terms_of(column: pa.Array):
    """Per piece of a text column: (first row, bytes, term starts, term ends, first term of each row and their number).

    A term is a maximal run of digits, letters and all characters beyond ASCII, with A-Z lower-cased.
    """
    for first, _, data, offsets in pieces(column):
        data = lowered(data)
        starts, ends, rows = runs(_TERM[data], offsets)
        yield first, data, starts, ends, rows


@dataclass(frozen=True)
class Terms:
    """Distinct terms, found again by hash and then by their bytes."""

    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    hashes: np.ndarray

    @classmethod
    def of(cls, terms: list[bytes]) -> Terms:
        data = np.frombuffer(b"".join(terms), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, terms), np.int64, len(terms)))
        starts = np.concatenate([np.zeros(1, np.int64), ends])[: len(terms)]
        order = np.argsort(span_hashes(data, starts, ends), kind="stable")
        starts, ends = starts[order], ends[order]
        return cls(data, starts, ends - starts, span_hashes(data, starts, ends))

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of the term that each span is, -1 for other spans."""
        out = np.full(len(starts), -1, np.int64)
        if not len(self.hashes) or not len(starts):
            return out
        hashed, lengths = span_hashes(data, starts, ends), ends - starts
        at = np.searchsorted(self.hashes, hashed)
        live = np.arange(len(starts))
        while len(live):  # once more for each term that shares its hash with the one before
            live = live[at[live] < len(self.hashes)]
            live = live[self.hashes[at[live]] == hashed[live]]
            alike = self.lengths[at[live]] == lengths[live]
            alike[alike] = equal_spans(data, starts[live[alike]], self.data, self.starts[at[live[alike]]], lengths[live[alike]])
            out[live[alike]] = at[live[alike]]
            live = live[~alike]
            at[live] += 1
        return out


@dataclass(frozen=True)
class Items:
    """The rows asked for: their ids and, one after the other, their distinct terms with repeats."""

    ids: list[int | None]
    bounds: np.ndarray
    terms: np.ndarray
    repeats: np.ndarray


def _items(rows: pa.Table) -> tuple[Terms, Items]:
    per_row: list[dict[bytes, int]] = [{} for _ in range(rows.num_rows)]
    for first, data, starts, ends, bounds in terms_of(rows.column("text")):
        for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            for k in range(a, b):
                term = data[starts[k]: ends[k]].tobytes()
                per_row[first + i][term] = per_row[first + i].get(term, 0) + 1
    found = sorted(set().union(*per_row))
    known = Terms.of(found)
    data, ends = np.frombuffer(b"".join(found), np.uint8), np.cumsum([len(t) for t in found], dtype=np.int64)
    number = dict(zip(found, known.numbers(data, ends - [len(t) for t in found], ends).tolist(), strict=True)) if found else {}
    bounds = np.cumsum([0, *map(len, per_row)])
    return known, Items(
        rows.column("item_id").to_pylist(), bounds,
        np.array([number[t] for row in per_row for t in row], np.int64), np.array([n for row in per_row for n in row.values()], np.int64),
    )


def _frequencies(terms):
    """Documents as (doc_id, number of all terms, asked terms, their frequencies)."""
    def run(batches):
        known = terms.value
        for batch in batches:
            ids = batch.column("doc_id")
            for first, data, starts, ends, rows in terms_of(batch.column("text")):
                number = known.numbers(data, starts, ends)
                row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
                pair, often = np.unique((row * max(1, len(known.hashes)) + number)[number >= 0], return_counts=True)
                row, number = np.divmod(pair, max(1, len(known.hashes)))
                at = pa.array(np.searchsorted(row, np.arange(len(rows))), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    ids.slice(first, len(rows) - 1), pa.array(np.diff(rows), pa.int64()),
                    pa.ListArray.from_arrays(at, pa.array(number, pa.int32())), pa.ListArray.from_arrays(at, pa.array(often, pa.int32())),
                ], names=["doc_id", "n", "terms", "often"])

    return run


def weights(documents: int, holders: np.ndarray) -> np.ndarray:
    """Weight of each term from the number of documents that hold it."""
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * holders + 1))).astype(np.int64)


def impacts(weight: np.ndarray, often: np.ndarray, n: np.ndarray, documents: int, all_terms: int) -> np.ndarray:
    """What a term adds to the score of a document of ``n`` terms that holds it ``often`` times."""
    length = 100 - 25 + (25 * n * documents) // all_terms
    return weight * ((1_000_000_000 * often) // (1000 * often + 12 * length))


def best_of(lists: list[tuple[np.ndarray, np.ndarray]], documents: int, k: int, first: int = FIRST_POSITIONS) -> tuple[np.ndarray, np.ndarray, int]:
    """(documents, scores) of the k best with a score above 0, best first, ties to smaller numbers; and positions read.

    A list holds document numbers and their impacts, largest first; a document's score is the sum of its impacts.
    """
    lengths = np.array([len(d) for d, _ in lists], np.int64)
    begin = np.cumsum(lengths) - lengths
    holder, impact = np.concatenate([d for d, _ in lists]), np.concatenate([i for _, i in lists])
    # Direct access: where a document stands in all its lists (16-bit numbers are sorted digit by digit).
    of_document = np.argsort(holder.astype(np.uint16) if documents <= 1 << 16 else holder, kind="stable")
    often = np.bincount(holder, minlength=documents)
    own = np.cumsum(often) - often
    seen, met = np.zeros(len(holder) + 1, bool), np.zeros(documents, bool)
    best_place = np.zeros(len(lists), np.int64)  # number of positions in the unbroken run of seen ones
    found, scores, depth, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, first
    while depth < lengths.max(initial=0):
        reads = [holder[b + depth: b + min(depth + step, n)] for b, n in zip(begin, lengths, strict=True)]
        new = np.unique(np.concatenate(reads))
        new = new[~met[new]]
        met[new] = True
        runs_of, skipped = often[new], np.cumsum(often[new]) - often[new]
        direct = of_document[np.repeat(own[new] - skipped, runs_of) + np.arange(runs_of.sum())]
        seen[direct] = True
        score = np.add.reduceat(impact[direct], skipped) if len(new) else np.zeros(0, np.int64)
        found, scores = np.concatenate([found, new]), np.concatenate([scores, score])
        if len(found) > k:
            order = np.lexsort((found, -scores))[:k]
            found, scores = found[order], scores[order]
        depth, step = depth + step, 2 * step
        bound = 0
        for t, (b, n) in enumerate(zip(begin, lengths, strict=True)):
            at = best_place[t]
            unseen = np.flatnonzero(~seen[b + at: b + n][: 2 * depth])
            while not len(unseen) and at + 2 * depth < n:
                at += 2 * depth
                unseen = np.flatnonzero(~seen[b + at: b + n][: 2 * depth])
            best_place[t] = at + unseen[0] if len(unseen) else n
            if best_place[t] < n:  # a list seen to its end adds nothing to unseen documents
                bound += int(impact[b + best_place[t] - 1]) if best_place[t] else int(impact[b])
        if len(found) == k and bound < scores.min():
            break
    order = np.lexsort((found, -scores))
    order = order[scores[order] > 0]
    return found[order], scores[order], int(np.minimum(depth, lengths).sum())


def _searched(items, weight, documents: int, all_terms: int, k: int):
    def shard(batches: list[pa.RecordBatch]):
        asked, weighed = items.value, weight.value
        rows = pa.Table.from_batches(batches)
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("doc_id", "ascending")], null_placement="at_end")).combine_chunks()
        n, lists = rows.column("n").to_numpy(), rows.column("terms").chunk(0)
        row = np.repeat(np.arange(rows.num_rows), np.diff(lists.offsets.to_numpy()))
        term, often = lists.flatten().to_numpy().astype(np.int64), rows.column("often").chunk(0).flatten().to_numpy().astype(np.int64)
        value = impacts(weighed[term], often, n[row], documents, all_terms)
        order = np.lexsort((row, -value, term))
        row, value = row[order], value[order]
        cuts = np.searchsorted(term[order], np.arange(len(weighed) + 1))
        ids = rows.column("doc_id")
        number, found, scores = [], [], []
        for i, (a, b) in enumerate(zip(asked.bounds[:-1], asked.bounds[1:], strict=True)):
            own = [(row[cuts[t]: cuts[t + 1]], value[cuts[t]: cuts[t + 1]] * r) for t, r in zip(asked.terms[a:b], asked.repeats[a:b], strict=True) if cuts[t] < cuts[t + 1]]
            if own:
                docs, score, _ = best_of(own, rows.num_rows, k)
                number.append(np.full(len(docs), i))
                found.append(docs)
                scores.append(score)
        if number:
            where = np.concatenate(number)
            yield pa.RecordBatch.from_arrays([
                pa.array(where, pa.int64()), pa.array([asked.ids[i] for i in where], pa.int64()),
                ids.take(pa.array(np.concatenate(found))).combine_chunks(), pa.array(np.concatenate(scores), pa.int64()),
            ], names=["item", "item_id", "doc_id", "score"])

    def run(batches):
        held, rows, postings = [], 0, 0
        for batch in batches:
            sizes = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                before = sizes[at - 1] if at else 0
                fits = int(np.searchsorted(sizes, before + SHARD_POSTINGS - postings, side="right")) - at
                take = min(SHARD_DOCUMENTS - rows, max(fits, 0 if held else 1), batch.num_rows - at)
                if take:
                    held.append(batch.slice(at, take))
                    rows, postings, at = rows + take, postings + int(sizes[at + take - 1] - before), at + take
                if at < batch.num_rows:
                    yield from shard(held)
                    held, rows, postings = [], 0, 0
        if held:
            yield from shard(held)

    return run


def best_documents(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of ``docs`` that score highest for each row of ``items``.

    Only documents with a score above 0 are ranked, equal scores by ascending doc_id (null last). Every row is an
    item, or a document, of its own, also where ids repeat or are null. Null and empty texts have no
    terms: they get no documents, are no results and do not count in the statistics.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-size // ITEM_BYTES))
    found = []
    for number in range(passes):
        part = asked if passes == 1 else asked.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(passes)) == number)
        terms, rows = _items(part.toArrow())  # about ITEM_BYTES of text, whatever the size of the tables
        if not len(terms.hashes):
            continue
        shared = spark.sparkContext.broadcast(terms)
        held = kept(texts.mapInArrow(_frequencies(shared), "doc_id long, n long, terms array<int>, often array<int>"), "term-frequencies")
        documents, all_terms = held.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        holders = np.zeros(len(terms.hashes), np.int64)
        counted = held.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()  # one row per asked term
        holders[counted["term"].to_numpy()] = counted["count"].to_numpy()
        weight = weights(documents, holders)
        search = _searched(spark.sparkContext.broadcast(rows), spark.sparkContext.broadcast(weight), documents, all_terms, k)
        near = held.where(F.size("terms") > 0).mapInArrow(search, "item long, item_id long, doc_id long, score long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        found.append(near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
