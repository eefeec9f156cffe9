"""Language identification by unigram pieces, summed over all segmentations.

A language is a probability for each piece of a fixed public vocabulary. A word (with a mark for its
beginning) has the probability of all ways to cut it into pieces, added up by a forward pass; a text has
the product of its words'. Training is expectation-maximisation on word counts of a bounded sample of
labelled documents: the expected uses of each piece are computed in Spark tasks, only sums per piece and
language (bounded by vocabulary and languages) reach the driver.

The forward pass runs over arrays: all distinct words of a chunk at once, one character column at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.storage import kept
from ordermill.llm.text import pieces, words

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN = "und"
#: Labelled documents that training looks at, those with the smallest hash of doc_id.
SAMPLE_DOCUMENTS = 2000
ROUNDS = 3
#: Pieces up to this many bytes are looked up at every place, longer (rare) ones where their first bytes are met.
COMMON_PIECE = 12
#: Words from this many bytes on are cut where no piece crosses, which leaves all segmentations; parts that are
#: still longer are scored with rescaling, and do not train.
CUT_BYTES, SCALED_BYTES = 40, 64
#: Factor per byte that keeps products within range, as a power of e.
_PER_BYTE = 10.0
_SPACE = "▁"
_TABLE_BITS = 20


class Vocabulary:
    """Pieces by hash of their bytes. Piece 0 stands for any single byte outside the vocabulary."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        seen = {b""}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
                seen.add(model.id_to_piece(i).replace(_SPACE, " ").lower().encode())
        self.names = sorted(seen)
        self.longest = max(map(len, self.names))
        common = np.array([i for i, p in enumerate(self.names) if len(p) <= COMMON_PIECE], np.int32)
        hashes = np.array([_hash_of(self.names[i]) for i in common], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], common[order]
        # Longer pieces: their lengths by their first bytes.
        self.long_numbers = {p: i for i, p in enumerate(self.names) if len(p) > COMMON_PIECE}
        self.long_lengths: dict[bytes, set[int]] = {}
        for p in self.long_numbers:
            self.long_lengths.setdefault(p[:COMMON_PIECE], set()).add(len(p))
        self.long_heads = np.unique(np.array([_hash_of(p) for p in self.long_lengths], np.uint64))
        # A table by the hash's low bits narrows the search to one or two places.
        low = (self.hashes & np.uint64((1 << _TABLE_BITS) - 1)).astype(np.int64)
        self.by_low = np.argsort(low, kind="stable")
        self.starts = np.searchsorted(low[self.by_low], np.arange((1 << _TABLE_BITS) + 1)).astype(np.int32)
        self.most = int(np.diff(self.starts).max())

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Piece numbers, -1 where there is no such piece."""
        low = (hashes & np.uint64((1 << _TABLE_BITS) - 1)).astype(np.int64)
        at, end = self.starts[low], self.starts[low + 1]
        found = np.full(len(hashes), -1, np.int32)
        for step in range(self.most):
            live = np.flatnonzero(at + step < end)
            if not len(live):
                break
            place = self.by_low[at[live] + step]
            hit = self.hashes[place] == hashes[live]
            found[live[hit]] = self.numbers[place[hit]]
        return found


_FACTOR = 0x9E3779B97F4A7C15


def _hash_of(piece: bytes) -> int:
    h = 0
    for b in piece:
        h = (h * _FACTOR + b + 1) & 0xFFFFFFFFFFFFFFFF
    return h


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def _matches(units: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All pieces in all units as (unit, end, length, piece number), by end and unit, and the units' lengths; a single byte falls back to piece 0."""
    width = max(map(len, units))
    text = np.frombuffer(b"".join(u.ljust(width, b"\0") for u in units), np.uint8).reshape(len(units), width).astype(np.uint64)
    lengths = np.fromiter(map(len, units), np.int64, len(units))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    rolling = np.zeros((len(units), width), np.uint64)  # hash of the bytes [end - n, end), by end
    for n in range(1, min(COMMON_PIECE, width) + 1):
        # hash(s + c) = hash(s) * F + c, read from the end backwards: the first byte enters with F**(n-1).
        step = np.uint64(pow(_FACTOR, n - 1, 1 << 64))
        ends = rolling[:, n - 1:] + (text[:, : width - n + 1] + np.uint64(1)) * step
        rolling[:, n - 1:] = ends
        unit, end = np.nonzero(np.arange(n, width + 1)[None, :] <= lengths[:, None])
        numbers = vocab.lookup(ends[unit, end])
        if n == 1:
            numbers = np.maximum(numbers, 0)
        hit = numbers >= 0
        found.append((unit[hit], end[hit] + n, np.full(hit.sum(), n), numbers[hit]))
        if n == COMMON_PIECE and len(vocab.long_heads):
            value = ends[unit, end]
            place = np.minimum(np.searchsorted(vocab.long_heads, value), len(vocab.long_heads) - 1)
            more = []
            for i in np.flatnonzero(vocab.long_heads[place] == value):
                word, begin = units[unit[i]], int(end[i])
                for size in vocab.long_lengths.get(word[begin: begin + COMMON_PIECE], ()):
                    number = vocab.long_numbers.get(word[begin: begin + size])
                    if number is not None:
                        more.append((unit[i], begin + size, size, number))
            if more:
                found.append(tuple(np.array(x) for x in zip(*more, strict=True)))
    unit, end, length, number = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((unit, end))
    return unit[order], end[order], length[order], number[order].astype(np.int64), lengths


def _ends(end: np.ndarray, width: int) -> np.ndarray:
    return np.searchsorted(end, np.arange(width + 2))


def _begun(unit: np.ndarray) -> np.ndarray:
    """Where a new unit begins in a run sorted by unit."""
    return np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))


def forward(units: list[bytes], vocab: Vocabulary, probability: np.ndarray) -> np.ndarray:
    """log P(unit | language) over all segmentations, [unit, language]; ``probability`` is [piece + 1, language], its last row zeros.

    Every byte of a piece brings a factor that keeps the sums of short units within range; in longer ones
    they are also divided by their largest recent one every few bytes. The logarithms of all factors are taken back.
    """
    unit, end, length, number, lengths = _matches(units, vocab)
    width, languages = int(lengths.max()), probability.shape[1]
    gain = np.exp(_PER_BYTE * np.arange(vocab.longest + 1)) if width <= SCALED_BYTES else np.ones(vocab.longest + 1)
    alpha = np.zeros((len(units), width + 1, languages))
    alpha[:, 0] = 1.0
    scale, out = np.zeros((len(units), languages)), np.zeros((len(units), languages))
    cuts, at_end = _ends(end, width), np.argsort(lengths, kind="stable")
    done = np.searchsorted(lengths[at_end], np.arange(width + 2))
    for e in range(1, width + 1):
        own = slice(cuts[e], cuts[e + 1])
        if cuts[e] < cuts[e + 1]:
            rows = unit[own]
            sums = alpha[rows, e - length[own]] * probability[number[own]] * gain[length[own]][:, None]
            begun = _begun(rows)
            alpha[rows[begun], e] = np.add.reduceat(sums, begun, axis=0)
        if width > SCALED_BYTES and e % 4 == 0:
            recent = alpha[:, max(0, e - vocab.longest): e + 1]
            largest = recent.max(axis=1)
            largest[largest == 0] = 1.0
            recent /= largest[:, None]
            scale += np.log(largest)
        over = at_end[done[e]: done[e + 1]]
        if len(over):
            out[over] = np.log(alpha[over, e]) + scale[over]
    return out - _PER_BYTE * lengths[:, None] if width <= SCALED_BYTES else out


def expected_uses(units: list[bytes], counts: np.ndarray, vocab: Vocabulary, probability: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece per language, [piece, language]; ``counts`` is [unit, language], units of ``SCALED_BYTES`` at most."""
    unit, end, length, number, lengths = _matches(units, vocab)
    width = int(lengths.max())
    weight = probability * np.exp(_PER_BYTE * np.array([*map(len, vocab.names), 1])[:, None])
    weight[0] = probability[0] * np.exp(_PER_BYTE)  # piece 0 stands for one byte
    alpha = np.zeros((len(units), width + 1, probability.shape[1]))
    beta = np.zeros_like(alpha)
    alpha[:, 0] = 1.0
    beta[np.arange(len(units)), lengths] = 1.0
    cuts = _ends(end, width)
    for e in range(1, width + 1):
        own = slice(cuts[e], cuts[e + 1])
        if cuts[e] < cuts[e + 1]:
            begun = _begun(unit[own])
            alpha[unit[own][begun], e] = np.add.reduceat(alpha[unit[own], e - length[own]] * weight[number[own]], begun, axis=0)
    for e in range(width, 0, -1):
        own = slice(cuts[e], cuts[e + 1])
        np.add.at(beta, (unit[own], e - length[own]), beta[unit[own], e] * weight[number[own]])
    share = counts / alpha[np.arange(len(units)), lengths]
    uses = np.zeros((len(vocab.names), probability.shape[1]))
    np.add.at(uses, number, alpha[unit, end - length] * weight[number] * beta[unit, end] * share[unit])
    return uses


def units_of(word: bytes, vocab: Vocabulary) -> list[bytes]:
    """A word as it is scored: begun by the mark; a long one cut at all places that no piece crosses, so that no segmentation is lost."""
    marked = b" " + word
    if len(marked) < CUT_BYTES:
        return [marked]
    _, end, length, _, _ = _matches([marked], vocab)
    crossed = np.zeros(len(marked) + 2, np.int64)
    np.add.at(crossed, end - length + 1, 1)
    np.add.at(crossed, end, -1)
    cuts = [*np.flatnonzero(np.cumsum(crossed)[1: len(marked)] == 0) + 1, len(marked)]
    return [marked[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().split()


def _count_words(path: str):
    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                counts: dict[bytes, int] = {}
                for word in words_of(text.as_py()):
                    for unit in units_of(word, vocab):
                        if len(unit) <= SCALED_BYTES:
                            counts[unit] = counts.get(unit, 0) + 1
                if counts:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64()),
                    ], names=["lang", "unit", "n"])

    return run


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    probability: np.ndarray  # [piece + 1, language]
    prior: np.ndarray
    path: str


def train(docs: DataFrame, path: str = VOCABULARY, sample: int = SAMPLE_DOCUMENTS, rounds: int = ROUNDS) -> Model | None:
    """Fit piece probabilities on a sample of documents with text and lang whose crc32(doc_id) mod 5 is not 0.

    The sample are the ``sample`` documents with the smallest hash of doc_id; all their words
    count. None if there is no such document.
    """
    spark = docs.sparkSession
    usable = docs.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").where(~held_out())
    chosen = usable.select("doc_id", F.col("lang").cast("string").alias("lang")).withColumn("draw", F.xxhash64("doc_id", F.lit(3))).orderBy("draw", "doc_id", "lang").limit(sample)
    drawn = F.broadcast(chosen.select(F.col("doc_id").alias("drawn_id")).distinct())  # at most ``sample`` rows
    texts = usable.join(drawn, F.col("doc_id") == F.col("drawn_id"), "left_semi").select(F.col("lang").cast("string").alias("lang"), "text")
    counted = texts.mapInArrow(_count_words(path), "lang string, unit binary, n long").groupBy("lang", "unit").agg(F.sum("n").alias("n"))
    counted = kept(counted.groupBy("unit").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("counts")), "lid-words")
    totals = {r.lang: r.n for r in counted.select(F.explode("counts").alias("lang", "n")).groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return None
    languages = tuple(sorted(totals))
    vocab = vocabulary(path)
    weight = np.array([2.0 ** -len(p) for p in vocab.names])
    probability = _normalised(np.repeat(weight[:, None], len(languages), axis=1))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(probability)
        sums = counted.mapInArrow(_expectation(path, languages, shared), "language int, piece int, uses double").groupBy("language", "piece").agg(F.sum("uses").alias("uses"))
        uses = np.zeros((len(vocab.names), len(languages)))
        got = sums.toArrow()
        uses[got["piece"].to_numpy(), got["language"].to_numpy()] = got["uses"].to_numpy()
        # What all languages use counts a little for each, so that rare pieces are not a verdict on their own.
        pooled = uses.sum(axis=1, keepdims=True)
        pooled = (pooled + 0.5) / (pooled + 0.5).sum()
        probability = _normalised(uses + pooled * 0.02 * np.maximum(uses.sum(axis=0, keepdims=True), 1000.0))
    prior = np.array([1.0 / len(languages)] * len(languages))
    return Model(languages, probability, prior, path)


def _normalised(weights: np.ndarray) -> np.ndarray:
    return np.vstack([weights / weights.sum(axis=0, keepdims=True), np.zeros((1, weights.shape[1]))])


def _expectation(path: str, languages: tuple[str, ...], shared):
    def run(batches):
        vocab, probability = vocabulary(path), shared.value
        uses = np.zeros((len(vocab.names), len(languages)))
        for batch in batches:
            units, maps = batch.column("unit").to_pylist(), batch.column("counts").to_pylist()
            order = sorted(range(len(units)), key=lambda i: len(units[i]))
            for at in range(0, len(order), 2000):
                part = order[at: at + 2000]
                counts = np.array([[dict(maps[i]).get(lang, 0) for lang in languages] for i in part], float)
                uses += expected_uses([units[i] for i in part], counts, vocab, probability)
        number, language = np.nonzero(uses)
        yield pa.RecordBatch.from_arrays([pa.array(language, pa.int32()), pa.array(number, pa.int32()), pa.array(uses[number, language])], names=["language", "piece", "uses"])

    return run


def held_out():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def _score(path: str, shared, columns: list[str]):
    def run(batches):
        vocab, (probability, prior) = vocabulary(path), shared.value
        known: dict[bytes, np.ndarray] = {}
        for batch in batches:
            logs = np.zeros((batch.num_rows, probability.shape[1]))
            texts = batch.column("text")
            for first, end, data, offsets in pieces(texts):
                held = _word_lists(texts.slice(first, end - first))
                new = list({w for ws in held for w in ws if w not in known})
                if len(known) + len(new) > 150_000:  # bounds the memory of the cache only
                    known.clear()
                    new = list({w for ws in held for w in ws})
                _add_words(new, known, vocab, probability)
                for i, ws in enumerate(held):
                    if ws:
                        logs[first + i] = np.sum([known[w] for w in ws], axis=0)
            logs += np.log(prior)
            logs -= logs.max(axis=1, keepdims=True)
            posterior = np.exp(logs)
            posterior /= posterior.sum(axis=1, keepdims=True)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], pa.array(posterior.argmax(axis=1), pa.int32()), pa.array(posterior.max(axis=1))],
                names=[*columns, "best", "score"],
            )

    return run


def _word_lists(texts: pa.Array) -> list[list[bytes]]:
    return [words_of(t) for t in texts.to_pylist()]


def _add_words(new: list[bytes], known: dict[bytes, np.ndarray], vocab: Vocabulary, probability: np.ndarray) -> None:
    units = sorted(((u, w) for w in new for u in units_of(w, vocab)), key=lambda x: len(x[0]))
    at = 0
    while at < len(units):
        # Units of like length, a bounded number of bytes at once.
        size = max(1, min(4000, 160_000 // len(units[min(at + 4000, len(units)) - 1][0])))
        part = units[at: at + size]
        for (_, w), log in zip(part, forward([u for u, _ in part], vocab, probability), strict=True):
            known[w] = known[w] + log if w in known else log
        at += size


def has_letter() -> Column:
    """Whether ``text`` is not null and holds a letter."""
    return F.coalesce(F.regexp_like("text", F.lit(r"\p{L}")), F.lit(False))


def identified(docs: DataFrame, path: str = VOCABULARY, keep: tuple[str, ...] = ("doc_id",), labelled: DataFrame | None = None, **training) -> DataFrame:
    """(*keep, held_out, lang_pred, score) for every row of ``docs``.

    ``lang_pred`` is the learned language with the largest posterior, ``score`` that posterior.
    A null text, or one without a letter, is ``und`` with score 0; so is everything if there is
    nothing to learn from. Only ``text`` enters a prediction.
    """
    model = train(docs if labelled is None else labelled, path, **training)
    lettered = has_letter()
    out = held_out().alias("held_out")
    if model is None:
        return docs.select(*keep, out, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast((model.probability, model.prior))
    rows = docs.select(*[F.col(k).alias(f"kept_{i}") for i, k in enumerate(keep)], out, lettered.alias("lettered"), F.when(lettered, F.col("text")).otherwise(F.lit("")).alias("text"))
    columns = [c for c in rows.columns if c != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    scored = rows.mapInArrow(_score(path, shared, columns), f"{schema}, best int, score double")
    names = F.array(*[F.lit(x) for x in model.languages])
    return scored.select(
        *[F.col(f"kept_{i}").alias(k) for i, k in enumerate(keep)], "held_out",
        F.when(F.col("lettered"), F.get(names, F.col("best"))).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("lettered"), F.col("score")).otherwise(0.0).alias("score"),
    )
