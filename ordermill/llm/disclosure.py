"""Personal data: patterns find protected entities, and corpus co-occurrence finds the terms that give them away.

1. E-mail addresses, IP addresses, card and phone numbers are found in every whole text. Their values are
   the protected *entities*.
2. A term (run of word characters, lower-cased) that stands near an entity may reveal it. Over all documents,
   with p(x) the share of documents that hold x, the disclosure of entity e by term t is
   PMI(t; e) / IC(e) = log(p(t, e) / (p(t) p(e))) / -log p(e): 0 if they are independent, 1 if t is only ever
   seen with e. Terms at the threshold or above, seen with e in enough different surroundings (copies of one
   passage are one), are spans too, wherever they stand.
3. Sanitising replaces entities by their kind. A disclosing term is generalised to its class (number, code,
   word) if the class, by the same measure, does not disclose the entity; otherwise it is removed.

Terms near entities are counted first, then document frequencies of those that are met often enough, then
the disclosing ones are located. Term sets are sent to the tasks only up to a stated number of terms; beyond it
tasks hand on all terms, and joins choose. Spans return to documents by a digest of the text, so copies are
located once.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.storage import kept

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: A term with this disclosure or more is a span, if it stands near the entity in so many surroundings at least.
THRESHOLD, SURROUNDINGS = 0.95, 3
#: Near an entity: so many terms to each side, within so many characters.
NEAR_TERMS, NEAR_POINTS = 8, 200
#: Terms that are sent to every task, at most.
SENT_TERMS = 200_000
#: Terms counted by a task before it hands them on.
CHUNK_TERMS = 200_000

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_SPACED = re.compile(r"[0-9](?:[ -]?[0-9])++")
_DIALLED = re.compile(r"\+[0-9]([ ().0-9-]++)")
_WORD = re.compile(r"\w+")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_LAST_DIGIT = re.compile(r"[^0-9]*\Z")
_DIGIT = re.compile(r"[0-9]")
#: Pseudo-terms for the classes; no text has terms of this form.
_NUMBER, _CODE, _PLAIN = "\0number", "\0code", "\0word"
_SPANS = "array<struct<kind:int,start:int,end:int>>"


def emails(text: str):
    """Leftmost matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, in time linear in the text."""
    free, at = 0, text.find("@")
    while at >= 0:
        domain, start = _DOMAIN.match(text, at + 1), at
        if domain:
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
        if start < at:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(free, at + 1))


def ips(text: str):
    """Four numbers of at most 255 with dots between, taken in fours from each dotted run."""
    for run in _DOTTED.finditer(text):
        parts, start = run.group().split("."), run.start()
        for i in range(0, len(parts) - 3, 4):
            own = parts[i: i + 4]
            end = start + sum(map(len, own)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in own):
                yield start, end
            start = end + 1


def luhn(digits: str) -> bool:
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def cards(text: str):
    for run in _SPACED.finditer(text):
        digits = run.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield run.span()


def phones(text: str):
    for run in _DIALLED.finditer(text):
        end = _LAST_DIGIT.search(text, run.start(1), run.end()).start()
        if end - run.start(1) >= 2 and 10 <= len(_NOT_DIGIT.sub("", text[run.start(): end])) <= 15:
            yield run.start(), end


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all entities by start, then kind; end exclusive, in code points."""
    found = [(0, *s) for s in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        found += [(1, *s) for s in ips(text)] + [(2, *s) for s in cards(text)]
        found += [(3, *s) for s in phones(text)] if "+" in text else []
    return sorted(found, key=lambda s: (s[1], s[0]))


def entity(kind: int, value: str) -> str:
    """The protected value: without case, and for numbers without punctuation."""
    return f"{KINDS[kind]}:{value.lower() if kind < 2 else _NOT_DIGIT.sub('', value)}"


def class_of(term: str) -> str:
    return _PLAIN if not _DIGIT.search(term) else _CODE if _NOT_DIGIT.search(term) else _NUMBER


def near_terms(text: str, spans: list[tuple[int, int, int]]) -> dict[tuple[str, str], set[int]]:
    """Hashes of the surroundings (the words before and after) in which each (entity, term) is met; terms inside spans do not count."""
    covered: list[list[int]] = []
    for _, start, end in spans:
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    begins, found = [c[0] for c in covered], {}
    for kind, start, end in spans:
        low, high = max(0, start - NEAR_POINTS), min(len(text), end + NEAR_POINTS)
        words = [m for m in _WORD.finditer(text, low, high)]
        # A word that the window cuts is left out.
        words = [m for m in words if (m.start() > low or low == 0 or not _WORD.match(text[low - 1])) and (m.end() < high or high == len(text) or not _WORD.match(text[high]))]
        words = [m for m in words if (at := bisect_right(begins, m.start()) - 1) < 0 or covered[at][1] <= m.start()]
        sides = [m for m in words if m.end() <= start][-NEAR_TERMS:], [m for m in words if m.start() >= end][:NEAR_TERMS]
        names = [m.group().lower() for side in sides for m in side]
        own = entity(kind, text[start:end])
        for i, name in enumerate(names):
            around = xxhash.xxh3_64_intdigest(f"{names[i - 1] if i else ''} {names[i + 1] if i + 1 < len(names) else ''}") >> 1
            for term in (name, class_of(name)):
                found.setdefault((own, term), set()).add(around)
    return found


def terms_in(text: str) -> set[str]:
    """Distinct terms of a text and their classes."""
    found = {w.lower() for w in set(_WORD.findall(text))}
    return found | {class_of(t) for t in found}


def _search(columns: list[str]):
    near_type = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string()), ("around", pa.int64()), ("first", pa.int64())]))
    span_type = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in batches:
            spans, entities, near = [], [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                found = base_spans(text)
                spans.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in found])
                entities.append(sorted({entity(k, text[a:b]) for k, a, b in found}))
                near.append([{"entity": e, "term": t, "around": x, "first": int(not i)} for (e, t), around in near_terms(text, found).items() for i, x in enumerate(sorted(around))])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], pa.array(spans, span_type), pa.array(entities, pa.list_(pa.string())), pa.array(near, near_type)],
                names=[*columns, "base", "entities", "near"],
            )

    return run


def _counted(sent):
    """(term, number of documents) of a task's documents, in chunks."""
    def packed(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

    def run(batches):
        wanted, counts = sent and sent.value, Counter()
        for batch in batches:
            for text in batch.column("text"):
                found = terms_in(text.as_py())
                counts.update(found if wanted is None else found & wanted)
                if len(counts) >= CHUNK_TERMS:
                    yield packed(counts)
                    counts.clear()
        if counts:
            yield packed(counts)

    return run


def _located(sent):
    """(digest, term, starts, ends) of the terms of a task's texts."""
    def run(batches):
        wanted = sent and sent.value
        for batch in batches:
            digests, terms, starts, ends = [], [], [], []
            for digest, text in zip(batch.column("digest"), batch.column("text"), strict=True):
                text, places = text.as_py(), {}
                if wanted is not None and wanted.isdisjoint(terms_in(text)):
                    continue
                for m in _WORD.finditer(text):
                    if wanted is None or m.group().lower() in wanted:
                        places.setdefault(m.group().lower(), []).append(m.span())
                for term, own in places.items():
                    digests.append(digest.as_py())
                    terms.append(term)
                    starts.append([a for a, _ in own])
                    ends.append([b for _, b in own])
            lists = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array(terms, pa.string()), pa.array(starts, lists), pa.array(ends, lists)], names=["digest", "term", "starts", "ends"],
            )

    return run


def _sent(terms: DataFrame):
    """A broadcast set of the terms of a table, or None (all terms) if it holds more than ``SENT_TERMS``."""
    found = terms.select("term").distinct().limit(SENT_TERMS + 1).toArrow()["term"].to_pylist()
    return terms.sparkSession.sparkContext.broadcast(set(found)) if len(found) <= SENT_TERMS else None


def disclosing_terms(held: DataFrame, texts: DataFrame, documents: int, threshold: float = THRESHOLD, surroundings: int = SURROUNDINGS) -> DataFrame:
    """(term, entity, disclosure, generalised) of all terms at the threshold or above; ``generalised`` is the replacement, empty for removal."""
    holders = held.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    near = held.select(F.inline("near")).groupBy("entity", "term", "around").agg(F.sum("first").alias("n"))
    pairs = near.groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count("*").alias("surroundings"))
    pairs = kept(pairs.where(F.col("surroundings") >= surroundings).join(holders, "entity").where(F.col("n_entity") < documents), "near-terms")
    counted = texts.select("text").mapInArrow(_counted(_sent(pairs)), "term string, n long").groupBy("term").agg(F.sum("n").alias("n_term"))
    both = F.log(F.col("n_both") * documents / (F.col("n_term") * F.col("n_entity")))
    scored = kept(pairs.join(counted, "term").withColumn("disclosure", both / F.log(F.lit(documents) / F.col("n_entity"))), "scored-terms")
    of_class = F.when(~F.col("term").rlike("[0-9]"), _PLAIN).when(F.col("term").rlike("[^0-9]"), _CODE).otherwise(_NUMBER)
    classes = scored.where(F.col("term").startswith("\0")).select(F.col("entity").alias("of_entity"), F.col("term").alias("class"), F.col("disclosure").alias("by_class"))
    found = scored.where(~F.col("term").startswith("\0") & (F.col("disclosure") >= threshold)).withColumn("own_class", of_class)
    found = found.join(classes, (F.col("entity") == F.col("of_entity")) & (F.col("own_class") == F.col("class")), "left")
    general = F.concat(F.lit("["), F.upper(F.substring("own_class", 2, 99)), F.lit("]"))
    return kept(found.select("term", "entity", "disclosure", F.when(F.coalesce("by_class", F.lit(0.0)) < threshold, general).otherwise("").alias("generalised")), "disclosing-terms")


def found(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD, surroundings: int = SURROUNDINGS) -> DataFrame:
    """(*keep, base, terms), one row per row of ``docs``.

    ``base`` holds the entities as (kind number, start, end) in order, ``terms`` the disclosing terms as (start,
    end, replacement), null if there are none. Every row is a document: rows of the same doc_id, or
    without one, are judged by their own text. A null text is empty and has neither; it counts in no statistic.
    """
    rows = docs.select(*[F.col(k).alias(f"kept_{i}") for i, k in enumerate(keep)], F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), "text")
    plain = [c for c in rows.columns if c != "text" and c != "digest"] + ["digest"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(plain).schema.fields)
    near = "array<struct<entity:string,term:string,around:bigint,first:bigint>>"
    held = kept(rows.mapInArrow(_search(plain), f"{schema}, base {_SPANS}, entities array<string>, near {near}"), "personal-data")
    texts = rows.where("text IS NOT NULL").select("digest", "text")
    terms = disclosing_terms(held, texts, texts.count(), threshold, surroundings)
    out = [*[F.col(f"kept_{i}").alias(k) for i, k in enumerate(keep)], "base"]
    if terms.isEmpty():
        return held.select(*out, F.lit(None).cast("array<struct<start:int,end:int,replacement:string>>").alias("terms"))
    replaced = terms.groupBy("term").agg(F.min("generalised").alias("replacement"))  # removed if that is so for any of its entities
    places = texts.mapInArrow(_located(_sent(terms)), "digest binary, term string, starts array<int>, ends array<int>")
    places = places.groupBy("digest", "term").agg(F.first("starts").alias("starts"), F.first("ends").alias("ends")).join(replaced, "term")
    one = F.transform(F.arrays_zip("starts", "ends"), lambda s: F.struct(s["starts"].alias("start"), s["ends"].alias("end"), F.col("replacement").alias("replacement")))
    spans = places.groupBy("digest").agg(F.array_sort(F.flatten(F.collect_list(one))).alias("terms"))  # of one text
    return held.join(kept(spans, "term-spans"), "digest", "left").select(*out, "terms")


def _rewritten(columns: list[str]):
    def run(batches):
        for batch in batches:
            texts = []
            for text, base, terms in zip(batch.column("old_text"), batch.column("base"), batch.column("terms"), strict=True):
                text, out, at = text.as_py(), [], 0
                spans = [(s["start"], -s["end"], f"[{KINDS[s['kind']].upper()}]") for s in base.as_py()] + [(s["start"], -s["end"], s["replacement"]) for s in terms.as_py() or ()]
                for start, end, instead in sorted(spans):
                    if start >= at:
                        out += [text[at:start], instead]
                    at = max(at, -end)
                texts.append(None if text is None else "".join([*out, text[at:]]))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else batch.column(f"kept_column_{i}") for i, c in enumerate(columns)], names=[f"kept_column_{i}" for i in range(len(columns))])

    return run


def sanitised(docs: DataFrame, threshold: float = THRESHOLD, surroundings: int = SURROUNDINGS) -> DataFrame:
    """All rows and columns of ``docs`` with entities replaced by their kind and disclosing terms generalised or removed.

    Of overlapping spans the one that starts first (the longest of these) gives the replacement, and all
    that they cover goes. Null texts stay null.
    """
    columns = docs.columns
    judged = found(docs, tuple(columns), threshold, surroundings)
    names = [F.col(c).alias(f"kept_column_{i}") for i, c in enumerate(columns)]
    judged = judged.toDF(*[f"kept_column_{i}" for i in range(len(columns))], "base", "terms").withColumn("old_text", F.col(f"kept_column_{columns.index('text')}"))
    schema = ", ".join(f"kept_column_{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.select(names).schema.fields))
    return judged.mapInArrow(_rewritten(columns), schema).toDF(*columns)


def digest_columns(judged: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) from the result of ``found``."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    said = lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    base = F.array_join(F.transform("base", said), ",")
    both = F.array_sort(F.concat(
        F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))),
        F.transform(F.coalesce("terms", F.array()), lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), s["end"].alias("end"))),
    ))
    named = F.array(*[F.lit(k) for k in (*KINDS, TERM)])
    every = F.transform(both, lambda s: F.concat_ws(":", F.get(named, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return judged.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"), F.array_join(every, ",").alias("spans"),
    )
