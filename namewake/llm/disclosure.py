"""Operator 8: personal data, and terms that give it away, by information content.

*Base.* E-mail and IP addresses, card and phone numbers are found by fixed rules, in time
that grows with the text's length whatever it holds.

*Method.* A base value that recurs is a protected entity. How strongly a term ``t`` reveals
an entity ``e`` is estimated from the corpus: PMI(t; e) = log(N n(t,e) / (n(t) n(e))), over
whole documents, with n(t,e) those that have both, wherever in the text. Knowing the
entity itself would tell IC(e) = log(N / n(e)). A term that tells at least ``DISCLOSURE`` of
that, in documents with ``MIN_CONTEXTS`` different surroundings of the entity (``REACH`` words
on each side, one for each document) or more (copies of one passage are one), is disclosive, and all its mentions in documents
that hold the entity become spans too. ``sanitize`` puts labels in place of base spans,
generalises disclosive numbers and names, and removes other terms.

Only entities in enough surroundings can be disclosed, and n(t,e) <= n(e) bounds the n(t) of
terms that can tell enough, so terms and entities are paired after both bounds, which lose
nothing. Counts combine map-side, and the terms whose documents must be counted are told by
a bit table of fixed size; a collision there only counts a term in vain.

Defined results: null and empty texts have no spans. Repeated rows are judged alike, each
comes back, and they count as documents each. An entity in every document discloses
nothing. An empty table gives an empty result. ``sanitize`` keeps all other columns.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namewake.llm.common import (
    Batches, map_arrow, packed, pieces, row_key, save, ship, strings, unpacked, with_row,
)
from namewake.operators.joins import lookup_join

KINDS = ("email", "ip", "card", "phone", "term")
REACH, MIN_CONTEXTS, DISCLOSURE = 8, 3, 0.8
TABLE_BITS = 24
KEEP = 500_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"\w+")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, ``@`` and dotted domain, from one ``@`` to the next."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in _LOCAL:
            begin -= 1
        end = begin < at and _DOMAIN.match(text, at + 1)
        if end:
            last = end.end()
            out.append((begin, last))
        at = text.find("@", max(at + 1, last))
    return out


def _luhn(digits: str) -> bool:
    twice = sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return (twice + sum(map(int, digits[-1::-2]))) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind and start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((1, *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = _NOT_DIGIT.sub("", m[0])
                if 16 <= len(digits) <= 19 and _luhn(digits):
                    out.append((2, *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    out.append((3, *m.span()))
    return out


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def _key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def _entity(kind: int, value: str) -> int:
    return _key(f"{kind}:" + (value.lower() if kind < 2 else _NOT_DIGIT.sub("", value)))


def mentions(text: str, spans: list[tuple[int, int, int]]) -> tuple[list, list]:
    """(term, start, end) of all words outside base spans; (entity, surroundings), one for each
    entity, so that a document is one of its surroundings however often it names it."""
    covered = sorted((a, b) for _, a, b in spans)
    words, k = [], 0
    for m in _WORD.finditer(text):
        while k < len(covered) and covered[k][1] <= m.start():
            k += 1
        if not (k < len(covered) and covered[k][0] < m.end()) and len(m[0]) > 2:
            words.append((m[0].lower(), *m.span()))
    starts = np.array([w[1] for w in words], np.int64)
    keys = {w: _key(w) for w in {w[0] for w in words}}
    held: dict[int, int] = {}
    for kind, a, b in spans:
        at = int(np.searchsorted(starts, a))
        around = words[max(0, at - REACH) : at + REACH]
        entity, context = _entity(kind, text[a:b]), _key(" ".join(w[0] for w in around))
        held[entity] = min(context, held.get(entity, context))
    return [(keys[w], a, b) for w, a, b in words], sorted(held.items())


_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
_WORD_FIELDS, _HELD_FIELDS = ("term", "start", "end"), ("entity", "context")
_WORDS, _HELD = (pa.struct([(f, pa.int64()) for f in fields]) for fields in (_WORD_FIELDS, _HELD_FIELDS))
_FOUND = (
    "doc_id bigint, rk bigint, spans array<struct<kind:int,start:bigint,end:bigint>>, "
    "words array<struct<term:bigint,start:bigint,end:bigint>>, "
    "held array<struct<entity:bigint,context:bigint>>"
)


def _find(batches: Batches) -> Batches:
    for batch in batches:
        ids, rks, texts = batch.columns
        for lo, hi in pieces(texts):
            spans, words, held = [], [], []
            for text in strings(texts.slice(lo, hi - lo)):
                found = base_spans(text)
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
                own, of = mentions(text, found) if found else ((), ())
                words.append([dict(zip(_WORD_FIELDS, x)) for x in own])
                held.append([dict(zip(_HELD_FIELDS, x)) for x in of])
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), rks.slice(lo, hi - lo),
                 pa.array(spans, pa.list_(_SPAN)), pa.array(words, pa.list_(_WORDS)),
                 pa.array(held, pa.list_(_HELD))],
                names=["doc_id", "rk", "spans", "words", "held"],
            )


def _slot(term: int) -> int:
    return (term & 0xFFFFFFFFFFFFFFFF) >> (64 - TABLE_BITS)


def _term_table(terms: DataFrame) -> Broadcast:
    """A bit for each term whose documents are to be counted; as large for any number."""
    slots = F.shiftrightunsigned("term", 64 - TABLE_BITS)
    word, bit = F.shiftrightunsigned(slots, 6), slots.bitwiseAND(F.lit(63)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    words = terms.select(word.alias("word"), one.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    table = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    for r in words.collect():  # at most 2**(TABLE_BITS - 6) words of 64 bits
        table[r["word"]] = r["bits"]
    return terms.sparkSession.sparkContext.broadcast(table.tobytes())


def _term_counts(table: Broadcast):
    def run(batches: Batches) -> Batches:
        bits = np.frombuffer(table.value, np.int64)
        known: dict[str, int | None] = {}
        counts: Counter[int] = Counter()
        for batch in batches:
            for text in strings(batch.column(0)):
                words = set(_WORD.findall(text.lower()))
                for w in words.difference(known):
                    term = _key(w) if len(w) > 2 else 0
                    slot = _slot(term)
                    known[w] = term if (int(bits[slot >> 6]) >> (slot & 63)) & 1 and len(w) > 2 else None
                counts.update([t for t in map(known.__getitem__, words) if t is not None])
                if len(known) > KEEP:
                    known.clear()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())],
            names=["term", "docs"],
        )

    return run


def disclosive(
    docs: DataFrame, found: DataFrame, held: DataFrame, words: DataFrame, min_contexts: int, least: float
) -> DataFrame:
    """(entity, term) pairs above the disclosure threshold, from counts over all documents."""
    n = found.count()
    met = words.select("row", "term").distinct()
    often = met.groupBy("term").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_contexts)
    often = save(often.select("term"), "terms")
    counted = map_arrow(docs.select("text"), _term_counts(_term_table(often)), "term bigint, docs bigint")
    terms = counted.groupBy(F.col("term").alias("of")).agg(F.sum("docs").alias("with_term"))
    # told >= least * whole, and n(t,e) <= n(e): a term in more documents cannot tell enough.
    bound = F.pow(F.lit(float(n)), F.lit(1 - least)) * F.pow(F.col("with_entity"), F.lit(least)) * (1 + 1e-9)
    most = held.select(F.max(bound)).first()[0] or 0.0
    terms = save(terms.filter(F.col("with_term") <= most), "rare-terms")
    rare = lookup_join(met, terms, "term", "of", "inner", row_id=["row"])
    pairs = rare.join(held, "row").filter(F.col("with_term") <= bound)
    by = ["entity", "term", "with_entity", "with_term"]
    both = pairs.groupBy(*by).agg(F.count(F.lit(1)).alias("both"))
    seen = pairs.select("entity", "term", "context").distinct().groupBy("entity", "term").agg(
        F.count(F.lit(1)).alias("contexts")
    )
    enough = both.join(seen.filter(F.col("contexts") >= min_contexts), ["entity", "term"])
    told = F.log(F.lit(float(n)) * F.col("both") / (F.col("with_term") * F.col("with_entity")))
    whole = F.log(F.lit(float(n)) / F.col("with_entity"))
    return enough.filter((whole > 0) & (told >= F.lit(least) * whole)).select("entity", "term")


def find_spans(
    docs: DataFrame, *, min_contexts: int = MIN_CONTEXTS, disclosure: float = DISCLOSURE
) -> DataFrame:
    """One row per row of ``docs``: doc_id, rk, base spans, and the added spans of terms."""
    ship(docs.sparkSession)
    own = docs.select("doc_id", row_key("text").alias("rk"), "text")
    found = save(
        map_arrow(own, _find, _FOUND).withColumn("row", F.monotonically_increasing_id()), "mentions"
    )
    held = found.select("row", F.explode("held").alias("x")).select("row", "x.entity", "x.context")
    contexts = held.select("entity", "context").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("contexts"))
    sizes = held.select("row", "entity").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("with_entity"))
    recurring = contexts.filter(F.col("contexts") >= min_contexts).join(sizes, "entity")
    recurring = save(recurring.select(F.col("entity").alias("of"), "with_entity"), "entities")
    held = save(lookup_join(held, recurring, "entity", "of", "inner", row_id=["row", "context"]), "held")
    bearing = found.join(held.select("row").distinct(), "row", "left_semi")
    words = save(
        bearing.select("row", F.explode("words").alias("x")).select("row", "x.term", "x.start", "x.end"), "words"
    )
    pairs = save(disclosive(docs, found, held, words, min_contexts, disclosure), "disclosive")
    near = lookup_join(
        words, pairs.select(F.col("term").alias("tells")).distinct(), "term", "tells", "inner", row_id=["row", "start"]
    )
    near = near.join(held.select("row", "entity").distinct(), "row").select(
        "row", F.concat_ws(":", "entity", "term").alias("pair"), "start", "end"
    )
    keys = pairs.select(F.concat_ws(":", "entity", "term").alias("key"))
    hit = lookup_join(near, keys, "pair", "key", "inner", row_id=["row", "start"])
    added = hit.groupBy(F.col("row").alias("of_row")).agg(
        F.collect_set(F.struct(F.lit(4).alias("kind"), "start", "end")).alias("terms")
    )
    rows = found.drop("words", "held").join(added, F.col("row") == F.col("of_row"), "left")
    return rows.select("doc_id", "rk", "spans", "terms")


def _summary(batches: Batches) -> Batches:
    for batch in batches:
        ids, spans, terms = batch.columns
        counts, shas, texts = [[], [], [], []], [], []
        for own, more in zip(spans.to_pylist(), terms.to_pylist()):
            base = [(s["kind"], s["start"], s["end"]) for s in own]
            extra = [(s["kind"], s["start"], s["end"]) for s in more or ()]
            for k in range(4):
                counts[k].append(sum(s[0] == k for s in base))
            shas.append(hashlib.sha256(spans_text(base).encode()).hexdigest())
            texts.append(spans_text(base + extra))
        yield pa.RecordBatch.from_arrays(
            [ids, *[pa.array(c, pa.int64()) for c in counts], pa.array(shas), pa.array(texts)],
            names=["doc_id", *[f"n_{k}" for k in KINDS[:4]], "base_sha256", "spans"],
        )


def digest(found: DataFrame) -> DataFrame:
    counts = ", ".join(f"n_{k} bigint" for k in KINDS[:4])
    return map_arrow(found.select("doc_id", "spans", "terms"), _summary,
                     f"doc_id bigint, {counts}, base_sha256 string, spans string")


def sanitized(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Labels for base spans; numbers and names among terms generalised, other terms removed.

    Where spans overlap, the earlier one covers the stretch, of equal starts the longer.
    """
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if a < at:
            a = at
        if b <= a:
            continue
        word = text[a:b]
        label = f"[{KINDS[kind]}]" if kind < 4 else (
            "[number]" if word.isdigit() else "[name]" if word[:1].isupper() else "")
        out += [text[at:a], label]
        at = b
    return "".join(out) + text[at:]


def _sanitize(batches: Batches) -> Batches:
    for batch in batches:
        rows, texts, spans = batch.columns
        out = []
        for text, own in zip(texts.to_pylist(), spans.to_pylist()):
            out.append(sanitized(text, [tuple(s.values()) for s in own]) if text and own else text)
        yield pa.RecordBatch.from_arrays([rows, pa.array(out, pa.string())], names=["__row", "__text"])


def sanitize(docs: DataFrame, **limits: float) -> DataFrame:
    """``docs`` with sanitised texts, the same columns and rows."""
    found = find_spans(docs, **limits).select(
        F.col("doc_id").alias("__id"), F.col("rk").alias("__rk"),
        F.concat("spans", F.coalesce("terms", F.expr("slice(spans, 1, 0)"))).alias("__spans"),
    )
    found = found.filter(F.size("__spans") > 0).dropDuplicates(["__id", "__rk"])
    own = packed(docs, row_key("text").alias("__own"))
    same = F.col("__row.doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__rk"))
    rows = own.join(found, same, "left").select("__row", "__text", "__spans")
    return unpacked(map_arrow(rows, _sanitize, with_row("__text string", rows)), docs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_spans(spark.read.parquet(f"{sf_dir}/documents.parquet")))
