"""Operator 10: quality rules with cross-document line frequency.

Lines are normalised (A-Z lower-cased, white space collapsed), hashed, and counted: in how
many distinct documents of one host (``source``) does a line occur? Lines above the limit
are boilerplate and go; documents with too little left are rejected, as are documents that
fail the plain rules (too few words, too much repetition).

A document is its exact text: copies of one page count once, in the count of a line and in
the host's size. Near copies are different documents here. So a host with more versions of
one page than the limit loses the lines that the versions share; they are alike in nearly
all of their text, as pages are that consist of boilerplate.

One row of each text is found first; counting its lines is then one aggregate that combines
map-side. Lines above the limit are few beside all lines (each stands for ``max_docs``
documents at least); they are joined back by broadcast where counted to fit, else by a
salted shuffle, since one line may be in a third of all rows.

Defined results: a null text is an empty one, has no words and fails the rules; null is a
host of its own; repeated rows are judged alike and each comes back; an empty table gives an empty result; a text of one long line has one line.
Other columns, whatever their names, are carried by ``clean_documents`` only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namewake.llm.common import (
    U64, Batches, among, by_text, find_words, hash_windows, hash_words, map_arrow, mix,
    packed, pieces, row_key, save, strings, text_bytes, unpacked, with_row,
)
from namewake.operators.joins import lookup_join

SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
#: A line goes when more distinct documents of one host than this have it: the larger of both.
MAX_DOCS, MAX_SHARE = 20, 0.002
#: A document goes when less than this share of its words is left.
MIN_LEFT = 0.2

_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SCHEMA = (
    "doc_id bigint, host string, rk bigint, "
    + ", ".join(f"{c} bigint" for c in _STATS)
    + ", lines array<struct<h:bigint,words:bigint>>"
)


def normal_line(line: bytes) -> bytes:
    return b" ".join(line.lower().split())


def line_hash(normal: bytes) -> int:
    return int.from_bytes(hashlib.md5(normal).digest()[8:], "little", signed=True)


def word_stats(texts: pa.Array) -> dict[str, np.ndarray]:
    """All counts but repeated lines, for a piece of the column."""
    data, offs = text_bytes(texts)
    starts, ends, first = find_words(data, offs)
    char = (data & 0xC0) != 0x80
    n_words = np.diff(first)
    text_of = np.repeat(np.arange(len(texts), dtype=U64), n_words)
    words = hash_words(data, starts, ends)
    covered = np.zeros(len(words) + 2, bool)
    windows = hash_windows(words, 3)
    inside = np.flatnonzero(text_of[: len(windows)] == text_of[2:]) if len(windows) else []
    if len(inside):
        keys = windows[inside] ^ mix(text_of[inside] + U64(1))
        _, back, counts = np.unique(keys, return_inverse=True, return_counts=True)
        again = inside[counts[back] > 1]
        for k in range(3):
            covered[again + k] = True
    return {
        "n_words": n_words,
        "word_chars": by_text(char & ~among(data, b" \t\n\x0b\x0c\r"), offs),
        "n_symbols": by_text(among(data, SYMBOLS), offs),
        "n_repeat_words": by_text(covered[: len(words)], first),
    }


def _lines(text: str) -> tuple[int, dict[int, int]]:
    """Repeated lines; words by line hash."""
    raw = [line for line in text.encode().split(b"\n") if line.split()]
    by_hash: dict[int, int] = {}
    for line in raw:
        normal = normal_line(line)
        h = line_hash(normal)
        by_hash[h] = by_hash.get(h, 0) + normal.count(b" ") + 1
    return len(raw) - len(set(raw)), by_hash


def _profile(batches: Batches) -> Batches:
    lines_type = pa.list_(pa.struct([("h", pa.int64()), ("words", pa.int64())]))
    for batch in batches:
        ids, hosts, rks, texts = batch.columns
        for lo, hi in pieces(texts):
            part = texts.slice(lo, hi - lo)
            stats = word_stats(part)
            dup, lines = [], []
            for text in strings(part):
                n, by_hash = _lines(text)
                dup.append(n)
                lines.append([{"h": h, "words": w} for h, w in by_hash.items()])
            stats["n_dup_lines"] = np.array(dup, np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), hosts.slice(lo, hi - lo), rks.slice(lo, hi - lo)]
                + [pa.array(stats[c], pa.int64()) for c in _STATS]
                + [pa.array(lines, lines_type)],
                names=["doc_id", "host", "rk", *_STATS, "lines"],
            )


def _host_key(host: Column, h: Column) -> Column:
    return F.concat(F.hex(h), F.coalesce(F.concat(F.lit("="), host), F.lit("")))


def frequent_lines(profile: DataFrame, max_docs: int, max_share: float) -> DataFrame:
    """Hosts' lines (host, h) in more distinct documents than the limit."""
    firsts = profile.groupBy("host", "rk").agg(F.min("row").alias("first"))
    firsts = save(firsts.select("host", "first"), "distinct-texts")
    one_each = lookup_join(
        profile.select("row", "host", "lines"), firsts.select("first"), "row", "first", "left_semi", row_id=["row"]
    )
    lines = one_each.select("host", F.explode("lines.h").alias("h"))
    counts = lines.groupBy("host", "h").agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") > max_docs)
    sizes = firsts.groupBy(F.col("host").alias("of")).agg(F.count(F.lit(1)).alias("size"))
    # Hosts' sizes are one row a host; the counts left are few.
    return (
        counts.join(sizes, F.col("host").eqNullSafe(F.col("of")))
        .filter(F.col("docs") > F.col("size") * max_share)
        .select("host", "h")
    )


def judge(
    docs: DataFrame,
    *,
    max_docs: int = MAX_DOCS,
    max_share: float = MAX_SHARE,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """One row per row of ``docs``: counts, verdicts, and ``frequent``, the lines to remove."""
    own = docs.select(
        "doc_id", F.col("source").alias("host"), row_key("source", "text").alias("rk"), "text"
    )
    profile = save(
        map_arrow(own, _profile, _SCHEMA).withColumn("row", F.monotonically_increasing_id()),
        "line-profile",
    )
    frequent = frequent_lines(profile, max_docs, max_share).select(
        _host_key(F.col("host"), F.col("h")).alias("key"), F.lit(True).alias("above")
    )
    frequent = save(frequent, "frequent-lines")
    lines = profile.select("row", "host", F.explode("lines").alias("line")).select(
        "row",
        _host_key(F.col("host"), F.col("line.h")).alias("line_key"),
        F.col("line.h").alias("h"),
        F.col("line.words").alias("words"),
    )
    hit = lookup_join(lines, frequent, "line_key", "key", "inner", row_id=["row", "h"])
    removed = hit.groupBy(F.col("row").alias("of_row")).agg(
        F.sum("words").alias("removed_words"), F.collect_list("h").alias("frequent")
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    gone = F.coalesce("removed_words", F.lit(0).cast("bigint"))
    left = F.col("n_words") - gone
    return profile.join(removed, F.col("row") == F.col("of_row"), "left").select(
        "doc_id",
        "rk",
        *_STATS,
        gone.alias("removed_words"),
        failed.alias("base_failed"),
        (~failed & (left >= F.lit(min_left) * F.col("n_words"))).alias("kept"),
        "frequent",
    )


def _without_lines(batches: Batches) -> Batches:
    for batch in batches:
        rows, texts, hashes = batch.columns
        out = []
        for text, go in zip(texts.to_pylist(), hashes.to_pylist()):
            if text and go:
                drop = set(go)
                kept = [x for x in text.split("\n") if line_hash(normal_line(x.encode())) not in drop]
                text = "\n".join(kept)
            out.append(text)
        yield pa.RecordBatch.from_arrays([rows, pa.array(out, pa.string())], names=["__row", "__text"])


def clean_documents(docs: DataFrame, **limits: float) -> DataFrame:
    """Kept documents without their frequent lines, with the columns of ``docs``."""
    verdicts = judge(docs, **limits).filter("kept").select(
        F.col("doc_id").alias("__id"), F.col("rk").alias("__rk"), F.col("frequent").alias("__frequent")
    )
    verdicts = verdicts.dropDuplicates(["__id", "__rk"])
    own = packed(docs, row_key("source", "text").alias("__own"))
    same = F.col("__row.doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__rk"))
    rows = own.join(verdicts, same).select("__row", "__text", "__frequent")
    return unpacked(map_arrow(rows, _without_lines, with_row("__text string", rows)), docs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return judged.drop("rk", "frequent")


ORACLE = r"""
WITH words AS (
    SELECT doc_id, source, coalesce(text, '') AS text,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                       lambda w: w <> '') AS w
    FROM documents
), windows AS (
    SELECT doc_id, i, w[i:i + 2] AS g FROM words, unnest(range(1, len(w) - 1)) AS t(i)
), again AS (
    SELECT doc_id, i FROM windows
    QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), repeated AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(0, 3) AS s(k) GROUP BY doc_id
), raw_lines AS (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM words
), lines AS (
    SELECT doc_id, source, line, trim(regexp_replace(translate(line,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
    FROM raw_lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dups AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id
), by_line AS (
    SELECT doc_id, source, norm, sum(len(string_split(norm, ' '))) AS words
    FROM lines GROUP BY ALL
), sizes AS (
    SELECT source, count(DISTINCT text) AS size FROM words GROUP BY source
), frequent AS (
    SELECT b.source, norm FROM by_line b JOIN words USING (doc_id) JOIN sizes c ON b.source IS NOT DISTINCT FROM c.source
    GROUP BY b.source, norm, size
    HAVING count(DISTINCT text) > greatest(20, 0.002 * size)
), removed AS (
    SELECT doc_id, sum(words) AS n FROM by_line b JOIN frequent f
      ON b.norm = f.norm AND b.source IS NOT DISTINCT FROM f.source GROUP BY doc_id
)
SELECT w.doc_id, len(w) AS n_words,
       length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
       length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
       coalesce(d.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
       CAST(coalesce(g.n, 0) AS BIGINT) AS removed_words,
       len(w) < 50 OR 100 * coalesce(r.n, 0) > 50 * len(w) AS base_failed,
       NOT (len(w) < 50 OR 100 * coalesce(r.n, 0) > 50 * len(w))
       AND len(w) - coalesce(g.n, 0) >= 0.2 * len(w) AS kept
FROM words w LEFT JOIN dups d USING (doc_id) LEFT JOIN repeated r USING (doc_id)
LEFT JOIN removed g USING (doc_id)
"""
