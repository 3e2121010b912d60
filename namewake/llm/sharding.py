"""Operator 13: sharding. Contiguous shards of near equal bytes, cut out of one order.

Documents stand in the order of their ids. Rows are dealt to partitions by ranges of that
order; sizes are summed within each partition, and the partitions' totals, as many numbers
as there are partitions, are summed in turn. So every document knows the bytes before it
in the whole corpus. A document belongs to the shard in which its middle byte lies when
the corpus is cut into equal lengths: shards differ from their target by no more than one
document at either end. JVM-side throughout. Texts are not moved to find the cuts: only
id, size and checksum go through the two shuffles; ``write_shards`` moves them once.

Defined results: a null text has the size of an empty one, 1 (each size counts one byte
for the text's end). Null ids come first. Rows of one id are ordered by checksum and size;
equal rows are interchangeable and may lie in two shards, as may equal texts: the law is
bytes, and a group of copies may be larger than a shard. A document larger than a shard
lies in one shard alone and may leave others empty. An empty table has no shards. Other
columns are not read, or, by ``write_shards``, kept as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from namewake.llm.common import save
from namewake.llm.ranges import in_order, part_of, row_of

SHARDS = 8


def measured(docs: DataFrame, doc_id: str, text: str) -> list[F.Column]:
    """Id, size and checksum of each document, as ``__id``, ``size`` and ``text_crc32``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return [
        F.col(doc_id).alias("__id"),
        (F.octet_length(whole) + 1).cast("bigint").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
    ]


_ORDER = ("__id", "text_crc32", "size")


def _order() -> list[F.Column]:
    first, *rest = _ORDER
    return [F.col(first).asc_nulls_first(), *map(F.col, rest)]


def cut(placed: DataFrame, shards: int) -> DataFrame:
    """Rows with ``ord`` and ``size`` (see ``in_order``), and their ``shard`` and ``slot``.

    ``placed`` must be stored. ``slot`` counts the rows of a shard from 0.
    """
    parts = placed.withColumn("part", part_of(F.col("ord")))
    totals = parts.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    # One row for each partition: a bound that does not grow with the documents.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("bytes_all"),
    )
    inside = Window.partitionBy("part").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    summed = parts.withColumn("upto", F.sum("size").over(inside)).join(F.broadcast(before), "part")
    middle = "2 * (bytes_before + upto) - size"
    numbered = summed.select(
        *placed.columns,
        F.expr("bytes_before + upto - size").alias("start_byte"),
        (F.col("rows_before") + row_of(F.col("ord"))).alias("row"),
        F.expr(f"int(least({shards - 1}, ({middle}) * {shards} div (2 * bytes_all)))").alias("shard"),
    )
    numbered = save(numbered, "shard-rows")
    firsts = numbered.groupBy("shard").agg(F.min("row").alias("first_row"))  # one row a shard
    slotted = numbered.join(F.broadcast(firsts), "shard")
    return slotted.select(*placed.columns, "start_byte", "shard", (F.col("row") - F.col("first_row")).alias("slot"))


def assign_shards(
    docs: DataFrame, shards: int = SHARDS, *, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """For every document its id, size, text_crc32, start_byte, shard and slot."""
    placed = save(in_order(docs.select(*measured(docs, doc_id, text)), _order()), "shard-order")
    return cut(placed, shards).select(
        F.col("__id").alias(doc_id), "size", "text_crc32", "start_byte", "shard", "slot"
    )


def write_shards(
    docs: DataFrame,
    path: str,
    shards: int = SHARDS,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    format: str = "parquet",
) -> None:
    """Write whole documents in folders ``shard=0`` and so on, files in the order of ids.

    A row is ``document``, with all columns as they were, and ``ord``, the order. Texts are moved once, to
    the ranges of the order; the cuts are then at most ``shards - 1`` places in it.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    whole = docs.select(F.struct(*names).alias("document"), *measured(docs, doc_id, text))
    placed = save(in_order(whole, _order()).drop("__id", "text_crc32"), "shard-texts")
    found = cut(placed.select("ord", "size"), shards).groupBy("shard").agg(F.min("ord").alias("at"))
    starts = sorted((r["at"], r["shard"]) for r in found.collect())
    shard = F.lit(0)
    for at, number in starts:
        shard = F.when(F.col("ord") >= at, number).otherwise(shard)
    kept = placed.select("document", "ord", shard.cast("int").alias("shard"))
    kept.write.partitionBy("shard").format(format).save(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return assign_shards(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "start_byte",
    )


ORACLE = r"""
WITH RECURSIVE steps AS (  -- the table of the checksum, from its polynomial
    SELECT range AS i, range::BIGINT AS c, 0 AS k FROM range(256)
    UNION ALL
    SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), crc_table AS (
    SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8
), read AS (
    SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents
), bytes AS (
    SELECT doc_id, octet_length(b) + 1 AS size,
           list_transform(range(1, octet_length(b) + 1), lambda j: ('0x' || hex(b[j:j]))::BIGINT) AS list
    FROM read
), sums AS (
    SELECT doc_id, size, xor(list_reduce(list, lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295), 4294967295) AS text_crc32
    FROM bytes, crc_table
), placed AS (
    SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING) AS upto,
           sum(size) OVER () AS whole,
           row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) AS row
    FROM sums
), cuts AS (
    SELECT *, least(7, (2 * upto - size) * 8 // (2 * whole))::INT AS shard FROM placed
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
       row - min(row) OVER (PARTITION BY shard) AS slot, NULL::INT AS grown_shard,
       (upto - size)::BIGINT AS start_byte
FROM cuts
"""
