"""Rows in one global order, in partitions that each hold a range of it."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from namewake.llm.common import map_arrow, partitions, save
from namewake.operators.joins import lookup_join

#: Lower bits of ``ord``: the row's place in its partition. Above them is the partition.
ROW_BITS = 33

#: Bytes of a piece of a long text that is hashed in order.
PACKED_BYTES = 1 << 20


def in_order(df: DataFrame, by: Sequence[Column], count: int | None = None) -> DataFrame:
    """The rows sorted by ``by``, with their place as ``ord``, which grows along the order.

    Rows that agree in ``by`` are told apart by where they stood in ``df``, so that no key
    is too frequent for one partition. Save the result before using ``ord`` twice.
    """
    salted = df.withColumn("__salt", F.monotonically_increasing_id())
    keys = [*by, F.col("__salt")]
    ranged = salted.repartitionByRange(count or partitions(df.sparkSession), *keys)
    placed = ranged.sortWithinPartitions(*keys).withColumn("ord", F.monotonically_increasing_id())
    return placed.drop("__salt")


def part_of(ord: Column) -> Column:
    return F.shiftright(ord, ROW_BITS).cast("int")


def row_of(ord: Column) -> Column:
    """Place in the partition, from 0."""
    return ord.bitwiseAND(F.lit((1 << ROW_BITS) - 1))


def dense_rows(placed: DataFrame) -> DataFrame:
    """Stored rows with ``ord``, numbered from 0 in ``__nth``."""
    parts = placed.withColumn("__part", part_of(F.col("ord")))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))  # one row a partition
    before = counts.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    met = parts.join(F.broadcast(before), "__part")
    return met.withColumn("__nth", F.col("__before") + row_of(F.col("ord"))).drop("__part", "__before")


def with_copy(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows with ``__copy``, their number among those that agree in ``keys``, from 0.

    Only rows that do have copies are ordered; copies are numbered over all tasks, so there
    may be any number of them.
    """
    own = df.withColumns({"__key": F.xxhash64(*keys, *[F.col(k).isNull() for k in keys]), "__at": F.monotonically_increasing_id()})
    again = own.groupBy(F.col("__key").alias("__of")).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    again = save(again.select("__of", F.lit(True).alias("__again")), "repeated")
    if again.isEmpty():
        return df.withColumn("__copy", F.lit(0).cast("bigint"))
    marked = lookup_join(own, again, "__key", "__of", "left", row_id=["__at"])
    single = marked.filter("__again IS NULL").select(*df.columns, F.lit(0).cast("bigint").alias("__copy"))
    several = marked.filter("__again").drop("__again", "__at")
    order = [F.col("__key"), *[F.col(k).asc_nulls_first() for k in keys]]
    rows = dense_rows(save(in_order(several, order), "copies"))
    told = F.struct(*keys)
    first = rows.groupBy("__key", told.alias("__told")).agg(F.min("__nth").alias("__first"))
    first = save(first.select(F.xxhash64("__told", "__key").alias("__group"), "__first"), "first-copies")
    met = lookup_join(
        rows.withColumn("__mine", F.xxhash64(told, "__key")), first, "__mine", "__group", "inner", row_id=["__nth"]
    )
    return single.unionByName(met.select(*df.columns, (F.col("__nth") - F.col("__first")).alias("__copy")))


def stream_sha256(pieces: DataFrame, by: Sequence[str], at: Sequence[str], skip: int) -> DataFrame:
    """SHA-256 of each group's pieces end to end: columns ``by`` and ``sha256``.

    A hash is a chain, so a group is read by one task, piece after piece; no more than a
    batch of pieces is in memory. Pieces should be large, so that they are few. The first
    ``skip`` bytes of a group, such as a separator, are left out.
    """
    spread = pieces.repartition(partitions(pieces.sparkSession), *by)
    ordered = spread.sortWithinPartitions(*by, *at).select(*by, "piece")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema.fields[:-1])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, schema = None, None, None
        for batch in batches:
            keys = pa.schema([batch.schema.field(i) for i in range(len(by))])
            schema, out = keys.append(pa.field("sha256", pa.string())), []
            *columns, texts = batch.to_pydict().values()
            for key, text in zip(zip(*columns), texts):
                if state is None or key != current:
                    if state is not None:
                        out.append((*current, state.hexdigest()))
                    current, state, text = key, hashlib.sha256(), text[skip:]
                state.update(text)
            if out:
                yield _batch(out, schema)
        if state is not None:
            yield _batch([(*current, state.hexdigest())], schema)

    return map_arrow(ordered, hashed, f"{kinds}, sha256 string")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
