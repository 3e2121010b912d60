"""Rows of a change feed: projections, filters, latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewake.entities import UPDATE, EntitySpec


def one_envelope(changes: DataFrame) -> DataFrame:
    """Name the first envelope column ``table1``, whichever spelling the feed uses."""
    columns = {c.lower() for c in changes.columns}
    if "table" not in columns:
        return changes
    if "table1" not in columns:
        return changes.withColumnRenamed("table", "table1")
    return changes.withColumn("table1", F.coalesce("table1", "table")).drop("table")


def key_and_op(changes: DataFrame, spec: EntitySpec) -> DataFrame:
    return changes.select(
        F.col(spec.key).alias("key"), "op_type", F.col(spec.name).alias("name")
    )


def non_null(messages: DataFrame, value: str = "value") -> DataFrame:
    """Drop tombstones, which carry a key but no value."""
    return messages.filter(F.col(value).isNotNull())


def updates_only(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col("op_type") == UPDATE)


def null_keys(changes: DataFrame, key: str = "key") -> DataFrame:
    """Changes that name no dimension row, to be looked at rather than applied."""
    return changes.filter(F.col(key).isNull())


def latest_per_key(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The last row of every key by ``order``, as one aggregate.

    Each map task sends at most one row per key, so a key that holds a large part
    of the feed is no burden. Equal orders are settled by the remaining columns,
    which keeps the result the same from run to run.
    """
    rest = [c for c in changes.columns if c not in keys and c not in order]
    last = F.max(F.struct(*order, *rest)).alias("__last")
    return (
        changes.groupBy(*keys)
        .agg(last)
        .select(*keys, *(F.col("__last")[c].alias(c) for c in changes.columns if c not in keys))
    )


def latest_updates(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The last update of every key.

    Updates are picked out first: a later insert or delete of the same key does
    not undo an update that came before it.
    """
    with_key = updates_only(changes)
    for key in keys:
        with_key = with_key.filter(F.col(key).isNotNull())
    return latest_per_key(with_key, keys, order)


def compact(
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    deleted: Column | None = None,
) -> DataFrame:
    """Log compaction: the last row of every key, without keys last seen ``deleted``.

    Works on a stream as well (``complete`` or ``update`` output mode), where the
    state holds one row per key.
    """
    latest = latest_per_key(changes, keys, order)
    return latest if deleted is None else latest.filter(~F.coalesce(deleted, F.lit(False)))


def rekey(stream: DataFrame, column: str, partitions: int | None = None) -> DataFrame:
    """Set the message key to ``column``; row content is unchanged.

    A message sink places rows by key itself, so nothing is shuffled unless a
    number of ``partitions`` is asked for.
    """
    keyed = stream.withColumn("key", F.col(column).cast("string"))
    return keyed if partitions is None else keyed.repartition(partitions, "key")
