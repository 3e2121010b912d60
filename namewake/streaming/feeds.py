"""Feeds of several dimensions as one stream."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewake.entities import EntitySpec
from namewake.functions.values import json_value

FEED_COLUMNS = ("entity", "msg_key", "msg_value", "key", "op_type", "name", "ord")


def tag_feed(
    changes: DataFrame, spec: EntitySpec, order: Sequence[str], value: Column | None = None
) -> DataFrame:
    """One dimension's feed in the common form.

    ``order`` names the columns that order the changes of one key: partition and
    offset of a topic, pos and op_ts of a file. The message is carried along
    unchanged if the feed has one (``msg_key``, ``msg_value``); otherwise it is the
    key as text and ``value``, by default the whole row as JSON.
    """
    if "msg_value" in changes.columns:
        msg_key, msg_value = F.col("msg_key"), F.col("msg_value")
    else:
        msg_key = F.col(spec.key).cast("string")
        msg_value = json_value(*changes.columns) if value is None else value
    return changes.select(
        F.lit(spec.entity).alias("entity"),
        msg_key.alias("msg_key"),
        msg_value.alias("msg_value"),
        F.col(spec.key).cast("string").alias("key"),
        "op_type",
        F.col(spec.name).alias("name"),
        F.struct(*order).alias("ord"),
    )


def union_feeds(feeds: Sequence[DataFrame]) -> DataFrame:
    """All feeds as one, so that a single query writes the target."""
    return reduce(DataFrame.unionByName, feeds)
