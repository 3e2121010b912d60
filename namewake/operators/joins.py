"""Equi-joins of a large fact table with a table of one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namewake.scratch import Size, measure, settle

BROADCAST_BYTES = "spark.namewake.broadcastBytes"
BROADCAST_BYTES_DEFAULT = 64 << 20

# Small pieces even out what hashing them to tasks makes uneven.
PIECES_PER_TASK = 4

_SALT, _SALTS, _HOT = "__salt", "__salts", "__hot_key"


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_BYTES, str(BROADCAST_BYTES_DEFAULT)))


def fits_broadcast(spark: SparkSession, size: Size) -> bool:
    return size.bytes <= broadcast_limit(spark)


def hot_keys(keys: DataFrame) -> DataFrame:
    """Keys of a one-column table too frequent for one shuffle task, with salt counts.

    A key is hot when it holds more rows than a quarter of an average task's share,
    and is split into pieces of about that many. At most four times as many keys as
    there are shuffle partitions can be hot, which bounds the result. The null key
    is treated like any other.
    """
    spark, key = keys.sparkSession, keys.columns[0]
    pieces = PIECES_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    piece = keys.count() // pieces + 1
    return (
        keys.groupBy(F.col(key).alias(_HOT))
        .count()
        .filter(F.col("count") > piece)
        .select(_HOT, F.ceil(F.col("count") / piece).cast("int").alias(_SALTS))
    )


def _salted_join(
    fact: DataFrame,
    lookup: DataFrame,
    fk: str,
    key: str,
    how: str,
    hot: DataFrame,
    row_id: Sequence[Column | str],
) -> DataFrame:
    hot = F.broadcast(hot)
    salted_fact = fact.join(hot, F.col(fk).eqNullSafe(F.col(_HOT)), "left").withColumn(
        _SALT,
        F.when(F.col(_SALTS).isNull(), 0).otherwise(
            F.pmod(F.xxhash64(*row_id), F.col(_SALTS)).cast("int")
        ),
    )
    salted_lookup = lookup.join(hot, F.col(key) == F.col(_HOT), "left").withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1))
    )
    left = salted_fact.drop(_HOT, _SALTS).withColumnRenamed(_SALT, "__fact_salt")
    right = salted_lookup.drop(_HOT, _SALTS)
    on = (left[fk] == right[key]) & (F.col("__fact_salt") == right[_SALT])
    return left.join(right.hint("merge"), on, how).drop("__fact_salt", _SALT)


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    fk: str,
    key: str,
    how: str = "left",
    *,
    row_id: Sequence[Column | str],
    size: Size | None = None,
    base: DataFrame | None = None,
) -> DataFrame:
    """Join ``fact`` with ``lookup`` on ``fk = key``; ``key`` is dropped.

    The lookup is broadcast when its counted size is within the limit: the fact
    is not shuffled, so frequent keys do not matter. Beyond the limit both sides
    are shuffled on (key, salt). Rows of hot keys, and rows without a key, are
    spread by a hash of ``row_id``; lookup rows of hot keys are repeated once per
    salt. ``row_id`` must tell the copies of a row apart.

    ``base`` is a cheaper table with the same ``fk`` values as ``fact`` to find
    the hot keys in. Column names of the two sides must differ.
    """
    spark = fact.sparkSession
    if size is None:
        size = measure(lookup, broadcast_limit(spark))
    if fits_broadcast(spark, size):
        joined = fact.join(F.broadcast(lookup), fact[fk] == lookup[key], how)
    else:
        hot, found = settle(hot_keys((fact if base is None else base).select(fk)), "hot-keys")
        if found.rows:
            joined = _salted_join(fact, lookup, fk, key, how, hot, row_id)
        else:
            joined = fact.join(lookup.hint("merge"), fact[fk] == lookup[key], how)
    return joined.drop(key)


def without_match(
    lookup: DataFrame, fact: DataFrame, fk: str, key: str, size: Size | None = None
) -> DataFrame:
    """Lookup rows whose key does not occur in ``fact``.

    The keys that do occur are found first, once each. Duplicates fall away before
    the shuffle, so frequent keys stay cheap. They are no more than the lookup's
    keys, and broadcast where those may be.
    """
    keys = lookup.select(F.col(key).alias("__wanted"))
    limit = broadcast_limit(fact.sparkSession)
    if size is None:
        size = measure(keys, limit)
    found = fact.select(F.col(fk).alias(key))
    if size.bytes <= limit:
        wanted = F.col(key) == F.col("__wanted")
        found = F.broadcast(found.join(F.broadcast(keys), wanted, "left_semi").distinct())
    else:
        found = found.distinct().hint("merge")
    return lookup.join(found, key, "left_anti")
