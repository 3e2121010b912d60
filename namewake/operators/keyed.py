"""Rows stored by key, so that joins on the key do not move them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namewake.operators.joins import hot_keys

_SALT, _HOT, _SALTS = "namewake_salt", "__hot_key", "__salts"


def _salted(df: DataFrame, key: str, hot: DataFrame, salt: Column) -> DataFrame:
    met = df.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col(_HOT)), "left")
    return met.withColumn(_SALT, salt).drop(_HOT, _SALTS)


@dataclass(frozen=True)
class KeyedTable:
    """A table in buckets by key and salt, under a name in the catalog.

    Keys so frequent that their bucket would outgrow a task are cut into pieces by a salt;
    which keys these are, and how many pieces, is stored in ``<name>_hot`` (a bounded
    table, see ``hot_keys``). A join repeats the other side's rows of such keys.
    """

    spark: SparkSession
    name: str
    key: str
    buckets: int

    @classmethod
    def write(
        cls, df: DataFrame, key: str, name: str, path: str, row_id: Sequence[Column | str], buckets: int | None = None
    ) -> KeyedTable:
        """Store ``df`` below ``path``; one shuffle, one file a bucket.

        ``row_id`` tells the rows of a key apart. Buckets are as many as shuffle partitions
        unless given.
        """
        spark = df.sparkSession
        count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        hot_keys(df.select(key)).write.option("path", f"{path}/hot").saveAsTable(f"{name}_hot")
        hot = spark.table(f"{name}_hot")
        piece = F.pmod(F.xxhash64(*row_id), F.col(_SALTS)).cast("int")
        salted = _salted(df, key, hot, F.coalesce(piece, F.lit(0)))
        dealt = salted.repartition(count, key, _SALT)  # as the buckets are, so that a task writes one
        writer = dealt.write.bucketBy(count, key, _SALT).sortBy(key, _SALT)
        writer.option("path", f"{path}/rows").saveAsTable(name)
        return cls(spark, name, key, count)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name).drop(_SALT)

    def join(self, other: DataFrame, other_key: str, how: str = "left") -> DataFrame:
        """Rows joined with ``other``, whose key is dropped; only ``other`` is shuffled.

        ``how`` is inner, left, left_semi or left_anti. Column names must differ.
        """
        if how not in ("inner", "left", "left_semi", "left_anti"):
            raise ValueError(f"rows of a hot key's pieces cannot be joined {how}")
        hot = self.spark.table(f"{self.name}_hot")
        pieces = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1))
        lookup = _salted(other, other_key, hot, pieces).withColumnRenamed(_SALT, "__other_salt")
        table = self.spark.table(self.name)
        on = (table[self.key] == lookup[other_key]) & (table[_SALT] == lookup["__other_salt"])
        joined = table.join(lookup.hint("merge"), on, how)
        return joined.drop(_SALT, "__other_salt", *([other_key] if how in ("inner", "left") else []))
