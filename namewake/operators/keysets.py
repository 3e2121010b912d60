"""The keys a table holds, as sorted runs beside it."""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namewake.entities import EntitySpec

SCHEMA = "entity string, key string, bucket int"

#: Runs whose sizes differ by less than this factor are of one tier; so many make one of the next.
TIER = 4


def keys_of(rows: DataFrame, specs: Iterable[EntitySpec], bucket: str = "bucket") -> DataFrame:
    """The distinct keys of each dimension in each bucket, as texts of the table's type."""
    parts = [
        rows.select(F.lit(s.entity).alias("entity"), F.col(s.fk).cast("string").alias("key"), F.col(bucket).alias("bucket"))
        .filter("key IS NOT NULL")
        .distinct()
        for s in specs
        if s.fk in rows.columns
    ]
    return reduce(DataFrame.unionByName, parts)


def write_run(keys: DataFrame, path: str) -> int:
    """Store keys in order, so that a reader skips what it does not ask for; the number of rows."""
    spark = keys.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = keys.repartitionByRange(count, "entity", "key", "bucket")
    ranged.sortWithinPartitions("entity", "key").write.parquet(path)
    return spark.read.schema(SCHEMA).parquet(path).count()


def read_runs(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """All runs; a key may be in several."""
    paths = list(paths)
    if not paths:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(*paths)


def to_merge(runs: list[list]) -> list[list]:
    """Runs ([path, rows]) of the lowest tier that has enough of them; none if none has.

    Every key is rewritten once a tier, so adding n keys in small runs costs n log n.
    """
    tiers: dict[int, list] = {}
    for run in runs:
        tiers.setdefault(int(math.log(max(run[1], 1), TIER)), []).append(run)
    return next((found for _, found in sorted(tiers.items()) if len(found) >= TIER), [])
