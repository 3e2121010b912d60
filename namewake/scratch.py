"""Tables kept in the shared folder while a query or job needs them."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="namewake-")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the cluster's shared folder, ``spark.checkpoint.dir``.

    A machine-local folder stands in for it in local mode only. Paths carry the
    application id, so that one application's leftovers can be dropped together.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    app = spark.sparkContext.applicationId
    return f"{base.rstrip('/')}/namewake/{app}/{purpose}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Size:
    """Counted rows and in-memory bytes of a table."""

    rows: int
    bytes: int


_ROW, _CELL = 24, 16


def _fixed_bytes(schema: T.StructType) -> int:
    """Bytes of a row without its text, the least a row can take."""
    for field in schema.fields:
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            raise TypeError(f"flatten column {field.name} before measuring it")
    return _ROW + _CELL * len(schema.fields)


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of one row: fixed-width columns by type, text and binary as counted."""
    text = [
        F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)).cast("bigint")
        for f in schema.fields
        if isinstance(f.dataType, (T.StringType, T.BinaryType))
    ]
    return sum(text, F.lit(_fixed_bytes(schema)).cast("bigint"))


def _counts(tables: Sequence[DataFrame], what: Callable[[DataFrame], Column]) -> list[int]:
    if not tables:
        return []
    one_each = [t.agg(F.lit(i).alias("i"), what(t).alias("n")) for i, t in enumerate(tables)]
    return [r["n"] or 0 for r in sorted(reduce(DataFrame.unionAll, one_each).collect())]


def measure_all(tables: Sequence[DataFrame], enough: int) -> list[Size]:
    """Count rows and bytes of several tables, all in one job or two.

    Rows are counted first, for which files need not be read beyond their footers.
    Where these alone make more than ``enough`` bytes, the text is not looked at,
    and the bytes are a lower bound.
    """
    rows = _counts(tables, lambda t: F.count(F.lit(1)))
    least = [n * _fixed_bytes(t.schema) for n, t in zip(rows, tables)]
    near = [i for i, n in enumerate(least) if n <= enough]
    exact = _counts([tables[i] for i in near], lambda t: F.sum(row_bytes(t.schema)))
    sizes = dict(enumerate(least)) | dict(zip(near, exact))
    return [Size(n, sizes[i]) for i, n in enumerate(rows)]


def measure(df: DataFrame, enough: int) -> Size:
    """Count rows and bytes of ``df``, these only as far as they matter."""
    return measure_all([df], enough)[0]


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` in memory and on disk while it is used several times."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def settle(df: DataFrame, purpose: str = "settled") -> tuple[DataFrame, Size]:
    """Write ``df`` to the shared folder; return it read back, with its size.

    The write counts rows and bytes on the way, so knowing whether the table may
    be broadcast costs no further pass. The table outlives a lost executor and
    cuts the lineage.
    """
    spark, seen = df.sparkSession, Observation()
    path = shared_folder(spark, purpose)
    df.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df.schema)).alias("bytes")
    ).write.parquet(path)
    counted = seen.get
    size = Size(counted["rows"], counted["bytes"] or 0)
    return spark.read.schema(df.schema).parquet(path), size
