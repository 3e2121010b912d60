"""What keys a file holds, in a few bytes: smallest, largest, and a Bloom filter."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A filter has so many words of 64 bits, of which each key sets so many bits.
WORDS, HASHES = 1024, 4

SCHEMA = (
    "file string, fk string, low bigint, high bigint, low_text string, high_text string, bits map<int,bigint>"
)


def _bit(key: Column, i: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(i)), F.lit(64 * WORDS)).cast("int")


def _mask(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(F.lit(63)))


def is_whole_number(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def _texts(held: DataFrame) -> DataFrame:
    """Smallest and largest text of each file and foreign key.

    Spark sorts all rows of a task for the least of texts alone, but keeps one row for each
    group beside a collected value, which therefore has to be of use.
    """
    some = F.collect_set(F.lit(True)).alias("some")
    ends = F.min("key").alias("low_text"), F.max("key").alias("high_text")
    return held.groupBy("file", "fk").agg(some, *ends).filter(F.size("some") > 0).drop("some")


def key_summaries(rows: DataFrame, fks: Sequence[str], file: str = "file") -> DataFrame:
    """One row for each file and foreign key; files without a key in it have none.

    Keys are gathered by word where they are read, so a task holds ``WORDS`` rows for each
    file and foreign key at most, however many rows it reads. Whole numbers have no texts.
    """
    numbers, texts = [], []
    for fk in fks:
        whole = is_whole_number(rows.schema[fk].dataType)
        number = F.col("key").cast("bigint") if whole else F.lit(None).cast("bigint")
        held = rows.select(F.col(file).alias("file"), F.lit(fk).alias("fk"), F.col(fk).cast("string").alias("key"))
        held = held.filter("key IS NOT NULL")
        numbers.append(held.select("*", number.alias("number")))
        texts += [] if whole else [held]
    keys = reduce(DataFrame.unionByName, numbers)
    bits = F.explode(F.array(*[_bit(F.col("key"), i) for i in range(HASHES)]))
    words = (
        keys.select("file", "fk", "number", bits.alias("bit"))
        .groupBy("file", "fk", F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(_mask(F.col("bit"))).alias("set"), F.min("number").alias("low"), F.max("number").alias("high"))
    )
    told = words.groupBy("file", "fk").agg(
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.map_from_entries(F.collect_list(F.struct("word", "set"))).alias("bits"),
    )
    if not texts:
        return told.select("file", "fk", "low", "high", *(F.lit(None).cast("string").alias(c) for c in ("low_text", "high_text")), "bits")
    ends = _texts(reduce(DataFrame.unionByName, texts))
    return told.join(ends, ["file", "fk"], "left").select("file", "fk", "low", "high", "low_text", "high_text", "bits")


def may_hold(summaries: DataFrame, fk: str, key: object) -> DataFrame:
    """Files that may hold a key; a file that does hold it is never left out."""
    text = str(key)
    asked = summaries.filter(F.col("fk") == fk)
    within = F.col("low_text").isNull() | F.lit(text).between(F.col("low_text"), F.col("high_text"))
    if isinstance(key, int):
        within = F.col("low").isNull() | F.lit(key).between(F.col("low"), F.col("high"))
    for i in range(HASHES):
        bit = _bit(F.lit(text), i)
        word = F.coalesce(F.try_element_at("bits", F.shiftright(bit, 6)), F.lit(0))
        within &= word.bitwiseAND(_mask(bit)) != 0
    return asked.filter(within).select("file").distinct()
