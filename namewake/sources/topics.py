"""Change feeds in topics of a message broker.

Reading needs the spark-sql-kafka module on the classpath.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namewake.operators.changes import one_envelope


# Limit of a micro-batch, in messages.
OFFSETS_PER_TRIGGER = 1_000_000

# Fixed value: stands for the beginning of a partition in the reader's option.
EARLIEST = -2


def starting_offsets(
    offsets: dict[str, dict[int, int]], partitions: dict[str, int] | None = None
) -> str:
    """First offsets per topic and partition, as the reader option wants them.

    They count for the first run only; later runs go on from the checkpoint. The reader
    wants all partitions of a topic: with ``partitions``, their number by topic, those
    that ``offsets`` leaves out start at their beginning.
    """
    full = {t: dict.fromkeys(range((partitions or {}).get(t, 0)), EARLIEST) | ps for t, ps in offsets.items()}
    return json.dumps({t: {str(p): n for p, n in ps.items()} for t, ps in full.items()})


def topic_options(
    servers: str,
    topic: str,
    offsets: dict[str, dict[int, int]] | None = None,
    partitions: dict[str, int] | None = None,
    max_offsets: int = OFFSETS_PER_TRIGGER,
) -> dict[str, str]:
    """Reader options; without ``offsets`` the first run starts at the beginning."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets(offsets, partitions) if offsets else "earliest",
        "maxOffsetsPerTrigger": str(max_offsets),
    }


def topic_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    offsets: dict[str, dict[int, int]] | None = None,
    partitions: dict[str, int] | None = None,
    **options: str,
) -> DataFrame:
    """Messages of one topic: text key, binary value, partition and offset.

    Given options override those of ``topic_options``.
    """
    return (
        spark.readStream.format("kafka")
        .options(**topic_options(servers, topic, offsets, partitions) | options)
        .load()
        .select(F.col("key").cast("string"), "value", "partition", "offset")
    )


def declare_stream(stream: DataFrame, name: str) -> DataFrame:
    """Give a stream (or table) a name to query by."""
    stream.createOrReplaceTempView(name)
    return stream


def decoded(messages: DataFrame, record: Column) -> DataFrame:
    """Messages with the fields of ``record`` as columns, tombstones included.

    ``record`` is the decoded value, such as ``decode_avro`` or ``parse_json`` give.
    The original key and value stay, as ``msg_key`` and ``msg_value``.
    """
    opened = messages.withColumn("__record", record).select(
        F.col("key").alias("msg_key"),
        F.col("value").alias("msg_value"),
        *(c for c in messages.columns if c not in ("key", "value")),
        "__record.*",
    )
    return one_envelope(opened)
