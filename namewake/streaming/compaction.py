"""Log compaction as a stream of its own: the last change of every key, held as state."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from namewake.operators.changes import latest_per_key
from namewake.streaming.commits import folders

# The state store that keeps state on disk, and its setting.
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _newest_of_each(keys: list[str], order: list[str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def newest(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            ranked = chunk.sort_values([*order, "record"], kind="stable")
            yield ranked.drop_duplicates(keys, keep="last")

    return newest


def _processor(order: list[str], state_schema: str, forget_ms: int) -> StatefulProcessor:
    class LastChange(StatefulProcessor):
        """The last row of a key in one value; written only when a later one comes."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.last = handle.getValueState("last", state_schema, forget_ms)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            held = self.last.get() if self.last.exists() else None
            best = None if held is None else tuple(held)
            for chunk in rows:
                for row in chunk[[*order, "record", "gone"]].itertuples(index=False, name=None):
                    best = row if best is None else max(best, row)
            if best is None or held is not None and best == tuple(held):
                return
            self.last.update(best)
            names = [*order, "record", "gone"]
            yield pd.DataFrame({f"key{i}": [v] for i, v in enumerate(key)} | {n: [v] for n, v in zip(names, best)})

        def close(self) -> None:
            pass

    return LastChange()


def _lasting(packed: DataFrame, keys: list[str]) -> DataFrame:
    """Of every micro-batch, the keys whose last row came with it; state as one aggregate."""
    # A micro-batch has one time. Of equal rows the first to come is greatest, which is no change.
    since = -F.unix_micros(F.current_timestamp())
    rest = [c for c in packed.columns if c not in keys]
    timed = packed.withColumn("since", since)
    last = timed.groupBy(*keys).agg(F.max(F.struct(*rest, "since")).alias("last"))
    return last.filter(F.col("last.since") == since).select(*keys, *(F.col("last")[c].alias(c) for c in rest))


def _forgetting(packed: DataFrame, keys: list[str], ranks: list[str], forget: str) -> DataFrame:
    """The same, where each key's state has an end of its own."""
    combined = packed.mapInPandas(_newest_of_each(keys, ranks), packed.schema)
    kinds = {f.name: f.dataType.simpleString() for f in packed.schema.fields}
    state = ", ".join(f"{c} {kinds[c]}" for c in [*ranks, "record", "gone"])
    spark = packed.sparkSession
    forget_ms = int(spark.sql(f"SELECT INTERVAL {forget} AS i").selectExpr("i / INTERVAL 1 MILLISECOND").first()[0])
    return combined.groupBy(*keys).transformWithStateInPandas(
        _processor(ranks, state, forget_ms), packed.schema, "Update", "ProcessingTime"
    )


def live_changes(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    deleted: Column,
    forget: str | None = None,
) -> DataFrame:
    """Of every micro-batch, the keys whose last row has changed, with ``deleted`` or not.

    The last row by ``order`` counts, over all micro-batches; of rows of equal order the one
    whose JSON is greatest. Order columns are whole numbers, texts or timestamps. Rows of one
    key that a task has read together go on as one, so a frequent key is no burden to its
    state. State holds one row for each key ever seen, deleted ones too, lest an older row
    revive them; with ``forget``, such as ``30 days``, keys untouched for so long are dropped
    from it, which takes a call of Python for each key of a micro-batch.
    """
    spark, types = stream.sparkSession, stream.schema
    if spark.conf.get(_PROVIDER, "") != _ROCKS:
        spark.conf.set(_PROVIDER, _ROCKS)
    rest = [c for c in stream.columns if c not in keys]
    ranks = [f"rank{i}" for i in range(len(order))]

    def rank(name: str) -> Column:
        """A text that is in the order of the values, null first."""
        kind = types[name].dataType
        if isinstance(kind, T.StringType):
            return F.coalesce(F.concat(F.lit("+"), name), F.lit(""))
        if isinstance(kind, T.TimestampNTZType):  # of years of four digits
            return F.coalesce(F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(""))
        number = F.unix_micros(name) if isinstance(kind, T.TimestampType) else F.col(name).cast("bigint")
        shifted = number.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
        return F.coalesce(F.lpad(shifted.cast("string"), 20, "0"), F.lit(""))

    packed = stream.select(
        *(F.col(k).alias(f"key{i}") for i, k in enumerate(keys)),
        *(rank(c).alias(r) for c, r in zip(order, ranks)),
        F.to_json(F.struct(*rest), _TIMES | {"ignoreNullFields": "false"}).alias("record"),
        F.coalesce(deleted, F.lit(False)).alias("gone"),
    )
    names = [f"key{i}" for i in range(len(keys))]
    last = _forgetting(packed, names, ranks, forget) if forget else _lasting(packed, names)
    record = F.from_json("record", T.StructType([types[c] for c in rest]), _TIMES).alias("r")

    opened = last.select("*", record)
    columns = {k: F.col(f"key{i}") for i, k in enumerate(keys)}
    return opened.select(*(columns.get(c, F.col(f"r.{c}")).alias(c) for c in stream.columns), F.col("gone").alias("deleted"))


class LiveTable:
    """What a compaction has said, in files; the last word on a key counts.

    A micro-batch's folder is written over when it is replayed. ``read`` gives the live rows.
    """

    def __init__(self, path: str, keys: Sequence[str]):
        self.path, self.keys = path.rstrip("/"), list(keys)

    def start(self, changes: DataFrame, checkpoint: str, available_now: bool = False) -> StreamingQuery:
        def put(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id:012d}")

        writer = changes.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint)
        return writer.trigger(availableNow=True).start() if available_now else writer.start()

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """Rows of ``schema``, those of deleted keys left out."""
        stored = T.StructType([*schema.fields, T.StructField("deleted", T.BooleanType()), T.StructField("batch_id", T.LongType())])
        paths = folders(spark, self.path)
        if not paths:
            return spark.createDataFrame([], schema)
        said = spark.read.schema(stored).option("basePath", self.path).parquet(*paths)
        last = latest_per_key(said, self.keys, ["batch_id"])
        return last.filter("NOT deleted").select(*schema.names)
