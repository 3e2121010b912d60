"""Where every change is copied to, before it is applied."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namewake.operators.changes import compact
from namewake.streaming.commits import CommitList, Entry, at, existing, last_of, latest_of_queries, stored_bytes
from namewake.streaming.targets import ID, PlanTarget, numbered


#: Columns of a logged change but its number; the types of its value and order may be others.
COLUMNS = {
    "entity": "string",
    "msg_key": "string",
    "msg_value": "string",
    "ord": "string",
    "query": "string",
    "batch_id": "bigint",
}


#: A merged file is made of so many bytes, or of one task's share if that is more.
MERGED_BYTES = 64 << 20


def log_schema(ord_type: T.DataType, value: str = "string") -> T.StructType:
    kinds = {"ord": ord_type.simpleString(), "msg_value": value}
    return T.StructType.fromDDL(", ".join(f"{n} {kinds.get(n, k)}" for n, k in COLUMNS.items()))


def parts_of(commits: list[Entry]) -> list[tuple[str, int | None]]:
    """Folders that make up a log of its own or a target's; those of one micro-batch with its number."""
    merged = last_of(commits, "merged", "log")
    after = at(merged[0]) if merged else -1
    own = [(c.get("log") or (c["path"] if c["kind"] == "batch" else None), c["number"]) for c in commits if c not in merged]
    return [(c.get("log") or c["path"], None) for c in merged] + [(p, n) for p, n in own if p and n > after]


class FileLog:
    """Changes in files, one folder for each micro-batch, numbered as they arrive.

    The number (``seq``) goes through all queries that write the log, so that a job with a
    new checkpoint comes after the one before. A micro-batch that was logged is not logged
    again when it is replayed. Several processes may write; ``merge_files`` puts the small
    files together whenever the owner wants it, beside the writers.
    """

    def __init__(self, path: str, format: str = "parquet"):
        self.path, self.format = path.rstrip("/"), format
        self._list: CommitList | None = None

    def _commits(self, spark: SparkSession) -> CommitList:
        if self._list is None:
            self._list = CommitList(spark, f"{self.path}/commits", self._live)
        return self._list

    def _parts(self, commits: list[Entry]) -> list[tuple[str, int | None]]:
        return parts_of(commits)

    def _live(self, commits: list[Entry]) -> list[Entry]:
        used = {path for path, _ in self._parts(commits)}
        telling = [c["number"] for c in latest_of_queries(commits)]
        return [c for c in commits if c["path"] in used or c["number"] in telling]

    def _new_path(self, kind: str) -> str:
        return f"{self.path}/{kind}/{ID}={uuid.uuid4().int >> 65}"

    def _done(self, commits: list[Entry], query_id: str, batch_id: int) -> list[str]:
        return [c["path"] for c in commits if c.get("query") == query_id and c.get("batch_id") == batch_id]

    def _write(self, rows: DataFrame, path: str) -> None:
        rows.write.format(self.format).save(path)

    def write(self, batch: DataFrame, query_id: str, batch_id: int) -> DataFrame:
        """Log a micro-batch and return it as logged, from shared storage."""
        spark, told = batch.sparkSession, self._commits(batch.sparkSession)
        rows = batch.select("*", F.lit(query_id).alias("query"), F.lit(batch_id).cast("bigint").alias("batch_id"))
        done = self._done(told.known(), query_id, batch_id)
        path = done[0] if done else self._new_path("batches")
        if not done:
            self._write(rows, path)
            entry = {"kind": "batch", "path": path, "query": query_id, "batch_id": batch_id}
            told.add(lambda known: None if self._done(known, query_id, batch_id) else entry)
        return spark.read.schema(rows.schema).format(self.format).load(path)

    def _read(self, spark: SparkSession, schema: T.StructType, parts: list[tuple[str, int | None]]) -> DataFrame:
        read = []
        for path in (p for p, number in parts if number is None):
            whole = T.StructType([*schema.fields, T.StructField("seq", T.LongType())])
            read.append(spark.read.schema(whole).format(self.format).load(path))
        if batches := {p: number for p, number in parts if number is not None}:
            base = next(iter(batches)).rpartition("/")[0]
            read.append(numbered(spark, base, schema, batches, "seq", self.format))
        if not read:
            return spark.createDataFrame([], schema).withColumn("seq", F.lit(None).cast("bigint"))
        return reduce(DataFrame.unionByName, read)

    def read(self, spark: SparkSession, ord_type: T.DataType, value: str = "string") -> DataFrame:
        schema = log_schema(ord_type, value)
        return self._read(spark, schema, self._parts(self._commits(spark).read()))

    def begin_merge(self, spark: SparkSession) -> Entry | None:
        """Write all micro-batches logged so far into one folder."""
        commits = self._commits(spark).read()
        parts = self._parts(commits)
        if len(parts) < 2:
            return None
        schema = spark.read.format(self.format).load([path for path, _ in parts]).drop("seq").schema
        every = self._read(spark, T.StructType([f for f in schema.fields if f.name != ID]), parts)
        path = self._new_path("merged")
        pieces = -(-stored_bytes(spark, [p for p, _ in parts]) // MERGED_BYTES)
        self._write(every.coalesce(max(1, pieces)), path)
        return {"kind": "merged", "path": path, "upto": commits[-1]["number"]}

    def finish_merge(self, spark: SparkSession, entry: Entry | None) -> bool:
        """Commit what was merged, unless another process has merged as much meanwhile."""

        def still(commits: list[Entry]) -> Entry | None:
            now = last_of(commits, "merged")
            return None if now and at(now[0]) >= entry["upto"] else entry

        return entry is not None and self._commits(spark).add(still) is not None

    def merge_files(self, spark: SparkSession) -> bool:
        """Put all micro-batches logged so far into one folder."""
        return self.finish_merge(spark, self.begin_merge(spark))

    def obsolete(self, spark: SparkSession) -> list[str]:
        """Folders needed no more, for the owner to remove: all, in this order, or none."""
        told = self._commits(spark)
        every = {c["path"] for c in told.everything()}  # before what is used, of which there may be more by then
        used = {path for path, _ in self._parts(told.read())}
        return existing(spark, every - used) + told.earlier_segments()


class TargetLog(FileLog):
    """A log kept with a plan target: one commit makes a micro-batch part of both.

    ``write`` stores the changes; they are logged when the target commits the names of the
    same micro-batch. The target's ``obsolete`` tells which folders may go.
    """

    def __init__(self, target: PlanTarget, format: str = "parquet"):
        super().__init__(f"{target.path}/log", format)
        self.target = target
        self._stored: dict[tuple[str, int], str] = {}

    def _commits(self, spark: SparkSession) -> CommitList:
        return self.target.list

    def _done(self, commits: list[Entry], query_id: str, batch_id: int) -> list[str]:
        same = [c for c in commits if c.get("query") == query_id and c.get("batch_id") == batch_id]
        return [c["log"] for c in same if c.get("log")]

    def write(self, batch: DataFrame, query_id: str, batch_id: int) -> DataFrame:
        rows = batch.select("*", F.lit(query_id).alias("query"), F.lit(batch_id).cast("bigint").alias("batch_id"))
        done = self._done(self.target.list.known(), query_id, batch_id)
        path = done[0] if done else self._new_path("batches")
        if not done:
            self._write(rows, path)
        self._stored = {(query_id, batch_id): path}
        return batch.sparkSession.read.schema(rows.schema).format(self.format).load(path)

    def stored(self, query_id: str, batch_id: int) -> str:
        """Where ``write`` put the micro-batch."""
        return self._stored[query_id, batch_id]

    def finish_merge(self, spark: SparkSession, entry: Entry | None) -> bool:
        if entry is None:
            return False
        return self.target.finish({"kind": "log", "log": entry["path"], "upto": entry["upto"]})

    def obsolete(self, spark: SparkSession) -> list[str]:
        return self.target.obsolete()


class TopicLog:
    """Changes in one topic per entity. Needs the spark-sql-kafka module.

    Delivery is at least once; compaction drops the copies.
    """

    def __init__(self, servers: str, topics: dict[str, str]):
        self.servers, self.topics = servers, topics

    def messages(self, batch: DataFrame) -> DataFrame:
        pairs = [F.lit(text) for pair in self.topics.items() for text in pair]
        return batch.select(
            F.create_map(*pairs)[F.col("entity")].alias("topic"),
            F.col("msg_key").alias("key"),
            F.col("msg_value").alias("value"),
        )

    def write(self, batch: DataFrame, query_id: str, batch_id: int) -> None:
        (
            self.messages(batch)
            .write.format("kafka")
            .option("kafka.bootstrap.servers", self.servers)
            .save()
        )


def compact_log(log: DataFrame) -> DataFrame:
    """The last message of every key; a message without a value deletes the key.

    Messages of later micro-batches are later, whichever query logged them. Messages without
    a key, such as broken ones, are no key's last.
    """
    log = log.filter(F.col("msg_key").isNotNull())
    return compact(
        log.select("entity", "msg_key", "seq", "ord", "msg_value"),
        ["entity", "msg_key"],
        ["seq", "ord"],
        deleted=F.col("msg_value").isNull(),
    )
