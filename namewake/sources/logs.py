"""A log as a stream: what was logged from a number on, as it is logged."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from namewake.functions.shipping import ship
from namewake.streaming.logs import COLUMNS, FileLog, TargetLog, parts_of

FORMAT = "namewake_log"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if ":" not in path.split("/", 1)[0]:
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def _names(fs: pafs.FileSystem, folder: str) -> list[pafs.FileInfo]:
    return sorted(fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)), key=lambda f: f.base_name)


def stored_entries(path: str) -> list[dict]:
    """Entries that matter of a commit list, without a JVM; see ``CommitList.read``."""
    fs, folder = _open(path)
    for segment in reversed([f for f in _names(fs, folder) if f.type == pafs.FileType.Directory]):
        files = [f for f in _names(fs, segment.path) if f.base_name.endswith(".json") and f.base_name[0] != "."]
        if files and int(files[0].base_name[:-5]) == int(segment.base_name.rpartition("=")[2]):
            told = []
            for f in files:
                with fs.open_input_stream(f.path) as stream:
                    told += json.loads(stream.read())
            return told
    return []


@dataclass
class Part(InputPartition):
    """One file of the log; of a merged one only rows with a number within ``after`` and ``upto``."""

    file: str
    number: int | None
    after: int
    upto: int


class LogReader(DataSourceStreamReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.arrow_schema, self.options = schema, options
        self.commits = options["commits"]
        self.first = int(options.get("startingnumber", "0"))

    def initialOffset(self) -> dict:
        return {"number": self.first - 1}

    def latestOffset(self) -> dict:
        entries = stored_entries(self.commits)
        return {"number": max([self.first - 1, *(e["number"] for e in entries)])}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        after, upto = start["number"], end["number"]
        out = []
        for path, number in parts_of(stored_entries(self.commits)):
            if number is not None and not after < number <= upto:
                continue
            fs, folder = _open(path)
            files = [f for f in _names(fs, folder) if f.base_name.endswith(".parquet") and f.base_name[0] not in "._"]
            out += [Part(f"{path.rstrip('/')}/{f.base_name}", number, after, upto) for f in files]
        return out

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        fs, path = _open(partition.file)
        names = [f.name for f in self.arrow_schema.fields]
        with fs.open_input_file(path) as stream:
            for batch in pq.ParquetFile(stream).iter_batches(batch_size=10_000):
                if partition.number is not None:
                    seq = pa.array([partition.number] * len(batch), pa.int64())
                    batch = batch.append_column("seq", seq)
                else:
                    seq = batch.column("seq").to_numpy()
                    batch = batch.filter(pa.array((seq > partition.after) & (seq <= partition.upto)))
                yield batch.select(names)

    def commit(self, end: dict) -> None:
        pass


class LogSource(DataSource):
    """Options: ``commits`` (the list's folder), ``startingNumber`` (of the first run; later
    ones go on from the checkpoint), ``ord`` and ``value`` (types).
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        kinds = {"ord": self.options["ord"], "msg_value": self.options.get("value", "string")}
        return ", ".join(f"{n} {kinds.get(n, k)}" for n, k in COLUMNS.items()) + ", seq bigint"

    def streamReader(self, schema: T.StructType) -> LogReader:
        return LogReader(schema, {k.lower(): v for k, v in self.options.items()})


def log_stream(
    spark: SparkSession,
    log: FileLog,
    ord_type: T.DataType,
    value: str = "string",
    starting_number: int = 0,
) -> DataFrame:
    """Logged changes with their number, from ``starting_number`` on, as more is logged.

    Each is read once, also when ``merge_files`` puts files together meanwhile. A micro-batch
    takes all that is there, file by file and in batches of rows. The log must be parquet, in
    a store that Arrow opens by its address.
    """
    if log.format != "parquet":
        raise ValueError(f"a log in {log.format} cannot be read as a stream")
    ship(spark)
    spark.dataSource.register(LogSource)
    folder = log.target.path if isinstance(log, TargetLog) else log.path
    return (
        spark.readStream.format(FORMAT)
        .option("commits", f"{folder}/commits")
        .option("startingNumber", starting_number)
        .option("ord", ord_type.simpleString())
        .option("value", value)
        .load()
    )
