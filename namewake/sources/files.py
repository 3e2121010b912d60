"""Change feeds, plan records and tables in files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namewake.entities import EntitySpec
from namewake.functions.values import read_tagged
from namewake.operators.changes import one_envelope
from namewake.streaming.commits import is_file

# Limits of a micro-batch and of a file's age. Files are read whatever their age: one that is
# copied or restored may be older than all read before. The price is a list of all files
# ever read, in the checkpoint and in memory; owners of a long feed move files away when
# they are done (``cleanSource``), or give an age beyond which none can arrive.
FILES_PER_TRIGGER = 1000
MAX_FILE_AGE = "36500d"


def _stream_path(spark: SparkSession, path: str) -> str:
    """A folder as it is, so that the commit log of a sink that wrote it is heeded.

    File streams take no single file, but a pattern that matches it alone.
    """
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]" if is_file(spark, path) else path


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    format: str = "parquet",
    max_files: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
    **options: str,
) -> DataFrame:
    """Rows of ``path`` as a stream; files that arrive later are read later, old ones too.

    A micro-batch reads ``max_files`` files at most, ``FILES_PER_TRIGGER`` if not given.
    """
    reader = spark.readStream.schema(schema).format(format).options(**options)
    reader = reader.option("maxFilesPerTrigger", max_files or FILES_PER_TRIGGER)
    return reader.option("maxFileAge", max_file_age).load(_stream_path(spark, path))


def change_stream(
    spark: SparkSession,
    spec: EntitySpec,
    path: str,
    format: str = "json",
    max_files: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
    **options: str,
) -> DataFrame:
    """The change feed of one dimension, either spelling of the envelope.

    ``options`` go to the reader, such as ``cleanSource``.
    """
    schema = T.StructType([T.StructField("table", T.StringType()), *spec.schema.fields])
    return one_envelope(file_stream(spark, path, schema, format, max_files, max_file_age, **options))


def raw_change_stream(
    spark: SparkSession,
    spec: EntitySpec,
    path: str,
    max_files: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
    **options: str,
) -> DataFrame:
    """The same feed line by line, with each line unchanged as the message (``msg_value``)."""
    lines = file_stream(spark, path, "value string", "text", max_files, max_file_age, **options)
    return opened_lines(lines, spec)


def opened_lines(lines: DataFrame, spec: EntitySpec, line: str = "value") -> DataFrame:
    """Lines as messages, with the fields of their JSON records as columns.

    Fields that the dimension does not have stay in the message. A line that is no record,
    or has a field of another type, is a message without key and columns.
    """
    fields = [T.StructField(f.name, f.dataType) for f in spec.schema.fields]
    schema = T.StructType([T.StructField("table", T.StringType()), *fields, T.StructField("__broken", T.StringType())])
    told = F.from_json(line, schema, {"columnNameOfCorruptRecord": "__broken"})
    record = F.when(told["__broken"].isNull(), told).alias("r")
    opened = lines.select(F.col(line).alias("msg_value"), record).select(
        F.col(f"r.{spec.key}").cast("string").alias("msg_key"), "msg_value", "r.*"
    )
    return one_envelope(opened.drop("__broken"))


def change_table(spark: SparkSession, spec: EntitySpec, path: str, format: str = "json") -> DataFrame:
    """The same feed as a batch."""
    schema = T.StructType([T.StructField("table", T.StringType()), *spec.schema.fields])
    return one_envelope(spark.read.schema(schema).format(format).load(path))


def keyed_lines(
    lines: DataFrame, fields: dict[str, str], line: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Parse ``"key":{json}`` lines into a key and the record's columns, after those to ``keep``.

    A line of another form gives a null key.
    """
    text = F.trim(line)
    quoted = F.substring_index(text, '"', 2)
    rest = F.ltrim(F.substr(text, F.length(quoted) + 2))
    formed = text.startswith('"') & rest.startswith(":")
    records = lines.select(
        *keep,
        F.when(formed, F.substr(quoted, F.lit(2))).alias("key"),
        F.substr(rest, F.lit(2)).alias("__record"),
    )
    return read_tagged(records, "__record", fields)


def keyed_line_file(spark: SparkSession, path: str, fields: dict[str, str]) -> DataFrame:
    return keyed_lines(spark.read.text(path), fields).filter(F.col("key").isNotNull())


def table(spark: SparkSession, name_or_path: str, format: str | None = None, **options: str) -> DataFrame:
    """A table by catalog name, or by path or options in a given format."""
    if format is None:
        return spark.table(name_or_path)
    reader = spark.read.format(format).options(**options)
    return reader.load(name_or_path) if name_or_path else reader.load()
