"""Avro record schemas as row schemas."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# The Avro types in use; int is widened to long.
AVRO_TYPES = {"string": T.StringType(), "int": T.LongType(), "long": T.LongType()}


def schema_text(
    spark: SparkSession, folder: str, topic: str, part: str = "value", version: int = 1
) -> str:
    """Schema of a topic's ``value`` or ``key``, from ``folder/<topic>-<part>/<version>.avsc``.

    A missing file or broken JSON raises.
    """
    path = f"{folder.rstrip('/')}/{topic}-{part}/{version}.avsc"
    text = spark.read.text(path, wholetext=True).first()["value"]
    json.loads(text)
    return text


def avro_to_struct(text: str) -> T.StructType:
    """Map an Avro record schema to a row schema; every field may be null.

    Only types are mapped, never field names. Field types are those of
    ``AVRO_TYPES``, or a union of one of them with null.
    """
    record = json.loads(text)
    if not isinstance(record, dict) or record.get("type") != "record":
        raise ValueError("not an Avro record schema")
    return T.StructType(
        [T.StructField(f["name"], _field_type(f["name"], f["type"])) for f in record["fields"]]
    )


def _field_type(name: str, kind: object) -> T.DataType:
    if isinstance(kind, list):
        named = [k for k in kind if k != "null"]
        if len(named) != 1:
            raise ValueError(f"field {name}: cannot map the union {kind}")
        return _field_type(name, named[0])
    if isinstance(kind, dict):
        kind = kind.get("type")
    if not isinstance(kind, str) or kind not in AVRO_TYPES:
        raise ValueError(f"field {name}: cannot map the type {kind}")
    return AVRO_TYPES[kind]
