"""Messages with a schema id in front: one zero byte, four id bytes, payload."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from namewake.functions.avro import decode_column, decode_framed_column, encode_column

# Length of the frame and its first byte.
FRAME_BYTES = 5
MAGIC_HEX = "00"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def frame(payload: Column | str, schema_id: int) -> Column:
    return F.concat(F.unhex(F.lit(f"{MAGIC_HEX}{schema_id:08X}")), _col(payload))


def unframe(message: Column | str) -> Column:
    message = _col(message)
    return F.substring(message, FRAME_BYTES + 1, F.length(message) - FRAME_BYTES)


def frame_schema_id(message: Column | str) -> Column:
    return F.conv(F.hex(F.substring(_col(message), 2, 4)), 16, 10).cast("int")


def decode_avro(message: Column | str, schema: str) -> Column:
    """The Avro record of a framed message, read by one schema whatever its frame says."""
    return decode_column(_col(message), schema, framed=True)


def decode_avro_by_id(message: Column | str, schemas: Mapping[int, str], reader: str) -> Column:
    """The same, read by the schema that the frame names and given in the reader's."""
    return decode_framed_column(_col(message), schemas, reader)


def encode_avro(record: Column, schema: str, schema_id: int) -> Column:
    return encode_column(record, schema, schema_id)
