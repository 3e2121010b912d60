"""Avro records against a plain reader and writer, one value at a time."""

import json
import random
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from namewake.functions import avro, framing

FIELDS = [
    {"name": "id", "type": "long"},
    {"name": "small", "type": ["null", "int"], "default": None},
    {"name": "name", "type": ["string", "null"]},
    {"name": "ok", "type": "boolean"},
    {"name": "x", "type": "double"},
    {"name": "y", "type": ["null", "float"]},
    {"name": "raw", "type": ["null", "bytes"]},
    {"name": "op", "type": {"type": "enum", "name": "op", "symbols": ["I", "U", "D"]}},
    {"name": "place", "type": ["null", {"type": "record", "name": "p", "fields": [{"name": "a", "type": "int"}, {"name": "b", "type": ["null", "string"]}]}]},
]
SCHEMA = json.dumps({"type": "record", "name": "r", "fields": FIELDS})


def plain_varint(n):
    z, out = (n << 1) ^ (n >> 63), bytearray()
    z &= (1 << 64) - 1
    while z >= 0x80:
        out.append(z & 0x7F | 0x80)
        z >>= 7
    return bytes(out) + bytes([z])


def plain(value, kind):
    if isinstance(kind, list):
        at = kind.index("null") if value is None else 1 - kind.index("null")
        return plain_varint(at) + (b"" if value is None else plain(value, kind[at]))
    name = kind["type"] if isinstance(kind, dict) else kind
    if name == "record":
        return b"".join(plain(value[f["name"]], f["type"]) for f in kind["fields"])
    if name == "enum":
        return plain_varint(kind["symbols"].index(value))
    if name in ("int", "long"):
        return plain_varint(value)
    if name == "boolean":
        return bytes([value])
    if name in ("float", "double"):
        return struct.pack("<f" if name == "float" else "<d", value)
    raw = value.encode() if name == "string" else value
    return plain_varint(len(raw)) + raw


def records(n):
    rng = random.Random(n)
    for i in range(n):
        yield {
            "id": rng.choice([0, -1, 63, 64, -64, -65, 2**63 - 1, -(2**63), i]),
            "small": rng.choice([None, 2**31 - 1, -(2**31), 5]),
            "name": rng.choice([None, "", "é😀" * rng.randint(0, 60), "x"]),
            "ok": rng.random() < 0.5,
            "x": rng.choice([0.0, -1.5, 1e300, float("inf")]),
            "y": rng.choice([None, 0.5]),
            "raw": rng.choice([None, b"", b"\x00\xff"]),
            "op": rng.choice("IUD"),
            "place": rng.choice([None, {"a": i, "b": None}, {"a": -i, "b": "b"}]),
        }


def test_both_ways_equal_plain_code():
    kind, rows = avro.kind_of(SCHEMA), [*records(500), None]
    want = [None if r is None else plain(r, json.loads(SCHEMA)) for r in rows]
    column = pa.array(rows, kind.arrow())
    assert avro.encode(column, kind).to_pylist() == want
    assert avro.encode(column, kind, b"\0abcd").to_pylist() == [m and b"\0abcd" + m for m in want]
    assert avro.decode(pa.array(want, pa.binary()), kind).to_pylist() == rows
    part = pa.array([b"x" * 9, *want], pa.binary()).slice(1)  # an offset within a batch
    assert avro.decode(part, kind).to_pylist() == rows
    assert avro.encode(column.slice(7, 90), kind).to_pylist() == want[7:97]


def test_truncated_and_wrong_messages_are_null():
    kind = avro.kind_of(SCHEMA)
    for record in records(40):
        whole = plain(record, json.loads(SCHEMA))
        cut = [whole[:i] for i in range(len(whole))]
        assert avro.decode(pa.array([*cut, whole + b"more"]), kind).to_pylist() == [None] * len(cut) + [record]
    one = avro.kind_of('{"type":"record","name":"r","fields":[{"name":"a","type":["null","string"]},{"name":"n","type":"int"}]}')
    wrong = [b"\x04\x02a\x02", b"\x01", b"\x02\x01", b"\x02\x02\xff\x02", b"\x00" + b"\xff" * 11, b"\x00" + plain_varint(2**31)]
    good = b"\x02\x02a\x02"
    assert avro.decode(pa.array([*wrong, good]), one).to_pylist() == [None] * 6 + [{"a": "a", "n": 1}]


def test_unknown_schemas_and_nulls_are_refused():
    for told in ('{"type":"record","name":"r","fields":[{"name":"a","type":["string","long"]}]}',
                 '{"type":"record","name":"r","fields":[{"name":"a","type":{"type":"map","values":"int"}}]}'):
        with pytest.raises(ValueError, match="map"):
            avro.kind_of(told)
    kind = avro.kind_of('{"type":"record","name":"r","fields":[{"name":"a","type":"long"}]}')
    with pytest.raises(ValueError, match="null"):
        avro.encode(pa.array([{"a": None}], kind.arrow()), kind)


def record(*fields):
    return json.dumps({"type": "record", "name": "r", "fields": list(fields)})


def test_writers_schemas_resolve_to_the_readers(spark):
    old = record({"name": "id", "type": "int"}, {"name": "called", "type": "string"}, {"name": "gone", "type": "long"})
    new = record({"name": "extra", "type": ["null", "long"]}, {"name": "id", "type": "long"}, {"name": "name", "type": ["null", "string"]})
    reader = record(
        {"name": "id", "type": "double"}, {"name": "name", "aliases": ["called"], "type": ["null", "bytes"]},
        {"name": "extra", "type": ["null", "long"], "default": None}, {"name": "kind", "type": "string", "default": "none"},
    )
    rows = [
        b"\0\0\0\0\x01" + plain(dict(id=5, called="é", gone=9), json.loads(old)),
        b"\0\0\0\0\x02" + plain(dict(extra=7, id=-(2**40), name=None), json.loads(new)),
        b"\0\0\0\0\x03abc", b"\0\0", b"", None, b"\x01\0\0\0\x01" + plain(dict(id=5, called="x", gone=9), json.loads(old)),
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, m binary").repartition(2)
    told = df.select("i", framing.decode_avro_by_id("m", {1: old, 2: new}, reader).alias("r")).orderBy("i").collect()
    assert [r["r"] and tuple(r["r"]) for r in told] == [
        (5.0, "é".encode(), None, "none"), (-(2.0**40), None, 7, "none"), *[None] * 5
    ]
    with pytest.raises(ValueError, match="default"):
        framing.decode_avro_by_id("m", {2: new}, record({"name": "missing", "type": "string"}))
    with pytest.raises(ValueError, match="read as"):
        framing.decode_avro_by_id("m", {2: new}, record({"name": "id", "type": "int"}))


def test_columns(spark):
    schema = record({"name": "a", "type": "long"}, {"name": "b", "type": ["null", "string"]})
    df = spark.createDataFrame([(1, "x"), (-300, None)], "a long, b string")
    framed = df.select("a", framing.encode_avro(F.struct("a", "b"), schema, 258).alias("m"))
    assert [bytes(r["m"]) for r in framed.collect()] == [b"\0\0\0\1\2\2\2\2x", b"\0\0\0\1\2\xd7\x04\0"]
    back = framed.select(framing.frame_schema_id("m").alias("id"), framing.decode_avro("m", schema).alias("r")).select("id", "r.*")
    assert [tuple(r) for r in back.collect()] == [(258, 1, "x"), (258, -300, None)]
