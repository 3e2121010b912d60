import datetime as dt
import json
import struct

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namewake.functions import framing, values
from namewake.functions.schemas import avro_to_struct, schema_text

RECORD = {
    "type": "record",
    "name": "shop",
    "fields": [
        {"name": "table1", "type": "string"},
        {"name": "SHOP_ID", "type": "int"},
        {"name": "int_string_note", "type": ["null", "string"]},
        {"name": "PARENT", "type": ["null", "long"]},
        {"name": "CODE", "type": {"type": "string", "avro.java.string": "String"}},
    ],
}


def test_avro_record_to_row_schema():
    want = T.StructType(
        [
            T.StructField("table1", T.StringType()),
            T.StructField("SHOP_ID", T.LongType()),
            T.StructField("int_string_note", T.StringType()),
            T.StructField("PARENT", T.LongType()),
            T.StructField("CODE", T.StringType()),
        ]
    )
    assert avro_to_struct(json.dumps(RECORD)) == want
    # a second call starts afresh
    assert avro_to_struct(json.dumps(RECORD)) == want


@pytest.mark.parametrize(
    "text",
    [
        '"string"',
        '{"type": "enum", "name": "x"}',
        '{"type": "record", "name": "x", "fields": [{"name": "a", "type": "bytes"}]}',
        '{"type": "record", "name": "x", "fields": [{"name": "a", "type": ["int", "string"]}]}',
        "Error: 404",
    ],
)
def test_unmapped_schemas_raise(text):
    with pytest.raises(ValueError):
        avro_to_struct(text)


def test_schema_lookup(spark, tmp_path):
    folder = tmp_path / "shops-value"
    folder.mkdir()
    (folder / "1.avsc").write_text(json.dumps(RECORD, indent=1))
    (folder / "2.avsc").write_text("Error: not found")
    assert json.loads(schema_text(spark, str(tmp_path), "shops")) == RECORD
    with pytest.raises(ValueError):
        schema_text(spark, str(tmp_path), "shops", version=2)
    with pytest.raises(AnalysisException):
        schema_text(spark, str(tmp_path), "shops", "key")


def test_tagged_and_plain_values(spark):
    texts = [
        '{"A": {"long": 5}, "N": {"string": "x"}}',
        '{"A": 7, "N": "y"}',
        '{"A": null, "N": null}',
        '{"A": {"int": 3}, "N": {"string": null}}',
        '{"A": {"string": "8"}, "N": {"long": 9}}',
        '{"A": "zz", "N": "{\\"string\\": \\"q\\"}"}',
        '{"A": 1, "N": "unfinished"',
        "{}",
        None,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    got = values.read_tagged(df, "v", {"A": "bigint", "N": "string"}).orderBy("i").collect()
    assert [(r["A"], r["N"]) for r in got] == [
        (5, "x"),
        (7, "y"),
        (None, None),
        (3, None),
        (8, "9"),
        (None, '{"string": "q"}'),
        (None, None),
        (None, None),
        (None, None),
    ]
    with pytest.raises(ValueError):
        values.read_tagged(df, "v", {"A": "double"})


def test_dates_and_times(spark):
    df = spark.createDataFrame([("03-NOV-21",), ("01-jan-99",), ("x",), (None,)], "d string")
    assert [r[0] for r in df.select(values.parse_date("d")).collect()] == [
        dt.date(2021, 11, 3),
        dt.date(2099, 1, 1),
        None,
        None,
    ]
    at = spark.createDataFrame([("2021-11-03 07:08:09.000010",), ("soon",)], "t string")
    got = at.select(F.unix_micros(values.parse_time("t").cast("timestamp"))).collect()
    assert [r[0] for r in got] == [1635923289000010, None]


def test_json_values_keep_nulls_and_round_trip(spark):
    df = spark.createDataFrame([(1, None, "a\"b\n")], "k bigint, n string, s string")
    message = df.select(values.as_bytes(values.json_value("k", "n", "s")).alias("value"))
    text = message.select(values.as_text("value")).first()[0]
    assert json.loads(text) == {"k": 1, "n": None, "s": 'a"b\n'}
    back = message.select(values.parse_json(values.as_text("value"), df.schema).alias("r"))
    assert back.select("r.*").collect() == df.collect()


def test_frames(spark):
    payload = b"\x02\x00abc"
    df = spark.createDataFrame([(payload,), (b"",), (None,)], "p binary")
    framed = df.select("p", framing.frame("p", 70000).alias("m")).collect()
    assert bytes(framed[0]["m"]) == b"\x00" + struct.pack(">I", 70000) + payload
    assert framed[2]["m"] is None
    back = df.select("p", framing.frame("p", 70000).alias("m")).select(
        framing.unframe("m").alias("p"), framing.frame_schema_id("m").alias("id")
    )
    rows = back.collect()
    assert [None if r["p"] is None else bytes(r["p"]) for r in rows] == [payload, b"", None]
    assert [r["id"] for r in rows] == [70000, 70000, None]
