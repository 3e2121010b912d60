"""Files, lines and topics; records are invented in the shapes the feeds have."""

import json
import os
import time
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from namewake.entities import ENTITIES
from namewake.functions.values import as_text, parse_json
from namewake.operators.changes import latest_updates, non_null
from namewake.operators.propagate import Dimension, merge_names, star_enrich
from namewake.sources import files, topics
from namewake.streaming.feeds import tag_feed
from namewake.streaming.job import copy_stream

# The entities in the order the target records gain their names.
STEPS = [
    ("property", "Channel Nine"),
    ("division", "Late News"),
    ("sub_division", "LNX"),
    ("target_group", "A18-49"),
    ("advertiser", "Socks & Co, LTD"),
    ("account_executive", "QQ"),
    ("deal_year", "2011-12"),
    ("agency", "Smith-Jones"),
]
TAGGED_LONG = {s.fk: 100 + i for i, s in enumerate(ENTITIES.values())} | {"REVISION_NO": -1}
FIELDS = (
    {"table1": "string", "op_type": "string", "op_ts": "string", "pos": "string"}
    | {"PLAN_ID": "bigint", "PLAN_NAME": "string", "STEW_LINK_ID": "bigint"}
    | dict.fromkeys(TAGGED_LONG, "bigint")
    | {"START_DATE": "string", "PLAN_CLASS": "string"}
)


def plan_line(plan_id=9001, **named):
    record = {
        "table1": "APPS.PLAN",
        "op_type": "D",
        "op_ts": "2020-02-03 04:05:06.000000",
        "pos": "00000000000000000042",
        "PLAN_ID": plan_id,
        "PLAN_NAME": "Spring plan (9000)-V2",
        "STEW_LINK_ID": None,
        **{k: {"long": v} for k, v in TAGGED_LONG.items()},
        "START_DATE": {"string": "03-NOV-21"},
        "PLAN_CLASS": {"string": "National"},
        **named,
    }
    return f'"{plan_id}":{json.dumps(record)}'


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_keyed_lines(spark, tmp_path):
    path = write(tmp_path / "plan", plan_line(), "", "  " + plan_line(9002), "no key here", '"k" {}')
    rows = files.keyed_line_file(spark, path, FIELDS).orderBy("key").collect()
    assert [r["key"] for r in rows] == ["9001", "9002"]
    assert rows[0]["PLAN_ID"] == 9001 and rows[0]["PROPERTY_ID"] == TAGGED_LONG["PROPERTY_ID"]
    assert rows[0]["START_DATE"] == "03-NOV-21" and rows[0]["STEW_LINK_ID"] is None


def test_eight_updates_build_the_target_record(spark, tmp_path):
    """Update by update, the record gains one name and changes nowhere else."""
    path = write(tmp_path / "plan", plan_line(), plan_line(9002, ADVERTISER_ID=None))
    plan = files.keyed_line_file(spark, path, FIELDS).drop("key")
    names = {}
    for entity, name in STEPS:
        spec = ENTITIES[entity]
        change = {c: None for c in spec.schema.fieldNames()} | {
            "op_type": "U",
            "pos": "1",
            spec.key: TAGGED_LONG[spec.fk],
            spec.name: name,
        }
        feed = write(tmp_path / entity, json.dumps(change))
        changes = files.change_table(spark, spec, feed)
        latest = latest_updates(changes, [spec.key], ["pos", "op_ts"])
        plan = merge_names(plan, latest.select(spec.key, spec.name), spec)
        names[spec.plan_name] = name
        golden = write(tmp_path / "golden", plan_line(**names))
        want = files.keyed_line_file(spark, golden, FIELDS | dict.fromkeys(names, "string"))
        got = {r["PLAN_ID"]: r for r in plan.collect()}
        assert got[9001].asDict() == want.drop("key").first().asDict()
        assert got[9001]["op_type"] == "D"
    assert got[9002]["ADVERTISER_NAME"] is None and got[9002]["AGENCY_NAME"] == "Smith-Jones"


def test_star_gives_the_same_names_when_every_row_was_there(spark, tmp_path):
    path = write(tmp_path / "plan", plan_line())
    plan = files.keyed_line_file(spark, path, FIELDS).drop("key")
    dims = []
    for entity, name in STEPS:
        spec = ENTITIES[entity]
        rows = spark.createDataFrame([(TAGGED_LONG[spec.fk], name)], "k bigint, n string")
        dims.append(Dimension(rows, spec.fk, "k", {"n": spec.plan_name}))
    row = star_enrich(plan, dims, row_id=["PLAN_ID"]).first()
    assert [row[ENTITIES[e].plan_name] for e, _ in STEPS] == [n for _, n in STEPS]


@pytest.mark.parametrize("spelling", ["table", "table1"])
def test_change_feed_takes_either_envelope(spark, tmp_path, spelling):
    spec = ENTITIES["agency"]
    change = {spelling: "T", "op_type": "I", "pos": "1", "AGENCY_ID": 5, "PARENT_AGENCY_ID": 2}
    (tmp_path / "in").mkdir()
    path = write(tmp_path / "in" / "a.json", json.dumps(change)).rsplit("/", 1)[0]
    batch = files.change_table(spark, spec, path)
    assert batch.columns == spec.schema.fieldNames()
    assert batch.first().asDict() | {"table1": "T", "AGENCY_ID": 5, "PARENT_AGENCY_ID": 2} == batch.first().asDict()
    stream = files.change_stream(spark, spec, path)
    assert stream.isStreaming and stream.columns == batch.columns
    copy_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).collect() == batch.collect()


def test_file_stream_reads_a_single_file(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "d"))
    one = str(next((tmp_path / "d").glob("part-*.parquet")))
    stream = files.file_stream(spark, one, spark.read.parquet(one).schema)
    copy_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_tables_by_name_and_path(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    files.table(spark, str(tmp_path / "t"), "parquet").createOrReplaceTempView("three")
    assert files.table(spark, "three").count() == 3


def test_declared_stream(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "t"))
    stream = files.file_stream(spark, str(tmp_path / "t"), spark.range(0).schema)
    topics.declare_stream(stream, "raw_stream")
    star = spark.sql("SELECT * FROM raw_stream")
    assert star.isStreaming
    copy_stream(star, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_topic_options():
    offsets = {"shops": {0: 12, 1: 7}}
    options = topics.topic_options("host:1", "shops", offsets)
    assert json.loads(options["startingOffsets"]) == {"shops": {"0": 12, "1": 7}}
    assert options["subscribe"] == "shops"
    assert topics.topic_options("host:1", "shops")["startingOffsets"] == "earliest"
    assert topics.topic_options("host:1", "shops")["maxOffsetsPerTrigger"] == "1000000"
    rest = topics.topic_options("host:1", "shops", {"shops": {1: 7}}, partitions={"shops": 3})
    assert json.loads(rest["startingOffsets"]) == {"shops": {"0": -2, "1": 7, "2": -2}}


def test_topics_need_their_module(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        topics.topic_stream(spark, "host:1", "shops")


def test_decoded_messages(spark):
    """Tombstones stay in the feed with their key, and broken values lose theirs."""
    spec = ENTITIES["property"]
    good = json.dumps({"table": "T", "op_type": "U", "PROPERTY_ID": 3, "PROPERTY_NAME": "N"})
    messages = spark.createDataFrame(
        [("3", bytearray(good.encode()), 0, 1), ("4", None, 0, 2), ("5", bytearray(b"{"), 0, 3)],
        "key string, value binary, partition int, offset bigint",
    )
    assert non_null(messages).count() == 2
    schema = "table string, op_type string, PROPERTY_ID bigint, PROPERTY_NAME string"
    opened = topics.decoded(messages, parse_json(as_text("value"), schema))
    assert opened.columns[:5] == ["msg_key", "msg_value", "partition", "offset", "table1"]
    feed = tag_feed(opened, spec, ["partition", "offset"]).orderBy("msg_key").collect()
    assert [(r["msg_key"], r["key"], r["op_type"], r["name"]) for r in feed] == [
        ("3", "3", "U", "N"),
        ("4", None, None, None),
        ("5", None, None, None),
    ]
    assert bytes(feed[0]["msg_value"]) == good.encode() and feed[1]["msg_value"] is None
    assert feed[0]["ord"].asDict() == {"partition": 0, "offset": 1}


def test_old_files_and_uncommitted_files(spark, tmp_path):
    """Files of any age are read; files beside a sink's commit log are not."""

    def copy(source, sink):
        stream = files.file_stream(spark, f"{tmp_path}/{source}", "id bigint")
        copy_stream(stream, f"{tmp_path}/{sink}", f"{tmp_path}/checkpoint-{sink}")

    Path(tmp_path, "in").mkdir()
    for i, days in enumerate((0, 10, 900)):
        spark.range(i, i + 1).coalesce(1).write.parquet(f"{tmp_path}/written-{i}")
        file = next(Path(tmp_path, f"written-{i}").glob("*.parquet"))
        os.utime(file, (time.time() - days * 86400,) * 2)
        file.rename(Path(tmp_path, "in", file.name))
        copy("in", "out")
    spark.range(99, 100).coalesce(1).write.parquet(f"{tmp_path}/stray")
    stray = next(Path(tmp_path, "stray").glob("*.parquet"))
    stray.rename(Path(tmp_path, "out", stray.name))
    copy("out", "again")
    assert sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/again").collect()) == [0, 1, 2]
