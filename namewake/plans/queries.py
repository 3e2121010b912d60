"""The registered queries, over the given tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namewake.entities import ENTITIES, EntitySpec
from namewake.functions import framing, values
from namewake.functions.schemas import avro_to_struct, schema_text
from namewake.operators import changes as ch
from namewake.operators import propagate as pr
from namewake.operators.keyed import KeyedTable
from namewake.plans import tables as tb
from namewake.scratch import settle, shared_folder
from namewake.sources.files import keyed_lines, raw_change_stream
from namewake.sources.logs import log_stream
from namewake.sources.topics import declare_stream, decoded
from namewake.streaming.compaction import LiveTable, live_changes
from namewake.streaming.feeds import tag_feed, union_feeds
from namewake.streaming.job import Target, copy_stream, start
from namewake.streaming.logs import FileLog, TargetLog, compact_log
from namewake.streaming.targets import PlanTarget, UpsertFiles

Query = Callable[[SparkSession, str], DataFrame]

ORDER_COLUMNS = [
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_totalprice",
    "o_orderpriority",
    "customer_name",
]


# Feed rows


def change_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.key_and_op(tb.customer_changes(tb.read(spark, sf_dir, "events")), tb.CUSTOMER)


def update_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.updates_only(change_extract(spark, sf_dir))


def _latest(events: DataFrame) -> DataFrame:
    return ch.latest_updates(tb.customer_changes(events), ["key"], tb.ORDER).select("key", "name")


def latest_update_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = tb.customer_changes(tb.read(spark, sf_dir, "events"))
    return ch.latest_updates(changes, ["key"], tb.ORDER).select("key", "name", "event_id")


def compact_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = tb.customer_changes(tb.read(spark, sf_dir, "events"))
    return ch.compact(changes, ["key"], tb.ORDER).select("key", "op_type", "name", "event_id")


def compact_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = tb.customer_changes(tb.read(spark, sf_dir, "events"))
    live = ch.compact(changes, ["key"], tb.ORDER, deleted=F.col("op_type") == "D")
    return live.select("key", "op_type", "name", "event_id")


def rekey(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tb.read(spark, sf_dir, "events")
    return ch.rekey(events, "user_id").select(
        "key", F.hex(values.as_bytes("key")).alias("key_hex"),
        "event_id", "user_id", "event_type", "value", "props",
    )


def rekey_bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events stored by user, joined with customers where they lie."""
    folder = shared_folder(spark, "rekeyed")
    events = ch.rekey(tb.read(spark, sf_dir, "events").drop("ts"), "user_id")
    table = KeyedTable.write(events, "key", f"rekeyed_{uuid.uuid4().hex}", folder, ["event_id"])
    customers = tb.read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("customer"), "c_name")
    return table.join(customers, "customer").select("key", "event_id", "event_type", "c_name")


# Plan rows


def key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.key_lookup(tb.named_orders(tb.read(spark, sf_dir, "orders")), "o_custkey", 42)


def propagate_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest, size = settle(_latest(tb.read(spark, sf_dir, "events")))
    return pr.matched_rows(tb.read(spark, sf_dir, "orders"), latest, tb.CUSTOMER, size=size)


def propagate_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest, size = settle(_latest(tb.read(spark, sf_dir, "events")))
    plan = tb.named_orders(tb.read(spark, sf_dir, "orders"))
    return pr.matched_rows(plan, latest, tb.CUSTOMER, columns=plan.columns, size=size)


def unmatched_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tb.read(spark, sf_dir, "events")
    changes = tb.customer_changes(events, key=F.col("user_id") * 11)
    latest, size = settle(
        ch.latest_updates(changes, ["key"], tb.ORDER).select("key", "name")
    )
    return pr.unmatched_updates(tb.read(spark, sf_dir, "orders"), latest, "o_custkey", size=size)


def upsert_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest, size = settle(_latest(tb.read(spark, sf_dir, "events")))
    plan = tb.named_orders(tb.read(spark, sf_dir, "orders"))
    return pr.merge_names(plan, latest, tb.CUSTOMER, size=size).select(*ORDER_COLUMNS)


def upsert_null_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = tb.nameless_changes(tb.read(spark, sf_dir, "events"))
    latest, size = settle(ch.latest_updates(changes, ["key"], tb.ORDER).select("key", "name"))
    plan = tb.named_orders(tb.read(spark, sf_dir, "orders"))
    return pr.merge_names(plan, latest, tb.CUSTOMER, size=size).select(*ORDER_COLUMNS)


def multi_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tb.read(spark, sf_dir, "events")
    by_priority = ch.latest_updates(tb.priority_changes(events), ["key"], tb.ORDER)
    priorities, few = settle(by_priority.select("key", "name"))
    customers, size = settle(_latest(events))
    orders = tb.named_orders(tb.read(spark, sf_dir, "orders"))
    named = pr.merge_names(orders, customers, tb.CUSTOMER, size=size, base=orders)
    both = pr.merge_names(named, priorities, tb.PRIORITY, size=few, base=orders)
    return both.select(*ORDER_COLUMNS, "priority_name")


def entity_rows(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one of the eight jobs writes: rows hit, in the columns it names."""
    spec = ENTITIES[entity]
    changes = tb.entity_changes(tb.read(spark, sf_dir, "events"), spec)
    updates = changes.select(spec.key, "op_type", spec.name, "pos", "op_ts")
    latest = ch.latest_updates(updates, [spec.key], ["pos", "op_ts"])
    latest, size = settle(latest.select(spec.key, spec.name))
    return pr.matched_rows(tb.plan_table(tb.read(spark, sf_dir, "orders")), latest, spec, size=size)


def star_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the names of eight lookups."""

    def table(name: str) -> DataFrame:
        return tb.read(spark, sf_dir, name)

    nations, regions = table("nation"), table("region")

    def place(fk: str, prefix: str) -> pr.Dimension:
        region = pr.Dimension(regions, "n_regionkey", "r_regionkey", {"r_name": f"{prefix}_region"})
        return pr.Dimension(nations, fk, "n_nationkey", {"n_name": f"{prefix}_nation"}, (region,))

    customer = pr.Dimension(
        table("customer"),
        "o_custkey",
        "c_custkey",
        {"c_name": "c_name"},
        (place("c_nationkey", "cust"),),
    )
    dimensions = [
        pr.Dimension(table("part"), "l_partkey", "p_partkey", {"p_name": "p_name"}),
        pr.Dimension(
            table("supplier"),
            "l_suppkey",
            "s_suppkey",
            {"s_name": "s_name"},
            (place("s_nationkey", "supp"),),
        ),
        pr.Dimension(
            table("orders"),
            "l_orderkey",
            "o_orderkey",
            {"o_orderpriority": "o_orderpriority"},
            (customer,),
        ),
    ]
    lines = table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
    )
    return pr.star_enrich(lines, dimensions, row_id=["_metadata.row_index"])


def star_from_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the names the compacted feed shows now, inserts included."""
    events = tb.read(spark, sf_dir, "events")
    dimensions = []
    for changes, spec, column in (
        (tb.customer_changes(events), tb.CUSTOMER, "customer_now"),
        (tb.priority_changes(events), tb.PRIORITY, "priority_now"),
    ):
        live = ch.compact(changes, ["key"], tb.ORDER, deleted=F.col("op_type") == "D")
        names, _ = settle(live.select("key", "name"))
        dimensions.append(pr.Dimension(names, spec.fk, "key", {"name": column}))
    orders = tb.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return pr.star_enrich(orders, dimensions, row_id=["o_orderkey"])


# Messages, text and schemas


def to_json_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as byte messages and back."""
    orders = tb.named_orders(tb.read(spark, sf_dir, "orders"))
    messages = orders.select(
        values.as_bytes("o_orderkey").alias("key"),
        values.as_bytes(values.json_value(*orders.columns)).alias("value"),
    )
    record = values.parse_json(values.as_text("value"), orders.schema)
    read_back = decoded(ch.non_null(messages), record)
    return read_back.select(
        values.as_text("msg_key").alias("msg_key"),
        F.hex("msg_value").alias("msg_hex"),
        *orders.columns,
    )


def framed_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event payloads put behind a schema id and taken out again."""
    events = tb.read(spark, sf_dir, "events")
    framed = events.select("event_id", framing.frame(values.as_bytes("props"), 21).alias("value"))
    return framed.select(
        "event_id",
        F.hex("value").alias("message_hex"),
        framing.frame_schema_id("value").alias("schema_id"),
        values.as_text(framing.unframe("value")).alias("props"),
    )


def union_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and texts, tagged in every second record."""
    events = tb.read(spark, sf_dir, "events")
    k = F.regexp_extract("props", "([0-9]+)", 1)
    kind = F.concat(F.lit('"'), "event_type", F.lit('"'))
    tagged = F.concat(
        F.lit('{"K": {"long": '), k, F.lit('}, "KIND": {"string": '), kind, F.lit("}}")
    )
    plain = F.concat(F.lit('{"K": '), k, F.lit(', "KIND": '), kind, F.lit("}"))
    text = F.when(F.col("event_id") % 2 == 0, tagged).otherwise(plain)
    records = values.read_tagged(
        events.select("event_id", text.alias("record")), "record", {"K": "bigint", "KIND": "string"}
    )
    return records.select("event_id", F.col("K").alias("k"), F.col("KIND").alias("kind"))


def keyed_line_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as keyed JSON lines, parsed."""
    orders = tb.read(spark, sf_dir, "orders")
    line = F.concat(
        F.lit('"'),
        "o_orderkey",
        F.lit('":{"PLAN_ID":'),
        "o_orderkey",
        F.lit(',"ADVERTISER_ID":{"long": '),
        "o_custkey",
        F.lit('}, "PLAN_NAME" :"'),
        "o_orderpriority",
        F.lit('","AGENCY_ID":null}'),
    )
    fields = {
        "PLAN_ID": "bigint",
        "ADVERTISER_ID": "bigint",
        "PLAN_NAME": "string",
        "AGENCY_ID": "bigint",
    }
    lines = orders.select(line.alias("value"))
    return keyed_lines(lines.withColumn("line", F.col("value")), fields, keep=["line"])


def date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written as upper-case texts with short years, parsed."""
    orders = tb.read(spark, sf_dir, "orders")
    text = F.upper(F.date_format("o_orderdate", "dd-MMM-yy"))
    return orders.select(
        "o_orderkey", text.alias("text"), values.parse_date(text).cast("string").alias("day")
    )


def time_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times written with microseconds, parsed."""
    events = tb.read(spark, sf_dir, "events")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    at = values.parse_time(text)
    return events.select(
        "event_id", text.alias("text"), F.date_format(at, "yyyyMMddHHmmss.SSSSSS").alias("at")
    )


EVENT_RECORD = json.dumps(
    {
        "type": "record",
        "name": "event",
        "fields": [
            {"name": "event_id", "type": "long"},
            {"name": "user_id", "type": "int"},
            {"name": "event_type", "type": "string"},
            {"name": "props", "type": ["null", "string"]},
        ],
    }
)


def avro_schema_to_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON, read by the row schema of an Avro record that is looked up by topic."""
    folder = shared_folder(spark, "schemas")
    spark.createDataFrame([(EVENT_RECORD,)], "value string").coalesce(1).write.text(f"{folder}/events-value/1.avsc")
    schema = avro_to_struct(schema_text(spark, folder, "events"))
    events = tb.read(spark, sf_dir, "events")
    text = values.json_value("event_id", "user_id", "event_type", "props")
    told = F.concat_ws(",", *(F.lit(f"{f.name}:{f.dataType.simpleString()}") for f in schema.fields))
    return events.select(text.alias("text"), values.parse_json(text, schema).alias("r"), told.alias("fields")).select(
        "text", "fields", "r.*"
    )


def _events_record(*fields: tuple) -> str:
    told = [dict(zip(("name", "type"), f[:2])) | (f[2] if len(f) > 2 else {}) for f in fields]
    return json.dumps({"type": "record", "name": "event", "fields": told})


ORDER_RECORD = _events_record(
    ("o_orderkey", "long"), ("o_custkey", ["null", "long"]), ("o_orderstatus", "string"), ("o_orderpriority", ["string", "null"])
)


def _avro_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as framed Avro records; every seventh has no customer, every fifth no priority."""
    key = F.col("o_orderkey")
    record = F.struct(
        "o_orderkey",
        F.when(key % 7 != 0, F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus",
        F.when(key % 5 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    orders = tb.read(spark, sf_dir, "orders").select("o_orderkey", record.alias("record"))
    return orders.select("o_orderkey", framing.encode_avro(F.col("record"), ORDER_RECORD, 7).alias("message"))


def avro_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _avro_orders(spark, sf_dir).select("o_orderkey", F.hex("message").alias("message_hex"))


def avro_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records out of their messages; of every eleventh message the last byte is lost."""
    sent = _avro_orders(spark, sf_dir)
    cut = F.when(F.col("o_orderkey") % 11 == 0, F.expr("substring(message, 1, length(message) - 1)")).otherwise(F.col("message"))
    read = sent.select(F.col("o_orderkey").alias("sent_key"), cut.alias("message"))
    record = framing.decode_avro("message", ORDER_RECORD).alias("r")
    return read.select("sent_key", F.hex("message").alias("message_hex"), record).select("sent_key", "message_hex", "r.*")


EVENT_WRITERS = {
    1: _events_record(("event_id", "int"), ("uid", "int"), ("event_type", "string")),
    2: _events_record(("props", ["null", "string"]), ("event_id", "long"), ("user_id", ["null", "long"]), ("event_type", "string")),
}
EVENT_READER = _events_record(
    ("event_id", "long"),
    ("user_id", ["null", "long"], {"aliases": ["uid"]}),
    ("event_type", "string"),
    ("props", ["null", "string"], {"default": None}),
    ("origin", "string", {"default": "feed"}),
)


def mixed_schema_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written by an old and a new schema, a third by one unknown, in one feed."""
    events = tb.read(spark, sf_dir, "events")
    old = F.struct("event_id", F.col("user_id").alias("uid"), "event_type")
    new = F.struct("props", "event_id", "user_id", "event_type")
    kind = F.col("event_id") % 3
    messages = events.select(
        "event_id",
        F.when(kind == 0, framing.encode_avro(old, EVENT_WRITERS[1], 1))
        .when(kind == 1, framing.encode_avro(new, EVENT_WRITERS[2], 2))
        .otherwise(framing.frame(values.as_bytes("event_type"), 3))
        .alias("value"),
    )
    record = framing.decode_avro_by_id("value", EVENT_WRITERS, EVENT_READER).alias("r")
    told = messages.select(F.col("event_id").alias("sent_id"), framing.frame_schema_id("value").alias("schema_id"), record)
    return told.select("sent_id", "schema_id", "r.*")


# Streams


def select_star_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SELECT * over a declared stream."""
    events = tb.stream(spark, sf_dir, "events")
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    declare_stream(events.withColumn("ts", at), "events_raw_stream")
    out = shared_folder(spark, "select-star")
    copy_stream(spark.sql("SELECT * FROM events_raw_stream"), f"{out}/rows", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/rows")


def stream_rekey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared stream, written on under another key."""
    events = tb.stream(spark, sf_dir, "events").drop("ts")
    declare_stream(events, "events_to_rekey")
    out = shared_folder(spark, "rekey")
    keyed = ch.rekey(spark.sql("SELECT * FROM events_to_rekey"), "event_type")
    copy_stream(keyed, f"{out}/rows", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/rows")


def _customer_target(spark: SparkSession, sf_dir: str, folder: str) -> PlanTarget:
    target = PlanTarget.create(spark, f"{folder}/target", [tb.CUSTOMER])
    target.append(tb.named_orders(tb.read(spark, sf_dir, "orders")))
    return target


def _customer_feed(events: DataFrame) -> DataFrame:
    return tag_feed(tb.customer_changes(events), tb.CUSTOMER, tb.ORDER)


def _finish(feed: DataFrame, target: Target, folder: str, **options) -> None:
    checkpoint = f"{folder}/checkpoint"
    start(feed, target, checkpoint, available_now=True, **options).awaitTermination()


def stream_propagate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job: feed to log and plan table."""
    folder = shared_folder(spark, "stream-propagate")
    target = _customer_target(spark, sf_dir, folder)
    feed = _customer_feed(tb.stream(spark, sf_dir, "events"))
    _finish(feed, target, folder, log=TargetLog(target))
    return target.read(ORDER_COLUMNS)


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed in two halves, the second after a restart."""
    folder = shared_folder(spark, "stream-resume")
    target = _customer_target(spark, sf_dir, folder)
    events = tb.read(spark, sf_dir, "events")
    half = events.agg(F.max("event_id")).first()[0] // 2
    arrivals = f"{folder}/arrivals"
    first = F.coalesce(F.col("event_id") <= half, F.lit(False))
    for part in (first, ~first):
        events.filter(part).write.mode("append").parquet(arrivals)
        feed = _customer_feed(tb.file_stream(spark, arrivals, events.schema))
        _finish(feed, target, folder)
    return target.read(ORDER_COLUMNS)


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd orders arrive after the updates, which leave them alone."""
    folder = shared_folder(spark, "stream-late-rows")
    orders = tb.named_orders(tb.read(spark, sf_dir, "orders"))
    odd = F.coalesce(F.col("o_orderkey") % 2 == 1, F.lit(False))
    target = PlanTarget.create(spark, f"{folder}/target", [tb.CUSTOMER])
    target.append(orders.filter(~odd))
    _finish(_customer_feed(tb.stream(spark, sf_dir, "events")), target, folder)
    target.append(orders.filter(odd))
    return target.read(ORDER_COLUMNS)


def stream_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names folded into the rows."""
    folder = shared_folder(spark, "stream-fold")
    target = _customer_target(spark, sf_dir, folder)
    _finish(_customer_feed(tb.stream(spark, sf_dir, "events")), target, folder)
    target.fold()
    return target.read(ORDER_COLUMNS)


def stream_all_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight dimensions in one query, one writer on the plan table."""
    folder = shared_folder(spark, "stream-all-entities")
    specs = list(ENTITIES.values())
    target = PlanTarget.create(spark, f"{folder}/target", specs)
    target.append(tb.plan_table(tb.read(spark, sf_dir, "orders")))
    events = tb.stream(spark, sf_dir, "events")
    feeds = [tag_feed(tb.entity_changes(events, s), s, ["pos", "op_ts"]) for s in specs]
    _finish(union_feeds(feeds), target, folder)
    return target.read(["PLAN_ID", "op_type", *(s.plan_name for s in specs)])


def stream_multi_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dimensions, one with a text key, in one query."""
    folder = shared_folder(spark, "stream-multi-entity")
    target = PlanTarget.create(spark, f"{folder}/target", [tb.CUSTOMER, tb.PRIORITY])
    target.append(tb.named_orders(tb.read(spark, sf_dir, "orders")))
    events = tb.stream(spark, sf_dir, "events")
    feeds = [
        _customer_feed(events),
        tag_feed(tb.priority_changes(events), tb.PRIORITY, tb.ORDER),
    ]
    _finish(union_feeds(feeds), target, folder)
    return target.read([*ORDER_COLUMNS, "priority_name"])


def stream_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates no order took, as the job reports them."""
    folder = shared_folder(spark, "stream-report")
    target = _customer_target(spark, sf_dir, folder)
    changes = tb.customer_changes(tb.stream(spark, sf_dir, "events"), F.col("user_id") * 11)
    feed = tag_feed(changes, tb.CUSTOMER, tb.ORDER)
    _finish(feed, target, folder, report=f"{folder}/report")
    return spark.read.parquet(f"{folder}/report").select("entity", "key", "name")


def _in_parts(spark: SparkSession, sf_dir: str, folder: str, parts: int) -> Iterator[DataFrame]:
    """The feed's stream, anew each time that another part of the events has arrived."""
    events = tb.read(spark, sf_dir, "events")
    last = events.agg(F.max("event_id")).first()[0] or 0
    part = F.lit(0)
    for k in range(1, parts):
        part += F.coalesce(F.col("event_id") > last * k // parts, F.lit(False)).cast("int")
    for k in range(parts):
        events.filter(part == k).write.mode("append").parquet(f"{folder}/arrivals")
        yield tb.file_stream(spark, f"{folder}/arrivals", events.schema)


def stream_partial_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial rows beside the plan after three micro-batches: the last of each order counts."""
    folder = shared_folder(spark, "stream-partial-rows")
    tb.named_orders(tb.read(spark, sf_dir, "orders")).write.parquet(f"{folder}/plan")
    target = UpsertFiles(spark, [tb.CUSTOMER], f"{folder}/plan", f"{folder}/partial")
    for events in _in_parts(spark, sf_dir, folder, 3):
        _finish(_customer_feed(events), target, folder)
    return target.partial_rows(tb.CUSTOMER).select("o_orderkey", "o_orderstatus", "o_custkey", "customer_name")


def stream_upserted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan table as such a store shows it."""
    folder = shared_folder(spark, "stream-upserted-rows")
    tb.named_orders(tb.read(spark, sf_dir, "orders")).write.parquet(f"{folder}/plan")
    target = UpsertFiles(spark, [tb.CUSTOMER], f"{folder}/plan", f"{folder}/partial")
    for events in _in_parts(spark, sf_dir, folder, 3):
        _finish(_customer_feed(events), target, folder, log=FileLog(f"{folder}/log"))
    return target.rows().select(*ORDER_COLUMNS)


def stream_fold_beside_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fold and a compaction begin before a micro-batch and end after it, in another process."""
    folder = shared_folder(spark, "stream-fold-beside")
    target = _customer_target(spark, sf_dir, folder)
    keeper = PlanTarget(spark, target.path, [tb.CUSTOMER])
    begun: list = [None, None]
    for events in _in_parts(spark, sf_dir, folder, 4):
        _finish(_customer_feed(events), target, folder, log=TargetLog(target))
        for entry in begun:
            keeper.finish(entry)
        begun = [keeper.begin_compaction(), keeper.begin_fold()]
    return target.read(ORDER_COLUMNS)


BUCKETS = 16


def _bucketed_orders(spark: SparkSession, sf_dir: str, folder: str) -> PlanTarget:
    target = PlanTarget.create(spark, f"{folder}/target", [tb.CUSTOMER], buckets=BUCKETS)
    target.append(tb.named_orders(tb.read(spark, sf_dir, "orders")))
    target.fold()
    return target


def upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in buckets by id; after each part of the feed, buckets it changed are rewritten."""
    folder = shared_folder(spark, "upsert-buckets")
    target = _bucketed_orders(spark, sf_dir, folder)
    for events in _in_parts(spark, sf_dir, folder, 2):
        _finish(_customer_feed(events), target, folder)
        target.fold()
    return target.read(ORDER_COLUMNS)


def key_lookup_skipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer's orders with its newest name, out of the files that may hold them."""
    folder = shared_folder(spark, "lookup-skipping")
    target = _bucketed_orders(spark, sf_dir, folder)
    _finish(_customer_feed(tb.stream(spark, sf_dir, "events")), target, folder)
    return target.lookup("o_custkey", 42, ORDER_COLUMNS)


def star_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of two dimensions as three earlier states of the table had them."""
    folder = shared_folder(spark, "star-as-of")
    target = PlanTarget.create(spark, f"{folder}/target", [tb.CUSTOMER, tb.PRIORITY])
    target.append(tb.named_orders(tb.read(spark, sf_dir, "orders")))
    numbers = []
    for events in _in_parts(spark, sf_dir, folder, 3):
        feeds = [_customer_feed(events), tag_feed(tb.priority_changes(events), tb.PRIORITY, tb.ORDER)]
        _finish(union_feeds(feeds), target, folder)
        numbers.append(target.commits()[-1]["number"])
    target.fold()
    columns = ["o_orderkey", "customer_name", "priority_name"]
    states = [target.read(columns, as_of=n).withColumn("state", F.lit(k + 1)) for k, n in enumerate(numbers)]
    return reduce(DataFrame.unionByName, states)


def _aged(spark: SparkSession, path: str, days: int) -> None:
    """Date the files of a folder back."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(at):
        fs.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


def stream_old_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed in two halves; the files of the second are dated a month before the first."""
    folder = shared_folder(spark, "stream-old-files")
    target = _customer_target(spark, sf_dir, folder)
    events = tb.read(spark, sf_dir, "events")
    half = events.agg(F.max("event_id")).first()[0] // 2
    first = F.coalesce(F.col("event_id") <= half, F.lit(False))
    for k, part in enumerate((first, ~first)):
        arrivals = f"{folder}/in/part={k}"
        events.filter(part).write.parquet(arrivals)
        _aged(spark, arrivals, 30 * k)
        feed = tb.file_stream(spark, f"{folder}/in", events.schema).select(*events.columns)
        _finish(_customer_feed(feed), target, folder)
    return target.read(ORDER_COLUMNS)


def stream_fold_two_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of two dimensions, folded by a process that knows one of them."""
    folder = shared_folder(spark, "stream-fold-two")
    target = PlanTarget.create(spark, f"{folder}/target", [tb.CUSTOMER, tb.PRIORITY])
    target.append(tb.named_orders(tb.read(spark, sf_dir, "orders")))
    events = tb.stream(spark, sf_dir, "events")
    feeds = [_customer_feed(events), tag_feed(tb.priority_changes(events), tb.PRIORITY, tb.ORDER)]
    _finish(union_feeds(feeds), target, folder)
    PlanTarget(spark, target.path, [tb.CUSTOMER]).fold()
    return PlanTarget(spark, target.path, []).read([*ORDER_COLUMNS, "priority_name"])


def _report_all(spark: SparkSession, sf_dir: str, folder: str, **settings: bool) -> DataFrame:
    specs = list(ENTITIES.values())
    target = PlanTarget.create(spark, f"{folder}/target", specs, **settings)
    target.append(tb.plan_table(tb.read(spark, sf_dir, "orders")))
    events = tb.stream(spark, sf_dir, "events").withColumn("user_id", F.col("user_id") * 11)
    feeds = [tag_feed(tb.entity_changes(events, s), s, ["pos", "op_ts"]) for s in specs]
    _finish(union_feeds(feeds), target, folder, report=f"{folder}/report")
    return spark.read.parquet(f"{folder}/report").select("entity", "key", "name")


def stream_report_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates of eight dimensions that no plan row took."""
    return _report_all(spark, sf_dir, shared_folder(spark, "stream-report-all"))


def stream_report_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, found among the keys stored beside the rows."""
    return _report_all(spark, sf_dir, shared_folder(spark, "stream-report-index"), index=True)


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the job counts of its changes, over three micro-batches."""
    folder = shared_folder(spark, "stream-counts")
    target, seen = _customer_target(spark, sf_dir, folder), []
    for events in _in_parts(spark, sf_dir, folder, 3):
        query = start(_customer_feed(events), target, f"{folder}/checkpoint", available_now=True)
        query.awaitTermination()
        seen += [p.observedMetrics["changes"] for p in query.recentProgress if "changes" in p.observedMetrics]
    names = ("changes", "updates", "without_key")
    return spark.createDataFrame([tuple(sum(getattr(r, n) for r in seen) for n in names)], ", ".join(f"{n} bigint" for n in names))


def stream_compact_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last change of every key as state, over three parts and as many runs of the query."""
    folder = shared_folder(spark, "compact-live")
    table = LiveTable(f"{folder}/live", ["key"])
    for events in _in_parts(spark, sf_dir, folder, 3):
        told = live_changes(tb.customer_changes(events), ["key"], tb.ORDER, F.col("op_type") == "D")
        table.start(told, f"{folder}/checkpoint", available_now=True).awaitTermination()
    schema = tb.customer_changes(tb.read(spark, sf_dir, "events")).schema
    return table.read(spark, schema).select("key", "op_type", "name", "event_id")


def upsert_without_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed of inserts and deletes leaves the plan as it is."""
    folder = shared_folder(spark, "no-updates")
    target = _customer_target(spark, sf_dir, folder)
    events = tb.stream(spark, sf_dir, "events").filter(F.col("event_type").isin("signup", "error"))
    _finish(_customer_feed(events), target, folder)
    return target.read(ORDER_COLUMNS)


def mixed_case_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched rows, with plan columns named in any case."""
    latest, size = settle(_latest(tb.read(spark, sf_dir, "events")))
    spec = replace(tb.CUSTOMER, fk="O_CustKey", plan_id="O_ORDERKEY", plan_op="o_OrderStatus")
    hit = pr.matched_rows(tb.read(spark, sf_dir, "orders"), latest, spec, size=size)
    return hit.select(F.col("O_OrderKey").alias("o_orderkey"), F.col("O_ORDERSTATUS").alias("o_orderstatus"),
                      F.col("o_CUSTKEY").alias("o_custkey"), "customer_name")


def _entity_log(spark: SparkSession, sf_dir: str, spec: EntitySpec) -> DataFrame:
    folder = shared_folder(spark, "stream-log")
    target = PlanTarget.create(spark, f"{folder}/target", [spec])
    feed = tag_feed(
        tb.entity_changes(tb.stream(spark, sf_dir, "events"), spec), spec, ["pos", "op_ts"]
    )
    log = FileLog(f"{folder}/log", "json")
    _finish(feed, target, folder, log=log)
    return log.read(spark, feed.schema["ord"].dataType)


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change as copied to the log, in JSON."""
    spec = ENTITIES["property"]
    record = values.parse_json("msg_value", spec.schema)
    copied = _entity_log(spark, sf_dir, spec).select("msg_key", record.alias("r"))
    return copied.select("msg_key", "r.op_type", "r.pos", "r.PROPERTY_ID", "r.PROPERTY_NAME")


def change_log_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last copy per key, whatever its op."""
    spec = ENTITIES["division"]
    record = values.parse_json("msg_value", spec.schema)
    last = compact_log(_entity_log(spark, sf_dir, spec)).select("msg_key", record.alias("r"))
    return last.select("msg_key", "r.op_type", "r.CHANNEL_DIVISION_NAME")


def change_log_two_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later events logged first, earlier ones by a second job: arrival decides, deletes count."""
    folder, spec = shared_folder(spark, "log-two"), ENTITIES["agency"]
    events = tb.read(spark, sf_dir, "events")
    half = events.agg(F.max("event_id")).first()[0] // 2
    first = F.coalesce(F.col("event_id") <= half, F.lit(False))
    target = PlanTarget.create(spark, f"{folder}/target", [spec])
    for k, part in enumerate((~first, first)):
        events.filter(part).write.parquet(f"{folder}/in-{k}")
        changes = tb.entity_changes(tb.file_stream(spark, f"{folder}/in-{k}", events.schema), spec)
        message = F.when(F.col("op_type") != "D", values.json_value(*changes.columns))
        feed = tag_feed(changes, spec, ["pos", "op_ts"], value=message)
        start(feed, target, f"{folder}/cp-{k}", log=FileLog(f"{folder}/log"), available_now=True).awaitTermination()
    log = FileLog(f"{folder}/log")
    log.merge_files(spark)
    last = compact_log(log.read(spark, feed.schema["ord"].dataType))
    record = values.parse_json("msg_value", spec.schema)
    return last.select("msg_key", record.alias("r")).select("msg_key", "r.op_type", "r.AGENCY_NAME")


def stream_from_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log read as a stream from its second micro-batch on, files merged halfway."""
    folder, spec = shared_folder(spark, "from-log"), ENTITIES["property"]
    target, log = PlanTarget.create(spark, f"{folder}/target", [spec]), FileLog(f"{folder}/log")
    copied = f"{folder}/copied"
    for k, events in enumerate(_in_parts(spark, sf_dir, folder, 3)):
        feed = tag_feed(tb.entity_changes(events, spec), spec, ["pos", "op_ts"])
        _finish(feed, target, folder, log=log)
        ord_type = feed.schema["ord"].dataType
        if k:
            copy_stream(log_stream(spark, log, ord_type, starting_number=1), copied, f"{folder}/copied-checkpoint")
        if k == 1:
            log.merge_files(spark)
    record = values.parse_json("msg_value", spec.schema)
    read = spark.read.parquet(copied).select("msg_key", "seq", record.alias("r"))
    return read.select("msg_key", (F.col("seq") > 1).alias("late"), "r.pos", "r.PROPERTY_NAME")


def change_log_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines, some broken, as they come into the log, and whether they are rejected."""
    folder, spec = shared_folder(spark, "log-raw"), ENTITIES["property"]
    events = tb.read(spark, sf_dir, "events")
    record = F.concat(
        F.lit('{"op_type": "U",  "PROPERTY_ID": '), "user_id", F.lit(', "PROPERTY_NAME": "'), "event_type",
        F.lit('", "EXTRA": "'), "event_id", F.lit('"}'),
    )
    line = F.when(F.col("event_id") % 97 == 0, F.concat(F.lit("no record "), "event_id")).otherwise(record)
    events.select(line.alias("value")).write.text(f"{folder}/in")
    feed = tag_feed(raw_change_stream(spark, spec, f"{folder}/in"), spec, ["pos", "op_ts"])
    target, log = PlanTarget.create(spark, f"{folder}/target", [spec]), FileLog(f"{folder}/log")
    _finish(feed, target, folder, log=log, rejects=f"{folder}/rejects")
    logged = log.read(spark, feed.schema["ord"].dataType).select("msg_key", "msg_value", F.lit("logged").alias("in"))
    rejected = spark.read.parquet(f"{folder}/rejects").select("msg_key", "msg_value", F.lit("rejected").alias("in"))
    return logged.unionByName(rejected)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        change_extract,
        update_filter,
        latest_update_per_key,
        compact_latest,
        compact_live,
        rekey,
        rekey_bucketed_join,
        key_lookup,
        propagate_narrow,
        propagate_wide,
        unmatched_updates,
        upsert_target,
        upsert_null_name,
        multi_entity,
        star_enrich,
        star_from_feed,
        to_json_value,
        framed_value,
        union_unwrap,
        keyed_line_records,
        date_parse,
        time_parse,
        avro_schema_to_struct,
        avro_encode,
        avro_decode,
        mixed_schema_feed,
        select_star_view,
        stream_rekey,
        stream_propagate,
        stream_resume,
        stream_late_rows,
        stream_fold,
        stream_all_entities,
        stream_multi_entity,
        stream_report,
        stream_partial_rows,
        stream_upserted_rows,
        stream_old_files,
        stream_fold_two_entities,
        stream_fold_beside_writer,
        upsert_buckets,
        key_lookup_skipping,
        star_as_of,
        stream_report_all,
        stream_report_index,
        stream_counts,
        stream_compact_live,
        upsert_without_updates,
        mixed_case_columns,
        change_log,
        change_log_compacted,
        change_log_two_queries,
        change_log_raw,
        stream_from_log,
    )
} | {f"entity_{e}": partial(entity_rows, e) for e in ENTITIES}
