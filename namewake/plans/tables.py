"""Feeds and plan tables made of the given tables.

``events`` stands in for a change feed and ``orders`` for the plan table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namewake.entities import ENTITIES, EntitySpec
from namewake.sources.files import file_stream

ORDER = ["ts", "event_id"]

# The customer dimension, fed by users, and what it names in an order.
CUSTOMER = EntitySpec(
    "customer",
    key="key",
    name="name",
    fk="o_custkey",
    plan_name="customer_name",
    plan_id="o_orderkey",
    plan_op="o_orderstatus",
)
PRIORITY = EntitySpec(
    "priority",
    key="key",
    name="name",
    fk="o_orderpriority",
    plan_name="priority_name",
    plan_id="o_orderkey",
    plan_op="o_orderstatus",
)

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(
    spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None
) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return file_stream(spark, path, spark.read.parquet(path).schema, max_files=max_files)


def _op(event_type: Column) -> Column:
    return F.when(event_type == "signup", "I").when(event_type == "error", "D").otherwise("U")


def _name() -> Column:
    return F.concat_ws("#", "event_type", F.col("event_id").cast("string"))


def customer_changes(events: DataFrame, key: Column | None = None) -> DataFrame:
    """Every event as a change of the user's name."""
    return events.select(
        (F.col("user_id") if key is None else key).alias("key"),
        _op(F.col("event_type")).alias("op_type"),
        _name().alias("name"),
        *ORDER,
    )


def nameless_changes(events: DataFrame) -> DataFrame:
    """The same, where small property values take the name away."""
    small = F.get_json_object("props", "$.k").cast("int") < 10
    return events.select(
        F.col("user_id").alias("key"),
        _op(F.col("event_type")).alias("op_type"),
        F.when(small, F.lit(None)).otherwise(_name()).alias("name"),
        *ORDER,
    )


def priority_changes(events: DataFrame) -> DataFrame:
    """Every event as a change of an order priority's name."""
    names = F.array(*map(F.lit, PRIORITIES))
    key = F.get(names, (F.col("event_id") % len(PRIORITIES)).cast("int"))
    return customer_changes(events, key)


def named_orders(orders: DataFrame) -> DataFrame:
    """Orders with an earlier customer name, for updates to overwrite."""
    return orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderpriority",
        F.concat(F.lit("old#"), F.col("o_custkey").cast("string")).alias("customer_name"),
    )


def entity_changes(events: DataFrame, spec: EntitySpec) -> DataFrame:
    """Every event as a change record of one of the eight dimensions."""
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    known = {
        "table1": F.lit(spec.entity),
        "op_type": _op(F.col("event_type")),
        "op_ts": at,
        "current_ts": at,
        "pos": F.lpad(F.col("event_id").cast("string"), 20, "0"),
        spec.key: F.col("user_id"),
        spec.name: F.concat(F.lit(f"{spec.entity}:"), _name()),
    }
    return events.select(
        *(
            known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in spec.schema.fields
        )
    )


def plan_table(orders: DataFrame) -> DataFrame:
    """Orders as plan rows, with one foreign key per dimension."""
    keys = [
        F.abs(F.col("o_custkey") - i).alias(spec.fk) for i, spec in enumerate(ENTITIES.values())
    ]
    return orders.select(
        F.col("o_orderkey").alias("PLAN_ID"),
        F.col("o_orderstatus").alias("op_type"),
        F.col("o_orderpriority").alias("PLAN_NAME"),
        F.col("o_orderkey").alias("ORIGINAL_PLAN_ID"),
        (F.col("o_orderkey") % 7).alias("PORTFOLIO_PLAN_ID"),
        (F.col("o_orderkey") % 11).alias("PRG_PLAN_ID"),
        (F.col("o_orderkey") % 3).alias("REVISION_NO"),
        (F.col("o_orderkey") % 13).alias("STEW_LINK_ID"),
        *keys,
    )
