"""Physical plans of the registered batch queries."""

import pytest

from namewake.operators.joins import BROADCAST_BYTES
from namewake.plans.queries import QUERIES
from tests.helpers import plan_text

SF = "/root/testdata/sf0.001"
STREAMS = ("stream_", "change_log", "select_star", "star_as_of", "upsert_buckets", "key_lookup_skipping")
AVRO = ("avro_encode", "avro_decode", "mixed_schema_feed")
ALIKE = ("entity_a", "entity_d", "entity_s", "entity_t")
BATCH = [q for q in QUERIES if not q.startswith(STREAMS + ALIKE) and q not in AVRO]


def text(spark, name):
    return plan_text(QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", BATCH)
def test_no_slow_operators(spark, name):
    """No pairing of all rows and no Python workers, even where nothing may be broadcast."""
    spark.conf.set(BROADCAST_BYTES, "0")
    try:
        plan = text(spark, name)
    finally:
        spark.conf.unset(BROADCAST_BYTES)
    for slow in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas"):
        assert slow not in plan
    if "settled" in plan:
        assert "SortMergeJoin" in plan


@pytest.mark.parametrize("name", AVRO)
def test_avro_goes_by_batches(spark, name):
    """Records are coded in Python, whole Arrow batches at a time and never row by row."""
    plan = text(spark, name)
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan and "Exchange" not in plan


def scan(plan, table):
    return next(line for line in plan.splitlines() if "FileScan" in line and f"/{table}.parquet" in line)


def test_only_needed_columns_are_read(spark):
    narrow = scan(text(spark, "propagate_narrow"), "orders")
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in narrow
    assert "props" not in scan(text(spark, "latest_update_per_key"), "events")
    lines = scan(text(spark, "star_enrich"), "lineitem")
    assert "row_index" not in lines and "l_tax" not in lines
    keys = scan(text(spark, "unmatched_updates"), "orders")
    assert "ReadSchema: struct<o_custkey:bigint>" in keys


def test_filters_reach_the_scan(spark):
    lookup = scan(text(spark, "key_lookup"), "orders")
    assert "EqualTo(o_custkey,42)" in lookup


@pytest.mark.parametrize(
    ("name", "shuffles"),
    [
        ("change_extract", 0),
        ("update_filter", 0),
        ("rekey", 0),
        ("key_lookup", 0),
        ("propagate_narrow", 0),
        ("upsert_target", 0),
        ("multi_entity", 0),
        ("star_enrich", 0),
        ("entity_property", 0),
        ("latest_update_per_key", 1),
        ("compact_latest", 1),
        ("unmatched_updates", 1),
    ],
)
def test_shuffles(spark, name, shuffles):
    assert text(spark, name).count("Exchange hashpartitioning") == shuffles


def test_latest_is_reduced_before_the_shuffle(spark):
    lines = text(spark, "compact_latest").splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert any("partial_max" in line for line in lines[exchange + 1 :])
