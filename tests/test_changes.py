import random

import pytest
from pyspark.sql import functions as F

from namewake.entities import ENTITIES, ENVELOPE
from namewake.operators import changes as ch
from namewake.operators.propagate import matched_rows, merge_names, unmatched_updates
from tests.helpers import CHANGES, PLAN, SPEC, change_rows, fold, plan_df, plan_rows, sorted_rows


def latest(spark, rows):
    df = spark.createDataFrame(rows, CHANGES)
    return ch.latest_updates(df, ["SHOP_ID"], ["pos"]).select("SHOP_ID", "SHOP_NAME")


def as_dict(df):
    return {r[0]: r[1] for r in df.collect()}


def test_later_delete_or_insert_does_not_hide_an_update(spark):
    rows = [(1, "U", "a", 0), (1, "U", "b", 1), (1, "D", "x", 2), (2, "U", "c", 3), (2, "I", "y", 4)]
    assert as_dict(latest(spark, rows)) == {1: "b", 2: "c"}


def test_null_name_is_an_update(spark):
    assert as_dict(latest(spark, [(1, "U", "a", 0), (1, "U", None, 1)])) == {1: None}


def test_null_keys_are_set_aside(spark):
    rows = [(None, "U", "a", 0), (1, "U", "b", 1)]
    assert as_dict(latest(spark, rows)) == {1: "b"}
    rejected = ch.null_keys(spark.createDataFrame(rows, CHANGES), "SHOP_ID")
    assert [r["SHOP_NAME"] for r in rejected.collect()] == ["a"]


def test_op_type_is_case_sensitive(spark):
    assert latest(spark, [(1, "u", "a", 0)]).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_one_merge_equals_the_row_loop(spark, seed):
    rng = random.Random(seed)
    plan, changes = plan_rows(200, 12, rng), change_rows(120, 12, rng)
    merged = merge_names(plan_df(spark, plan), latest(spark, changes), SPEC)
    assert sorted_rows(merged) == fold(plan, changes)


def test_empty_feed_changes_nothing(spark):
    plan = plan_rows(20, 4, random.Random(0))
    merged = merge_names(plan_df(spark, plan), latest(spark, [(1, "I", "a", 0)]), SPEC)
    assert sorted_rows(merged) == fold(plan, [])


def test_merge_makes_a_missing_name_column(spark):
    plan = spark.createDataFrame([(1, "U", 5), (2, "U", 6)], "PLAN_ID int, op_type string, SHOP_ID bigint")
    merged = merge_names(plan, latest(spark, [(5, "U", "a", 0)]), SPEC)
    assert {r["PLAN_ID"]: r["SHOP_NAME"] for r in merged.collect()} == {1: "a", 2: None}


def test_matched_rows_keep_the_plans_own_op(spark):
    plan = spark.createDataFrame([(1, "D", 5, "old", "n"), (2, "U", 6, "old", "m")], PLAN)
    hit = matched_rows(plan, latest(spark, [(5, "U", "a", 0)]), SPEC, columns=["NOTE"])
    assert hit.columns == ["PLAN_ID", "op_type", "SHOP_ID", "SHOP_NAME", "NOTE"]
    assert [tuple(r) for r in hit.collect()] == [(1, "D", 5, "a", "n")]


def test_column_names_in_any_case(spark):
    plan = spark.createDataFrame([(1, "D", 5, "old", "n")], PLAN)
    assert plan.select("OP_TYPE", "shop_id").columns == ["OP_TYPE", "shop_id"]


def test_unmatched_updates(spark):
    plan = spark.createDataFrame([(1, "U", 5, None, ""), (2, "U", None, None, "")], PLAN)
    last = latest(spark, [(5, "U", "a", 0), (6, "U", "b", 1), (7, "I", "c", 2)])
    assert as_dict(unmatched_updates(plan, last, "SHOP_ID", "SHOP_ID")) == {6: "b"}


def test_compaction_keeps_the_last_value_and_drops_tombstones(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), ("b", 2, None), ("c", 1, None), ("c", 2, "w")]
    log = spark.createDataFrame(rows, "k string, n int, v string")
    kept = ch.compact(log, ["k"], ["n"], deleted=F.col("v").isNull())
    assert {r["k"]: r["v"] for r in kept.collect()} == {"a": "y", "c": "w"}
    assert ch.compact(log, ["k"], ["n"]).count() == 3


def test_null_delete_condition_keeps_the_row(spark):
    log = spark.createDataFrame([("a", 1, None)], "k string, n int, op string")
    assert ch.compact(log, ["k"], ["n"], deleted=F.col("op") == "D").count() == 1


def test_equal_orders_give_one_steady_row(spark):
    log = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y")] * 3, "k string, n int, v string")
    for parts in (1, 2, 5):
        got = ch.compact(log.repartition(parts), ["k"], ["n"]).collect()
        assert [r["v"] for r in got] == ["y"]


def test_envelope_spellings(spark):
    one = spark.createDataFrame([("t", 1)], "table string, k int")
    both = spark.createDataFrame([("t", None), (None, "u")], "table string, table1 string")
    assert ch.one_envelope(one).columns == ["table1", "k"]
    assert sorted(r["table1"] for r in ch.one_envelope(both).collect()) == ["t", "u"]
    assert ch.one_envelope(both).columns == ["table1"]


def test_rekey(spark):
    df = spark.range(100).withColumn("p", F.col("id") % 7)
    assert ch.rekey(df, "p").rdd.getNumPartitions() == df.rdd.getNumPartitions()
    one = ch.rekey(df, "p", 1)
    assert one.rdd.getNumPartitions() == 1
    placed = ch.rekey(df, "p", 4).withColumn("part", F.spark_partition_id())
    assert placed.groupBy("key").agg(F.count_distinct("part").alias("n")).filter("n > 1").count() == 0


def test_eight_entities():
    assert len(ENTITIES) == 8
    for spec in ENTITIES.values():
        names = spec.schema.fieldNames()
        assert names[:5] == list(ENVELOPE)
        assert names[5:7] == [spec.key, spec.name]
        assert not spec.schema[spec.key].nullable
        assert {f.dataType.simpleString() for f in spec.schema} <= {"string", "bigint"}
    assert ENTITIES["target_group"].fk == "PRIMARY_DEMO_ID"
    assert len(ENTITIES["advertiser"].keep) == 7
