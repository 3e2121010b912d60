import random

import pytest
from pyspark.sql import functions as F

from namewake.operators import joins
from namewake.operators.propagate import Dimension, merge_names, star_enrich
from namewake.scratch import Size, measure, measure_all, settle, shared_folder
from tests.helpers import CHANGES, SPEC, change_rows, fold, plan_df, plan_rows, plan_text, sorted_rows
from namewake.operators.changes import latest_updates


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set(joins.BROADCAST_BYTES, "0")
    yield
    spark.conf.unset(joins.BROADCAST_BYTES)


def skewed(spark, n=30000):
    """A third of the rows under one key, a third without a key, the rest spread."""
    fk = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 5000 + 100)
    return spark.range(n).select("id", fk.cast("bigint").alias("fk"))


def lookup(spark, n=6000):
    return spark.range(n).select(
        F.col("id").alias("key"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("v")
    )


def expected(n=30000, keys=6000):
    out = {}
    for i in range(n):
        k = 7 if i % 3 == 0 else (i % 5000 + 100 if i % 3 == 1 else None)
        out[i] = None if k is None or k >= keys else f"v{k}"
    return out


@pytest.mark.parametrize("how", ["left", "inner"])
def test_broadcast_and_salted_joins_agree(spark, how):
    fact, small = skewed(spark), lookup(spark)
    want = expected()
    if how == "inner":
        want = {k: v for k, v in want.items() if v is not None}
    wide = joins.lookup_join(fact, small, "fk", "key", how, row_id=["id"])
    assert "BroadcastHashJoin" in plan_text(wide)
    assert {r["id"]: r["v"] for r in wide.collect()} == want
    spark.conf.set(joins.BROADCAST_BYTES, "0")
    try:
        salted = joins.lookup_join(fact, small, "fk", "key", how, row_id=["id"])
        rows = salted.collect()
    finally:
        spark.conf.unset(joins.BROADCAST_BYTES)
    assert "SortMergeJoin" in plan_text(salted)
    assert salted.columns == wide.columns == ["id", "fk", "v"]
    assert len(rows) == len(want)
    assert {r["id"]: r["v"] for r in rows} == want


def test_hot_rows_are_spread(spark, no_broadcast):
    """No task of the salted join gets much more than its share."""
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = joins.lookup_join(skewed(spark), lookup(spark), "fk", "key", "left", row_id=["id"])
        loads = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert sum(r["count"] for r in loads) == 30000
    assert max(r["count"] for r in loads) < 2 * 30000 / 8


def test_plain_shuffle_join_without_hot_keys(spark, no_broadcast):
    fact = spark.range(8000).select("id", (F.col("id") % 4000).alias("fk"))
    out = joins.lookup_join(fact, lookup(spark), "fk", "key", "left", row_id=["id"])
    assert "__salt" not in plan_text(out)
    assert out.filter(F.col("v") == F.concat(F.lit("v"), F.col("fk").cast("string"))).count() == 8000


def test_hot_keys_are_few(spark):
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = {r["__hot_key"]: r["__salts"] for r in joins.hot_keys(skewed(spark).select("fk")).collect()}
    assert set(hot) == {7, None}
    assert tasks < sum(hot.values()) <= joins.PIECES_PER_TASK * tasks + len(hot)
    even = spark.range(1000).select((F.col("id") % (5 * tasks)).alias("fk"))
    assert joins.hot_keys(even).count() <= joins.PIECES_PER_TASK * tasks


def test_merge_through_the_salted_join(spark, no_broadcast):
    rng = random.Random(11)
    plan, changes = plan_rows(300, 3, rng), change_rows(80, 3, rng)
    last = latest_updates(spark.createDataFrame(changes, CHANGES), ["SHOP_ID"], ["pos"])
    merged = merge_names(plan_df(spark, plan), last.select("SHOP_ID", "SHOP_NAME"), SPEC)
    assert sorted_rows(merged) == fold(plan, changes)


@pytest.mark.parametrize("limit", ["0", "250000", "100000000"])
def test_star_is_the_same_at_any_limit(spark, limit):
    """Nothing fits, only the small tables fit, everything fits."""
    fact = spark.range(2000).select("id", (F.col("id") % 300).alias("a"), (F.col("id") % 9).alias("b"))
    regions = spark.range(3).select(F.col("id").alias("r"), F.concat(F.lit("r"), F.col("id")).alias("rn"))
    towns = spark.range(8).select(
        F.col("id").alias("t"), F.concat(F.lit("t"), F.col("id")).alias("tn"), (F.col("id") % 4).alias("tr")
    )
    people = spark.range(9000).select(
        F.col("id").alias("p"), F.concat(F.lit("p"), F.col("id")).alias("pn"), (F.col("id") % 10).alias("pt")
    )

    def town(fk, prefix):
        region = Dimension(regions, "tr", "r", {"rn": f"{prefix}_region"})
        return Dimension(towns, fk, "t", {"tn": f"{prefix}_town"}, (region,))

    dims = [Dimension(people, "a", "p", {"pn": "person"}, (town("pt", "home"),)), town("b", "work")]
    spark.conf.set(joins.BROADCAST_BYTES, limit)
    try:
        out = star_enrich(fact, dims, row_id=["id"])
        rows = out.collect()
    finally:
        spark.conf.unset(joins.BROADCAST_BYTES)
    assert out.columns == [
        "id", "a", "b", "person", "home_town", "home_region", "work_town", "work_region",
    ]

    def place(t):
        if t >= 8:
            return None, None
        return f"t{t}", f"r{t % 4}" if t % 4 < 3 else None

    want = {}
    for i in range(2000):
        a, b = i % 300, i % 9
        want[i] = (i, a, b, f"p{a}", *place(a % 10), *place(b))
    assert {r["id"]: tuple(r) for r in rows} == want and len(rows) == 2000


def test_sizes(spark):
    df = spark.createDataFrame([("ab", 1), (None, 2)], "s string, n int")
    one, none = measure_all([df, df.filter("n > 5")], 1000)
    assert one == measure(df, 1000) == Size(2, 2 * (24 + 16 + 16) + 2)
    assert none == Size(0, 0)
    # beyond what matters, rows are enough
    assert measure(df, 100) == Size(2, 2 * (24 + 16 + 16))
    settled, size = settle(df)
    assert size == one and sorted(r["n"] for r in settled.collect()) == [1, 2]
    empty, size = settle(df.filter("n > 5"))
    assert size.rows == 0 and empty.count() == 0 and empty.columns == df.columns


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert a.startswith(base) and a != b

