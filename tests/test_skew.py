"""Tables as folders of several files, with a third of all rows under one key."""

import duckdb
import pytest
from pyspark.sql import functions as F

from namewake.operators.joins import BROADCAST_BYTES
from namewake.plans.oracles import ORACLES
from namewake.plans.queries import QUERIES
from tests.test_oracle import TABLES, canonical

SMALL = "/root/testdata/sf0.001"
HOT = {
    "events": ("user_id", "event_id"),
    "orders": ("o_custkey", "o_orderkey"),
    "lineitem": ("l_orderkey", "l_linenumber"),
}
NAMES = [
    "latest_update_per_key",
    "compact_live",
    "propagate_narrow",
    "propagate_wide",
    "unmatched_updates",
    "upsert_target",
    "upsert_null_name",
    "multi_entity",
    "star_enrich",
    "entity_target_group",
    "stream_propagate",
    "stream_all_entities",
    "stream_partial_rows",
    "stream_report",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for table in TABLES[:8]:
        df = spark.read.parquet(f"{SMALL}/{table}.parquet")
        if table in HOT:
            column, by = HOT[table]
            kind = df.schema[column].dataType
            hot = F.when(F.col(by) % 3 == 0, F.lit(7)).when(F.col(by) % 7 != 1, F.col(column))
            # users stay known, plan rows may lack a key
            hot = F.coalesce(hot, F.col(column)) if table == "events" else hot
            df = df.withColumn(column, hot.cast(kind))
        df.repartition(3).write.parquet(f"{folder}/{table}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def db(skewed):
    con = duckdb.connect()
    for t in TABLES[:8]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{skewed}/{t}.parquet/*.parquet'")
    return con


@pytest.mark.parametrize("limit", ["67108864", "0"])
@pytest.mark.parametrize("name", NAMES)
def test_query(spark, skewed, db, name, limit):
    expected = db.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    spark.conf.set(BROADCAST_BYTES, limit)
    try:
        df = QUERIES[name](spark, skewed)
        ours = canonical([tuple(r) for r in df.collect()], df.columns)
    finally:
        spark.conf.unset(BROADCAST_BYTES)
    theirs = canonical(expected.fetchall(), columns)
    assert ours == theirs and ours
