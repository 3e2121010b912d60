import datetime
import random

import pytest

from namewake.operators.changes import compact
from namewake.sources.files import file_stream
from namewake.streaming.compaction import LiveTable, live_changes
from pyspark.sql import functions as F

SCHEMA = "k bigint, op string, at timestamp, n bigint, name string, x double"


def changes(rng, n, first):
    day = datetime.datetime(2024, 1, 1)
    out = []
    for i in range(n):
        at = day + datetime.timedelta(microseconds=rng.randrange(50)) if rng.random() < 0.9 else None
        out.append((rng.choice([None, *range(6)]), rng.choice("IUDUU"), at, (2**60 if i % 3 else -5) + first + i,
                    rng.choice([None, f"é\n{i}"]), rng.random()))
    return out


def live(df):
    return sorted(map(str, compact(df, ["k"], ["at", "n"], deleted=F.col("op") == "D").select(*[c.split()[0] for c in SCHEMA.split(", ")]).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_state_over_restarts_equals_the_batch(spark, tmp_path, seed):
    """Old rows come late, keys are deleted and come back; a new run begins from the checkpoint."""
    rng, table = random.Random(seed), LiveTable(f"{tmp_path}/live", ["k"])
    for run in range(3):
        for part in range(2):
            spark.createDataFrame(changes(rng, 40, 100 * run + 50 * part), SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = file_stream(spark, f"{tmp_path}/in", SCHEMA, max_files=1)
        told = live_changes(stream, ["k"], ["at", "n"], F.col("op") == "D")
        table.start(told, f"{tmp_path}/cp", available_now=True).awaitTermination()
        every = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/in")
        assert sorted(map(str, table.read(spark, every.schema).collect())) == live(every)
    said = spark.read.parquet(f"{tmp_path}/live")
    assert said.groupBy("batch_id", "k").count().filter("count > 1").isEmpty()
    assert said.filter("deleted").count() > 0


def test_state_without_a_call_for_each_key(spark, tmp_path):
    """State is one aggregate; equal and older rows of a later micro-batch change nothing."""
    day = datetime.datetime(2024, 1, 1)
    parts = [[(1, "U", day, 5, "a", 0.5), (2, "U", day, 5, "b", 0.5), (3, "U", day, 1, "c", 0.5)],
             [(1, "U", day, 5, "a", 0.5), (2, "U", None, 9, "old", 0.5), (3, "D", day, 2, "c", 0.5)]]
    table, said = LiveTable(f"{tmp_path}/live", ["k"]), None
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        told = live_changes(file_stream(spark, f"{tmp_path}/in", SCHEMA), ["k"], ["at", "n"], F.col("op") == "D")
        plan = told._jdf.queryExecution().analyzed().toString()
        assert "InPandas" not in plan and "StateInPy" not in plan
        table.start(told, f"{tmp_path}/cp", available_now=True).awaitTermination()
    said = spark.read.parquet(f"{tmp_path}/live").select("batch_id", "k", "deleted")
    assert sorted(map(tuple, said.collect())) == [(0, 1, False), (0, 2, False), (0, 3, False), (1, 3, True)]


def test_nothing_yet(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    assert LiveTable(f"{tmp_path}/none", ["k"]).read(spark, schema).collect() == []
