import json
import random
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namewake.entities import ENTITIES, EntitySpec
from namewake.operators.changes import latest_updates
from namewake.operators.joins import BROADCAST_BYTES
from namewake.sources.files import file_stream, raw_change_stream
from namewake.streaming import commits, job
from namewake.streaming.commits import folders
from namewake.streaming.feeds import FEED_COLUMNS, tag_feed, union_feeds
from namewake.streaming.job import last_names, start
from namewake.streaming.logs import FileLog, TopicLog, compact_log
from namewake.streaming.targets import KeyedStoreTarget, MergeTarget, PlanTarget, UpsertFiles
from tests.helpers import CHANGES, SPEC, change_rows, fold, plan_df, plan_rows, sorted_rows

SCHEMA = CHANGES
ORD = T.StructType().add("pos", "long")
NAMES = ["SHOP_ID", "op_type", "SHOP_NAME", "pos"]


class Run:
    """A feed folder, a plan target and a log below one folder."""

    def __init__(self, spark, folder, rows, specs=(SPEC,)):
        self.spark, self.folder = spark, str(folder)
        self.target = PlanTarget.create(spark, f"{folder}/target", specs)
        self.target.append(plan_df(spark, rows))
        self.log = FileLog(f"{folder}/log")

    def arrive(self, changes):
        df = self.spark.createDataFrame(changes, CHANGES)
        df.coalesce(1).write.mode("append").parquet(f"{self.folder}/in")

    def feed(self, max_files=None):
        stream = file_stream(self.spark, f"{self.folder}/in", SCHEMA, max_files=max_files)
        return tag_feed(stream, SPEC, ["pos"])

    def go(self, target=None, checkpoint="checkpoint", **options):
        options = {"log": self.log} | options
        query = start(
            self.feed(options.pop("max_files", None)),
            target or self.target,
            f"{self.folder}/{checkpoint}",
            available_now=True,
            **options,
        )
        query.awaitTermination()
        return query

    def logged(self):
        return self.log.read(self.spark, ORD)


def remove(paths):
    for path in paths:
        path = Path(path.removeprefix("file://").removeprefix("file:"))
        shutil.rmtree(path) if path.is_dir() else path.unlink()


def pieces(rows, n):
    size = -(-len(rows) // n)
    return [rows[i : i + size] for i in range(0, len(rows), size)]


@pytest.mark.parametrize("batches", [1, 3, 10])
def test_any_number_of_batches_equals_the_row_loop(spark, tmp_path, batches):
    rng = random.Random(batches)
    plan, changes = plan_rows(150, 10, rng), change_rows(100, 10, rng)
    run = Run(spark, tmp_path, plan)
    for piece in pieces(changes, batches):
        run.arrive(piece)
    run.go(max_files=1)
    assert sorted_rows(run.target.read()) == fold(plan, changes)
    log = run.logged()
    assert log.select("batch_id").distinct().count() == batches
    want = sorted(json.dumps(dict(zip(NAMES, c))) for c in changes)
    got = sorted(json.dumps(json.loads(r["msg_value"])) for r in log.collect())
    assert got == want


def test_arrival_order_wins_over_the_order_column(spark, tmp_path):
    plan = plan_rows(30, 2, random.Random(1))
    run = Run(spark, tmp_path, plan)
    first, second = [(1, "U", "late number", 9)], [(1, "U", "early number", 2)]
    for piece in (first, second):
        run.arrive(piece)
        run.go()
    assert sorted_rows(run.target.read()) == fold(plan, first + second)


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    rng = random.Random(5)
    plan, changes = plan_rows(80, 6, rng), change_rows(60, 6, rng)
    run = Run(spark, tmp_path, plan)
    a, b = pieces(changes, 2)
    run.arrive(a)
    run.go()
    assert run.go().recentProgress == [] or run.logged().count() == len(a)
    run.arrive(b)
    # a new process opens the target anew
    run.target = PlanTarget(spark, run.target.path, [SPEC])
    run.go()
    assert sorted_rows(run.target.read()) == fold(plan, changes)
    assert run.logged().count() == len(changes)


class FailsOnce:
    """A target whose process dies before or after the names are committed."""

    def __init__(self, target, after):
        self.target, self.after, self.failed = target, after, False
        self.specs, self.rows = target.specs, target.rows

    def put_names(self, *args):
        if self.after:
            self.target.put_names(*args)
        if not self.failed:
            self.failed = True
            raise RuntimeError("lost")
        return self.after or self.target.put_names(*args)


@pytest.mark.parametrize("after", [False, True])
def test_failed_batch_is_replayed_without_traces(spark, tmp_path, after):
    rng = random.Random(7)
    plan, changes = plan_rows(80, 6, rng), change_rows(60, 6, rng)
    run = Run(spark, tmp_path, plan)
    run.arrive(changes)
    with pytest.raises(Exception, match="lost"):
        run.go(FailsOnce(run.target, after))
    run.target = PlanTarget(spark, run.target.path, [SPEC])
    run.go()
    assert sorted_rows(run.target.read()) == fold(plan, changes)
    assert run.logged().count() == len(changes)
    assert [c["kind"] for c in run.target.commits()] == ["rows", "names"]


def test_a_new_checkpoint_does_not_overwrite_the_log(spark, tmp_path):
    run = Run(spark, tmp_path, plan_rows(10, 2, random.Random(1)))
    run.arrive([(1, "U", "a", 0)])
    run.go()
    run.go(checkpoint="another")
    assert run.logged().count() == 2
    assert compact_log(run.logged()).count() == 1


def test_rows_that_arrive_later_are_left_alone(spark, tmp_path):
    rng = random.Random(3)
    plan, changes = plan_rows(90, 5, rng), change_rows(90, 5, rng)
    early, late = plan[:45], plan[45:]
    first, second = pieces(changes, 2)
    run = Run(spark, tmp_path, early)
    run.arrive(first)
    run.go()
    run.target.append(plan_df(spark, late))
    run.arrive(second)
    run.go()
    want = sorted(fold(early, changes) + fold(late, second))
    assert sorted_rows(run.target.read()) == want
    # the same before and after names are compacted and folded in
    run.target.compact_names()
    assert sorted_rows(run.target.read()) == want
    run.target.fold()
    assert sorted_rows(run.target.read()) == want
    run.arrive([(1, "U", "newest", 1000)])
    run.go()
    again = fold([dict(zip(plan[0], t)) for t in want], [(1, "U", "newest", 0)])
    assert sorted_rows(run.target.read()) == again
    # what is named obsolete can go, and a later batch finds its way
    kinds = {c["path"]: c["kind"] for c in run.target.commits()}
    gone = run.target.obsolete()
    assert sorted(kinds[p] for p in gone if p in kinds) == [
        "compacted", "names", "names", "rows", "rows",
    ]
    assert len(gone) == 5
    remove(gone)
    run.target = PlanTarget(spark, run.target.path, [SPEC])
    assert sorted_rows(run.target.read()) == again
    run.arrive([(2, "U", "last", 2000)])
    run.go()
    once_more = fold([dict(zip(plan[0], t)) for t in again], [(2, "U", "last", 0)])
    assert sorted_rows(run.target.read()) == once_more


def test_commits_are_read_in_bounded_time(spark, tmp_path, monkeypatch):
    """Segments of commits: many micro-batches, few files read, nothing lost."""
    monkeypatch.setattr(commits, "SEGMENT", 4)
    plan = plan_rows(40, 4, random.Random(2))
    run = Run(spark, tmp_path, plan)
    names = "entity string, key string, name string"
    changes = [(i % 4, "U", f"n{i}", i) for i in range(14)]
    for key, _, name, i in changes:
        run.target.put_names(spark.createDataFrame([("shop", str(key), name)], names), "q", i)
        if i % 6 == 5:
            run.target.compact_names()
    assert len(folders(spark, f"{run.target.path}/commits")) > 3
    again = PlanTarget(spark, run.target.path, [SPEC])
    assert len(again.commits()) < 10 and len(again.list._files) <= 4
    assert sorted_rows(again.read()) == fold(plan, changes)
    assert not again.put_names(spark.createDataFrame([("shop", "1", "again")], names), "q", 13)
    remove(again.obsolete())
    assert sorted_rows(PlanTarget(spark, run.target.path, [SPEC]).read()) == fold(plan, changes)


def test_fold_by_one_opener_keeps_the_names_of_all(spark, tmp_path):
    person = EntitySpec("person", key="P", name="P_NAME", fk="PERSON_ID")
    target = PlanTarget.create(spark, f"{tmp_path}/t", [SPEC, person])
    target.append(spark.createDataFrame([(1, "U", 1, 1)], "PLAN_ID int, op_type string, SHOP_ID bigint, PERSON_ID bigint"))
    names = "entity string, key string, name string"
    target.put_names(spark.createDataFrame([("shop", "1", "s"), ("person", "1", "p")], names), "q", 0)
    PlanTarget(spark, f"{tmp_path}/t", [SPEC]).fold()
    row = PlanTarget(spark, f"{tmp_path}/t", []).read().first()
    assert (row["SHOP_NAME"], row["P_NAME"]) == ("s", "p")
    with pytest.raises(ValueError, match="dimension"):
        target.put_names(spark.createDataFrame([("stranger", "1", "x")], names), "q", 1)
    assert sorted(c["kind"] for c in target.commits()) == ["full", "names", "rows"]


def test_fold_beside_the_writer_loses_nothing(spark, tmp_path):
    """Names committed between a fold's reading and its commit stay pending."""
    plan = plan_rows(40, 3, random.Random(2))
    run = Run(spark, tmp_path, plan)
    run.arrive([(1, "U", "a", 0)])
    run.go()
    folder = PlanTarget(spark, run.target.path, [SPEC])
    begun = folder.begin_fold()
    run.arrive([(2, "U", "b", 1)])
    run.go()
    assert folder.finish(begun)
    assert sorted_rows(run.target.read()) == fold(plan, [(1, "U", "a", 0), (2, "U", "b", 1)])


def test_a_batch_without_updates_commits_nothing(spark, tmp_path):
    plan = plan_rows(10, 2, random.Random(2))
    run = Run(spark, tmp_path, plan)
    run.arrive([(1, "I", "a", 0), (None, "U", "b", 1)])
    run.go()
    assert [c["kind"] for c in run.target.commits()] == ["rows"]
    assert sorted_rows(run.target.read()) == fold(plan, [])
    assert run.logged().count() == 2


def test_adopted_files_are_not_copied_or_dropped(spark, tmp_path):
    plan = plan_rows(20, 3, random.Random(2))
    plan_df(spark, plan).write.parquet(f"{tmp_path}/existing")
    target = PlanTarget.create(spark, f"{tmp_path}/target", [SPEC])
    target.adopt(f"{tmp_path}/existing")
    assert sorted_rows(target.read()) == fold(plan, [])
    target.fold()
    assert sorted_rows(target.read()) == fold(plan, [])
    assert target.obsolete() == []


def test_many_small_appends_are_one_read(spark, tmp_path):
    plan = plan_rows(12, 2, random.Random(2))
    target = PlanTarget.create(spark, f"{tmp_path}/target", [SPEC])
    for row in plan[:6]:
        target.append(plan_df(spark, [row]))
    target.put_names(spark.createDataFrame([("shop", "1", "a")], "entity string, key string, name string"), "q", 0)
    for row in plan[6:]:
        target.append(plan_df(spark, [row]).drop("SHOP_NAME"))
    plain = target.rows()._jdf.queryExecution().executedPlan().toString()
    assert plain.count("FileScan") == 2
    late = [r | {"SHOP_NAME": None} for r in plan[6:]]
    want = sorted(fold(plan[:6], [(1, "U", "a", 0)]) + fold(late, []))
    assert sorted_rows(target.read()) == want


def test_only_wanted_names_are_joined(spark, tmp_path):
    run = Run(spark, tmp_path, plan_rows(20, 3, random.Random(2)))
    run.arrive([(1, "U", "a", 0)])
    run.go()
    plain = run.target.read(["PLAN_ID", "NOTE"])
    assert "Join" not in plain._jdf.queryExecution().executedPlan().toString()
    assert plain.columns == ["PLAN_ID", "NOTE"]
    assert "SHOP_NAME" in run.target.rows().columns


def test_target_without_broadcast(spark, tmp_path):
    rng = random.Random(21)
    plan, changes = plan_rows(200, 2, rng), change_rows(50, 2, rng)
    run = Run(spark, tmp_path, plan)
    run.arrive(changes)
    run.go()
    spark.conf.set(BROADCAST_BYTES, "0")
    try:
        assert sorted_rows(run.target.read()) == fold(plan, changes)
    finally:
        spark.conf.unset(BROADCAST_BYTES)


def test_progress_counts_and_report(spark, tmp_path):
    run = Run(spark, tmp_path, plan_rows(30, 2, random.Random(4)))
    run.arrive([(0, "U", "a", 0), (77, "U", "b", 1), (78, "I", "c", 2), (None, "U", "d", 3)])
    query = run.go(report=f"{tmp_path}/report")
    seen = query.lastProgress.observedMetrics["changes"]
    assert (seen.changes, seen.updates, seen.without_key) == (4, 3, 1)
    report = spark.read.parquet(f"{tmp_path}/report")
    assert [(r["entity"], r["key"], r["name"]) for r in report.collect()] == [("shop", "77", "b")]


def test_report_of_keys_beyond_the_plans_type(spark, tmp_path):
    target = PlanTarget.create(spark, f"{tmp_path}/target", [SPEC])
    target.append(spark.createDataFrame([(1, "U", 5)], "PLAN_ID int, op_type string, SHOP_ID int"))
    names = spark.createDataFrame(
        [("shop", "5", "a"), ("shop", "9999999999", "b"), ("other", "1", "c")],
        "entity string, key string, name string",
    )
    assert [r["key"] for r in job.unmatched_report(names, target).collect()] == ["9999999999"]
    target.put_names(names.filter("entity = 'shop'"), "q", 0)
    assert [r["SHOP_NAME"] for r in target.read().collect()] == ["a"]


def test_cost_per_batch_does_not_grow_with_updates(spark, tmp_path):
    """A micro-batch takes the same number of Spark jobs for 5 and for 500 updates."""
    jobs = []
    for n in (5, 500):
        run = Run(spark, tmp_path / str(n), plan_rows(20, 3, random.Random(4)))
        run.arrive([(i, "U", f"n{i}", i) for i in range(n)])
        query = run.go()
        tracker = spark.sparkContext.statusTracker()
        jobs.append(len(tracker.getJobIdsForGroup(str(query.runId))))
    assert jobs[0] == jobs[1] > 0


def test_two_dimensions_in_one_query(spark, tmp_path):
    person = EntitySpec("person", key="P", name="P_NAME", fk="PERSON_ID")
    plan = [(1, "U", 1, 1), (2, "U", 1, 2), (3, "D", 2, 1)]
    target = PlanTarget.create(spark, f"{tmp_path}/target", [SPEC, person])
    target.append(spark.createDataFrame(plan, "PLAN_ID int, op_type string, SHOP_ID bigint, PERSON_ID bigint"))
    spark.createDataFrame([(1, "U", "s", 0)], CHANGES).write.parquet(f"{tmp_path}/shops")
    people = "P bigint, op_type string, P_NAME string, pos bigint"
    spark.createDataFrame([(1, "U", "p", 0), (2, "I", "q", 1)], people).write.parquet(f"{tmp_path}/people")
    feed = union_feeds(
        [
            tag_feed(file_stream(spark, f"{tmp_path}/shops", SCHEMA), SPEC, ["pos"]),
            tag_feed(file_stream(spark, f"{tmp_path}/people", people), person, ["pos"]),
        ]
    )
    assert tuple(feed.columns) == FEED_COLUMNS
    start(feed, target, f"{tmp_path}/cp", available_now=True).awaitTermination()
    got = {r["PLAN_ID"]: (r["SHOP_NAME"], r["P_NAME"]) for r in target.read().collect()}
    assert got == {1: ("s", "p"), 2: ("s", None), 3: (None, "p")}


def test_timed_trigger_runs_until_stopped(spark, tmp_path):
    run = Run(spark, tmp_path, plan_rows(10, 2, random.Random(1)))
    run.arrive([(1, "U", "a", 0)])
    query = start(run.feed(), run.target, f"{tmp_path}/cp", interval="1 second")
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert job.BATCH_INTERVAL == "10 seconds"
    assert "a" in {r["SHOP_NAME"] for r in run.target.read().collect()}


def test_json_log(spark, tmp_path):
    run = Run(spark, tmp_path, plan_rows(10, 2, random.Random(1)))
    run.log = FileLog(f"{tmp_path}/json-log", "json")
    run.arrive([(1, "U", None, 0), (2, "D", "b", 1)])
    run.go()
    values = sorted(r["msg_value"] for r in run.logged().collect())
    assert [json.loads(v)["SHOP_NAME"] for v in values] == [None, "b"]


def test_log_compaction_with_tombstones(spark):
    schema = "entity string, msg_key string, seq bigint, ord struct<pos:bigint>, msg_value string"
    rows = [
        ("a", "1", 0, (1,), "x"),
        ("a", "1", 0, (2,), "y"),
        ("a", "2", 0, (9,), "z"),
        ("a", "2", 1, (1,), None),
        ("b", "2", 0, (1,), "w"),
    ]
    kept = compact_log(spark.createDataFrame(rows, schema))
    assert sorted((r["entity"], r["msg_key"], r["msg_value"]) for r in kept.collect()) == [
        ("a", "1", "y"),
        ("b", "2", "w"),
    ]


def test_streaming_compaction_equals_batch(spark, tmp_path):
    from namewake.operators.changes import compact

    changes = change_rows(80, 6, random.Random(9))
    for piece in pieces(changes, 4):
        spark.createDataFrame(piece, CHANGES).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = file_stream(spark, f"{tmp_path}/in", SCHEMA, max_files=1)
    query = (
        compact(stream, ["SHOP_ID"], ["pos"])
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName("compacted_stream")
        .option("checkpointLocation", f"{tmp_path}/cp")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    batch = compact(spark.read.parquet(f"{tmp_path}/in"), ["SHOP_ID"], ["pos"])
    assert sorted(map(str, spark.table("compacted_stream").collect())) == sorted(map(str, batch.collect()))


def test_topic_log_messages(spark):
    batch = spark.createDataFrame([("shop", "1", "v"), ("person", "2", None)], "entity string, msg_key string, msg_value string")
    log = TopicLog("host:1", {"shop": "shops", "person": "people"})
    got = sorted(tuple(r) for r in log.messages(batch).collect())
    assert got == [("people", "2", None), ("shops", "1", "v")]


def test_keyed_store_refuses_plain_files(spark, tmp_path):
    with pytest.raises(ValueError, match="upsert"):
        KeyedStoreTarget(spark, [SPEC], "parquet", f"{tmp_path}/store")


@pytest.mark.parametrize("batches", [1, 4])
def test_upsert_files_equal_the_row_loop(spark, tmp_path, batches):
    rng = random.Random(batches)
    plan, changes = plan_rows(80, 8, rng), change_rows(80, 8, rng)
    run = Run(spark, tmp_path, [])
    plan_df(spark, plan).write.parquet(f"{tmp_path}/plan")
    target = UpsertFiles(spark, [SPEC], f"{tmp_path}/plan", f"{tmp_path}/partial")
    assert sorted_rows(target.rows()) == fold(plan, [])
    for piece in pieces(changes, batches):
        run.arrive(piece)
    run.go(target, max_files=1)
    assert sorted_rows(target.rows()) == fold(plan, changes)
    hit = {k for k, op, _, _ in changes if op == "U" and k is not None}
    partial = target.partial_rows(SPEC).collect()
    assert sorted(r["PLAN_ID"] for r in partial) == sorted(r["PLAN_ID"] for r in plan if r["SHOP_ID"] in hit)


def test_a_log_of_two_queries_is_in_order_of_arrival(spark, tmp_path):
    run = Run(spark, tmp_path, plan_rows(10, 2, random.Random(1)))
    for i, name in enumerate(("first", "second", "OLD")):
        run.arrive([(1, "U", name, 9 - i)])
        run.go()
    Path(run.folder, "in").rename(Path(run.folder, "in-before"))
    run.arrive([(1, "U", "NEW", 0)])
    run.log = FileLog(f"{tmp_path}/log")  # another process
    run.go(checkpoint="another")
    assert [json.loads(r["msg_value"])["SHOP_NAME"] for r in compact_log(run.logged()).collect()] == ["NEW"]
    before = sorted(map(str, run.logged().collect()))
    run.log.merge_files(spark)
    assert sorted(map(str, run.logged().collect())) == before
    remove(run.log.obsolete(spark))
    assert sorted(map(str, FileLog(f"{tmp_path}/log").read(spark, ORD).collect())) == before
    run.arrive([(1, "U", "NEWEST", 0)])
    run.go(checkpoint="another")
    assert [json.loads(r["msg_value"])["SHOP_NAME"] for r in compact_log(run.logged()).collect()] == ["NEWEST"]


def test_raw_lines_are_logged_unchanged_and_broken_ones_rejected(spark, tmp_path):
    spec = EntitySpec("shop", key="SHOP_ID", name="SHOP_NAME")
    lines = [
        '{"SHOP_ID":1, "op_type":"U","SHOP_NAME":"a","EXTRA":"keep me"}', "not json at all", "",
        '{"SHOP_ID":"text","op_type":"U","SHOP_NAME":"b"}', '{"table":"t","SHOP_ID":2,"op_type":"I"}',
    ]
    Path(tmp_path, "in").mkdir()
    Path(tmp_path, "in", "a.json").write_text("\n".join(lines) + "\n")
    feed = tag_feed(raw_change_stream(spark, spec, f"{tmp_path}/in"), spec, ["pos"])
    target = PlanTarget.create(spark, f"{tmp_path}/target", [spec])
    log = FileLog(f"{tmp_path}/log")
    start(feed, target, f"{tmp_path}/cp", log=log, rejects=f"{tmp_path}/rejects", available_now=True).awaitTermination()
    logged = log.read(spark, T.StructType().add("pos", "string")).collect()
    assert sorted(r["msg_value"] for r in logged) == sorted(lines)
    assert sorted((r["msg_key"] or "", r["msg_value"]) for r in logged)[-2:] == [("1", lines[0]), ("2", lines[4])]
    rejected = spark.read.parquet(f"{tmp_path}/rejects").collect()
    assert sorted(r["msg_value"] for r in rejected) == sorted(lines[1:4])
    assert [c["kind"] for c in target.commits()] == ["names"]


def test_no_micro_batch_is_kept_by_executors(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrame

    def refuse(*_):
        raise AssertionError("kept")

    monkeypatch.setattr(DataFrame, "persist", refuse)
    run = Run(spark, tmp_path, plan_rows(10, 2, random.Random(1)))
    run.arrive([(1, "U", "a", 0)])
    run.go()
    assert run.logged().count() == 1


def test_report_scans_the_plan_once_for_all_entities(spark, tmp_path):
    specs = list(ENTITIES.values())
    plan = spark.range(50).select(
        F.col("id").alias("PLAN_ID"), F.lit("U").alias("op_type"), *((F.col("id") % 9).alias(s.fk) for s in specs)
    )
    target = PlanTarget.create(spark, f"{tmp_path}/t", specs)
    target.append(plan)
    names = [(s.entity, str(k), "n") for s in specs for k in (3, 8, 9, 70)]
    df = spark.createDataFrame(names, "entity string, key string, name string")
    report = job.unmatched_report(df, target)
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert sorted((r["entity"], r["key"]) for r in report.collect()) == sorted((e, k) for e, k, _ in names if int(k) > 8)


def test_print_changes_shows_every_row(spark, tmp_path, monkeypatch):
    """The text goes to the JVM's output; the query tells where its rows went."""
    from pyspark.sql.streaming.readwriter import DataStreamWriter

    given, option = {}, DataStreamWriter.option
    monkeypatch.setattr(DataStreamWriter, "option", lambda self, k, v: given.update({k: v}) or option(self, k, v))
    run = Run(spark, tmp_path, plan_rows(2, 1, random.Random(1)))
    run.arrive([(1, "U", "a", 0), (2, "I", "b", 1)])
    query = job.print_changes(run.feed(), rows=7)
    query.processAllAvailable()
    query.stop()
    shown = [p for p in query.recentProgress if p.numInputRows]
    assert [(p.numInputRows, p.sink.numOutputRows) for p in shown] == [(2, 2)]
    assert "Console" in shown[0].sink.description and given == {"numRows": 7, "truncate": False}


def test_merge_target_reaches_merge_into(spark, tmp_path):
    """Parquet tables do not support MERGE INTO, and say so."""
    spark.createDataFrame([(1, 1, "x")], "PLAN_ID int, SHOP_ID bigint, SHOP_NAME string").write.mode(
        "overwrite"
    ).option("path", f"{tmp_path}/t").saveAsTable("plan_merge")
    names = spark.createDataFrame([("shop", "1", "a")], "entity string, key string, name string")
    with pytest.raises(Exception, match="MERGE"):
        MergeTarget(spark, [SPEC], "plan_merge").put_names(names, "q", 0)


def test_last_names_over_entities(spark):
    spec = ENTITIES["division"]
    rows = [{"op_type": "U", "pos": str(i), spec.key: i % 3, spec.name: f"n{i}"} for i in range(9)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], f"op_type string, pos string, {spec.key} bigint, {spec.name} string")
    got = last_names(tag_feed(df, spec, ["pos"])).collect()
    assert sorted(tuple(r) for r in got) == [("division", str(k), f"n{6 + k}") for k in range(3)]
    direct = latest_updates(df, [spec.key], ["pos"]).select(F.col(spec.name))
    assert sorted(r[0] for r in direct.collect()) == ["n6", "n7", "n8"]
