"""Several processes on one list of commits, one plan table, one log."""

import json
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from namewake.entities import EntitySpec
from namewake.operators.keysets import TIER, to_merge
from namewake.operators.summaries import key_summaries, may_hold
from namewake.sources.logs import log_stream
from namewake.streaming import commits, job, logs
from namewake.streaming.commits import CommitList, put_new, read_text
from namewake.streaming.logs import FileLog, TargetLog, compact_log
from namewake.streaming.targets import PlanTarget
from tests.helpers import SPEC, fold, plan_df, plan_rows, plan_text, sorted_rows
from tests.test_streaming import ORD, Run, remove

NAMES = "entity string, key string, name string"


def every(entries):
    return entries


def listed(spark, path):
    """Numbers and tags as a new process reads them."""
    return [(e["number"], e["tag"]) for e in CommitList(spark, path, every).read()]


def test_a_file_is_put_once_and_whole(spark, tmp_path):
    path = f"{tmp_path}/a b/x.json"
    assert put_new(spark, path, "é first") and not put_new(spark, path, "second")
    assert read_text(spark, path) == "é first"
    assert [p.name for p in (tmp_path / "a b").iterdir()] == ["x.json"]


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_whoever_is_overtaken_reads_anew(spark, tmp_path, monkeypatch, size):
    """Before every entry of one process, another adds up to three: none is lost or repeated."""
    monkeypatch.setattr(commits, "SEGMENT", size)
    one, other = (CommitList(spark, f"{tmp_path}/c", every) for _ in range(2))
    told = []
    for n in range(12):
        between, seen = list(range(n % 4)), []

        def make(known):
            seen.append([e["tag"] for e in known])
            if between:
                other.add(lambda _, tag=f"b{n}.{between.pop()}": told.append(tag) or {"tag": tag})
            return {"tag": f"a{n}"}

        assert one.add(make)["tag"] == f"a{n}"
        told.append(f"a{n}")
        assert len(seen) == n % 4 + 1 and seen[-1] == told[:-1]
    assert listed(spark, f"{tmp_path}/c") == list(enumerate(told))
    assert [e["tag"] for e in one.read_as_of(4)] == told[:5]


def test_many_threads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "SEGMENT", 7)

    def work(name):
        own = CommitList(spark, f"{tmp_path}/c", every)
        return [own.add(lambda _, i=i: {"tag": f"{name}{i}"})["number"] for i in range(15)]

    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(work, "abcd"))
    assert sorted(n for own in numbers for n in own) == list(range(60))
    stored = listed(spark, f"{tmp_path}/c")
    assert [n for n, _ in stored] == list(range(60))
    assert all([t for _, t in stored if t[0] == name] == [f"{name}{i}" for i in range(15)] for name in "abcd")


def test_an_entry_that_is_no_longer_wanted_is_not_added(spark, tmp_path):
    one, other = (CommitList(spark, f"{tmp_path}/c", every) for _ in range(2))
    once = lambda known: None if known else {"tag": "x"}
    assert one.add(once) and other.add(once) is None


class Table:
    """A target opened by several processes, and the same table as a row loop keeps it."""

    def __init__(self, spark, path, **settings):
        self.spark, self.path, self.rows, self.names = spark, str(path), [], 0
        PlanTarget.create(spark, self.path, [SPEC], **settings)
        self.begun = {}

    def open(self):
        return PlanTarget(self.spark, self.path, [SPEC])

    def append(self, rng):
        new = [r | {"PLAN_ID": len(self.rows) + i} for i, r in enumerate(plan_rows(8, 4, rng))]
        self.open().append(plan_df(self.spark, new))
        self.rows += new

    def write(self, rng):
        changes = [(rng.randrange(4), "U", rng.choice([None, f"n{self.names}"]), 0)]
        self.put(changes)

    def put(self, changes):
        names = [("shop", str(k), n) for k, _, n, _ in changes]
        assert self.open().put_names(self.spark.createDataFrame(names, NAMES), "q", self.names)
        self.names += 1
        columns = list(self.rows[0])
        self.rows = [dict(zip(columns, t)) for t in fold(self.rows, changes)]

    def begin(self, what):
        process = self.open()
        self.begun[what] = process, getattr(process, f"begin_{what}")()

    def finish(self, what):
        process, entry = self.begun.pop(what, (None, None))
        if entry:
            process.finish(entry)

    def clear(self):
        if not self.begun:  # those who read the files are done
            remove(p for p in self.open().obsolete())

    def check(self):
        assert sorted_rows(self.open().read()) == fold(self.rows, [])


STEPS = [
    lambda t, rng: t.write(rng),
    lambda t, rng: t.write(rng),
    lambda t, rng: t.append(rng),
    lambda t, rng: t.begin("fold"),
    lambda t, rng: t.finish("fold"),
    lambda t, rng: t.begin("compaction"),
    lambda t, rng: t.finish("compaction"),
    lambda t, rng: t.clear(),
]


@pytest.mark.parametrize("buckets", [None, 4])
@pytest.mark.parametrize("seed", range(3))
def test_upkeep_beside_the_writer_equals_the_row_loop(spark, tmp_path, monkeypatch, seed, buckets):
    """Folds, compactions and clearing begin and end at any step; segments of three."""
    monkeypatch.setattr(commits, "SEGMENT", 3)
    rng = random.Random(seed)
    table = Table(spark, tmp_path / "t", buckets=buckets)
    table.append(rng)
    for _ in range(14):
        rng.choice(STEPS)(table, rng)
    table.check()
    for what in list(table.begun):
        table.finish(what)
    table.check()
    table.clear()
    table.check()


def test_a_fold_across_a_segments_end_loses_nothing(spark, tmp_path, monkeypatch):
    """The case of a writer that begins a segment while a fold is under way, at every step."""
    monkeypatch.setattr(commits, "SEGMENT", 3)
    for before in range(3):
        for within in range(3):
            table = Table(spark, tmp_path / f"t{before}{within}")
            table.append(random.Random(1))
            for i in range(before):
                table.put([(i, "U", f"before{i}", 0)])
            table.begin("fold")
            for i in range(within):
                table.put([(i, "U", f"within{i}", 0)])
            table.finish("fold")
            table.clear()
            table.put([(3, "U", "after", 0)])
            table.check()


def test_of_two_folds_the_one_that_sums_up_less_is_dropped(spark, tmp_path):
    table = Table(spark, tmp_path / "t")
    table.append(random.Random(1))
    one, other = table.open(), table.open()
    slow = one.begin_fold()
    table.put([(1, "U", "a", 0)])
    assert other.fold() and not one.finish(slow)
    table.check()
    assert slow["path"] not in table.open().list.read()[-1]["path"]


def test_writers_of_several_dimensions_at_once(spark, tmp_path):
    """Eight jobs of their own write one table, as threads here."""
    specs = [EntitySpec(f"e{i}", key=f"K{i}", name=f"N{i}", fk=f"F{i}") for i in range(8)]
    target = PlanTarget.create(spark, f"{tmp_path}/t", specs)
    keys = ", ".join(f"F{i} bigint" for i in range(8))
    target.append(spark.createDataFrame([(1, "U", *range(8)), (2, "U", *[9] * 8)], f"PLAN_ID int, op_type string, {keys}"))

    def work(i):
        own = PlanTarget(spark, f"{tmp_path}/t", [specs[i]])
        for batch in range(3):
            own.put_names(spark.createDataFrame([(f"e{i}", str(i), f"name{batch}")], NAMES), f"q{i}", batch)

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(work, range(8)))
    got = {r["PLAN_ID"]: [r[f"N{i}"] for i in range(8)] for r in target.read().collect()}
    assert got == {1: ["name2"] * 8, 2: [None] * 8}
    assert len([c for c in target.commits() if c["kind"] == "names"]) == 24


def test_merging_a_log_beside_its_writer_loses_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "SEGMENT", 3)
    log, n = FileLog(f"{tmp_path}/log"), 0

    def write(count):
        nonlocal n
        for _ in range(count):
            row = [("shop", "1", f"m{n}", (n,))]
            FileLog(f"{tmp_path}/log").write(spark.createDataFrame(row, "entity string, msg_key string, msg_value string, ord struct<pos:bigint>"), "q", n)
            n += 1

    for before in range(4):
        write(before)
        begun = log.begin_merge(spark)
        write(before % 3)
        log.finish_merge(spark, begun)
        remove(log.obsolete(spark))
        stored = sorted((r["seq"], r["msg_value"]) for r in FileLog(f"{tmp_path}/log").read(spark, ORD).collect())
        assert [m for _, m in stored] == [f"m{i}" for i in range(n)]


# log and target in one commit


def test_log_and_target_appear_together(spark, tmp_path):
    """A failure between the two leaves neither; one commit for each micro-batch."""
    plan = plan_rows(20, 3, random.Random(2))
    run = Run(spark, tmp_path, plan)
    run.log = TargetLog(run.target)
    changes = [(1, "U", "a", 0), (2, "I", "b", 1)]
    run.arrive(changes)

    class Dies(PlanTarget):
        def put_names(self, *args, **options):
            raise RuntimeError("lost")

    dying = Dies(spark, run.target.path, [SPEC])
    with pytest.raises(Exception, match="lost"):
        run.go(dying, log=TargetLog(dying))
    assert run.logged().count() == 0 and sorted_rows(run.target.read()) == fold(plan, [])
    run.go()
    assert run.logged().count() == 2 and sorted_rows(run.target.read()) == fold(plan, changes)
    run.arrive([(5, "I", "only logged", 2)])
    run.go()
    assert [c["kind"] for c in run.target.commits()] == ["rows", "names", "batch"]
    assert run.logged().count() == 3
    run.log.merge_files(spark)
    assert run.logged().count() == 3
    remove(run.target.obsolete())
    assert run.logged().count() == 3 and sorted_rows(run.target.read()) == fold(plan, changes)
    newest = {r["msg_key"]: json.loads(r["msg_value"])["SHOP_NAME"] for r in compact_log(run.logged()).collect()}
    assert newest == {"1": "a", "2": "b", "5": "only logged"}


def test_a_log_is_read_as_a_stream_once_each(spark, tmp_path, monkeypatch):
    """New micro-batches, merges and clearing between runs; a start position."""
    monkeypatch.setattr(commits, "SEGMENT", 3)
    schema = "entity string, msg_key string, msg_value string, ord struct<pos:bigint>"
    target = PlanTarget.create(spark, f"{tmp_path}/t", [SPEC])
    for log in (FileLog(f"{tmp_path}/log"), TargetLog(target)):
        name, n = type(log).__name__, 0

        def write(count):
            nonlocal n
            for _ in range(count):
                batch = spark.createDataFrame([("shop", "1", f"m{n}", (n,)), ("shop", None, None, None)], schema)
                log.write(batch, "q", n)
                if isinstance(log, TargetLog):
                    target.put_names(spark.createDataFrame([], NAMES), "q", n, log=log.stored("q", n))
                n += 1

        def run(start, to):
            stream = log_stream(spark, log, ORD, starting_number=start)
            query = stream.writeStream.format("parquet").option("path", to).option("checkpointLocation", f"{to}-cp")
            query.trigger(availableNow=True).start().awaitTermination()
            rows = [(r["seq"], r["msg_value"]) for r in spark.read.schema(stream.schema).parquet(to).collect()]
            return sorted((s, v) for s, v in rows if v), sum(v is None for _, v in rows)

        write(2)
        assert run(1, f"{tmp_path}/{name}1") == ([(1, "m1")], 1)
        for step in range(3):
            write(step + 1)
            assert run(1, f"{tmp_path}/{name}1")[1] == n - 1
            log.merge_files(spark)
            remove(log.obsolete(spark))
        write(1)
        told, empty = run(1, f"{tmp_path}/{name}1")
        assert [v for _, v in told] == [f"m{i}" for i in range(1, n)] and empty == n - 1
        assert [v for _, v in run(0, f"{tmp_path}/{name}0")[0]] == [f"m{i}" for i in range(n)]
    with pytest.raises(ValueError, match="json"):
        log_stream(spark, FileLog(f"{tmp_path}/j", "json"), ORD)


# buckets, keys, summaries


def bucketed(spark, path, rows=400, keys=60, buckets=16):
    table = Table(spark, path, buckets=buckets)
    rng = random.Random(5)
    table.rows = [r | {"PLAN_ID": i} for i, r in enumerate(plan_rows(rows, keys, rng))]
    table.open().append(plan_df(spark, table.rows))
    assert table.open().fold()
    return table


def test_one_keys_update_rewrites_only_its_buckets(spark, tmp_path):
    table = bucketed(spark, tmp_path / "t")
    table.check()
    first = table.open().commits()[-1]
    assert len(first["rewritten"]) == 16
    held = table.open()._bucketed(plan_df(spark, table.rows).select("*", F.struct(F.lit("").alias("file_path")).alias("_metadata")))
    want = sorted({r["namewake_bucket"] for r in held.filter("SHOP_ID = 7").collect()})
    assert 0 < len(want) < 16
    table.put([(7, "U", "seven", 0)])
    before = table.open()._manifest(first["path"])
    assert table.open().fold()
    last = table.open().commits()[-1]
    now = table.open()._manifest(last["path"])
    assert last["rewritten"] == want == sorted(int(b) for b in now if now[b] != before[b])
    table.check()
    table.put([(999, "U", "nobody's", 0)])
    assert table.open().fold() and table.open().commits()[-1]["rewritten"] == []
    table.check()
    remove(table.open().obsolete())
    table.check()


def test_clearing_again_and_again(spark, tmp_path, monkeypatch):
    """What is cleared away is not asked for again, nor when a segment begins; nor what comes meanwhile."""
    monkeypatch.setattr(commits, "SEGMENT", 100)
    table = bucketed(spark, tmp_path / "t", rows=60, keys=5, buckets=2)
    for i in range(3):
        table.put([(i, "U", f"n{i}", 0)])
        assert table.open().fold()
        remove(table.open().obsolete())
    assert table.open().obsolete() == []
    table.check()
    target = table.open()
    target._live(target.commits())  # as at the beginning of a segment
    everything = target.list.everything
    target.list.everything = lambda: (everything(), table.put([(4, "U", "meanwhile", 0)]))[0]
    assert target.obsolete() == []
    table.check()


def test_a_lookup_reads_the_files_that_may_hold_the_key(spark, tmp_path):
    table = bucketed(spark, tmp_path / "t")
    table.put([(7, "U", "seven", 0)])
    target = table.open()
    every_file = target.rows().inputFiles()
    for key in (0, 7, 59, 60, 10**9):
        got = target.lookup("SHOP_ID", key)
        want = [t for t in fold(table.rows, []) if t[2] == key]
        assert sorted_rows(got) == want
        assert len(got.inputFiles()) < len(every_file)
    late = [{"PLAN_ID": 5000, "op_type": "U", "SHOP_ID": 10**9, "SHOP_NAME": "x", "NOTE": "n"}]
    target.append(plan_df(spark, late))
    assert [t[0] for t in sorted_rows(target.lookup("SHOP_ID", 10**9))] == [5000]


def test_summaries_never_miss_a_key(spark):
    """Also when every bit of the filter is set, and for texts, negative numbers and odd names."""
    rows = [(f"f{i % 3}", i * 37 - 5000, f"k{i % 11}" if i % 3 else None) for i in range(30_000)]
    summaries = key_summaries(spark.createDataFrame(rows, "file string, number bigint, word string"), ["number", "word"])
    full = summaries.filter("fk = 'number'").select(F.aggregate(F.map_values("bits"), F.lit(0), lambda s, w: s + F.bit_count(w)))
    assert max(r[0] for r in full.collect()) > 0.4 * 65_536
    for i in range(0, 30_000, 2_999):
        f, number, word = rows[i]
        assert f in {r["file"] for r in may_hold(summaries, "number", number).collect()}
        assert word is None or f in {r["file"] for r in may_hold(summaries, "word", word).collect()}
    assert may_hold(summaries, "word", "zzz").count() == may_hold(summaries, "number", -10**9).count() == 0
    assert summaries.filter("fk = 'word'").count() == 2


def test_summaries_hold_no_rows_of_a_task(spark):
    """Neither numbers nor texts are sorted or made distinct; texts keep their range."""
    rows = [(f"f{i % 3}", i, f"k{i:03}") for i in range(300)]
    df = spark.createDataFrame(rows, "file string, number bigint, word string")
    told = key_summaries(df, ["number", "word"])
    assert "SortAggregate" not in plan_text(told)
    assert plan_text(key_summaries(df, ["number"])).count("Exchange hashpartitioning") == 2
    ends = {(r["file"], r["fk"]): (r["low"], r["high"], r["low_text"], r["high_text"]) for r in told.collect()}
    assert ends["f1", "number"][:2] == (1, 298) and ends["f1", "word"] == (None, None, "k001", "k298")


def test_merged_files_are_of_bounded_size(spark, tmp_path, monkeypatch):
    """A task that merges reads so many bytes of the log, not a share of the whole."""
    schema, log = "entity string, msg_key string, msg_value string, ord struct<pos:bigint>", FileLog(f"{tmp_path}/log")
    for n in range(3):
        batch = spark.range(4000).select(F.lit("shop").alias("entity"), F.col("id").cast("string").alias("msg_key"),
                                         F.sha2(F.col("id").cast("string"), 256).alias("msg_value"), F.struct(F.col("id").alias("pos")).alias("ord"))
        log.write(spark.createDataFrame(batch.rdd, schema).repartition(4), "q", n)
    size = commits.stored_bytes(spark, [p for p, _ in log._parts(log._commits(spark).read())])
    monkeypatch.setattr(logs, "MERGED_BYTES", size // 3)
    spark.conf.set("spark.sql.files.maxPartitionBytes", size // 12)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        entry = log.begin_merge(spark)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    merged = spark.read.parquet(entry["path"])
    assert merged.count() == 12_000 and len(merged.inputFiles()) in (3, 4)
    monkeypatch.setattr(logs, "MERGED_BYTES", 64 << 20)
    assert len(spark.read.parquet(log.begin_merge(spark)["path"]).inputFiles()) == 1


def test_the_report_reads_keys_and_no_plan_file(spark, tmp_path):
    table = bucketed(spark, tmp_path / "t")
    table.append(random.Random(9))
    target = table.open()
    names = spark.createDataFrame([("shop", "7", "a"), ("shop", "0012", "b"), ("shop", "999", "c"), ("x", "1", "d")], NAMES)
    report = job.unmatched_report(names, target)
    assert sorted((r["key"], r["name"]) for r in report.collect()) == [("999", "c")]
    assert "/keys/" in "".join(report.inputFiles()) and "/buckets/" not in "".join(report.inputFiles())
    plain = PlanTarget.create(spark, f"{tmp_path}/plain", [SPEC])
    plain.append(plan_df(spark, table.rows))
    assert sorted(map(tuple, job.unmatched_report(names, plain).collect())) == sorted(map(tuple, report.collect()))


def test_key_runs_are_merged_by_size(spark, tmp_path):
    assert to_merge([["a", 10], ["b", 11], ["c", 12]]) == []
    runs = [["a", 10], ["big", 5000], ["b", 11], ["c", 12], ["d", 15]]
    assert len(to_merge(runs)) == TIER and ["big", 5000] not in to_merge(runs)
    table = Table(spark, tmp_path / "t", index=True)
    rng = random.Random(1)
    for _ in range(2 * TIER):  # of two tiers at most, so one is full
        table.append(rng)
    target = table.open()
    before = {(r["entity"], r["key"]) for r in target.known_keys().collect()}
    assert target.merge_keys() and len(target._key_runs(target.commits())) < 2 * TIER
    table.append(rng)
    remove(table.open().obsolete())
    assert before <= {(r["entity"], r["key"]) for r in table.open().known_keys().collect()}
    table.check()


# earlier states


def test_states_as_of_a_commit(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "SEGMENT", 3)
    table, states, rng = Table(spark, tmp_path / "t", buckets=4), [], random.Random(3)
    table.append(rng)
    for step in range(9):
        states.append((table.open().commits()[-1]["number"], fold(table.rows, [])))
        table.open().fold() if step % 4 == 3 else table.open().compact_names() if step % 4 == 2 else table.write(rng)
    for number, want in states:
        assert sorted_rows(table.open().read(as_of=number)) == want
    keep = states[4][0]
    remove(table.open().obsolete(since=keep))
    for number, want in states[4:]:
        assert sorted_rows(table.open().read(as_of=number)) == want
    table.check()
