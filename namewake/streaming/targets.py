"""Plan tables that take name updates."""

from __future__ import annotations

import dataclasses
import json
import uuid
from collections import defaultdict
from collections.abc import Iterable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namewake.entities import EntitySpec
from namewake.operators.changes import latest_per_key
from namewake.operators.keysets import keys_of, read_runs, to_merge, write_run
from namewake.operators.propagate import key_lookup, matched_rows, merge_names
from namewake.operators.summaries import SCHEMA as SUMMARY_SCHEMA
from namewake.operators.summaries import is_whole_number, key_summaries, may_hold
from namewake.scratch import Size, kept, row_bytes, settle
from namewake.sources.files import table
from namewake.streaming.commits import (
    CommitList,
    Entry,
    at,
    existing,
    files,
    folders,
    last_of,
    latest_of_queries,
    put_new,
    read_text,
    text_if_there,
)

_SEQ, _NAMES_SEQ, _FILE, _BUCKET = "__seq", "__names_seq", "__file", "namewake_bucket"

#: A folder of data is named by this column and a number of its own.
ID = "namewake_id"

_NAMES = "entity string, key string, name string"

#: Summaries in more places than this are put together at the next fold.
MANY_SUMMARIES = 8

# Formats that append files: a partial row there is one more row, not an upsert.
FILE_FORMATS = ("parquet", "json", "csv", "orc", "text", "avro", "xml")


def entity_sizes(names: DataFrame) -> dict[str, Size]:
    """Size of each entity's names; one row per entity reaches the driver."""
    counted = names.groupBy("entity").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(names.schema)).alias("bytes")
    )
    return {r["entity"]: Size(r["rows"], r["bytes"]) for r in counted.collect()}


def _names_of(
    names: DataFrame, spec: EntitySpec, plan: DataFrame, *extra: Column
) -> DataFrame:
    """One entity's names by key; a key the plan's type cannot hold has no rows there."""
    key = F.col("key").try_cast(plan.schema[spec.fk].dataType)
    return names.filter((F.col("entity") == spec.entity) & key.isNotNull()).select(
        key.alias(spec.key), F.col("name").alias(spec.name), *extra
    )


def numbered(
    spark: SparkSession, base: str, schema: T.StructType | str, paths: dict[str, int], column: str, format: str = "parquet"
) -> DataFrame:
    """Rows of several folders below ``base``, each with its commit's number.

    A folder's name tells its id, which Spark attaches to rows without reading it; a small
    table of ids, one for each folder, has the numbers.
    """
    read = spark.read.schema(_with_id(schema)).option("basePath", base).format(format)
    ids = ", ".join(f"({path.rpartition('=')[2]}L, {number}L)" for path, number in paths.items())
    numbers = spark.sql(f"SELECT * FROM VALUES {ids} AS t(__id, {column})")
    rows = read.load(list(paths))
    return rows.join(F.broadcast(numbers), rows[ID] == numbers["__id"]).drop(ID, "__id")


def _with_id(schema: T.StructType | str) -> T.StructType:
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    return T.StructType([*fields, T.StructField(ID, T.LongType())])


def _plain(path: str) -> str:
    """A path without the slashes that writers of URIs differ in."""
    scheme, colon, rest = path.partition(":")
    return f"{scheme}:/{rest.lstrip('/')}" if colon else f"file:/{path.lstrip('/')}"


def _plain_column(path: Column) -> Column:
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def typed_key(specs: Iterable[EntitySpec], plan: T.StructType) -> Column:
    """The key of a row of names as the plan's type writes it; null if that cannot hold it."""
    out = F.lit(None).cast("string")
    for spec in specs:
        if spec.fk in plan.names:
            own = F.col("key").try_cast(plan[spec.fk].dataType).cast("string")
            out = F.when(F.col("entity") == spec.entity, own).otherwise(out)
    return out


class PlanTarget:
    """A plan table in parquet, with the updates beside it until they are folded in.

    A micro-batch adds its names (at most one row per entity and key); plan rows are
    neither searched nor rewritten for it. Reading joins the rows with the last name of
    every key, where that name came after the row. That is the same table as overwriting
    the matching rows at every update, since an update sets one column of all rows that
    carry its key. ``fold`` writes names into rows, at a pace of the owner's choice.

    What counts is listed in ``commits``, one small entry each, numbered in the order that
    all see and added after the data it names. Any number of processes may add names and
    rows, fold, compact and list what is obsolete beside each other: see ``CommitList``.
    A micro-batch committed once is skipped when it is replayed.

    With ``buckets``, rows lie in so many buckets by plan id, and a fold rewrites only
    buckets that hold new rows or a changed key. With ``index`` (always with buckets),
    each append also stores which keys it brought (``known_keys``) and, for each file, a
    summary of its keys, by which ``lookup`` leaves out files.

    The target keeps the dimensions it was ever created with. Whoever opens it, with
    whichever of them, reads and folds the names of all.
    """

    def __init__(self, spark: SparkSession, path: str, specs: Iterable[EntitySpec]):
        self.spark, self.path, self.specs = spark, path.rstrip("/"), tuple(specs)
        self.list = CommitList(spark, f"{self.path}/commits", self._live)
        self._specs: dict[str, list[dict]] = {}
        self._manifests: dict[str, dict[str, str]] = {}
        self._settings: dict | None = None

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        path: str,
        specs: Iterable[EntitySpec],
        buckets: int | None = None,
        index: bool = False,
    ) -> PlanTarget:
        """Open the target, made anew if there is none, and add its dimensions.

        ``buckets`` and ``index`` count when it is made.
        """
        target = cls(spark, path, specs)
        put_new(spark, f"{target.path}/settings.json", json.dumps({"buckets": buckets, "index": index or bool(buckets)}))
        while True:
            files = target._spec_files()
            stored = {s.entity: s for s in target._stored_specs()}
            new = [s for s in target.specs if stored.get(s.entity) != s]
            rows = json.dumps([dataclasses.asdict(s) for s in new])
            if not new or put_new(spark, f"{target.path}/specs/{len(files):06d}.json", rows):
                return target

    @property
    def settings(self) -> dict:
        if self._settings is None:
            self._settings = json.loads(read_text(self.spark, f"{self.path}/settings.json"))
        return self._settings

    def _spec_files(self) -> list[str]:
        return files(self.spark, f"{self.path}/specs")

    def _stored_specs(self) -> list[EntitySpec]:
        found = {}
        for path in self._spec_files():
            if path not in self._specs:
                self._specs[path] = json.loads(read_text(self.spark, path))
            for told in self._specs[path]:
                attributes = tuple(map(tuple, told["attributes"]))
                found[told["entity"]] = EntitySpec(**told | {"attributes": attributes, "keep": tuple(told["keep"])})
        return list(found.values())

    def all_specs(self) -> list[EntitySpec]:
        """The dimensions stored with the target and those it was opened with."""
        stored = {s.entity: s for s in self._stored_specs()}
        return list((stored | {s.entity: s for s in self.specs}).values())

    # commits

    def commits(self, as_of: int | None = None) -> list[Entry]:
        """The commits that matter, as stored now or as of a number; theirs is bounded."""
        return self.list.read() if as_of is None else self.list.read_as_of(as_of)

    def _live(self, commits: list[Entry]) -> list[Entry]:
        used = self._used(commits)
        telling = [c["number"] for c in latest_of_queries(commits)]
        return [c for c in commits if c["number"] in telling or used & set(self._named(c))]

    def _manifest(self, path: str) -> dict[str, str]:
        if path not in self._manifests:
            self._manifests[path] = json.loads(read_text(self.spark, path))
        return self._manifests[path]

    def _named(self, commit: Entry) -> list[str]:
        """All paths that a commit names."""
        own = [commit[k] for k in ("path", "log") if commit.get(k)]
        own += [run[0] for run in commit.get("keys") or []] + (commit.get("summaries") or [])
        if commit["kind"] != "buckets":
            return own
        # An earlier manifest may have been cleared away, after all that it alone named.
        told = self._manifests.get(commit["path"]) or json.loads(text_if_there(self.spark, commit["path"]) or "{}")
        return own + list(told.values())

    def _used(self, commits: list[Entry]) -> set[str]:
        """Paths that some read of the present state needs."""
        rows = self._row_commits(commits)
        used = {c["path"] for c in rows} | set(self._name_paths(commits))
        for c in rows:
            if c["kind"] == "buckets":
                used |= set(self._manifest(c["path"]).values())
        used |= {path for path, _ in self._key_runs(commits)} | set(self._summary_paths(commits))
        return used | {path for path, _ in self.log_parts(commits)}

    def _new_path(self, kind: str) -> str:
        return f"{self.path}/{kind}/{ID}={uuid.uuid4().int >> 65}"

    # writing

    def adopt(self, path: str) -> None:
        """Take existing parquet files as plan rows, without copying them."""
        schema = self.spark.read.parquet(path).schema
        self._add_rows("adopted", path, schema)

    def append(self, rows: DataFrame) -> None:
        """Add new plan rows; updates committed before do not touch them."""
        path = self._new_path("rows")
        rows.write.parquet(path)
        self._add_rows("rows", path, rows.schema)

    def _add_rows(self, kind: str, path: str, schema: T.StructType) -> None:
        entry = {"kind": kind, "path": path, "schema": schema.json()}
        if self.settings["index"]:
            rows = self._bucketed(self._read_rows(schema.json(), path))
            entry |= {"keys": [self._put_keys(keys_of(rows, self._indexed_specs(rows), _BUCKET))], "summaries": [self._put_summaries(rows)]}
        self.list.add(lambda _: entry)

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        """Rows with their file and bucket."""
        plan_id = self.all_specs()[0].plan_id
        bucket = F.pmod(F.xxhash64(plan_id), F.lit(self.settings["buckets"] or 1)).cast("int")
        return rows.select("*", F.col("_metadata.file_path").alias(_FILE), bucket.alias(_BUCKET))

    def _indexed_specs(self, rows: DataFrame) -> list[EntitySpec]:
        return [s for s in self.all_specs() if s.fk in rows.columns]

    def _put_keys(self, keys: DataFrame) -> list:
        path = self._new_path("keys")
        return [path, write_run(keys, path)]

    def _put_summaries(self, rows: DataFrame) -> str:
        path, fks = self._new_path("summaries"), {s.fk for s in self._indexed_specs(rows)}
        key_summaries(rows, sorted(fks), _FILE).write.parquet(path)
        return path

    def put_names(self, names: DataFrame, query_id: str, batch_id: int, log: str | None = None) -> bool:
        """Commit a micro-batch's last names, and the ``log`` of the micro-batch with them.

        False if there are none, or if it was committed before. Names of a dimension
        that the target does not have are an error, and nothing is committed.
        """

        def done(commits: list[Entry]) -> bool:
            return any(c.get("query") == query_id and c.get("batch_id") == batch_id for c in commits)

        if done(self.list.known()):
            return False
        path, seen = self._new_path("names"), Observation()
        told = names.select("entity", "key", "name")
        unknown = ~F.col("entity").isin([s.entity for s in self.all_specs()])
        told.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count_if(unknown).alias("unknown")
        ).write.parquet(path)
        if seen.get["unknown"]:
            raise ValueError("names of a dimension the target was not created with")
        some = seen.get["rows"] > 0
        if not some and log is None:
            return False
        entry = {"kind": "names" if some else "batch", "query": query_id, "batch_id": batch_id}
        entry |= {"path": path} if some else {}
        entry |= {"log": log} if log else {}
        return self.list.add(lambda commits: None if done(commits) else entry) is not None and some

    def compact_names(self) -> bool:
        """Reduce the names committed so far to the last one per key.

        Worth while after some hundred micro-batches, beside the job.
        """
        return self.finish(self.begin_compaction())

    def fold(self) -> bool:
        """Write names into rows, those of all dimensions; False if another fold was faster.

        A target with buckets rewrites those that hold new rows or a changed key.
        """
        return self.finish(self.begin_fold())

    def merge_keys(self) -> bool:
        """Put together key runs of like size, after many appends."""
        commits = self.commits()
        runs = self._key_runs(commits)
        merged = self._merged_runs(runs)
        if merged == runs:
            return False
        return self.finish({"kind": "keys", "keys": merged, "upto": commits[-1]["number"]})

    # Work in two steps: ``begin_`` reads a state and writes files, ``finish`` commits them.

    def begin_compaction(self) -> Entry | None:
        commits = self.commits()
        names, stored = self._names(commits)
        if stored:
            return None
        path = self._new_path("names")
        names.write.parquet(path)
        return {"kind": "compacted", "path": path, "upto": commits[-1]["number"]}

    def begin_fold(self) -> Entry | None:
        commits = self.commits()
        if not commits:
            return None
        entry = {"upto": commits[-1]["number"]}
        if self.settings["index"]:
            entry |= {"keys": self._merged_runs(self._key_runs(commits))}
        if self.settings["buckets"]:
            return entry | self._fold_buckets(commits)
        path, rows = self._new_path("rows"), self._merged(commits, None)
        rows.write.parquet(path)
        if self.settings["index"]:
            entry |= {"summaries": [self._put_summaries(self._bucketed(self._read_rows(rows.schema.json(), path)))]}
        return entry | {"kind": "full", "path": path, "schema": rows.schema.json()}

    def finish(self, entry: Entry | None) -> bool:
        """Commit what was begun, unless another process has summed up as much meanwhile."""

        def still(commits: list[Entry]) -> Entry | None:
            now = last_of(commits, entry["kind"])
            if entry["kind"] == "buckets":
                kept = (now[0]["number"] if now else None) == entry["base"]
            else:
                kept = not now or at(now[0]) < entry["upto"]
            return entry if kept else None

        return entry is not None and self.list.add(still) is not None

    def _fold_buckets(self, commits: list[Entry]) -> Entry:
        base = last_of(commits, "buckets")
        held = self._manifest(base[0]["path"]) if base else {}
        added = [c for c in self._row_commits(commits) if c["kind"] != "buckets"]
        touched = set()
        if added:
            new = self._bucketed(self._rows(commits, added))
            touched |= {r[0] for r in new.select(_BUCKET).distinct().collect()}
        names, _ = self._names(commits)
        if names is not None and held:
            typed = typed_key(self.all_specs(), T.StructType.fromJson(json.loads(base[0]["schema"])))
            changed = names.select(F.col("entity").alias("__entity"), typed.alias("__key"))
            keys = read_runs(self.spark, [path for path, _ in self._key_runs(commits)])
            same = (F.col("entity") == F.col("__entity")) & (F.col("key") == F.col("__key"))
            touched |= {r[0] for r in keys.join(changed, same, "left_semi").select("bucket").distinct().collect()}
        path, schema, summaries = self._new_path("buckets"), base[0]["schema"] if base else None, self._summary_paths(commits)
        if touched:
            rows = self._rows(commits, added, [held[str(b)] for b in sorted(touched) if str(b) in held])
            merged = self._bucketed_merge(self._with_names(rows, commits, None))
            merged.write.partitionBy(_BUCKET).parquet(path)
            schema = merged.drop(_BUCKET).schema.json()
            paths = [f"{path}/{_BUCKET}={b}" for b in touched]
            written = self._bucketed(self._read_rows(schema, *paths))
            live = [*(held[b] for b in held if int(b) not in touched), *paths]
            summaries = self._kept_summaries([*summaries, self._put_summaries(written)], live)
        manifest = held | {str(b): f"{path}/{_BUCKET}={b}" for b in touched}
        told = f"{self.path}/manifests/{uuid.uuid4().hex}.json"
        put_new(self.spark, told, json.dumps(manifest))
        return {
            "kind": "buckets",
            "path": told,
            "schema": schema,
            "base": base[0]["number"] if base else None,
            "rewritten": sorted(touched),
            "summaries": summaries,
        }

    def _bucketed_merge(self, rows: DataFrame) -> DataFrame:
        """Rows dealt to tasks by bucket and a salt, so that no bucket is one task's work."""
        plan_id = F.col(self.all_specs()[0].plan_id)
        bucket = F.pmod(F.xxhash64(plan_id), F.lit(self.settings["buckets"])).cast("int")
        count = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        salt = F.pmod(F.xxhash64(plan_id, F.lit(1)), F.lit(max(1, count // self.settings["buckets"])))
        return rows.withColumn(_BUCKET, bucket).repartition(count, F.col(_BUCKET), salt)

    def _merged_runs(self, runs: list[list]) -> list[list]:
        while some := to_merge(runs):
            keys = read_runs(self.spark, [path for path, _ in some]).distinct()
            runs = [r for r in runs if r not in some] + [self._put_keys(keys)]
        return runs

    def _kept_summaries(self, paths: list[str], live: list[str]) -> list[str]:
        """The same summaries, in one place without those of dead files once there are many."""
        if len(paths) <= MANY_SUMMARIES:
            return paths
        folder = F.regexp_replace("file", "/[^/]*$", "")
        told = self.spark.read.schema(SUMMARY_SCHEMA).parquet(*paths)
        current = self.spark.createDataFrame([(_plain(p),) for p in live], "__folder string")
        path = self._new_path("summaries")
        told.join(F.broadcast(current), _plain_column(folder) == F.col("__folder"), "left_semi").write.parquet(path)
        return [path]

    # upkeep

    def obsolete(self, since: int | None = None) -> list[str]:
        """Files and folders of the target that are needed no more, for the owner to remove.

        These are data that no read uses, then commits of earlier segments. A reader that
        started earlier may still use the data. All should go, in this order, or none.
        With ``since``, the states as of that number and later ones stay readable.
        """
        every = self.list.everything()  # before what is used, of which there may be more by then
        used, segments = self._used(self.commits()), self.list.earlier_segments(since)
        if since is not None:
            for state in self.list.states(since):
                used |= self._used(state)
        idle = {p for c in every for p in self._named(c)} - used
        return existing(self.spark, (p for p in idle if p.startswith(self.path))) + segments

    # reading

    def _row_commits(self, commits: list[Entry]) -> list[Entry]:
        full = last_of(commits, "full", "buckets")
        after = at(full[0]) if full else -1
        return full + [c for c in commits if c["kind"] in ("rows", "adopted") and c["number"] > after]

    def _name_paths(self, commits: list[Entry]) -> list[str]:
        compacted, plain = self._name_commits(commits)
        return [c["path"] for c in (*compacted, *plain)]

    def _name_commits(self, commits: list[Entry]) -> tuple[list[Entry], list[Entry]]:
        oldest = min((at(c) for c in self._row_commits(commits)), default=-1)
        compacted = [c for c in last_of(commits, "compacted") if at(c) > oldest]
        after = max([oldest, *map(at, compacted)])
        return compacted, [c for c in commits if c["kind"] == "names" and c["number"] > after]

    def _key_runs(self, commits: list[Entry]) -> list[list]:
        whole = [c for c in commits if c.get("keys") is not None and c.get("upto") is not None]
        start = max(whole, key=lambda c: (at(c), c["number"]), default=None)
        later = [c for c in commits if c["kind"] in ("rows", "adopted") and (start is None or c["number"] > at(start))]
        return [*(start["keys"] if start else []), *(run for c in later for run in c.get("keys") or [])]

    def _summary_paths(self, commits: list[Entry]) -> list[str]:
        return [path for c in self._row_commits(commits) for path in c.get("summaries") or []]

    def log_parts(self, commits: list[Entry]) -> list[tuple[str, int | None]]:
        """Paths of the log kept with the target, with the number of those of one micro-batch."""
        whole = last_of(commits, "log")
        later = [c for c in commits if c.get("log") and c["kind"] != "log" and (not whole or c["number"] > at(whole[0]))]
        return [(c["log"], None) for c in whole] + [(c["log"], c["number"]) for c in later]

    def _names(self, commits: list[Entry]) -> tuple[DataFrame | None, bool]:
        """The last name per entity and key among those younger than the oldest rows.

        Tells besides whether they lie in files that way.
        """
        compacted, plain = self._name_commits(commits)
        parts = [self.spark.read.schema(f"{_NAMES}, seq bigint").parquet(c["path"]) for c in compacted]
        if plain:
            parts.append(numbered(self.spark, f"{self.path}/names", _NAMES, {c["path"]: c["number"] for c in plain}, "seq"))
        if not parts:
            return None, True
        names = reduce(DataFrame.unionByName, parts)
        if len(compacted) + len(plain) == 1:
            return names, True
        latest = latest_per_key(names, ["entity", "key"], ["seq"])
        return latest.select("entity", "key", "name", "seq"), False

    def _rows(self, commits: list[Entry], only: list[Entry] | None = None, buckets: list[str] | None = None) -> DataFrame:
        """Plan rows with their place, as one read for all own files of one schema.

        ``only`` some commits and ``buckets`` of a fold, if given.
        """
        listed, own, parts = self._row_commits(commits) if only is None else only, defaultdict(dict), []
        base = [c for c in self._row_commits(commits) if c["kind"] == "buckets"]
        for c in listed if buckets is None else [*listed, *base]:
            if c["kind"] == "rows":
                own[c["schema"]][c["path"]] = c["number"]
                continue
            paths = [c["path"]]
            if c["kind"] == "buckets":
                paths = list(self._manifest(c["path"]).values()) if buckets is None else buckets
            if paths:
                parts.append(self._read_rows(c["schema"], *paths).withColumn(_SEQ, F.lit(at(c)).cast("bigint")))
        for schema, paths in own.items():
            if len(paths) == 1:
                rows = self._read_rows(schema, *paths).withColumn(_SEQ, F.lit(*paths.values()).cast("bigint"))
            else:
                rows = numbered(self.spark, f"{self.path}/rows", T.StructType.fromJson(json.loads(schema)), paths, _SEQ)
            parts.append(rows)
        if not parts:
            raise ValueError(f"no plan rows in {self.path}")
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def _read_rows(self, schema: str, *paths: str) -> DataFrame:
        return self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*paths)

    def _merged(self, commits: list[Entry], wanted: Sequence[str] | None) -> DataFrame:
        return self._with_names(self._rows(commits), commits, wanted)

    def _with_names(self, rows: DataFrame, commits: list[Entry], wanted: Sequence[str] | None) -> DataFrame:
        names, stored = self._names(commits)
        if not stored:
            names, _ = settle(names, "names")
        out, sizes = rows, entity_sizes(names) if names is not None else {}
        for spec in self.all_specs():
            if wanted is not None and spec.plan_name not in wanted:
                continue
            if spec.entity in sizes:
                lookup = _names_of(names, spec, rows, F.col("seq").alias(_NAMES_SEQ))
                out = merge_names(
                    out,
                    lookup,
                    spec,
                    sizes[spec.entity],
                    base=rows,
                    applies=F.col(_NAMES_SEQ) > F.col(_SEQ),
                )
            elif spec.plan_name not in out.columns:
                out = out.withColumn(spec.plan_name, F.lit(None).cast("string"))
        out = out.drop(_SEQ)
        return out if wanted is None else out.select(*wanted)

    def rows(self) -> DataFrame:
        """Plan rows without the pending names."""
        return self._rows(self.commits()).drop(_SEQ)

    def read(self, columns: Sequence[str] | None = None, as_of: int | None = None) -> DataFrame:
        """The plan table as of now, or as of a commit; only names among ``columns`` are joined.

        What ``obsolete`` listed without ``since`` may be gone, and older states with it.
        """
        return self._merged(self.commits(as_of), columns)

    def lookup(self, fk: str, key: object, columns: Sequence[str] | None = None) -> DataFrame:
        """Plan rows of one key, out of the files that may hold it.

        The number of files that may is what reaches the driver.
        """
        commits = self.commits()
        rows, paths = self._rows(commits), self._summary_paths(commits)
        kind = rows.schema[fk].dataType
        plain = isinstance(key, int) and is_whole_number(kind) or isinstance(key, str) and isinstance(kind, T.StringType)
        if plain and all(c.get("summaries") for c in self._row_commits(commits)):
            told = self.spark.read.schema(SUMMARY_SCHEMA).parquet(*paths)
            may = {_plain(unquote(r["file"])) for r in may_hold(told, fk, key).collect()}
            current = [unquote(f) for f in rows.inputFiles()]
            rows = self._rows_of_files(commits, [f for f in current if _plain(f) in may])
        return self._with_names(key_lookup(rows, fk, key), commits, columns)

    def _rows_of_files(self, commits: list[Entry], held: list[str]) -> DataFrame:
        """Plan rows of some files, with their place."""
        parts, listed = [], self._row_commits(commits)
        for c in listed:
            own = self._manifest(c["path"]).values() if c["kind"] == "buckets" else [c["path"]]
            below = tuple(f"{_plain(p)}/" for p in own)
            if read := [f for f in held if _plain(f).startswith(below)]:
                parts.append(self._read_rows(c["schema"], *read).withColumn(_SEQ, F.lit(at(c)).cast("bigint")))
        if not parts:
            return self._rows(commits).limit(0)
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def known_keys(self) -> DataFrame | None:
        """Entity, key and bucket of all plan rows, from the runs beside them; None without an index.

        A key may be in several runs.
        """
        return read_runs(self.spark, [path for path, _ in self._key_runs(self.commits())]) if self.settings["index"] else None


class KeyedStoreTarget:
    """A table in a store where appending a partial row upserts it by primary key.

    The table is read anew for every micro-batch and the matching rows are written
    back with plan id, op, key, name and the columns the entity keeps. Plain files do
    not upsert and are refused; ``UpsertFiles`` keeps partial rows in files.
    """

    def __init__(
        self,
        spark: SparkSession,
        specs: Iterable[EntitySpec],
        format: str,
        path: str = "",
        **options: str,
    ):
        if format.lower() in FILE_FORMATS:
            raise ValueError(f"{format} files do not upsert partial rows")
        self.spark, self.specs = spark, tuple(specs)
        self.format, self.path, self.options = format, path, options

    def rows(self) -> DataFrame:
        return table(self.spark, self.path, self.format, **self.options)

    def put_names(self, names: DataFrame, query_id: str, batch_id: int) -> bool:
        with kept(names) as names:
            sizes = entity_sizes(names)
            for spec in self.specs:
                if spec.entity in sizes:
                    self._put(_names_of(names, spec, self.rows()), spec, sizes[spec.entity])
        return bool(sizes)

    def _put(self, latest: DataFrame, spec: EntitySpec, size: Size) -> None:
        hit = matched_rows(self.rows(), latest, spec, size=size)
        writer = hit.write.mode("append").format(self.format).options(**self.options)
        writer.save(self.path) if self.path else writer.save()


class UpsertFiles:
    """A plan table in parquet with partial rows beside it; the last one per plan id counts.

    What a store with upserts does, in files: ``path`` holds whole rows and is only read,
    ``partial_path`` takes the partial rows of each dimension, numbered by micro-batch.
    """

    def __init__(self, spark: SparkSession, specs: Iterable[EntitySpec], path: str, partial_path: str):
        self.spark, self.specs = spark, tuple(specs)
        self.path, self.partial_path = path, partial_path.rstrip("/")

    def _folder(self, spec: EntitySpec) -> str:
        return f"{self.partial_path}/{spec.entity}"

    def partial_rows(self, spec: EntitySpec) -> DataFrame | None:
        """The last partial row of every plan id, if there is any."""
        if not folders(self.spark, self._folder(spec)):
            return None
        stored = self.spark.read.option("basePath", self._folder(spec)).parquet(self._folder(spec))
        return latest_per_key(stored, [spec.plan_id], ["seq"]).drop("seq")

    def rows(self) -> DataFrame:
        """The plan table as of now."""
        out = self.spark.read.parquet(self.path)
        for spec in self.specs:
            partial = self.partial_rows(spec)
            if partial is None:
                if spec.plan_name not in out.columns:
                    out = out.withColumn(spec.plan_name, F.lit(None).cast("string"))
                continue
            last = partial.select(
                F.col(spec.plan_id).alias("__id"), F.col(spec.plan_name).alias("__name"), F.lit(True).alias("__hit")
            )
            old = F.col(spec.plan_name) if spec.plan_name in out.columns else F.lit(None).cast("string")
            out = out.join(last, out[spec.plan_id] == last["__id"], "left").withColumn(
                spec.plan_name, F.when(F.col("__hit"), F.col("__name")).otherwise(old)
            ).drop("__id", "__name", "__hit")
        return out

    def put_names(self, names: DataFrame, query_id: str, batch_id: int) -> bool:
        with kept(names) as names:
            sizes = entity_sizes(names)
            for spec in self.specs:
                if spec.entity in sizes:
                    plan = self.spark.read.parquet(self.path)
                    latest = _names_of(names, spec, plan)
                    hit = matched_rows(plan, latest, spec, size=sizes[spec.entity])
                    seq = len(folders(self.spark, self._folder(spec)))
                    hit.write.parquet(f"{self._folder(spec)}/seq={seq:010d}")
        return bool(sizes)


class MergeTarget:
    """A table whose format supports MERGE INTO."""

    def __init__(self, spark: SparkSession, specs: Iterable[EntitySpec], name: str):
        self.spark, self.specs, self.name = spark, tuple(specs), name

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def put_names(self, names: DataFrame, query_id: str, batch_id: int) -> bool:
        with kept(names) as names:
            sizes = entity_sizes(names)
            for spec in self.specs:
                if spec.entity in sizes:
                    self._put(_names_of(names, spec, self.rows()), spec)
        return bool(sizes)

    def _put(self, latest: DataFrame, spec: EntitySpec) -> None:
        source = latest.select(
            F.col(spec.key).alias("__key"), F.col(spec.name).alias("__name")
        )
        (
            source.mergeInto(self.name, F.col(f"{self.name}.{spec.fk}") == F.col("__key"))
            .whenMatched()
            .update({spec.plan_name: F.col("__name")})
            .merge()
        )
