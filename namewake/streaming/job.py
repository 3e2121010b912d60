"""The propagation job: one query from the change feeds to the plan table."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from namewake.entities import UPDATE, EntitySpec
from namewake.operators.changes import latest_updates
from namewake.operators.propagate import unmatched_updates
from namewake.scratch import kept
from namewake.streaming.logs import TargetLog
from namewake.streaming.targets import PlanTarget, typed_key

# Fixed value: time between micro-batches.
BATCH_INTERVAL = "10 seconds"


class Log(Protocol):
    def write(self, batch: DataFrame, query_id: str, batch_id: int) -> DataFrame | None: ...


class Target(Protocol):
    specs: tuple[EntitySpec, ...]

    def rows(self) -> DataFrame: ...

    def put_names(self, names: DataFrame, query_id: str, batch_id: int) -> bool: ...


def last_names(batch: DataFrame) -> DataFrame:
    """What a micro-batch comes to: the last updated name per entity and key."""
    updates = batch.select("entity", "key", "op_type", "name", "ord")
    return latest_updates(updates, ["entity", "key"], ["ord"]).select("entity", "key", "name")


def unmatched_report(names: DataFrame, target: Target) -> DataFrame:
    """Updates of a micro-batch that no plan row took, for all entities.

    A target that keeps the keys of its rows is asked for these, and no row is read. Else
    one scan of the plan's foreign keys serves all. Keys are compared as the plan's type
    writes them; one that it cannot hold matches nothing.
    """
    plan = target.rows()
    known = names.filter(F.col("entity").isin([s.entity for s in target.specs]))
    typed = typed_key(target.specs, plan.schema)
    asked = known.withColumn("__pair", F.concat("entity", F.lit(":"), typed))
    keys = target.known_keys() if isinstance(target, PlanTarget) else None
    if keys is not None:
        held = keys.select(F.concat("entity", F.lit(":"), "key").alias("__held"))
    else:
        pairs = [F.concat(F.lit(f"{s.entity}:"), F.col(s.fk).cast("string")) for s in target.specs]
        held = plan.select(F.explode(F.array(*pairs)).alias("__held")).filter("__held IS NOT NULL")
    return unmatched_updates(held, asked, "__held", "__pair").drop("__pair")


def batch_handler(
    target: Target, log: Log | None = None, report: str | None = None, rejects: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Copy a micro-batch to the log, then apply it; both may be repeated safely.

    What is applied is read from the log where that is in files, so that the source is
    read once and no micro-batch is kept by executors. With ``report``, updates that match
    no plan row are written there, see ``unmatched_report``. With ``rejects``, messages that
    name no key, broken ones among them, are written there. With the target's own log, a
    micro-batch is in both or in neither.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        context = batch.sparkSession.sparkContext
        # The query id stays with the checkpoint, so batch ids are unique under it.
        query_id = context.getLocalProperty("sql.streaming.queryId")
        logged = log.write(batch, query_id, batch_id) if log is not None else None
        changes = batch if logged is None else logged
        if rejects is not None:
            put(changes.filter(F.col("key").isNull()).select("entity", "msg_key", "msg_value"), rejects, query_id, batch_id)
        together = {"log": log.stored(query_id, batch_id)} if isinstance(log, TargetLog) else {}
        apply(last_names(changes), query_id, batch_id, together)

    def put(rows: DataFrame, folder: str, query_id: str, batch_id: int) -> None:
        path = f"{folder.rstrip('/')}/query={query_id}/batch_id={batch_id}"
        rows.write.mode("overwrite").parquet(path)

    def apply(names: DataFrame, query_id: str, batch_id: int, together: dict[str, str]) -> None:
        if report is None:
            target.put_names(names, query_id, batch_id, **together)
        else:
            with kept(names) as names:
                put(unmatched_report(names, target), report, query_id, batch_id)
                target.put_names(names, query_id, batch_id, **together)

    return handle


def start(
    feed: DataFrame,
    target: Target,
    checkpoint: str,
    log: Log | None = None,
    report: str | None = None,
    rejects: str | None = None,
    available_now: bool = False,
    interval: str = BATCH_INTERVAL,
) -> StreamingQuery:
    """Start the job on a feed in common form (see ``feeds.tag_feed``).

    It goes on from ``checkpoint``. Counts of changes, updates and changes without
    a key appear in the query's progress under ``changes``. With ``available_now``
    it ends when all input present is done, otherwise it runs until stopped.
    """
    if log is None and rejects is None:
        # A micro-batch is computed with all its columns, so unused ones go before.
        feed = feed.drop("msg_key", "msg_value")
    observed = feed.observe(
        "changes",
        F.count(F.lit(1)).alias("changes"),
        F.count_if(F.col("op_type") == UPDATE).alias("updates"),
        F.count_if(F.col("key").isNull()).alias("without_key"),
    )
    writer = observed.writeStream.foreachBatch(batch_handler(target, log, report, rejects))
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def run(feed: DataFrame, target: Target, checkpoint: str, **options) -> None:
    """Start the job and wait until it is stopped or fails."""
    start(feed, target, checkpoint, **options).awaitTermination()


def copy_stream(stream: DataFrame, path: str, checkpoint: str, format: str = "parquet") -> None:
    """Write all rows present in a stream to files, once each."""
    (
        stream.writeStream.format(format)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def print_changes(feed: DataFrame, rows: int = 20) -> StreamingQuery:
    """Show every micro-batch on the console, for looking into a feed."""
    return (
        feed.writeStream.format("console")
        .option("numRows", rows)
        .option("truncate", False)
        .trigger(processingTime=BATCH_INTERVAL)
        .start()
    )
