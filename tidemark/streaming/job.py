"""The streaming run: micro-batches of the log into the stored targets."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.routing import Route, matched_targets
from tidemark.plans.sync import BatchReport, SyncPlan
from tidemark.sources.changelog import decode, row_changes
from tidemark.sources.offsets import Start


def start_sync(
    plan: SyncPlan,
    log: DataFrame,
    checkpoint: str,
    job: str = "sync",
    interval: str | None = "10 seconds",
    start: Start | None = None,
    on_batch: Callable[[BatchReport], None] | None = None,
) -> StreamingQuery:
    """T-01, T-02, W-09: run the plan over a streaming log.

    ``interval=None`` drains what is there and stops. Micro-batches run one after the other and order rows
    by log position inside, so the last change of a key wins. A batch that is replayed after a failure is
    skipped by the targets that already have it, so each change counts once. Batches are told apart by the
    stream's own id, which its checkpoint keeps: a stream with a new checkpoint never meets old numbers.
    """
    ids: list[str] = []

    def apply(batch: DataFrame, number: int) -> None:
        if not ids:
            ids.append(stream_id(batch.sparkSession, checkpoint))
        report = plan.run_batch(batch, number, f"{job}:{ids[0]}", start)
        if on_batch:
            on_batch(report)

    writer = log.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).queryName(job)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of a checkpoint folder when it first started."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def start_divided(
    plan: SyncPlan, log: DataFrame, checkpoint: str, interval: str | None = "10 seconds", start: Start | None = None
) -> StreamingQuery:
    """W-03: a writer for every target, all fed from one read of the log."""
    return start_sync(replace(plan, writers=max(len(plan.targets), 1)), log, checkpoint, "divided", interval, start)


def start_new_tables(
    log: DataFrame, routes: Sequence[Route], checkpoint: str, path: str, interval: str | None = "10 seconds"
) -> StreamingQuery:
    """F-10: a row in the Parquet table at ``path`` for each source table when its first change comes, with the targets it
    is routed to. The names seen are kept in the stream's state store, so a restart from the checkpoint tells none twice."""
    names = row_changes(decode(log)).select("db", "tbl", "file_no", "pos", "ts_ms")
    new = names.dropDuplicates(["db", "tbl"]).withColumn("targets", matched_targets(routes))
    writer = new.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()
