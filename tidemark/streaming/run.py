"""Change streams into stored state."""

from __future__ import annotations

import threading
import time
from collections import defaultdict
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from tidemark.operators.merge import apply_updates
from tidemark.plans.jobs import merge_once
from tidemark.plans.options import MergeOptions
from tidemark.sources.changes import read_changes
from tidemark.sources.state import StateTable, ensure_state, read_state, replace_buckets, stream_offset
from tidemark.sources.swap import is_local
from tidemark.streaming.late import latest_seen


#: Batches limited to so many rows are logged without a shuffle, by a task for every ``TASK_ROWS`` of the limit.
SMALL_ROWS, TASK_ROWS = 80_000, 4_000

#: Spark's setting of how checkpoint files are written, and the way that suits many small batches on local disks:
#: the usual one starts some ten processes a file there, and a batch has three files.
CHECKPOINT_FILES = "spark.sql.streaming.checkpointFileManagerClass"
LOCAL_FILES = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"


def run_changes(
    spark: SparkSession,
    log_path: str,
    business: T.StructType,
    table: StateTable,
    options: MergeOptions,
    name: str | None = None,
) -> StreamingQuery:
    """Start the stream that merges a change log into a table.

    The merge-on-read sink is safe to replay and immune to batches that arrive out of
    order. File batches do not follow the order of changes, so a copy-on-write table must keep
    what it needs to tell an older change: a ``guard_col``, and soft deletes, whose tombstones
    keep the deleted keys' guards. With hard deletes, ``late_seconds`` says how long the stream itself remembers
    the last change of every key (:mod:`tidemark.streaming.late`); an older change that comes later than that is
    applied. After the loss of the checkpoint the whole log has to be read again, which ends in the same rows.
    A stream applies upserts only: phases are not safe to replay.
    """
    if options.semantics != "upsert":
        raise ValueError("a stream can be replayed only with semantics='upsert'")
    late = options.late_seconds is not None
    if late and (options.sink != "cow" or table.delete_mode != "hard"):
        raise ValueError("late_seconds is for copy-on-write tables with delete_mode='hard'")
    if options.sink == "cow" and not late and (table.guard_col is None or table.delete_mode != "soft"):
        raise ValueError(
            "a stream into a copy-on-write table needs guard_col and delete_mode='soft', or late_seconds and 'hard'"
        )
    changes = read_changes(
        spark,
        log_path,
        business,
        stream=True,
        buckets=options.buckets,
        max_files_per_trigger=options.max_files_per_trigger,
        max_bytes_per_trigger=options.max_bytes_per_trigger,
        max_rows_per_trigger=options.max_rows_per_trigger,
    )
    if late:
        changes = latest_seen(changes, table.keys, options.late_seconds, table.order_by)
    writer = changes.writeStream.outputMode("update" if late else "append").option("checkpointLocation", options.checkpoint)
    writer = writer.trigger(**options.trigger_arguments())
    if name:
        writer = writer.queryName(name)
    if options.sink == "console":
        return writer.format("console").option("truncate", "false").start()
    if options.sink == "noop" and not options.fold:
        return writer.format("noop").start()

    limit, offset = options.max_rows_per_trigger, None
    tasks = -(-limit // TASK_ROWS) if limit is not None and limit <= SMALL_ROWS else None
    fits = False  # the schema of a stream's batches is fixed, and no one else writes to the table

    def apply(batch: DataFrame, batch_id: int) -> None:
        nonlocal fits, offset
        # No look at the batch before the merge: every sink reads it once, and an empty one
        # changes nothing (copy-on-write finds no touched bucket, the log gets no row).
        session, number = batch.sparkSession, batch_id
        query_id = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        if options.sink == "mor":
            if not fits:
                ensure_state(session, table, batch, options.auto_create, options.evolve)
            if offset is None:
                offset = stream_offset(session, table, query_id)
            number += offset
        report = (query_id, batch_id) if options.report and options.sink in ("cow", "mor") else None
        ready = fits or options.sink == "mor"
        merge_once(session, batch, table, options, number, report=report, ready=ready, tasks=tasks)
        fits = True

    writer = writer.foreachBatch(apply)
    return writer.start() if limit is None else _start_small(spark, writer, options.checkpoint)


def _start_small(spark: SparkSession, writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Start a stream of many small batches; its files in a local checkpoint are written by ``LOCAL_FILES``.

    The files are the same, so a checkpoint can be gone on with either way. A session that names a way keeps it.
    """
    if not is_local(spark, checkpoint) or spark.conf.get(CHECKPOINT_FILES, None) is not None:
        return writer.start()
    spark.conf.set(CHECKPOINT_FILES, LOCAL_FILES)
    try:
        query = writer.start()
        # The source reads the setting when the stream has begun to run.
        while query.isActive and query.status["message"].startswith("Initializing"):
            time.sleep(0.01)
        return query
    finally:
        spark.conf.unset(CHECKPOINT_FILES)


def run_all(
    spark: SparkSession,
    jobs: dict[str, tuple[str, T.StructType, StateTable, MergeOptions]],
    wait: bool = True,
) -> dict[str, StreamingQuery]:
    """Start one stream per table in this session, each with its own checkpoint.

    With ``wait``, blocks until all have ended; the first failure stops the others and is
    raised.
    """
    started: dict[str, StreamingQuery] = {}
    try:
        for name, (log_path, business, table, options) in jobs.items():
            started[name] = run_changes(spark, log_path, business, table, options, name)
        running = list(started.values()) if wait else []
        while running:
            # Raises as soon as one has failed, whichever it is.
            running = [query for query in running if not query.awaitTermination(1)]
    except BaseException:
        for query in started.values():
            query.stop()
        raise
    return started


def backfill_slice(
    spark: SparkSession,
    table: StateTable,
    bucket: int,
    assignments: dict[str, str],
    order_by: Sequence[str],
    batch_rows: int,
) -> int:
    """Recompute columns of up to ``batch_rows`` rows of one bucket and merge them back.

    ``assignments`` maps columns to SQL expressions over the row; the rows that come first
    by ``order_by`` are taken, so ordering by a stamp that the step renews walks through
    the whole bucket. Returns the number of rows changed.
    """
    state = read_state(spark, table, view="base", buckets=[bucket])
    new = [
        F.expr(assignments[c]).cast(state.schema[c].dataType).alias(c) if c in assignments else F.col(c)
        for c in state.columns
    ]
    part = state.orderBy(*[F.col(c).asc_nulls_first() for c in order_by]).limit(batch_rows).select(*new)
    part = part.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = part.count()
        if rows:
            replace_buckets(spark, table, apply_updates(state, part, table.keys), [bucket])
        return rows
    finally:
        part.unpersist()


def run_backfill(
    spark: SparkSession,
    table: StateTable,
    bucket: int,
    assignments: dict[str, str],
    order_by: Sequence[str],
    batch_rows: int,
    checkpoint: str,
    interval: str = "2 seconds",
    rows_per_second: int = 1,
    on_step: Callable[[int, int | None, Exception | None], None] | None = None,
) -> StreamingQuery:
    """Run :func:`backfill_slice` at every heartbeat of a rate source.

    A step that fails is reported to ``on_step(batch_id, rows, error)`` and skipped.
    """
    beat = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).option("numPartitions", 1).load()

    def step(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        rows, error = None, None
        try:
            rows = backfill_slice(batch.sparkSession, table, bucket, assignments, order_by, batch_rows)
        except Exception as failure:  # a heartbeat job goes on after a bad step
            error = failure
        if on_step is not None:
            on_step(batch_id, rows, error)
        elif error is not None:
            print(f"backfill step {batch_id} failed: {error}")

    return (
        beat.writeStream.option("checkpointLocation", checkpoint)
        .trigger(processingTime=interval)
        .foreachBatch(step)
        .start()
    )


class ProgressLog(StreamingQueryListener):
    """Notes every batch of the session's streams; a query itself only remembers its last ones.

    Register it before the streams start: ``spark.streams.addListener(log)``. One small row
    per batch stays on the driver until :meth:`forget`.
    """

    def __init__(self) -> None:
        self._batches: dict[str, list] = defaultdict(list)
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._batches[str(event.progress.runId)].append(_batch_row(event.progress))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def batches(self, query: StreamingQuery, timeout: float = 60) -> list[tuple]:
        """Rows of all batches so far; of a stream that has ended, not before its last one has been told."""
        run = str(query.runId)
        if not query.isActive and not self._ended[run].wait(timeout):
            raise TimeoutError("the end of the stream was not reported")
        return list(self._batches[run])

    def forget(self, query: StreamingQuery) -> None:
        """Drop the rows of a stream."""
        self._batches.pop(str(query.runId), None)


def progress_frame(spark: SparkSession, query: StreamingQuery, log: ProgressLog | None = None) -> DataFrame:
    """Batches of a stream: id, input rows, duration and rate. All with a ``log``, else the recent ones Spark keeps."""
    rows = [_batch_row(p) for p in query.recentProgress] if log is None else log.batches(query)
    frame = spark.createDataFrame(rows, "batch_id bigint, started string, input_rows bigint, duration_ms bigint")
    seconds = F.col("duration_ms") / 1000.0
    return frame.withColumn(
        "rows_per_second", F.when(seconds > 0, F.round(F.col("input_rows") / seconds, 2))
    )


def _batch_row(progress) -> tuple:
    p = _as_dict(progress)
    return p["batchId"], p["timestamp"], int(p["numInputRows"]), int(p["durationMs"].get("triggerExecution", 0))


def _as_dict(progress) -> dict:
    if isinstance(progress, dict):
        return progress
    return {
        "batchId": progress.batchId,
        "timestamp": progress.timestamp,
        "numInputRows": progress.numInputRows,
        "durationMs": progress.durationMs,
    }
