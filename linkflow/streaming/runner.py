"""Running Structured Streaming queries into parquet tables.

Targets and checkpoints live under the session's shared checkpoint folder.
``foreachBatch`` callbacks write into tables of ``table.VersionedTable``: a
retried batch never adds its rows twice, readers see whole batches only, and the
number of folders does not grow with the number of batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from linkflow.session import prepare_session, scratch_path
from linkflow.streaming.table import OffsetTable, VersionedTable


class Workspace:
    """Fresh target/checkpoint paths for one streaming run."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = prepare_session(spark)
        self.root = scratch_path(spark, f"stream-{name}")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"


#: Bytes that a task of a stream reads: of files, and of a bucket that is written.
#: Messages shrink to a tenth or less in a file, so the first bounds what a task holds
#: of a batch that several targets share.
TASK_BYTES = {"spark.sql.files.maxPartitionBytes": str(8 << 20),
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(32 << 20)}


@contextmanager
def small_tasks(spark: SparkSession):
    """What runs meanwhile reads ``TASK_BYTES`` a task (a stream's scans follow the session
    that made it); the session has its own settings back afterwards."""
    before = {k: spark.conf.get(k, None) for k in TASK_BYTES}
    for k, v in TASK_BYTES.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def run(writer, checkpoint: str, query_name: str | None = None,
        every: str | None = None, spark: SparkSession | None = None) -> StreamingQuery:
    """Start a query.

    ``every=None`` uses ``trigger(availableNow=True)`` and waits until all that
    is available is processed, in as many micro-batches as the source limits
    allow, however long it takes.  With ``every`` (a processing-time interval
    such as ``"300 seconds"``) the query runs on and is returned while active.
    With ``spark``, the stream's session, such a run is of small tasks.
    Rerunning with the same checkpoint resumes after the last committed batch.
    """
    w = writer.option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if every is not None:
        return w.trigger(processingTime=every).start()
    with small_tasks(spark) if spark is not None else nullcontext():
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def drain(*queries: StreamingQuery) -> None:
    """Wait until each running query, in the given order, has processed what is available."""
    for q in queries:
        q.processAllAvailable()


def append_parquet(stream: DataFrame, target: str, checkpoint: str, query_name: str | None = None,
                   partition_by: Sequence[str] = (), every: str | None = None) -> StreamingQuery:
    """Append-mode file sink (exactly-once through its metadata log)."""
    w = stream.writeStream.format("parquet").outputMode("append").option("path", target)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return run(w, checkpoint, query_name, every, stream.sparkSession)


#: Error conditions of a table that nothing was written to yet.
NOT_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """A parquet table, or None if nothing was written there yet."""
    try:
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in NOT_THERE:
            return None
        raise


def insert_batches(target: str, keys: Sequence[str] = ("topic", "partition", "offset"),
                   transform: Callable[[DataFrame], DataFrame] | None = None):
    """``foreachBatch`` callback: insert the rows whose transport id is not in the
    target yet (MERGE ... WHEN NOT MATCHED THEN INSERT)."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        OffsetTable(batch.sparkSession, target, keys).insert(rows, batch_id)

    return fn


def latest_batches(target: str, keys: Sequence[str], order: Sequence[str], bucket: Column | None = None,
                   transform: Callable[[DataFrame], DataFrame] | None = None):
    """``foreachBatch`` callback for an upsert keyed by ``keys`` and sequenced by
    ``order``: out-of-order arrival and replays come to the same row per key."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        VersionedTable(batch.sparkSession, target, bucket).upsert(rows, batch_id, keys, order)

    return fn


@contextmanager
def dealt_by_size(spark: SparkSession):
    """Tables are written by size meanwhile, also in the session of a stateful stream.

    Such a stream runs with a fixed number of partitions, where a rebalance does nothing
    and each state partition would write a file into each bucket.  The batch's own plan
    is made before the callback, so its partitions stay."""
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def update_batches(target: str, keys: Sequence[str], bucket: Column | None = None):
    """``foreachBatch`` callback for update mode: the changed rows replace those of their keys."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        with dealt_by_size(batch.sparkSession):
            VersionedTable(batch.sparkSession, target, bucket).upsert(batch, batch_id, keys)

    return fn


def complete_batches(target: str):
    """``foreachBatch`` callback for complete mode: every batch is the whole result."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        with dealt_by_size(batch.sparkSession):
            VersionedTable(batch.sparkSession, target).replace(batch, batch_id)

    return fn


def fan_out(*targets: Callable[[DataFrame, int], None]):
    """``foreachBatch`` callback that feeds several targets from one read, in order.

    Every target records the batch with its own commit, and does nothing for a
    batch that it has: after a failure between two targets, the retried batch goes
    on where it stopped.
    """

    def fn(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            for target in targets:
                target(held, batch_id)
        finally:
            held.unpersist()

    return fn


def table(spark: SparkSession, target: str) -> DataFrame:
    """The current rows of a target of the callbacks above."""
    return VersionedTable(spark, target).rows()


def foreach_batch(stream: DataFrame, fn, checkpoint: str, query_name: str | None = None,
                  output_mode: str = "append", every: str | None = None) -> StreamingQuery:
    w = stream.writeStream.outputMode(output_mode).foreachBatch(fn)
    return run(w, checkpoint, query_name, every, stream.sparkSession)
