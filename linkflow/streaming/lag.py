"""Lag of a load from landing files, from its own books.

How far the load is: its checkpoint's commit log names the newest committed
micro-batch, that micro-batch's offset names a ledger version.  What it holds: the
offset runs of its table.  What has landed since: the lines after that ledger
version, and only those are read.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkflow.operators.health import NEVER_COMMITTED, consumer_lag
from linkflow.sources import growing, jsonl
from linkflow.streaming.table import VERSION, Files, OffsetTable


def committed_ledger(spark: SparkSession, checkpoint: str) -> int:
    """The ledger version of the newest committed micro-batch; 0 before the first."""
    files = Files(spark, checkpoint)
    done = [int(n) for n in files.names("commits") if n.isdigit()]
    if not done:
        return 0
    offsets = files.read(f"offsets/{max(done)}").strip().split("\n")
    return json.loads(offsets[-1])["ledger"]


def loaded_offsets(spark: SparkSession, target: str) -> DataFrame:
    """(topic, partition, first, last) that a table of offsets holds."""
    table = OffsetTable(spark, target)
    versions = sorted({v for v, _ in table.pointer().named()})
    if not versions:
        return spark.createDataFrame([], "topic string, partition int, first bigint, last bigint")
    runs = spark.read.parquet(*[f"{table.root}/runs/{VERSION}={v}" for v in versions])
    return runs.groupBy("topic", "partition").agg(F.min("lo").alias("first"), F.max("hi").alias("last"))


def landing_lag(spark: SparkSession, folder: str, ledger: str, checkpoint: str, target: str,
                pattern: str = "*.jsonl") -> DataFrame:
    """``partition, begin_offset, end_offset, committed_offset, lag, pending``.

    ``lag`` is that of ``consumer_lag`` over the offsets of the landed records;
    ``pending`` counts the landed records that no committed micro-batch has read.
    """
    lines = growing.growing_range(spark, folder, ledger, since=committed_ledger(spark, checkpoint), pattern=pattern)
    new = jsonl.parse_dump_lines(lines.select("value")).select(
        "topic", F.col("partition").try_cast("int").alias("partition"), F.col("offset").try_cast("bigint").alias("offset"))
    pending = new.filter("partition IS NOT NULL AND offset IS NOT NULL").groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("pending"), F.min("offset").alias("from"), F.max("offset").alias("to"))
    held = loaded_offsets(spark, target)
    both = held.join(pending, ["topic", "partition"], "full_outer")
    offsets = both.select(
        "topic", "partition", F.least("first", "from").alias("begin_offset"), (F.greatest("last", "to") + 1).alias("end_offset"),
        F.coalesce(F.col("last") + 1, F.lit(NEVER_COMMITTED)).alias("committed_offset"),
        F.coalesce("pending", F.lit(0)).alias("pending"))
    return consumer_lag(offsets, "topic", "pending").select(
        "topic", "partition", "begin_offset", "end_offset", "committed_offset", "lag", "pending")
