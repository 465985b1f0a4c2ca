"""Publishing key/value records with a delivery report.

``writeStream.format("outbox")`` (or ``write``) delivers records to a topic folder,
each task in a part file of its own, as JSON lines of ``key`` and ``value``.  A
record that cannot be delivered (no value, or larger than ``maxBytes``) goes to the
task's reject file with the reason.  When all tasks of a batch are done, its report
appears in one step: the part files that count, delivered and rejected records.  If a
task fails for good the batch is aborted: its files go, and an abort report says how
many tasks had delivered.  Readers take the files that reports name, so a retried
task or batch is delivered once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyspark
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

from linkflow.sources.growing import open_fs

FORMAT = "outbox"
MAX_BYTES = 1 << 20
REPORT_SCHEMA = "batch bigint, aborted boolean, tasks int, delivered bigint, rejected bigint, files array<string>"


@dataclass
class Delivered(WriterCommitMessage):
    """What one task delivered."""

    file: str
    delivered: int
    rejected: int


def _text(value) -> str | None:
    return bytes(value).decode("utf-8", "replace") if isinstance(value, (bytes, bytearray)) else value


class OutboxWriter(DataSourceStreamWriter, DataSourceWriter):
    """One writer for streams (a report per micro-batch) and for batch jobs (batch -1)."""

    def __init__(self, options: dict):
        self.options = {k.lower(): v for k, v in options.items()}

    def _open(self) -> tuple[fs.FileSystem, str]:
        where, root = open_fs(self.options["path"])
        for folder in ("records", "rejected", "reports"):
            where.create_dir(f"{root}/{folder}", recursive=True)
        return where, root

    def write(self, iterator: Iterator) -> Delivered:
        where, root = self._open()
        limit = int(self.options.get("maxbytes", MAX_BYTES))
        name = f"part-{pyspark.TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:12]}.jsonl"
        ok = bad = 0
        with where.open_output_stream(f"{root}/records/{name}") as out, \
                where.open_output_stream(f"{root}/rejected/{name}") as off:
            for row in iterator:
                size = len(row.value or b"") + len(row.key or b"")
                reason = "no value" if row.value is None else f"{size} bytes" if size > limit else None
                record = {"key": _text(row.key), "value": _text(row.value)}
                if reason is None:
                    out.write(json.dumps(record, ensure_ascii=False).encode() + b"\n")
                    ok += 1
                else:
                    off.write(json.dumps(record | {"reason": reason}, ensure_ascii=False).encode() + b"\n")
                    bad += 1
        return Delivered(name, ok, bad)

    def _report(self, messages: list, batch: int, aborted: bool) -> None:
        where, root = self._open()
        done = [m for m in messages if m is not None]
        if aborted:
            for m in done:
                for folder in ("records", "rejected"):
                    where.delete_file(f"{root}/{folder}/{m.file}")
        report = {"batch": batch, "aborted": aborted, "tasks": len(done), "delivered": sum(m.delivered for m in done),
                  "rejected": sum(m.rejected for m in done), "files": [] if aborted else [m.file for m in done]}
        final = f"{root}/reports/" + (f"{batch:012d}-aborted-{uuid.uuid4().hex[:12]}.json" if aborted else
                                      f"{batch:012d}.json" if batch >= 0 else f"batch-{uuid.uuid4().hex}.json")
        new = f"{root}/reports/.{uuid.uuid4().hex}"
        with where.open_output_stream(new) as out:
            out.write(json.dumps(report).encode() + b"\n")
        where.move(new, final)

    def commit(self, messages: list, batchId: int = -1) -> None:  # noqa: N803
        self._report(messages, batchId, aborted=False)

    def abort(self, messages: list, batchId: int = -1) -> None:  # noqa: N803
        self._report(messages, batchId, aborted=True)


class Outbox(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "key binary, value binary"

    def streamWriter(self, schema, overwrite: bool) -> OutboxWriter:  # noqa: N802
        return OutboxWriter(self.options)

    def writer(self, schema, overwrite: bool) -> OutboxWriter:
        return OutboxWriter(self.options)


def register(spark: SparkSession) -> None:
    from linkflow.session import prepare_session, ship_package
    ship_package(prepare_session(spark))
    spark.dataSource.register(Outbox)


def publish_stream(frame: DataFrame, folder: str, max_bytes: int = MAX_BYTES):
    """A stream writer of ``key``/``value`` rows to a topic folder; see ``runner.run``."""
    register(frame.sparkSession)
    return frame.select("key", "value").writeStream.format(FORMAT).outputMode("append") \
        .option("path", folder).option("maxBytes", max_bytes)


def reports(spark: SparkSession, folder: str) -> DataFrame:
    """(batch, aborted, tasks, delivered, rejected, files) of every finished or aborted batch."""
    return spark.read.schema(REPORT_SCHEMA).option("pathGlobFilter", "*.json").json(f"{folder}/reports")


def _named(spark: SparkSession, folder: str, sub: str, schema: str) -> DataFrame:
    rows = spark.read.schema(schema).json(f"{folder}/{sub}").selectExpr("*", "_metadata.file_name AS file__")
    files = reports(spark, folder).filter("NOT aborted").selectExpr("explode(files) AS file__")
    return rows.join(files, "file__", "left_semi").drop("file__")


def delivered(spark: SparkSession, folder: str) -> DataFrame:
    """(key, value) text of the delivered records."""
    return _named(spark, folder, "records", "key string, value string")


def rejected(spark: SparkSession, folder: str) -> DataFrame:
    """(key, value, reason) of the records that were not delivered."""
    return _named(spark, folder, "rejected", "key string, value string, reason string")
