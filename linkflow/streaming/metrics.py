"""What the row guards of running queries counted, as a table.

Every guard counts the rows that it saw, the violations of each rule and the rows
it kept (``quality.guard``).  ``ExpectationLog`` is a query listener that writes the
counts of each micro-batch to a file of its own, so a repeated micro-batch replaces
its counts; ``log`` writes those of a batch job; ``expectation_log`` reads them all.
"""

from __future__ import annotations

import json
import re
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from linkflow.streaming.table import Files

SCHEMA = ("query string, batch bigint, expectations string, rule string, violations bigint, rows bigint, kept bigint")
RULE = "violations_"


def counts(query: str, batch: int, observed: dict[str, dict]) -> list[dict]:
    """A record per rule of the observations that are guards'."""
    out = []
    for name, values in observed.items():
        for field, n in values.items():
            if field.startswith(RULE):
                out.append({"query": query, "batch": batch, "expectations": re.sub(r"_\d+$", "", name),
                            "rule": field.removeprefix(RULE), "violations": n, "rows": values["rows"],
                            "kept": values["kept"]})
    return out


def log(spark: SparkSession, root: str, query: str, batch: int, observed: dict[str, dict]) -> None:
    """Writes the counts of one batch of a query."""
    records = counts(query, batch, observed)
    if records:
        files, name = Files(spark, root), f"{query}-{batch:012d}.json"
        files.fs.mkdirs(files.path(""))
        files.delete(name)
        files.write(name, "".join(json.dumps(r) + "\n" for r in records))


def expectation_log(spark: SparkSession, root: str) -> DataFrame:
    """(query, batch, expectations, rule, violations, rows, kept) of all batches so far."""
    return spark.read.schema(SCHEMA).option("pathGlobFilter", "*.json").json(root)


def totals(entries: DataFrame) -> DataFrame:
    """``rule, violations, kept`` over all batches, as ``quality.expectation_report`` gives them."""
    return entries.groupBy("rule").agg(F.sum("violations").alias("violations"), F.sum("kept").alias("kept"))


class ExpectationLog(StreamingQueryListener):
    """Register with ``spark.streams.addListener``; named queries only."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.ended: dict[str, threading.Event] = {}
        self.lock = threading.Lock()

    def _end(self, run: str) -> threading.Event:
        with self.lock:
            return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        if p.name:
            log(self.spark, self.root, p.name, p.batchId, {k: r.asDict() for k, r in p.observedMetrics.items()})

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._end(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 120) -> None:
        """Until all events of a query that has ended are written."""
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError(f"events of {query.name}")
