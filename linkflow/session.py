"""Session construction and the per-session settings every query relies on."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that change results: all instants are read and rendered in UTC.
RESULT_CONFS = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings that only change the physical plan.  AQE re-plans joins and
# aggregations from measured shuffle sizes: it coalesces small partitions,
# splits skewed join partitions and turns a sort-merge join into a broadcast
# join only when the measured side is below the threshold.
PLAN_CONFS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.optimizer.enableJsonExpressionOptimization": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the result-relevant runtime settings to an existing session.

    Every public query calls this, so a session built elsewhere (a driver, a
    notebook) gives the same results as one built by :func:`build_session`.
    """
    for k, v in RESULT_CONFS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    for k, v in PLAN_CONFS.items():
        if k.startswith("spark.sql.streaming.stateStore"):
            continue  # only effective before the first stream; set at build
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def build_session(master: str | None = None, app_name: str = "linkflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session configured for linkflow.

    On a cluster pass ``master=None`` and let the launcher decide; the
    shuffle partition count then stays whatever the cluster set (AQE
    coalesces it at runtime).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    confs = dict(RESULT_CONFS)
    confs.update(PLAN_CONFS)
    confs["spark.ui.enabled"] = "false"
    confs["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions is not None:
        confs["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        confs.update(extra)
    for k, v in confs.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare_session(spark)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, unless they find it as the driver does.

    Workers see ``PYTHONPATH`` and their working folder; a driver that put the
    package on its own path only (a notebook, a script run from elsewhere)
    would leave them without it.
    """
    root = Path(__file__).resolve().parents[1]
    app = spark.sparkContext.applicationId
    found = {Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p} | {Path.cwd()}
    if root in found or app in _shipped:
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/linkflow", "zip", root, "linkflow")
    spark.sparkContext.addPyFile(archive)  # executors fetch it from the driver
    _shipped.add(app)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables and stream checkpoints.

    Uses the cluster's ``spark.checkpoint.dir`` (must be on shared storage).
    Only a local session (tests) that has none gets a private directory,
    registered as the checkpoint directory; on a cluster executors would not
    share it, so there the setting is required.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = sc.getCheckpointDir()
    if not d and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="linkflow-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of :func:`scratch_root` for one run."""
    root = scratch_root(spark).rstrip("/")
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


_scratch: dict[str, list[str]] = {}


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders that this application has made so far.

    For the end of a job, or between jobs: frames that still read such a
    folder (a query's lazy result) must have been used or written before.
    Returns the number of folders deleted."""
    sc = spark.sparkContext
    n = 0
    for p in _scratch.pop(sc.applicationId, []):
        path = sc._jvm.org.apache.hadoop.fs.Path(p)
        n += bool(path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True))
    return n
