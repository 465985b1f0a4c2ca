"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkflow.session import scratch_path

#: The characters that separate words: space, tab, line feed, vertical tab,
#: form feed, carriage return.
GAPS = " \t\n\x0b\x0c\r"
WORD_GAP = r"[ \t-\r]+"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, unless they find it as the driver does.

    Workers see ``PYTHONPATH`` and their working folder; a driver that put the
    package on its own path only (a notebook, a script run from elsewhere)
    would leave them without it.
    """
    root = Path(__file__).resolve().parents[2]
    app = spark.sparkContext.applicationId
    found = {Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p} | {Path.cwd()}
    if root in found or app in _shipped:
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/linkflow", "zip", root, "linkflow")
    spark.sparkContext.addPyFile(archive)  # executors fetch it from the driver
    _shipped.add(app)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The named columns of the ``documents`` table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    The files outlive the executor that wrote them, so later stages do not
    recompute their input when an executor is lost.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer name that no column of ``df`` has (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words(text: Column) -> Column:
    """Array of the words of a non-null text."""
    inner = F.btrim(text, F.lit(GAPS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, WORD_GAP))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    Binding it as a lambda variable keeps the optimizer from copying a costly
    expression into every place (or every array element) that refers to it.
    """
    return F.transform(F.array(value), body)[0]


def train_split(key: Column, mod: int, held: int) -> Column:
    """True for the rows held out: crc32 of the id as text mod ``mod`` is ``held``.

    A null id is never held out.
    """
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % mod == held, F.lit(False))


def looked_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` joined to ``table``, which has one row per ``key`` (a bigint), by that column.

    A merge join: a broadcast is built in the driver's memory, several times the
    size that the threshold is compared with.  Both sides are shuffled for the
    join by the complement of the key, as Spark splits a hot key's rows only if
    no aggregate stands between a shuffle and the join.
    """
    by, at = fresh(rows, "by__"), fresh(table, "at__")
    more = [c for c in table.columns if c != key]
    met = rows.withColumn(by, F.bitwise_not(key)).join(
        table.select(F.bitwise_not(key).alias(at), *more).hint("merge"), F.col(by) == F.col(at))
    return met.select(*rows.columns, *more)


def ranked(df: DataFrame, keys: list[str], ident: list[str], rank: str = "rank",
           carry: DataFrame | None = None, buckets: int = 256) -> DataFrame:
    """Adds a rank from 0 within each group of non-null ``keys``; no group is one task.

    A group is dealt over ``buckets`` by the hash of ``ident``; ranks run
    within a bucket and start at the number of rows in the group's earlier
    buckets.  The order is that of (bucket, ident): the same on every run,
    as long as rows equal in ``ident`` are interchangeable.

    ``carry`` (one row per key) is joined to the bucket counts, so its columns
    reach the rows by the same evenly spread join.  Rows whose key is not in
    ``carry`` are lost: it must hold every key.
    """
    b, n, before = "bucket__", "n__", "before__"
    dealt = df.withColumn(b, F.pmod(F.xxhash64(*ident), F.lit(buckets)).cast("int"))
    per_bucket = Window.partitionBy(*keys, b)
    rows = dealt.withColumn(rank, F.row_number().over(per_bucket.orderBy(*ident)) - 1)
    sizes = dealt.groupBy(*keys, b).agg(F.count(F.lit(1)).alias(n))
    ahead = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.withColumn(before, F.coalesce(F.sum(n).over(ahead), F.lit(0))).drop(n)
    more = []
    if carry is not None:
        more = [c for c in carry.columns if c not in keys]
        base = base.join(carry, keys)
    # a merge join: the rows are sorted by its key already, and nothing is broadcast
    out = rows.join(base.hint("merge"), [*keys, b]).withColumn(rank, F.col(rank) + F.col(before))
    return out.select(*df.columns, rank, *more)
