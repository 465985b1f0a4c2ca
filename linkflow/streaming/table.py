"""Tables that last under micro-batches: files by bucket, and a pointer to the current ones.

``<root>/data/version=<n>/bucket=<value>/`` holds the rows that version ``n``
wrote of a bucket (a function of a row's keys: a day, a block of offsets, a hash).
``<root>/versions/<n>.json`` is the pointer: the folders of every bucket and the
last micro-batch that went in.  It appears in one step, by a rename, when all
files of its version are there, so

* readers follow the newest pointer and see whole micro-batches only;
* a retried micro-batch that is already in changes nothing, and one that failed
  half way writes its version anew;
* a micro-batch reads and rewrites the buckets that it touches, not the table.

The last ``keep`` versions stay readable; folders that only older ones name are
deleted.  A bucket has at most ``fanout`` folders, then it is compacted.  So the
number of folders is bounded by the buckets, whatever the number of batches.
One query writes a table; any number read it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkflow.operators.latest import first_by, insert_only, latest_by

BUCKET, VERSION = "bucket", "version"

#: Offsets of a block: runs of offsets are cut at the ends of blocks, and runs of
#: equal blocks are compared with each other.
BLOCK = 1 << 8
#: Offsets of a bucket of an ``OffsetTable``.
BUCKET_OFFSETS = 1 << 24


class Files:
    """The few file operations of a table, on whatever file system its path names."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The whole file, or none of it."""
        new = self.path(f"{name}.{uuid.uuid4().hex}.new")
        stream = self.fs.create(new)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.fs.rename(new, self.path(name)):
            raise FileExistsError(f"{self.root}/{name}")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def move(self, name: str, to: str) -> None:
        self.delete(to)  # of a version that was never committed
        self.fs.mkdirs(self.path(to).getParent())
        if not self.fs.rename(self.path(name), self.path(to)):
            raise FileExistsError(f"{self.root}/{to}")


@dataclass
class Pointer:
    """One version: which folders (by version) hold each bucket."""

    version: int = 0
    batch: int = -1
    schema: dict | None = None
    folders: dict[str, list[int]] = field(default_factory=dict)

    def named(self) -> set[tuple[int, str]]:
        return {(v, b) for b, versions in self.folders.items() for v in versions}


class VersionedTable:
    """``bucket``: a column expression over the table's rows."""

    def __init__(self, spark: SparkSession, root: str, bucket: Column | None = None, keep: int = 4, fanout: int = 8):
        self.spark, self.root = spark, root.rstrip("/")
        self.bucket = F.lit(0) if bucket is None else bucket
        self.keep, self.fanout = keep, fanout
        self.files = Files(spark, self.root)

    # ------------------------------------------------------------ pointers
    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names("versions") if n.endswith(".json") and n[0] != ".")

    def pointer(self, version: int | None = None) -> Pointer:
        """A version's pointer, by default the newest."""
        all_ = self.versions()
        if not all_:
            return Pointer()
        return Pointer(**json.loads(self.files.read(f"versions/{(version or all_[-1]):012d}.json")))

    def as_of(self, batch: int) -> Pointer:
        """The newest kept version of the batches up to ``batch``."""
        for v in reversed(self.versions()):
            if (p := self.pointer(v)).batch <= batch:
                return p
        return Pointer()

    def first_of(self, batch: int) -> Pointer:
        """The version that a kept batch made, before any compaction."""
        return next((p for p in map(self.pointer, self.versions()) if p.batch == batch), self.as_of(batch))

    def changed(self, batch: int) -> tuple[list[str], Pointer, Pointer]:
        """(buckets that a kept batch changed, the table before it, the table after it)."""
        before, after = self.as_of(batch - 1), self.first_of(batch)
        buckets = [b for b in {**before.folders, **after.folders} if before.folders.get(b) != after.folders.get(b)]
        return sorted(buckets), before, after

    def _commit(self, old: Pointer, schema: T.StructType | None, folders: dict[str, list[int]], batch: int) -> None:
        new = Pointer(old.version + 1, batch, json.loads(schema.json()) if schema is not None else old.schema, folders)
        if all(v != new.version for v, _ in new.named()):  # nothing was new
            self.files.delete(self._folder(old))
        self.files.write(f"versions/{new.version:012d}.json", json.dumps(vars(new)))
        self._clean(new.version)

    def _clean(self, newest: int) -> None:
        """Deletes what only versions before the kept ones name."""
        old = [v for v in self.versions() if v <= newest - self.keep]
        if not old:
            return
        kept = set().union(*(self.pointer(v).named() for v in self.versions() if v > newest - self.keep))
        alive = {v for v, _ in kept}
        for v in old:
            for version, bucket in self.pointer(v).named() - kept:
                gone = f"data/{VERSION}={version}"
                self.files.delete(f"{gone}/{bucket}" if version in alive else gone)
            self.files.delete(f"versions/{v:012d}.json")

    # ------------------------------------------------------------ reading
    def read(self, buckets: Iterable[str] | None = None, pointer: Pointer | None = None,
             folders: Iterable[tuple[int, str]] | None = None) -> DataFrame | None:
        """The rows of a version (of some buckets, or some folders); None: nothing was ever written.

        The bucket is a partition column of the files: a filter on it reads its folders only.
        """
        p = pointer or self.pointer()
        if p.schema is None:
            return None
        some = p.named() if folders is None else set(folders)
        if buckets is not None:
            some = {x for x in some if x[1] in set(buckets)}
        schema = T.StructType.fromJson(p.schema)
        if not some:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/data/{VERSION}={v}/{b}" for v, b in sorted(some)]
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths)
        return rows.drop(VERSION)

    def rows(self, **kw) -> DataFrame:
        """What ``read`` gives, without the bucket column."""
        return self.read(**kw).drop(BUCKET)

    # ------------------------------------------------------------ writing
    def _write(self, rows: DataFrame, folder: str) -> list[str]:
        """Writes rows by bucket; the names of the bucket folders."""
        by = rows.withColumn(BUCKET, self.bucket.cast("string")).hint("rebalance", BUCKET)
        by.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.root}/{folder}")
        return [n for n in self.files.names(folder) if n.startswith(f"{BUCKET}=")]

    def _staged(self, rows: DataFrame, old: Pointer) -> tuple[DataFrame, list[str]]:
        """The batch, written once, and the buckets that it touches."""
        stage = self._stage(old)
        touched = self._write(rows, stage)
        return self.spark.read.schema(rows.schema).parquet(f"{self.root}/{stage}").drop(BUCKET), touched

    @staticmethod
    def _stage(old: Pointer) -> str:
        return f"staged/{old.version + 1}"

    @staticmethod
    def _folder(old: Pointer) -> str:
        return f"data/{VERSION}={old.version + 1}"

    def append(self, rows: DataFrame, batch: int) -> bool:
        """Adds rows.  All writers return False, and do nothing, if the batch is in already."""
        old = self.pointer()
        if batch <= old.batch:
            return False
        made = self._write(rows, self._folder(old))
        self._commit(old, rows.schema, self._added(old, made), batch)
        self._compact()
        return True

    @staticmethod
    def _added(old: Pointer, made: Iterable[str]) -> dict[str, list[int]]:
        return old.folders | {b: [*old.folders.get(b, []), old.version + 1] for b in made}

    def _compact(self) -> None:
        """One folder for each bucket that has more than ``fanout``."""
        old = self.pointer()
        full = [b for b, versions in old.folders.items() if len(versions) > self.fanout]
        if full:
            made = self._write(self.rows(buckets=full, pointer=old), self._folder(old))
            self._compacted(old)
            self._commit(old, None, old.folders | {b: [old.version + 1] for b in made}, old.batch)

    def _compacted(self, old: Pointer) -> None:
        """For tables that keep more about their versions."""

    def replace(self, rows: DataFrame, batch: int, buckets: Iterable[str] | None = None) -> bool:
        """Puts rows in the place of some buckets, or of the whole table."""
        old = self.pointer()
        if batch <= old.batch:
            return False
        made = self._write(rows, self._folder(old))
        gone = set(old.folders if buckets is None else buckets)
        stay = {b: v for b, v in old.folders.items() if b not in gone}
        self._commit(old, rows.schema, stay | {b: [old.version + 1] for b in made}, batch)
        return True

    def merge(self, rows: DataFrame, batch: int, how: Callable[[DataFrame, DataFrame], DataFrame]) -> bool:
        """Rewrites the buckets that the rows touch: ``how(rows there, new rows)``."""
        old = self.pointer()
        if batch <= old.batch:
            return False
        mine, touched = self._staged(rows, old)
        if set(touched) & set(old.folders):
            made = self._write(how(self.read(touched, old).select(*mine.columns), mine), self._folder(old))
        else:  # all is new: the batch's own files are the version's
            made = touched
            self.files.move(self._stage(old), self._folder(old))
        stay = {b: v for b, v in old.folders.items() if b not in touched}
        self._commit(old, rows.schema, stay | {b: [old.version + 1] for b in made}, batch)
        self.files.delete("staged")
        return True

    def upsert(self, rows: DataFrame, batch: int, keys: Sequence[str], order: Sequence[str] = ()) -> bool:
        """One row per key: the one last in ``order``; without an order, the batch's own."""
        if not order:
            return self.merge(rows, batch, lambda held, mine: insert_only(held, mine, keys).unionByName(mine))
        return self.merge(latest_by(rows, keys, order), batch,
                          lambda held, mine: latest_by(held.unionByName(mine), keys, order))

    def insert_first(self, rows: DataFrame, batch: int, keys: Sequence[str], order: Sequence[str]) -> bool:
        """Adds a row per key that is not there: of a batch's rows, the first in ``order``."""
        old = self.pointer()
        if batch <= old.batch:
            return False
        mine, touched = self._staged(first_by(rows, keys, order), old)
        if set(touched) & set(old.folders):
            made = self._write(insert_only(mine, self.read(touched, old), keys), self._folder(old))
        else:
            made = touched
            self.files.move(self._stage(old), self._folder(old))
        self._commit(old, rows.schema, self._added(old, made), batch)
        self.files.delete("staged")
        self._compact()
        return True

    def added(self, batch: int) -> DataFrame:
        """The rows that a kept batch added to a table that it added to."""
        before, after = self.as_of(batch - 1), self.first_of(batch)
        return self.rows(pointer=after, folders=after.named() - before.named())


def seq_runs(rows: DataFrame, range_keys: Sequence[str], seq: str, block: int = BLOCK) -> DataFrame:
    """The values of ``seq`` per ``range_keys`` as runs without gaps: (keys, block, lo, hi).

    Runs end at the ends of blocks, so a window holds a block's distinct values at
    most, however many rows a topic partition has.
    """
    s = F.col(seq).cast("bigint")
    some = rows.select(*range_keys, s.alias(seq)).filter(F.col(seq).isNotNull()) \
        .withColumn("block", F.floor(F.col(seq) / block)).dropDuplicates()
    gap = F.col(seq) - F.row_number().over(Window.partitionBy(*range_keys, "block").orderBy(seq))
    return (some.withColumn("gap", gap).groupBy(*range_keys, "block", "gap")
            .agg(F.min(seq).alias("lo"), F.max(seq).alias("hi")).drop("gap"))


class OffsetTable(VersionedTable):
    """Rows whose key is new (MERGE ... WHEN NOT MATCHED THEN INSERT), by transport id.

    Next to the rows of each version lie the runs of its offsets.  A batch meets
    the runs of earlier versions by (range keys, block) and overlap, and reads the
    keys of only those folders that hold one of its own offsets: a replay of a few
    offsets reads the versions that have them, not all between the first and the last.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str] = ("topic", "partition", "offset"),
                 bucket_offsets: int = BUCKET_OFFSETS, **kw):
        self.keys, self.range_keys, self.seq = list(keys), list(keys[:-1]), keys[-1]
        super().__init__(spark, root, F.concat_ws("-", *[F.col(k).cast("string") for k in self.range_keys],
                                                  F.floor(F.col(self.seq) / bucket_offsets).cast("string")), **kw)

    def _runs(self, rows: DataFrame, folder: str) -> DataFrame:
        path = f"{self.root}/{folder}"
        seq_runs(rows, self.range_keys, self.seq).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def colliding(self, runs: DataFrame, pointer: Pointer) -> list[tuple[int, str]]:
        """The folders of a version that hold an offset of some runs."""
        named = pointer.named()
        versions = sorted({v for v, _ in named})
        if not versions:
            return []
        theirs = self.spark.read.schema(runs.schema).option("basePath", f"{self.root}/runs") \
            .parquet(*[f"{self.root}/runs/{VERSION}={v}" for v in versions])
        met = theirs.join(runs.withColumnsRenamed({"lo": "from", "hi": "to"}), [*self.range_keys, "block"]) \
            .filter((F.col("lo") <= F.col("to")) & (F.col("hi") >= F.col("from")))
        # a row per folder at most
        found = met.withColumn(self.seq, F.greatest("lo", "from")).select(VERSION, self.bucket.alias(BUCKET)).distinct()
        name = {unquote(b.split("=", 1)[1]): b for _, b in named}
        return sorted({(r[0], name.get(r[1])) for r in found.collect()} & named)

    def insert(self, rows: DataFrame, batch: int) -> bool:
        """Adds the rows whose key is not there; repeated keys inside a batch are all new."""
        old = self.pointer()
        if batch <= old.batch:
            return False
        mine, made = self._staged(rows, old)
        runs = self._runs(mine, f"runs/{VERSION}={old.version + 1}")
        if met := self.colliding(runs, old):
            made = self._write(insert_only(mine, self.rows(folders=met, pointer=old), self.keys), self._folder(old))
        else:
            self.files.move(self._stage(old), self._folder(old))
        self._commit(old, rows.schema, self._added(old, made), batch)
        self.files.delete("staged")
        self._compact()
        return True

    def _compacted(self, old: Pointer) -> None:
        full = {b: v for b, v in old.folders.items() if len(v) > self.fanout}
        versions = sorted({v for vs in full.values() for v in vs})
        paths = [f"{self.root}/runs/{VERSION}={v}" for v in versions]
        held = self.spark.read.parquet(*paths).select(*self.range_keys, "block", "lo", "hi").dropDuplicates()
        held.write.mode("overwrite").parquet(f"{self.root}/runs/{VERSION}={old.version + 1}")

    def _clean(self, newest: int) -> None:
        super()._clean(newest)
        alive = {v for p in map(self.pointer, self.versions()) for v, _ in p.named()}
        for name in self.files.names("runs"):
            v = int(name.split("=")[1])
            if v not in alive and v <= newest - self.keep:
                self.files.delete(f"runs/{name}")
