"""Line de-duplication over levelled sorted runs of line hashes.

A line's key is the line stripped of white space, A-Z lower-cased; it stands as
the 128-bit hash of its bytes.  Documents come in batches, those with greater ids
first.  ``LineRuns`` keeps what the batches so far held:

* A *run* is a table of (key, n, holder), sorted by key within hash buckets: in
  how many documents the key was found, and the greatest of their ids.  All runs
  have the same buckets, so a batch is shuffled to them once and merge-joined
  with every run as it lies; no run is shuffled or sorted again.
* Each new batch is anti-joined with the runs: keys that a run has settled (found
  in ``min_docs`` documents) are known to repeat, and their holder is among the
  earlier, greater ids, so nothing more needs to be known of them.  What is left
  is the batch's own run, at level 0.
* Where a level has ``fanout`` runs, they are compacted to one of the next level,
  adding up the counts.  So there are at most ``fanout - 1`` runs a level, a key
  is rewritten once a level, and keys settle as their counts meet.

At the end all runs are merged.  Keys of ``min_docs`` documents lose their lines
outside the holder.  Of those keys at most ``HEAVY`` can each hold more than one
in ``HEAVY`` of all lines; these are joined as a small table, all others by a
shuffle in which no key is hot.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkflow.llm.common import fresh, saved
from linkflow.session import scratch_path

#: Keys of a larger share of all lines are joined as a small table: at most so many.
HEAVY = 2000

#: Bytes that continue a code point.
CONTINUE = bytes(range(0x80, 0xC0))


def line_key(line: bytes) -> bytes:
    """A line stripped of ASCII white space, A-Z lower-cased."""
    return line.strip().lower()


def long_enough(key: bytes, least: int) -> bool:
    """Whether a key has ``least`` code points."""
    return len(key) >= least and (len(key) >= 4 * least or len(key.translate(None, CONTINUE)) >= least)


def line_keys(text: Column, min_chars: int) -> Column:
    """The hashes of each text's distinct keys of at least ``min_chars`` code points."""

    @F.arrow_udf("array<binary>")
    def keys(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.cast(pa.binary()):
            found = {k for line in (t.as_py() or b"").split(b"\n") if long_enough(k := line_key(line), min_chars)}
            out.append([xxhash.xxh3_128_digest(k) for k in found])
        return pa.array(out, pa.list_(pa.binary()))

    return keys(text)


class LineRuns:
    """The runs of all batches so far, in a folder that all executors share."""

    def __init__(self, spark: SparkSession, min_docs: int = 5, fanout: int = 3, buckets: int | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.root = scratch_path(spark, "line-runs")
        self.levels: list[list[str]] = []
        self.made: dict[str, str] = {}  # where each run lies

    def _write(self, rows: DataFrame, level: int) -> None:
        """A run of its own at a level; a full level is compacted into the next."""
        name = f"line_run_{uuid.uuid4().hex[:12]}"
        path = self.made[name] = f"{self.root}/level={level}/{name}"
        rows.select("key", "n", "holder").write.bucketBy(self.buckets, "key").sortBy("key") \
            .option("path", path).saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(self._merged(full), level + 1)
            for old in full:
                self._drop(old)

    def _drop(self, name: str) -> None:
        """Forgets a run; its files go with it."""
        sc = self.spark.sparkContext
        self.spark.sql(f"DROP TABLE {name}")
        folder = sc._jvm.org.apache.hadoop.fs.Path(self.made.pop(name))
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)

    def _merged(self, names: list[str]) -> DataFrame:
        # read as plain files: Spark 4.1 takes a columnar union of bucketed tables for
        # bucketed, which it is not, and would leave the same key in two tasks
        kind = self.spark.table(names[0]).schema
        rows = self.spark.read.schema(kind).parquet(*[self.made[name] for name in names])
        return rows.groupBy("key").agg(F.sum("n").alias("n"), F.max("holder").alias("holder"))

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def add(self, lines: DataFrame) -> None:
        """Adds a batch: (key, id), one row per document and key.

        All its ids are smaller than those of earlier batches, or equal to the smallest.
        """
        own = lines.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("holder"))
        for name in self.runs():
            settled = self.spark.table(name).filter(F.col("n") >= self.min_docs).select("key")
            own = own.join(settled.hint("merge"), "key", "left_anti")
        self._write(own, 0)

    def repeated(self) -> DataFrame:
        """(key, n, holder) of the keys of at least ``min_docs`` documents.

        ``n`` leaves out documents that came after a run had settled the key.
        """
        return self._merged(self.runs()).filter(F.col("n") >= self.min_docs)

    def close(self) -> None:
        """Takes the runs out of the catalog and deletes them."""
        for name in list(self.made):
            self._drop(name)


def _digests(rows: DataFrame, id_col: str) -> DataFrame:
    """(id, text, drop) -> (id, n_lines, n_dropped, kept_sha256)."""
    names = [id_col, "n_lines", "n_dropped", "kept_sha256"]
    kind = rows.schema[0].dataType.simpleString()

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, digest = [], [], []
            for t, d in zip(batch.column(1).cast(pa.binary()), batch.column(2).to_pylist(), strict=True):
                raw = t.as_py() or b""
                lines = raw.count(b"\n") + 1
                dropped = 0
                if d:
                    out, drop = [], set(d)
                    for line in raw.split(b"\n"):
                        if xxhash.xxh3_128_digest(line_key(line)) not in drop:
                            out.append(line)
                    dropped, raw = lines - len(out), b"\n".join(out)
                total.append(lines)
                gone.append(dropped)
                digest.append(hashlib.sha256(raw).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()),
                                              pa.array(gone, pa.int64()), pa.array(digest, pa.string())], names)

    return rows.mapInArrow(kept, f"`{id_col}` {kind}, n_lines bigint, n_dropped bigint, kept_sha256 string")


def _marked(df: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int, batches: int) -> tuple:
    """(rows with their key, key column, (row key, id, keys to drop))."""
    spark = df.sparkSession
    mark = fresh(df, "row__")
    marked = df.withColumn(mark, F.xxhash64(id_col, text_col, F.col(text_col).isNull()))
    # documents by id, greatest first, in batches of even size; null ids come last
    cuts = df.select(F.percentile_approx(id_col, [i / batches for i in range(1, batches)], 1000)).first()[0] or []
    batch = F.lit(0)
    for cut in set(cuts):
        batch = batch + F.coalesce(F.col("id") <= F.lit(cut), F.lit(True)).cast("int")
    held = marked.select(F.col(mark).alias("row"), F.col(id_col).alias("id"),
                         line_keys(F.col(text_col), min_chars).alias("keys"))
    held = held.withColumn("batch", batch)
    path = scratch_path(spark, "line-keys")
    held.write.partitionBy("batch").parquet(path)
    found = spark.read.schema(held.schema).parquet(path)

    runs = LineRuns(spark, min_docs)
    for i in range(len(set(cuts)) + 1):
        runs.add(found.filter(F.col("batch") == i).select("id", F.explode("keys").alias("key")))
    repeated = saved(runs.repeated(), "line-repeats")
    runs.close()

    lines = found.select("row", "id", F.explode("keys").alias("key"))
    all_lines = found.select(F.sum(F.size("keys")).alias("n")).first().n or 0
    often = F.col("n") * HEAVY > all_lines  # fewer than HEAVY keys
    heavy = F.broadcast(repeated.filter(often).select("key", "holder"))
    light = repeated.filter(~often).select("key", "holder")
    hit = lines.join(heavy, "key").unionByName(lines.join(heavy.select("key"), "key", "left_anti").join(light, "key"))
    drop = hit.filter(~F.col("id").eqNullSafe(F.col("holder"))).groupBy("row", "id").agg(F.collect_set("key").alias("drop"))
    return marked, mark, drop


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
                min_docs: int = 5, batches: int = 6) -> DataFrame:
    """(id, n_lines, n_dropped, kept_sha256) of every row.

    Lines whose key has at least ``min_chars`` code points and is found in at
    least ``min_docs`` documents go, except in the document with the greatest id
    that holds it; the other lines stay, joined by line feeds.

    Null and empty texts are one empty line.  Every row is a document, repeated
    rows too; rows that share the greatest id all keep the line, and a null id is
    smaller than any other.  Very long texts are read whole.  An empty table gives
    no rows.  Other columns are not read, so their names cannot clash.
    """
    rows = df.select(F.col(id_col), F.col(text_col).alias(f"{id_col}_text"))
    text = f"{id_col}_text"
    marked, mark, drop = _marked(rows, id_col, text, min_chars, min_docs, batches)
    met = marked.join(drop.withColumnRenamed("id", "id_of_drop"),
                      (F.col(mark) == F.col("row")) & F.col(id_col).eqNullSafe(F.col("id_of_drop")), "left")
    return _digests(met.select(F.col(id_col), text, "drop"), id_col)
