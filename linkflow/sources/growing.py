"""Landing files that grow: a streaming source of the lines appended to them.

``spark.readStream.format("growing_lines")`` gives the whole lines that were
appended to the files of a landing folder since the last micro-batch, also to
files that earlier micro-batches have read.  A *ledger* says how many bytes of
each file are read.  Options: ``path`` (the folder), ``pattern`` (of the entries
below it, files or folders of part files; default ``*.jsonl``), ``ledger`` (a
folder that belongs to one query, on shared storage) and ``splitBytes``.

* The stream's offset is the number of a ledger file, which is written before the
  offset is used.  A restarted query gets the same byte ranges for the same
  offsets, whatever was appended meanwhile; unused ledgers are deleted.
* A range ends at the last line feed: a line that is still being written waits
  for the next micro-batch.
* Ranges are cut into splits of ``splitBytes``.  A split reads the lines that
  start in it, so a large file is many tasks' work.
* A file that has become shorter was replaced and is read from its start.

Paths are read with Arrow's file systems (local and mounted folders, ``hdfs://``,
``s3://``, ``gs://``).  The driver lists the folder; it reads no more of a file
than back to its last line feed.
"""

from __future__ import annotations

import json
import os
import posixpath
import uuid
from collections.abc import Iterator
from fnmatch import fnmatch

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FORMAT = "growing_lines"
SPLIT_BYTES = 32 << 20
BATCH_BYTES = 4 << 20
TAIL_BYTES = 1 << 16

SCHEMA = "value string, source_file string, start bigint"


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    if "://" in uri or uri.startswith("file:"):
        scheme, _, rest = uri.partition(":")
        if scheme == "file":
            return fs.LocalFileSystem(), "/" + rest.lstrip("/")
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), os.path.abspath(uri)


class Landing:
    """The growing files of a folder."""

    def __init__(self, options: dict):
        self.uri, self.pattern = options["path"].rstrip("/"), options.get("pattern", "*.jsonl")
        self.fs, self.root = open_fs(self.uri)

    def sizes(self) -> dict[str, int]:
        """Bytes of each file, by its path below the folder."""
        out = {}
        for f in self.fs.get_file_info(fs.FileSelector(self.root, allow_not_found=True, recursive=True)):
            name = posixpath.relpath(f.path, self.root)
            parts = name.split("/")
            if f.is_file and fnmatch(parts[0], self.pattern) and not parts[-1].startswith(("_", ".")):
                out[name] = f.size
        return out

    def last_line_end(self, name: str, start: int, size: int) -> int:
        """Where the last whole line between two positions ends; ``start`` if there is none."""
        with self.fs.open_input_file(f"{self.root}/{name}") as f:
            while size > start:
                low = max(start, size - TAIL_BYTES)
                f.seek(low)
                at = f.read(size - low).rfind(b"\n")
                if at >= 0:
                    return low + at + 1
                size = low
        return start

    def read_to(self, done: dict[str, int]) -> dict[str, int]:
        """How far each file can be read now, given how far it is read."""
        out = {}
        for name, size in self.sizes().items():
            start = done.get(name, 0)
            out[name] = self.last_line_end(name, start if start <= size else 0, size) if size != start else start
        return out

    def splits(self, done: dict[str, int], to: dict[str, int], step: int) -> list[Split]:
        out = []
        for name, end in sorted(to.items()):
            start = done.get(name, 0)
            start = start if start <= end else 0
            out += [Split(name, start, a, min(a + step, end), end) for a in range(start, end, step)]
        return out

    def blocks(self, split: Split) -> Iterator[tuple[np.ndarray, pa.Array]]:
        """(positions, lines) of the lines that start in a split, a block of bytes at a time."""
        # inside a range the first line end is looked for from the byte before
        first = split.low > split.start
        at, held = split.low - first, b""
        with self.fs.open_input_file(f"{self.root}/{split.name}") as f:
            f.seek(at)
            while at < split.high:
                more = f.read(min(BATCH_BYTES, split.end - at - len(held)))
                if not more:
                    return
                block = held + more
                cut = block.rfind(b"\n") + 1
                held = block[cut:]
                if not cut:
                    continue
                data = np.frombuffer(block, np.uint8, cut)
                ends = np.flatnonzero(data == ord("\n")) + 1
                bounds = np.concatenate([[0], ends])
                # of lines that start at the bounds: without a first part, up to the split's end
                bounds = bounds[int(first):np.searchsorted(bounds[:-1], split.high - at) + 1]
                first = False
                if len(bounds) > 1:
                    text = data[bounds[0]:bounds[-1]]
                    offsets = bounds - bounds[0] - np.arange(len(bounds))  # without the line ends
                    yield at + bounds[:-1], pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [
                        None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(text[text != ord("\n")])])
                at += cut

    def lines(self, split: Split) -> Iterator[tuple[int, bytes]]:
        """(position, line) of the lines that start in a split."""
        for start, text in self.blocks(split):
            yield from zip(start.tolist(), text.to_pylist(), strict=True)


class Split(InputPartition):
    """The lines of a file that start in [low, high), of the range [start, end)."""

    def __init__(self, name: str, start: int, low: int, high: int, end: int):
        self.name, self.start, self.low, self.high, self.end = name, start, low, high, end


def _batches(options: dict, split: Split | None) -> Iterator[pa.RecordBatch]:
    if split is None:  # there is no split at all
        return
    name = split.name.split("/")[0]
    for start, text in Landing(options).blocks(split):
        yield pa.RecordBatch.from_arrays([_decoded(text), pa.repeat(name, len(text)), pa.array(start, pa.int64())],
                                         ["value", "source_file", "start"])


def _decoded(text: pa.Array) -> pa.Array:
    try:
        return text.cast(pa.string())
    except pa.ArrowInvalid:  # bytes that are no UTF-8
        return pa.array([v.decode("utf-8", "replace") for v in text.to_pylist()], pa.string())


class Ledger:
    """How far each file is read, by version, in a folder of its own."""

    def __init__(self, uri: str):
        self.fs, self.root = open_fs(uri.rstrip("/"))

    def versions(self) -> list[int]:
        found = self.fs.get_file_info(fs.FileSelector(self.root, allow_not_found=True))
        return sorted(int(f.base_name[:-5]) for f in found if f.is_file and f.base_name.endswith(".json"))

    def load(self, version: int) -> dict[str, int]:
        if not version:
            return {}
        with self.fs.open_input_stream(f"{self.root}/{version:012d}.json") as f:
            return json.loads(f.read())

    def save(self, version: int, done: dict[str, int]) -> None:
        self.fs.create_dir(self.root, recursive=True)
        new = f"{self.root}/.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(new) as f:
            f.write(json.dumps(done).encode())
        self.fs.move(new, f"{self.root}/{version:012d}.json")

    def forget(self, before: int) -> None:
        for v in self.versions():
            if v < before:
                self.fs.delete_file(f"{self.root}/{v:012d}.json")


class GrowingStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = {k.lower(): v for k, v in options.items()}
        self.step = int(self.options.get("splitbytes", SPLIT_BYTES))

    def initialOffset(self) -> dict:  # noqa: N802
        return {"ledger": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        """A new ledger version if a whole line was added, else the newest there is."""
        ledger = Ledger(self.options["ledger"])
        newest = (ledger.versions() or [0])[-1]
        done = ledger.load(newest)
        to = done | Landing(self.options).read_to(done)
        if to != done:
            newest += 1
            ledger.save(newest, to)
        return {"ledger": newest}

    def partitions(self, start: dict, end: dict) -> list[Split]:
        ledger = Ledger(self.options["ledger"])
        return Landing(self.options).splits(ledger.load(start["ledger"]), ledger.load(end["ledger"]), self.step)

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        return _batches(self.options, partition)

    def commit(self, end: dict) -> None:
        Ledger(self.options["ledger"]).forget(end["ledger"])


class GrowingRange(DataSourceReader):
    """The same lines as a batch, between two ledger versions (``from``, ``to``; default: all there is)."""

    def __init__(self, options: dict):
        self.options = {k.lower(): v for k, v in options.items()}

    def partitions(self) -> list[Split]:
        landing = Landing(self.options)
        ledger = Ledger(self.options["ledger"]) if "ledger" in self.options else None
        done = ledger.load(int(self.options["from"])) if "from" in self.options else {}
        to = ledger.load(int(self.options["to"])) if "to" in self.options else landing.read_to(done)
        return landing.splits(done, to, int(self.options.get("splitbytes", SPLIT_BYTES)))

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        return _batches(self.options, partition)


class GrowingLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> GrowingStream:  # noqa: N802
        return GrowingStream(self.options)

    def reader(self, schema) -> GrowingRange:
        return GrowingRange(self.options)


def _registered(spark: SparkSession) -> SparkSession:
    from linkflow.session import prepare_session, ship_package
    ship_package(prepare_session(spark))
    spark.dataSource.register(GrowingLines)
    return spark


def growing_stream(spark: SparkSession, folder: str, ledger: str, pattern: str = "*.jsonl",
                   split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Stream of (value, source_file, start): the lines appended to a folder's files."""
    return _registered(spark).readStream.format(FORMAT) \
        .options(path=folder, pattern=pattern, ledger=ledger, splitBytes=split_bytes).load()


def growing_range(spark: SparkSession, folder: str, ledger: str | None = None, since: int | None = None,
                  upto: int | None = None, pattern: str = "*.jsonl", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The lines between two ledger versions (default: from the start, to all there is) as a batch."""
    known = {"ledger": ledger, "from": since, "to": upto}
    return _registered(spark).read.format(FORMAT).options(path=folder, pattern=pattern, splitBytes=split_bytes) \
        .options(**{k: v for k, v in known.items() if v is not None}).load()


def append_lines(lines: DataFrame, folder: str, name: str) -> None:
    """Appends a frame of single lines to the part files of landing file ``name``.

    Each task appends to a part of its own.  A repeated task appends its lines
    again (loads ignore known transport ids); a line that a lost task left
    unfinished is ended first, and skipped by the scanners.
    """
    import pyspark

    def write(batches):
        where, root = open_fs(folder)
        where.create_dir(f"{root}/{name}", recursive=True)
        part = f"{root}/{name}/part-{pyspark.TaskContext.get().partitionId():05d}.jsonl"
        info = where.get_file_info(part)
        whole = True
        if info.is_file and info.size:
            with where.open_input_file(part) as f:
                f.seek(info.size - 1)
                whole = f.read(1) == b"\n"
        n = 0
        with where.open_append_stream(part) as out:
            if not whole:
                out.write(b"\n")
            for batch in batches:
                if batch.num_rows:
                    out.write("\n".join(batch.column(0).to_pylist()).encode() + b"\n")
                    n += batch.num_rows
        yield pa.RecordBatch.from_pydict({"n": [n]})

    lines.toDF("value").mapInArrow(write, "n bigint").agg({"n": "sum"}).collect()
