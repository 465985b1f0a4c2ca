"""Best-fit packing by exact-complement hashing.

Documents become token pieces of at most ``capacity`` tokens.  Only the number
of pieces of each length decides the packing, so the plan is made from that
histogram, which has at most ``capacity`` rows whatever the input:

1. Take the longest length left.  Look up the gap it leaves in an index of the
   lengths, of the sums of two lengths and of three; a combination that fills
   the gap exactly is consumed as often as the counts allow.
2. What no combination fills is packed best fit: the longest piece that still
   fits goes next, until nothing fits.

The plan is a list of runs "``count`` sequences that hold these lengths".  The
pieces of one length are ranked without gathering them in one task, and a
piece's rank says which run, sequence and offset it has.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkflow.llm.common import ranked, saved
from linkflow.llm.subwords import encoder
from linkflow.llm.token_counts import VOCAB

_PIECE = "struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint{ids}>"


def pieces(text: Column, vocab: str = VOCAB, capacity: int = 2048, end_id: int = 0,
           with_ids: bool = False) -> Column:
    """Array of a text's pieces: its ids and then ``end_id``, cut every ``capacity``."""

    @F.arrow_udf(f"array<{_PIECE.format(ids=',ids:array<int>' if with_ids else '')}>")
    def cut(texts: pa.Array) -> pa.Array:
        flat, bounds = encoder(vocab).ids(texts)
        # every text's ids are followed by one end id
        n = np.diff(bounds) + 1
        ends = np.cumsum(n)
        closed = np.full(ends[-1] if len(ends) else 0, end_id, np.uint32)
        kept = np.ones(len(closed), bool)
        kept[ends - 1] = False
        closed[kept] = flat
        per_text = -(-n // capacity)
        offsets = np.concatenate([[0], np.cumsum(per_text)])
        piece = np.arange(offsets[-1]) - np.repeat(offsets[:-1], per_text)
        start = piece * capacity
        length = np.minimum(capacity, np.repeat(n, per_text) - start)
        at = np.repeat(ends - n, per_text) + start
        raw = memoryview(closed.astype("<u4").tobytes())
        crc = [zlib.crc32(raw[4 * a:4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist(), strict=True)]
        columns = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                   pa.array(crc, pa.int64())]
        names = ["piece", "start", "length", "ids_crc32"]
        if with_ids:
            # the pieces lie end to end in ``closed``
            columns.append(pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(length)]).astype(np.int32),
                                                    pa.array(closed.astype(np.int32), pa.int32())))
            names.append("ids")
        return pa.ListArray.from_arrays(offsets.astype(np.int32), pa.StructArray.from_arrays(columns, names))

    return cut(text)


class _Sums:
    """Which gaps single lengths, pairs and triples of available lengths fill."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        size = len(counts)
        have = np.flatnonzero(counts).astype(np.int64)
        #: number of pairs x <= y of available lengths, by their sum
        self.pairs = np.zeros(size, np.int64)
        for x in have:
            y = have[(have >= x) & (have + x < size)]
            self.pairs[x + y] += 1

    def gone(self, x: int) -> None:
        """``x`` has run out: its pairs leave the index."""
        size = len(self.counts)
        partners = np.flatnonzero(self.counts[:max(0, size - x)])
        self.pairs[partners + x] -= 1
        if 2 * x < size:
            self.pairs[2 * x] -= 1

    def fill(self, gap: int) -> list[int] | None:
        """One, two or three available lengths that sum to ``gap``, the longest first."""
        c = self.counts
        if c[gap]:
            return [gap]
        if two := self._pair(gap):
            return two
        for x in np.flatnonzero(c[:gap + 1])[::-1]:
            rest = gap - int(x)
            if rest and self.pairs[rest] and (two := self._pair(rest)):
                three = [int(x), *two]
                if all(c[v] >= three.count(v) for v in three):
                    return three
        return None

    def _pair(self, gap: int) -> list[int] | None:
        if not self.pairs[gap]:
            return None
        c = self.counts
        x = np.arange(gap - gap // 2, gap)
        for v in x[(c[x] > 0) & (c[gap - x] > 0)][::-1]:
            v = int(v)
            if 2 * v != gap or c[v] >= 2:
                return [v, gap - v]
        return None


def plan_packing(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Runs (lengths of a sequence, number of such sequences) that use every piece.

    ``histogram``: number of pieces by length, lengths from 1 to ``capacity``.
    Each step uses up a length or leaves at most two pieces of it, so there are
    a few steps per distinct length, however many pieces there are.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    runs: list[tuple[list[int], int]] = []
    if counts[capacity]:
        runs.append(([capacity], int(counts[capacity])))
        counts[capacity] = 0
    sums = _Sums(counts)

    def use(lengths: list[int]) -> None:
        times = min(int(counts[v]) // lengths.count(v) for v in set(lengths))
        runs.append((lengths, times))
        for v in set(lengths):
            counts[v] -= times * lengths.count(v)
            if not counts[v]:
                sums.gone(v)

    left = []  # lengths that no combination completes
    for a in range(capacity - 1, 0, -1):
        while counts[a]:
            counts[a] -= 1  # a combination may need the same length again
            if not counts[a]:
                sums.gone(a)
            found = sums.fill(capacity - a)
            if counts[a] == 0:
                sums.pairs += _pairs_of(counts, a)
            counts[a] += 1
            if found is None:
                left.append((a, int(counts[a])))
                counts[a] = 0
                sums.gone(a)
            else:
                use([a, *found])
    for a, n in left:
        counts[a] = n
    top = capacity - 1
    while True:
        while top and not counts[top]:
            top -= 1
        if not top:
            return runs
        lengths, gap = [top], capacity - top
        counts[top] -= 1
        while gap and (fits := np.flatnonzero(counts[:gap + 1])).size:
            v = int(fits[-1])
            lengths.append(v)
            counts[v] -= 1
            gap -= v
        for v in lengths:
            counts[v] += 1
        times = min(int(counts[v]) // lengths.count(v) for v in set(lengths))
        for v in set(lengths):
            counts[v] -= times * lengths.count(v)
        runs.append((lengths, times))


def _pairs_of(counts: np.ndarray, x: int) -> np.ndarray:
    """The pairs that ``x``, just out, adds to the index when it comes back."""
    out, size = np.zeros(len(counts), np.int64), len(counts)
    out[np.flatnonzero(counts[:max(0, size - x)]) + x] += 1
    if 2 * x < size:
        out[2 * x] += 1
    return out


def _slots(runs: list[tuple[list[int], int]], capacity: int):
    """For each stretch of a length's ranks: (key, first rank, first sequence, copies, offset).

    A run with a length ``k`` times gives the ranks of each copy in turn.
    Sorted by key = length << 40 | first rank, ready for a binary search.
    """
    used = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for lengths, times in runs:
        offset = 0
        for v in lengths:
            rows.append(((v << 40) + int(used[v]), sequence, offset))
            used[v] += times
            offset += v
        sequence += times
    rows.sort()
    return np.array(rows, dtype=np.int64).reshape(-1, 3)


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str = VOCAB,
         capacity: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """A row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Only documents longer than ``capacity`` are cut; offsets within a sequence
    run without gaps from 0.  ``with_ids`` adds each piece's ids, so that the
    rows of a sequence in offset order are the packed sequence itself.

    Null and empty texts are the end id alone.  Ids are passed through; with
    null or repeated ids, or repeated rows, every row is packed as a document
    of its own (pieces equal in every column are interchangeable).  An empty
    table gives no rows.  Other columns are not read.

    The only data at the driver is the histogram: at most ``capacity`` rows.
    """
    cut = F.explode(pieces(F.col(text_col), vocab, capacity, end_id, with_ids))
    parts = saved(df.select(F.col(id_col), cut.alias("p")).select(id_col, "p.*"), "packing-pieces")
    histogram = {r["length"]: r["n"] for r in
                 parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = _slots(plan_packing(histogram, capacity), capacity)

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        key = (np.asarray(length).astype(np.int64) << 40) + np.asarray(rank).astype(np.int64)
        found = slots[np.searchsorted(slots[:, 0], key, side="right") - 1] if len(key) else slots[:0]
        return pa.StructArray.from_arrays([pa.array(found[:, 1] + key - found[:, 0], pa.int64()),
                                           pa.array(found[:, 2], pa.int64())], ["sequence_id", "offset"])

    ident = [id_col, "piece", "start", "ids_crc32"]
    placed = ranked(parts, ["length"], ident, "rank__")
    return (placed.withColumn("at__", place("length", "rank__"))
            .select(*parts.columns, "at__.sequence_id", "at__.offset"))
