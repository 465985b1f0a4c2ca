"""Periodic runs of words by dyadic square catching.

A *run* is a stretch of words with smallest period ``q`` that no neighbouring
word extends, at least ``times * q`` and ``least`` words long.

Words are appended one after another.  For every power of two ``B`` a catcher
stands over each completed aligned block of ``B`` words, for the periods from
``B`` to ``2B - 1``.  With each appended word, the suffix of the last ``B``
words has moved to a new distance from the blocks before it, and exactly one
block of that size stands at a distance in ``[B, 2B)``: its catcher compares
itself with the suffix.  Equal: the block repeats at that distance.  A run holds
at least ``(times - 1) * B`` words that repeat, so with ``times = 4`` it holds
two neighbouring blocks that both repeat: a square is reported where two
neighbouring catchers hold at the same distance.  Squares of one distance that
follow on each other merge, and are widened by fewer than ``B`` words on either
side, until a word breaks the period.  A stretch that was caught at a multiple of
its period was caught at the period too, with the same ends, and counts once.

The suffix comparisons of all appended words of a size are one comparison of
two arrays: words are random 64-bit values, a suffix is compared by its rolling
hash, and the texts of a batch are laid out one after the other with a mark of
its own after each.  Runs are verified on the words; where the hash was wrong,
the stretches are compared word by word.  Time is n log n, memory is linear.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkflow.llm.subwords import by_bytes

# The odd multiplier of the rolling hash and its inverse mod 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

TIMES, LEAST = 4, 6


class Catchers:
    """The catchers of a sequence of words, given as codes from 0.

    ``codes`` holds all texts, each followed by a code that occurs nowhere else.
    """

    def __init__(self, codes: np.ndarray, seed: int = 42):
        self.codes = codes
        n = len(codes)
        values = np.random.default_rng(seed).integers(0, 1 << 64, int(codes.max(initial=0)) + 1, dtype=np.uint64)
        power = np.full(n + 1, BASE, np.uint64)
        self.back = np.full(n + 1, INVERSE, np.uint64)
        power[0] = self.back[0] = 1
        np.cumprod(power, out=power)
        np.cumprod(self.back, out=self.back)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[codes] * power[:-1], out=self.sums[1:])

    def hashes(self, start: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the windows of ``length`` words at ``start``."""
        return (self.sums[start + length] - self.sums[start]) * self.back[start]

    def caught(self, block: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first block, last block, distance) of the merged squares of one size.

        Only the first ``n`` words are looked at.
        """
        windows = n - block + 1
        rows = -(-windows // block)
        h = np.zeros(rows * block, np.uint64)
        h[:windows] = (self.sums[block:n + 1] - self.sums[:windows]) * self.back[:windows]
        h = h.reshape(rows, block)
        hit = np.flatnonzero(h[1:] == h[:-1, :1])  # row: the block; column: its distance less one block
        hit = hit[hit < windows - block]
        key = np.sort((hit % block) * rows + hit // block)  # the blocks caught at one distance, in order
        cut = np.flatnonzero(np.diff(key) != 1)
        first, last = key[np.concatenate([[0], cut + 1])[:len(key)]], key[np.concatenate([cut, [len(key) - 1]])[:len(key)]]
        two = last > first
        first, last = first[two], last[two]
        return first % rows, last % rows, first // rows + block

    def widened(self, at: np.ndarray, q: np.ndarray, block: int, right: bool) -> np.ndarray:
        """Words (fewer than ``block``) by which the repetition goes on from ``at``."""
        more = np.zeros(len(at), np.int64)
        step = block // 2
        while step:
            start = at + more if right else at - more - step
            ok = np.flatnonzero(start + q + step <= len(self.codes) if right else start >= 0)
            same = self.hashes(start[ok], step) == self.hashes(start[ok] + q[ok], step)
            more[ok[same]] += step
            step //= 2
        return more

    def squares(self, n_at_least) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, period) of the merged squares of all sizes.

        ``n_at_least(m)``: so many first words hold all texts of ``m`` words or more.
        """
        found, block = [], 1
        while (n := n_at_least(TIMES * block)) > 2 * block:
            first, last, q = self.caught(block, n)
            start, end = first * block, (last + 1) * block
            start = start - self.widened(start, q, block, right=False)
            end = end + self.widened(end, q, block, right=True) + q
            found.append((start, end, q))
            block *= 2
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3

    def runs(self, n_at_least, times: int = TIMES, least: int = LEAST):
        """(start, length, period) of all runs, by start, then period."""
        start, end, q = self.squares(n_at_least)
        long = end - start >= np.maximum(least, times * q)
        start, end, q = self._exact(start[long], end[long], q[long], times, least)
        order = np.lexsort((q, end, start))
        start, end, q = start[order], end[order], q[order]
        first = np.ones(len(start), bool)  # of stretches with equal ends, the smallest period
        first[1:] = (np.diff(start) != 0) | (np.diff(end) != 0)
        start, end, q = start[first], end[first], q[first]
        order = np.lexsort((q, start))
        return start[order], (end - start)[order], q[order]

    def _exact(self, start, end, q, times, least):
        """The stretches, compared word by word where the hashes were wrong."""
        c, n, out = self.codes, len(self.codes), []
        order = np.lexsort((q, end, start))
        held = (-1, -1)
        for a, b, p in zip(start[order].tolist(), end[order].tolist(), q[order].tolist(), strict=True):
            if (a, b) == held:
                continue  # a multiple of the period just verified
            right = (np.array_equal(c[a:b - p], c[a + p:b]) and (a == 0 or c[a - 1] != c[a - 1 + p])
                     and (b == n or c[b] != c[b - p]))
            if right:
                held = (a, b)
                out.append((a, b, p))
                continue
            low, high = max(0, a - 2 * p), min(n, b + 2 * p)
            same = np.concatenate([[False], c[low:high - p] == c[low + p:high], [False]])
            edge = np.flatnonzero(same[1:] != same[:-1])
            out += [(low + x, low + y + p, p) for x, y in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)
                    if y - x + p >= max(least, times * p) and low + x >= a - p and low + y <= b + p]
        return tuple(np.array(x, np.int64) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def planted_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """The order of words that the contract gives some documents; None: as they are."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def text_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts, and the number of words of each; null has none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, bounds = lists.flatten(), np.asarray(lists.offsets).astype(np.int64)
    bounds = bounds - bounds[0]
    real = np.asarray(pc.greater(pc.binary_length(flat), 0))  # the ends of texts that start or end with white space
    before = np.concatenate([[0], np.cumsum(real)])
    return flat.filter(pa.array(real)), np.diff(before[bounds])


def _hex(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def _batch(ids: pa.Array, texts: pa.Array, orders, times: int, least: int) -> list[pa.Array]:
    """The result columns of one batch of texts."""
    words, sizes = text_words(texts)
    coded = words.dictionary_encode()
    code = np.asarray(coded.indices).astype(np.int64)
    ends = np.cumsum(sizes)
    source = np.arange(len(code))
    for i, doc in enumerate(ids.to_pylist()):
        order = orders(doc, int(sizes[i])) if orders else None
        if order is not None:
            source[ends[i] - sizes[i]:ends[i]] = ends[i] - sizes[i] + order
    code = code[source]

    # the longest texts first, each followed by its own mark
    by_size = np.argsort(-sizes, kind="stable")
    spans = sizes[by_size] + 1
    offset = np.cumsum(spans) - spans
    laid = len(coded.dictionary) + np.zeros(int(spans.sum()), np.int64)
    laid[offset + sizes[by_size]] += np.arange(len(sizes))
    begin = np.zeros(len(sizes), np.int64)
    begin[by_size] = offset
    laid[np.arange(len(code)) + np.repeat(begin - (ends - sizes), sizes)] = code

    def n_at_least(m: int) -> int:
        k = int(np.searchsorted(-sizes[by_size], -m, side="right"))
        return int(offset[k - 1] + spans[k - 1]) if k else 0

    start, length, q = Catchers(laid).runs(n_at_least, times, least)
    text = by_size[np.searchsorted(offset, start, side="right") - 1]

    # dropped: words of a run after its first period
    edge = np.zeros(len(laid) + 1, np.int64)
    np.add.at(edge, start + q, 1)
    np.add.at(edge, start + length, -1)
    place = np.arange(len(code)) + np.repeat(begin - (ends - sizes), sizes)
    keep = np.cumsum(edge)[place] == 0
    kept = np.concatenate([[0], np.cumsum(keep)])
    bounds = np.concatenate([[0], kept[ends]])
    lists = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()),
                                          words.cast(pa.large_string()).take(pa.array(source[keep])))
    collapsed = pc.binary_join(lists, pa.scalar(" ", pa.large_string()))

    report: list[list] = [[] for _ in range(len(sizes))]
    for t, s, n, p in zip(text.tolist(), (start - begin[text]).tolist(), length.tolist(), q.tolist(), strict=True):
        report[t].append((s, n, p))
    best: list[tuple | None] = []
    for rs in report:
        rs.sort(key=lambda r: (r[0], r[2]))
        top = None
        for r in rs:
            if top is None or r[1] * top[2] > top[1] * r[2]:
                top = r
        best.append(top)
    column = lambda k: pa.array([b[k] if b else None for b in best], pa.int64())
    none = _hex(b"")
    return [
        pa.array(list(map(len, report)), pa.int64()), column(0), column(1), column(2),
        pa.array([1000 * b[1] // b[2] if b else None for b in best], pa.int64()),
        pa.array([_hex("".join(f"{s},{n},{p}\n" for s, n, p in rs).encode()) if rs else none for rs in report]),
        pa.array([_hex(x.as_buffer() or b"") if x.is_valid else none for x in collapsed]),
    ]


COLUMNS = ("n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
           "runs_sha256 string, collapsed_sha256 string")


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", orders=None,
                  times: int = TIMES, least: int = LEAST) -> DataFrame:
    """The runs of each row's words, and the text without their repetitions.

    ``orders(id, n)`` may give the ``n`` words of a text another order first
    (None: as they are).  ``times`` is at least 4.

    Returns per row: id, n_runs; start, length, period and exponent_milli of the
    run with the greatest length / period (ties: the smallest start, then
    period; all null without a run); runs_sha256, of ``start,length,period`` and
    a line feed for every run by start, then period; collapsed_sha256, of the
    words that no run repeats, joined by spaces.

    Null, empty and blank texts have no words.  A very long text is one task's
    work, whole, in memory linear in its length.  Null or repeated ids and
    repeated rows are rows of their own.  An empty table gives no rows.  Other
    columns are not read, so their names cannot clash.
    """
    if times < TIMES or least < times:
        raise ValueError(f"runs of at least {TIMES} periods")
    rows = df.select(F.col(id_col), F.col(text_col).alias(f"{id_col}_text"))
    schema = f"`{id_col}` {rows.schema[0].dataType.simpleString()}, {COLUMNS}"
    names = [id_col, *(c.split()[0] for c in COLUMNS.split(", "))]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            done = 0
            for part in by_bytes(texts):
                own = ids.slice(done, len(part))
                done += len(part)
                yield pa.RecordBatch.from_arrays([own, *_batch(own, part, orders, times, least)], names)

    return rows.mapInArrow(found, schema)
