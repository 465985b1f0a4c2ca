"""Mixing sources to target weights by subset-sum budget fitting.

Sources, in code point order with null last, have the weights 3, 1, 2 in turn
and share a budget of 150 % of all words.  A source can give each document at
most twice, so a target stops at twice the source's size and the excess goes
to the others by weight.

A source whose target is its size or more gives every document once.  The rest
of its budget is a bounded knapsack over the number of documents of each exact
length: an even share of every length first, then the largest lengths that
fit, and for the last stretch a dynamic program that finds the combination of
the documents left whose sum comes closest.  Where that misses the target, the
documents taken before are given back for a longer and longer stretch, up to the
whole target.  Documents of a length are taken in a seeded order.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkflow.llm.common import ranked, saved, words

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
LIMIT = 2.0
#: Words of budget that the dynamic program covers at first.
REACH = 1 << 15
#: Bytes of records that the program may hold for a longer stretch, and the
#: bytes that it may go through for each of them.
ROOM, PASSES = 1 << 28, 32


def n_words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.size(words(F.coalesce(text, F.lit("")))).cast("bigint")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """Adds ``target`` to (no_source, source_key, source_size), one row per source.

    Resharing the excess by weight until no source is above its stop ends at
    ``min(stop, level * weight)`` with one level for all.  In order of
    stop / weight the stopped sources come first, so the level is found from
    running sums: it is the first one under which the rest stay.

    These windows are over one row per source, not over documents.
    """
    order = Window.orderBy("no_source", "source_key")
    number = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (number + 1).cast("int"))
    t = sizes.withColumn("weight__", weight).withColumn("stop__", F.col("source_size") * limit)
    t = t.withColumn("ratio__", F.col("stop__") / F.col("weight__"))
    by_ratio = Window.orderBy("ratio__", "no_source", "source_key")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(whole) * share
    level = (budget - F.coalesce(F.sum("stop__").over(before), F.lit(0.0))) / F.sum("weight__").over(after)
    t = t.withColumn("level__", level)
    # the level at the first source that its own level does not stop
    open_level = F.when(F.col("level__") <= F.col("ratio__"), F.col("level__"))
    t = t.withColumn("level__", F.coalesce(F.first(open_level, ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(float("inf"))))
    target = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(
        F.least(F.col("stop__").cast("double"), F.col("level__") * F.col("weight__")))
    return t.withColumn("target", target).drop("weight__", "stop__", "ratio__", "level__")


def fit_budget(counts: dict[int, int], budget: int, reach: int = REACH) -> dict[int, int]:
    """How many documents of each length to take so that the words sum to ``budget``.

    The sum never exceeds the budget.  Within ``reach`` words of it the search
    is exact over all lengths that still fit.  If the sum is not the highest
    that the lengths' common divisor allows, the search is done again over
    twice the stretch, until it is, the stretch is the budget (then no sum is
    closer) or the program has no room; the closest sum counts.
    """
    total = sum(length * n for length, n in counts.items())
    lengths = sorted((v for v in counts if v > 0), reverse=True)
    if budget >= total:
        return {v: counts[v] for v in lengths}
    best = _fit(counts, lengths, budget, total, reach)
    goal, met = budget - budget % math.gcd(*lengths), _sum(best)
    room = [ROOM, ROOM * PASSES]
    while met < goal and reach < budget and min(room) > 0:
        reach *= 2
        room = [ROOM, ROOM * PASSES]
        again = _fit(counts, lengths, budget, total, reach, room)
        if _sum(again) > met:
            best, met = again, _sum(again)
    return best


def _sum(taken: dict[int, int]) -> int:
    return sum(v * n for v, n in taken.items())


def _fit(counts: dict[int, int], lengths: list[int], budget: int, total: int, reach: int,
         room: list[int] | None = None) -> dict[int, int]:
    """One search; with ``room`` the last ``reach`` words of the budget are all left to the program."""
    share = budget if room is None else max(0, budget - reach)
    kept = reach // 2 if room is None else reach
    # an even share keeps the mix of lengths; whole numbers, so rounded down
    taken = {v: counts[v] * share // total for v in lengths}
    rest = budget - _sum(taken)
    for v in lengths:
        more = min(counts[v] - taken[v], max(0, rest - kept) // v)
        taken[v] += more
        rest -= more * v
    if room is None and rest > reach:  # too few small documents: what is left are longer ones
        for v in lengths:
            more = min(counts[v] - taken[v], rest // v)
            taken[v] += more
            rest -= more * v
        return taken
    left = {v: counts[v] - taken[v] for v in lengths if counts[v] > taken[v] and v <= rest}
    for v in _closest(left, rest, room):
        taken[v] += 1
    return taken


def _closest(counts: dict[int, int], budget: int, room: list[int] | None = None) -> list[int]:
    """Lengths, with repeats up to their counts, whose sum is the largest up to ``budget``.

    ``reached`` has a bit for each sum.  Each added copy of a length records
    the sums that it reaches first; from the best sum, the records lead back.
    A sum is in one record, so the sums of sparse records are kept as numbers:
    the records of many copies then hold as much as the sums, not as the copies.
    ``room``: bytes left for records and for passes; without any left, the
    lengths that remain are not added.
    """
    mask = (1 << (budget + 1)) - 1
    reached = 1
    records: list[tuple[int, int | np.ndarray]] = []
    for v in sorted(counts, reverse=True):
        last = reached
        for _ in range(min(counts[v], budget // v)):
            last = (last << v) & mask & ~reached
            if room:
                room[0] -= last.bit_length() // 8
                room[1] -= budget // 8
            if not last:
                break
            reached |= last
            records.append((v, _sparse(last)))
            if room and min(room) <= 0:
                break
        if reached >> budget & 1 or room and min(room) <= 0:
            break
    at = reached.bit_length() - 1
    out = []
    for v, new in reversed(records):
        if at and _holds(new, at):
            out.append(v)
            at -= v
    return out


def _sparse(bits: int) -> int | np.ndarray:
    """The places of the set bits, in order, where they take less room than the bits."""
    if bits.bit_count() * 32 >= bits.bit_length():
        return bits
    raw = np.frombuffer(bits.to_bytes(-(-bits.bit_length() // 8), "little"), np.uint8)
    some = np.flatnonzero(raw)
    row, bit = np.nonzero(np.unpackbits(raw[some, None], axis=1, bitorder="little"))
    places = some[row] * 8 + bit
    return places.astype(np.uint32) if bits.bit_length() <= 1 << 32 else places


def _holds(record: int | np.ndarray, at: int) -> bool:
    if isinstance(record, int):
        return bool(record >> at & 1)
    i = int(np.searchsorted(record, at))
    return i < len(record) and int(record[i]) == at


def _plan(group: pd.DataFrame) -> pd.DataFrame:
    """The lengths of one source, with how often all and how many more are taken."""
    size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
    budget = round(target)
    whole = 1 if budget >= size else 0
    counts = dict(zip(group["size"].tolist(), group["n"].tolist(), strict=True))
    more = fit_budget(counts, budget - whole * size)
    group["whole"] = whole
    group["more"] = [more.get(v, 0) for v in group["size"].tolist()]
    return group.drop(columns="n")


_SOURCE = ["no_source", "source_key"]
_LENGTH = [*_SOURCE, "size"]


def _keyed(df: DataFrame, text: str, source: str) -> DataFrame:
    """Adds the non-null source key, null last, and the size."""
    return df.withColumns({"no_source": F.col(source).isNull(),
                           "source_key": F.coalesce(F.col(source).cast("string"), F.lit("")),
                           "size": n_words(F.col(text))})


def plan(keyed: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """For each length of each source: its target, how often all documents are
    taken (``whole``), and how many of them once more (``more``)."""
    histogram = saved(keyed.groupBy(*_LENGTH).agg(F.count(F.lit(1)).alias("n")), "mixing-lengths")
    sizes = histogram.groupBy(*_SOURCE).agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    joined = histogram.join(targets(sizes, weights, share, limit), _SOURCE)
    schema = ("no_source boolean, source_key string, size bigint, source_size bigint, target double, "
              "whole int, more bigint")
    return saved(joined.groupBy(*_SOURCE).applyInPandas(_plan, schema), "mixing-plan")


def _taken(keyed: DataFrame, planned: DataFrame, ident: list[str], seed: int) -> DataFrame:
    """Adds ``copies``: how often the mix has the document.

    The documents of a length are taken in the order of a seeded hash, which
    also deals a frequent length over the tasks.
    """
    dealt = keyed.withColumn("order__", F.xxhash64(F.lit(seed), *ident))
    rows = ranked(dealt, _LENGTH, ["order__", *ident], "rank__", carry=planned)
    more = F.when(F.col("rank__") < F.col("more"), 1).otherwise(0)
    return rows.withColumn("copies", F.col("whole") + more)


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT, seed: int = 42) -> DataFrame:
    """(id, size, source_size, target, taken) of every row.

    ``taken``: the words that the mix has of the document, 0, 1 or 2 times its
    size.  A group that a task plans is one source's histogram, a row per
    distinct length, never its documents.

    Null and empty texts have size 0 and none taken.  A null source is a source
    of its own, the last.  Null or repeated ids and repeated rows are documents
    of their own; equal rows are interchangeable, so one of them may be taken
    more often than the other.  Very long texts are measured whole.
    An empty table gives no rows.  Other columns
    are not read.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"))
    narrow = saved(_keyed(rows, "text", "source").select("id", *_LENGTH), "mixing-sizes")
    out = _taken(narrow, plan(narrow, weights, share, limit), ["id"], seed)
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target",
                      (F.col("size") * F.col("copies")).cast("bigint").alias("taken"))


def repeated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT, seed: int = 42) -> DataFrame:
    """The rows of ``df`` as often as ``mix`` takes them, all columns as they are.

    Documents without a word are in the mix as often as their source as a
    whole, so a source below its target keeps them.
    """
    inner = {c: f"c{i}__" for i, c in enumerate(df.columns)}  # free for names of our own
    rows = _keyed(df.toDF(*inner.values()), inner[text_col], inner[source_col]) \
        .withColumn("hash__", F.xxhash64(inner[text_col]))
    out = _taken(rows, plan(rows, weights, share, limit), [inner[id_col], "hash__"], seed)
    each = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return out.filter("copies > 0").withColumn("copy__", each) \
        .select(*[F.col(v).alias(k) for k, v in inner.items()])
