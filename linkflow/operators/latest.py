"""Latest/first row per key and insert-only merge.

``latest_by`` / ``first_by`` use ``max_by`` / ``min_by`` over a struct of
the wanted columns, ordered by a struct of (sequence, tiebreak...).  Spark
plans this as a (sort-based, since the buffer holds a struct) aggregation
with map-side partial aggregation: every map task reduces each key --
even one holding a third of all rows -- to a single row before the
shuffle, so the shuffle carries at most one row per key per task and no
task ever receives a whole hot group.  ``row_number()`` over a window would
instead shuffle every row of the group into one task and sort it there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_V = "__winner"


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
          fn, columns: Sequence[str] | None) -> DataFrame:
    keys = list(keys)
    cols = [c for c in (columns if columns is not None else df.columns) if c not in keys]
    ordering = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    packed = F.struct(*[F.col(c) for c in cols])
    agg = df.groupBy(*keys).agg(fn(packed, ordering).alias(_V))
    return agg.select(*[F.col(k) for k in keys], *[F.col(f"{_V}.{c}").alias(c) for c in cols])


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
              columns: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order`` tuple.

    ``order`` lists the sequence column first, then unique tiebreak columns
    (e.g. topic, partition, offset) so the winner is deterministic.  NULLs
    in the sequence sort lowest (a sequenced row beats an unsequenced one).
    """
    return _pick(df, keys, order, F.max_by, columns)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
             columns: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order`` tuple."""
    return _pick(df, keys, order, F.min_by, columns)


def insert_only(batch: DataFrame, target: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target`` (MERGE ... WHEN NOT
    MATCHED THEN INSERT).  NULL key parts never match, and duplicates inside
    the batch are all kept, as with a MERGE.  Only the target's key columns
    are read and de-duplicated (partial aggregation) before the anti-join."""
    if target is None:
        return batch
    tk = target.select(*[F.col(k).alias(f"__t_{k}") for k in keys]).dropDuplicates()
    cond = None
    for k in keys:
        c = F.col(k) == F.col(f"__t_{k}")
        cond = c if cond is None else (cond & c)
    return batch.join(tk, cond, "left_anti")
