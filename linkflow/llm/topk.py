"""Exact top-k search by MaxScore over integer vectors.

The dimensions are the terms, and a term's postings are the components of all
rows of a shard.  A term's contribution to a query's score lies between two
bounds, from the smallest and the largest component of the shard.  Terms are
taken by falling width of these bounds.  With the k-th best score so far as
threshold, the narrowest terms whose bounds together cannot lift a row that is
worst in all others to the threshold are non-essential:

* the postings of the essential terms are traversed for all rows of a chunk,
* the others are probed for the rows that may still reach the threshold, a few
  terms at a time, and rows that no longer can are dropped.

Rows are dealt into shards and queries into blocks; a task searches one shard
for one block, and the shards' best are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 1024
PROBE = 8

_FOUND = "query_id bigint, vec_id bigint, score bigint"


def _matrix(column: pa.ChunkedArray, scale: int, width: int) -> np.ndarray:
    """Terms x rows of floor(scale * x); shorter vectors end in zeros."""
    lists = column.combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    n = np.diff(np.asarray(lists.offsets))
    out = np.zeros((len(lists), width))
    if len(lists):
        flat = np.floor(scale * np.asarray(lists.flatten(), dtype=np.float64))
        row = np.repeat(np.arange(len(n)), n)
        out[row, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = flat
    return np.ascontiguousarray(out.T)


def _exact(x: np.ndarray, q: np.ndarray) -> bool:
    """Whether doubles hold every sum of products exactly."""
    top = lambda m: float(np.abs(m).max()) if m.size else 0.0
    return top(x) * top(q) * 4 * max(1, len(x)) < 2.0**53


def search_one(x: np.ndarray, ids: np.ndarray, q: np.ndarray, own: int, k: int,
               low: np.ndarray, high: np.ndarray) -> list[tuple[int, int]]:
    """The k best (score, id) of the rows other than ``own``; ties to the smaller id."""
    at_low, at_high = q * low, q * high
    most = np.maximum(at_low, at_high)
    least = np.minimum(at_low, at_high)
    order = np.argsort(-(most - least).astype(np.float64), kind="stable")
    q, most, least = q[order], most[order], least[order]
    # what the terms from a place on can add at most
    rest = np.concatenate([np.cumsum(most[::-1])[::-1], [0]])
    worst = np.concatenate([[0], np.cumsum(least)])
    best_score, best_id = x[0, :0] if len(x) else np.zeros(0), ids[:0]
    for start in range(0, len(ids), CHUNK):
        chunk = slice(start, start + CHUNK)
        alive = np.flatnonzero(ids[chunk] != own)
        if len(best_id) >= k:
            bar = best_score[-1]
            # essential: the terms without which even the worst row could get there
            reach = worst + rest
            essential = max(1, int(np.argmax(reach < bar))) if (reach < bar).any() else len(q)
        else:
            bar, essential = None, len(q)
        terms = order[:essential]
        score = q[:essential] @ x[terms, chunk] if len(q) else np.zeros(len(ids[chunk]))
        score = score[alive]
        while essential < len(q):
            may = score + rest[essential] >= bar
            alive, score = alive[may], score[may]
            if not len(alive):
                break
            step = order[essential:essential + PROBE]
            score = score + q[essential:essential + PROBE] @ x[np.ix_(step, alive + start)]
            essential += len(step)
        if bar is not None:
            may = score >= bar
            alive, score = alive[may], score[may]
        if len(alive):
            best_score = np.concatenate([best_score, score])
            best_id = np.concatenate([best_id, ids[chunk][alive]])
            first = np.lexsort((best_id, -best_score))[:k]
            best_score, best_id = best_score[first], best_id[first]
    return list(zip(best_score.tolist(), best_id.tolist(), strict=True))


def _search(shard: pa.Table, block: pa.Table, k: int, scale: int) -> pa.Table:
    """The best of one shard for each query of one block."""
    found: list[tuple[int, int, int]] = []
    if shard.num_rows and block.num_rows:
        longest = lambda t: max(len(v) for v in t["v"])
        width = max(longest(shard), longest(block))
        x, q = _matrix(shard["v"], scale, width), _matrix(block["v"], scale, width)
        if not _exact(x, q):  # whole numbers of any size
            to_int = np.frompyfunc(int, 1, 1)
            x, q = to_int(x), to_int(q)
        ids = np.asarray(shard["vec_id"])
        low, high = (x.min(axis=1), x.max(axis=1)) if width else (x[:, 0], x[:, 0])
        for i, query in enumerate(block["vec_id"].to_pylist()):
            found += [(query, v, s) for s, v in search_one(x, ids, q[:, i], query, k, low, high)]
    fit = lambda s: max(-2**63, min(2**63 - 1, int(s)))
    return pa.table({"query_id": pa.array([f[0] for f in found], pa.int64()),
                     "vec_id": pa.array([f[1] for f in found], pa.int64()),
                     "score": pa.array([fit(f[2]) for f in found], pa.int64())})


def top_k(df: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
          scale: int = 1024, shard_rows: int = 8192, block_rows: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best rows.

    ``is_query``: the condition, a Column over ``df``, that makes a row a query.
    Score: inner product of floor(scale * component); ranks from 1, ties to the
    smaller id.  A query's own row is no candidate; with fewer than ``k`` others
    all are returned.

    Rows with a null id, a null vector or a null or non-finite component take
    no part.  An empty vector has score 0 with all; shorter vectors are filled
    with zeros.  Rows of one id count as one, with their smallest vector, and
    it is a query if any of them is.  Scores beyond 64 bits are held at the
    limit.  An empty table gives no rows.  Other columns are not read.
    """
    vector = F.col(vector_col).cast("array<double>")
    sound = ~F.exists(vector, lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    rows = df.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & sound) \
        .groupBy(F.col(id_col).cast("bigint").alias("vec_id")) \
        .agg(F.min(vector).alias("v"), F.max(F.coalesce(is_query, F.lit(False))).alias("asks"))
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).first()
    shards, blocks = -(-max(1, sizes["n"]) // shard_rows), -(-max(1, sizes["q"]) // block_rows)
    dealt = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = rows.select("vec_id", "v", dealt(shards).alias("shard")).withColumn("block", every(blocks))
    queries = rows.filter("asks").select("vec_id", "v", dealt(blocks).alias("block")).withColumn("shard", every(shards))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return _search(left, right, k, scale)

    found = candidates.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block")) \
        .applyInArrow(search, _FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


#: DuckDB twin over the ``embeddings`` table.
ORACLE = """
WITH sound AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM sound q JOIN sound c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
