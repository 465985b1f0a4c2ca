"""SimHash near-duplicates by pivot distance tables.

A document's fingerprint has a bit for each bit position that is set in more
than half of its shingles' hashes.  Fingerprints that differ in at most
``max_bits`` bits are linked, and linked documents form groups.

Equal fingerprints are one node, so a group of copies costs one row.  For the
other links:

* ``PIVOTS`` reference fingerprints give each node a table row of Hamming
  distances.  By the triangle inequality, two nodes within ``max_bits`` differ
  by at most that in every coordinate; pairs with a larger difference in any
  coordinate are discarded, and the survivors are verified on the bits.
* Which pairs are tried: the 64 bits are cut into ``max_bits + 2`` windows, and
  linked nodes agree in at least two of them, that is in their distances to
  every reference that varies within those windows.  Each pair of windows is a
  key, and nodes meet under equal keys.
* A key that more than ``crowd`` nodes share would try too many pairs.  Its
  nodes are linked through midpoints instead: two fingerprints are within two
  bits exactly if some word is within one bit of both, so every node names the
  65 words within one bit, and all that name a word are linked to the smallest
  of them.  At most 65 nodes name a word.  This is exact as well and emits no
  pairs, so nothing is capped.

The joins are merge joins: a table of fingerprints that is below the broadcast
threshold would still take several times that in the driver's memory.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkflow.llm.common import fresh, looked_up, saved
from linkflow.llm.components import components

PIVOTS = 16


def fingerprint(text: Column, shingle: int = 3, seed: int = 42) -> Column:
    """SimHash of each text as a signed 64-bit number; 0 for null or no word.

    A-Z is lower-cased; a text with fewer words than ``shingle`` has one
    shingle, the whole sequence.  Bytes are split and lower-cased as ASCII,
    which leaves every other character as it is.
    """

    def one(raw: bytes) -> int:
        w = raw.lower().split()
        if len(w) <= shingle:
            grams = [b" ".join(w)] if w else []
        else:
            grams = map(b" ".join, zip(*[w[i:] for i in range(shingle)], strict=False))
        hashes = np.fromiter((xxhash.xxh64_intdigest(g, seed) for g in grams), np.uint64)
        if not len(hashes):
            return 0
        ones = np.zeros(64, np.int64)
        for part in range(0, len(hashes), 1 << 16):  # bounds the unpacked bits of a long text
            block = hashes[part:part + (1 << 16)].astype(">u8")
            ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])

    @F.arrow_udf("bigint")
    def prints(texts: pa.Array) -> pa.Array:
        raw = texts.cast(pa.binary()) if texts.type == pa.string() else texts.cast(pa.large_binary())
        return pa.array([one(t.as_py() or b"") for t in raw], pa.int64())

    # evaluated once: a filter on the result must not repeat it below a join
    return prints.asNondeterministic()(text)


def pivots(n: int = PIVOTS, seed: int = 42) -> list[int]:
    """Reference fingerprints, as signed 64-bit numbers."""
    return np.random.default_rng(seed).integers(-2**63, 2**63 - 1, n, dtype=np.int64).tolist()


def bits(a: Column, b: Column) -> Column:
    """Number of bits in which two fingerprints differ."""
    return F.bit_count(a.bitwiseXOR(b))


def _window_keys(fp: Column, max_bits: int) -> Column:
    """Array of (which windows, their bits): one for each pair of windows.

    The bits of a window are the one-to-one short form of its distances to the
    references that vary within it (the zero word and each single bit).
    """
    n = max_bits + 2
    edges = [64 * i // n for i in range(n + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in itertools.pairwise(edges)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return F.array(*[F.struct(F.lit(i).alias("windows"), fp.bitwiseAND(F.lit(signed(a | b))).alias("part"))
                     for i, (a, b) in enumerate(itertools.combinations(masks, 2))])


def links(nodes: DataFrame, max_bits: int = 2, crowd: int = 32, n_pivots: int = PIVOTS) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints (``fp``) within ``max_bits``.

    All links between nodes that meet under a key of at most ``crowd`` nodes;
    for the others, links that connect the same nodes.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("links are of at most two bits")
    refs = pivots(n_pivots)
    table = nodes.select("fp", F.array(*[bits(F.col("fp"), F.lit(p)).cast("tinyint") for p in refs]).alias("far"))
    keyed = table.select("fp", "far", F.explode(_window_keys(F.col("fp"), max_bits)).alias("k")) \
        .select("fp", "far", "k.windows", "k.part")
    shared = keyed.groupBy("windows", "part").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = saved(keyed.join(shared.hint("merge"), ["windows", "part"]), "simhash-keys")

    few = met.filter(F.col("n") <= crowd)
    a, b = few.alias("a"), few.alias("b")
    apart = F.lit(False)
    for i in range(n_pivots):
        apart = apart | (F.abs(F.col("a.far")[i] - F.col("b.far")[i]) > max_bits)
    on = ((F.col("a.windows") == F.col("b.windows")) & (F.col("a.part") == F.col("b.part"))
          & (F.col("a.fp") < F.col("b.fp")) & ~apart
          & (bits(F.col("a.fp"), F.col("b.fp")) <= max_bits))
    near = a.join(b.hint("merge"), on).select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))

    crowded = met.filter(F.col("n") > crowd).select("fp").distinct()
    flips = F.array(F.lit(0).cast("bigint"), *[F.lit(-2**63 if i == 63 else 1 << i) for i in range(64)])
    named = crowded.select("fp", F.explode(flips).alias("flip")) \
        .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("word"))
    if max_bits == 2:
        named = named.withColumn("v", F.min("fp").over(Window.partitionBy("word")))
    else:  # a word that is itself a node is a link of one bit
        named = named.join(crowded.select(F.col("fp").alias("v")).hint("merge"), F.col("word") == F.col("v"))
    through = named.filter((F.col("fp") != F.col("v")) & (bits(F.col("fp"), F.col("v")) <= max_bits)) \
        .select(F.col("fp").alias("u"), "v")
    return near.unionByName(through)


def groups(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """(fp, component) of each distinct non-null ``fp``; component: a fingerprint of it."""
    nodes = prints.select("fp").distinct()
    linked = components(links(nodes, max_bits))
    joined = nodes.join(linked.hint("merge"), nodes.fp == linked.node, "left")
    return joined.select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2, seed: int = 42) -> DataFrame:
    """(id, fingerprint, component_id) of every row.

    ``fingerprint``: 16 lowercase hex digits.  ``component_id``: the smallest
    non-null id that links reach, null only if all of them are null.

    Texts without a word (null, empty, white space) have fingerprint zero and
    are linked like any other.  Null or repeated ids and repeated rows are rows
    of their own, in the same component.  Very long texts are read whole.
    An empty table gives no rows.  Other
    columns are not read.
    """
    prints = saved(df.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle, seed).alias("fp")),
                   "simhash-prints")
    of = saved(groups(prints, max_bits), "simhash-groups")
    least = prints.groupBy("fp").agg(F.min("id").alias("id"))
    smallest = of.join(least.hint("merge"), "fp").groupBy("component").agg(F.min("id").alias("component_id"))
    named = looked_up(of, smallest, "component").select("fp", "component_id")
    return prints.join(named.hint("merge"), "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             max_bits: int = 2, seed: int = 42) -> DataFrame:
    """The rows of ``df``, one of each near-duplicate group, all columns as they are.

    Kept: the row with the smallest id (null ids last); of repeated ids, the
    one with the smallest text hash; of equal rows, one.  Documents meet their
    group under (fingerprint, id), so that copies are dealt over many tasks.
    """
    fp, key, keep = fresh(df, "fp__"), fresh(df, "key__"), fresh(df, "keep__")
    hashed = lambda c: F.xxhash64(c, F.col(c).isNull())  # noqa: E731  never null
    marked = df.withColumn(fp, fingerprint(F.col(text_col), shingle, seed)).withColumn(key, hashed(id_col))
    prints = saved(marked.select(F.col(fp).alias("fp"), F.col(id_col).alias("id")), "simhash-prints")
    of = saved(groups(prints, max_bits), "simhash-groups")
    first = F.min_by(F.struct("fp", "id"), F.struct(F.col("id").isNull(), "id", "fp")).alias("first")
    per_print = prints.groupBy("fp").agg(F.min("id").alias("id"))
    chosen = of.join(per_print.hint("merge"), "fp").groupBy("component").agg(first).select("first.*") \
        .select(F.col("fp").alias("fp_c"), hashed("id").alias("key_c"))
    met = marked.join(chosen.hint("merge"), (F.col(fp) == chosen.fp_c) & (F.col(key) == chosen.key_c), "left_semi")
    one = Window.partitionBy(fp, key).orderBy(F.col(id_col).asc_nulls_last(), F.xxhash64(text_col))
    return met.withColumn(keep, F.row_number().over(one)).filter(F.col(keep) == 1).select(*df.columns)
