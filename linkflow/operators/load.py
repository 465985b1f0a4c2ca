"""Local observation load: normalise, flatten, insert-or-ignore by
(topic, partition, offset).

Within one load the first row of a key in (landing file, line) order wins;
``dumped_at`` grows along a landing file, so it stands for the line order.
Rows whose key has a NULL part never conflict (a NULL never equals anything)
and are all kept.  Against an existing table only new keys are inserted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkflow.functions.columns import to_ts
from linkflow.operators.ingest import flatten_observations, normalize_payload
from linkflow.operators.latest import first_by, insert_only
from linkflow.schemas import OBSERVATION_COLUMNS

PK = ["topic", "partition", "offset"]


def load_observations(dump: DataFrame, existing: DataFrame | None = None,
                      columns: Sequence[str] = OBSERVATION_COLUMNS) -> DataFrame:
    """Observation rows a load inserts (``existing=None``: an empty table),
    restricted to ``columns`` (the key columns are always kept).

    One pass: the first-wins pick is a ``min_by`` aggregation per key (map-
    side partial aggregation, so a replayed hot key never gathers in one
    task).  A row with a NULL key part gets a unique row tag as an extra
    grouping key, so it never conflicts and is kept as it is.  Only
    ``columns`` are packed into the aggregation, so a reader that needs a
    few columns does not shuffle the payload text.
    """
    cols = list(PK) + [c for c in columns if c not in PK]
    has_file = "source_file" in dump.columns
    f = flatten_observations(normalize_payload(dump), carry=("source_file",) if has_file else ())
    f = f.withColumn("_file", F.col("source_file") if has_file else F.lit(""))
    # a landing time that cannot be read comes last, not first
    f = f.withColumn("_seq", F.coalesce(to_ts("dumped_at"), F.to_timestamp(F.lit("9999-12-31"))))
    key_ok = F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("offset").isNotNull()
    f = f.withColumn("_nk", F.when(key_ok, F.lit(None).cast("bigint")).otherwise(F.monotonically_increasing_id()))
    rest = [c for c in cols if c not in PK]
    # rows with equal hashes are equal, so the hash ends the order and the
    # ordering struct does not carry the row a second time
    f = f.withColumn("_hash", F.xxhash64(*rest))
    order = ["_file", "_seq", "dumped_at", "_hash"]
    out = first_by(f, PK + ["_nk"], order, rest).select(*cols)
    if existing is not None:
        out = insert_only(out, existing, PK)
    return out


def observation_table(spark, obs: DataFrame) -> DataFrame:
    """Write loaded observations as a table in the shared scratch folder
    and read it back (the table the dashboards query).

    Instants are typed once here, and the table is partitioned by interval day,
    so that a window reads its days only; large days are split over files."""
    from linkflow.session import scratch_path
    path = scratch_path(spark, "observations")
    typed = obs.withColumns({c: to_ts(c) for c in ("interval_start", "dumped_at") if c in obs.columns})
    by_day = typed.withColumn("interval_day", F.to_date("interval_start")).hint("rebalance", "interval_day")
    by_day.write.partitionBy("interval_day").parquet(path)
    return spark.read.parquet(path)


def load_summary(dump_with_files: DataFrame, landed: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """``files, inserted``: landing files read (``landed``: a row per file with
    its ``source_file``, with or without a valid line) and rows a load inserts."""
    files = landed.select(F.count_distinct("source_file")).scalar()
    inserted = load_observations(dump_with_files, existing, columns=["dumped_at"]).agg(F.count(F.lit(1)).alias("inserted"))
    return inserted.select(files.alias("files"), "inserted")
