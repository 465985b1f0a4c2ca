"""Landing health report and consumer lag.

The anchor instant of a recency filter (``as_of``) is a parameter; when it
is a frame-derived maximum it is a scalar subquery (computed once by a
one-row aggregate, then inlined as a literal) -- no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkflow.functions.columns import hour_local_bucket, tcast, to_ts

# Defaults of the status check.
DEFAULT_SINCE_MINUTES = 120
DEFAULT_BUCKET_MINUTES = 5
TOP_KEYS = 10
NEVER_COMMITTED = -1001


def landed(dump: DataFrame) -> DataFrame:
    """Dump records with a parseable landing time (``dumped_at_ts``)."""
    return dump.withColumn("dumped_at_ts", to_ts(F.col("dumped_at").cast("string"))) \
               .filter(F.col("dumped_at_ts").isNotNull())


def latest_landing(dump: DataFrame) -> Column:
    """max(dumped_at) of a dump as a scalar subquery column."""
    return landed(dump).select(F.max("dumped_at_ts")).scalar()


def recent(dump: DataFrame, since_minutes: int | None = DEFAULT_SINCE_MINUTES,
           as_of: Column | None = None) -> DataFrame:
    """Records landed at or after ``as_of - since_minutes`` (``as_of``
    defaults to the current time); ``since_minutes=None`` keeps all."""
    df = landed(dump)
    if since_minutes is None:
        return df
    anchor = as_of if as_of is not None else F.current_timestamp()
    return df.filter(F.col("dumped_at_ts") >= anchor - F.make_interval(mins=F.lit(since_minutes)))


def buckets(df: DataFrame, minutes: int = DEFAULT_BUCKET_MINUTES) -> DataFrame:
    """Messages per ``minutes`` bucket floored within the UTC hour."""
    return (df.groupBy(hour_local_bucket("dumped_at_ts", minutes).alias("bucket"))
              .agg(F.count(F.lit(1)).alias("n")).orderBy("bucket"))


def top_keys(df: DataFrame, k: int = TOP_KEYS) -> DataFrame:
    """The ``k`` most frequent non-NULL keys (ties by key text)."""
    counts = (df.filter(F.col("key").isNotNull())
                .groupBy(F.col("key").cast("string").alias("key"))
                .agg(F.count(F.lit(1)).alias("n")))
    return counts.orderBy(F.desc("n"), F.asc("key")).limit(k)


def max_offsets(df: DataFrame) -> DataFrame:
    """Max offset per partition; rows whose partition or offset is not an
    integer are skipped."""
    typed = df.select(tcast(F.col("partition").cast("string"), "int").alias("partition"),
                      tcast(F.col("offset").cast("string"), "bigint").alias("offset"))
    return (typed.filter(F.col("partition").isNotNull() & F.col("offset").isNotNull())
                 .groupBy("partition").agg(F.max("offset").alias("max_offset")).orderBy("partition"))


def summary(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("messages_seen"))


def consumer_lag(offsets: DataFrame, *carry: str) -> DataFrame:
    """Lag per partition: never committed (NULL or negative) -> end - begin;
    otherwise max(0, end - committed).  ``carry``: columns kept beside it."""
    b, e, c = F.col("begin_offset"), F.col("end_offset"), F.col("committed_offset")
    lag = F.when(c.isNull() | (c < 0), e - b).otherwise(F.greatest(F.lit(0), e - c))
    return offsets.select("partition", "begin_offset", "end_offset", "committed_offset",
                          lag.cast("bigint").alias("lag"), *carry)


def lag_totals(lag: DataFrame) -> DataFrame:
    """available = max(0, sum(end) - sum(begin)); lag = sum(lag)."""
    return lag.agg(
        F.greatest(F.lit(0), F.sum("end_offset") - F.sum("begin_offset")).cast("bigint").alias("available"),
        F.sum("lag").cast("bigint").alias("lag"),
    )
