"""JSON-lines message dumps: landing (write) and scanning (read).

A landing batch is written as one Spark output folder named like a dump
file, ``{topic}_{stamp}.jsonl``; a dump folder may equally hold plain
``.jsonl`` files from another writer.  The scanner takes a path glob, so it
matches both, and reads with ``text`` + ``from_json`` rather than
``read.json``: blank lines, broken lines and lines that are not a JSON
object are skipped instead of becoming all-NULL rows, and a line holding a
JSON array is not expanded into rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkflow.functions.columns import iso_text
from linkflow.schemas import DUMP_SCHEMA
from linkflow.session import prepare_session

DUMP_FIELDS = ("topic", "partition", "offset", "timestamp", "key", "value", "value_json", "dumped_at")


def dump_line(df: DataFrame) -> Column:
    """One JSON line per landed message (``value_json`` embedded as JSON)."""
    cols = []
    for c in DUMP_FIELDS:
        if c not in df.columns:
            continue
        if c == "value_json":
            continue
        cols.append(F.col(c))
    head = F.to_json(F.struct(*cols))
    if "value_json" not in df.columns:
        return head
    vj = F.col("value_json")
    return F.when(vj.isNull(), head).otherwise(
        F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"value_json":'), vj, F.lit("}")))


def write_jsonl(lines: DataFrame, folder: str, name: str, mode: str = "overwrite") -> str:
    """Write a single-column frame of JSON lines as landing batch ``name``."""
    path = f"{folder.rstrip('/')}/{name}"
    lines.toDF("value").write.mode(mode).text(path)
    return path


def land_dump(dump: DataFrame, folder: str, name: str) -> str:
    """Write a dump frame as one landing batch of JSON lines."""
    return write_jsonl(dump.select(dump_line(dump).alias("value")), folder, name)


def dump_glob(folder: str, topic: str | None = None) -> str:
    return f"{folder.rstrip('/')}/{topic}_*.jsonl" if topic else f"{folder.rstrip('/')}/*.jsonl"


def parse_dump_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Text lines -> dump records; blank, unparseable and non-object lines
    are skipped and counted (observed metrics ``dump_scan_<n>``: ``lines``,
    ``skipped``).  The observation also keeps later filters from being
    pushed into -- and re-running -- the line parse."""
    from linkflow.operators.quality import metrics_name
    t = F.trim(F.col(line_col))
    keep = [c for c in lines.columns if c != line_col]
    parsed = lines.select(*keep, ((t != "") & F.json_object_keys(t).isNotNull()).alias("_ok"),
                          F.from_json(t, DUMP_SCHEMA).alias("r"))
    parsed = parsed.observe(metrics_name("dump_scan"), F.count(F.lit(1)).alias("lines"),
                            F.count_if(~F.col("_ok")).alias("skipped"))
    return parsed.filter("_ok").select(*keep, "r.*")


def read_jsonl_dump(spark: SparkSession, folder: str, topic: str | None = None,
                    with_file: bool = False) -> DataFrame:
    """Scan ``{topic}_*.jsonl`` (or ``*.jsonl``) under ``folder``.

    ``partition``/``offset`` come back as text (a broken dump may hold
    anything there); layers ``try_cast`` them.  With ``with_file`` the
    landing file (``source_file``) is kept for first-wins loading.
    """
    prepare_session(spark)
    raw = spark.read.text(dump_glob(folder, topic))
    if with_file:
        raw = raw.withColumn("source_file", _batch_name(F.col("_metadata.file_path")))
    return parse_dump_lines(raw)


def _batch_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+\.jsonl)(/[^/]*)?$", 1)


def landed_files(spark: SparkSession, folder: str, topic: str | None = None) -> DataFrame:
    """``source_file`` of every landing file, from the listing alone (no
    content is read), so files without a valid line count too."""
    files = spark.read.format("binaryFile").load(dump_glob(folder, topic)).select("path")
    return files.select(_batch_name(F.col("path")).alias("source_file")).distinct()


def land_batches(folder: str, topic: str):
    """``foreachBatch`` callback that lands Kafka rows as JSON-lines batches.

    A retried micro-batch overwrites its own batch, so lines land once."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        land_dump(landing_frame(batch), folder, f"{topic}_{batch_id:08d}.jsonl")

    return fn


def landing_frame(kafka_rows: DataFrame, dumped_at: Column | None = None) -> DataFrame:
    """Kafka source rows -> dump records: decoded key/value, ``[type, ms]``
    timestamp, ``value_json`` (the value when it is a JSON object, else
    NULL) and the landing time ``dumped_at`` as ISO text (default: now)."""
    from linkflow.sources.kafka import shape_kafka
    shaped = shape_kafka(kafka_rows)
    v = F.col("value")
    return shaped.select(
        "topic", "partition", "offset",
        F.array(F.col("timestampType").cast("bigint"), F.unix_millis("timestamp")).alias("timestamp"),
        "key", "value",
        F.when(F.json_object_keys(v).isNotNull(), v).alias("value_json"),
        iso_text(dumped_at if dumped_at is not None else F.current_timestamp()).alias("dumped_at"),
    )
